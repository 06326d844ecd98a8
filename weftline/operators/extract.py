"""Facts from texts: a table of patterns, each with a rule's number, what it captures and what follows from it.

Each pattern is found in whole texts, left to right and without overlap; one
projection finds all patterns of a phase, and one explode makes rows of them.
The order of facts is (phase, rule or entry, place), as first values win later.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as T

_N = r"([A-Z][a-z]{2,})"
_KIN = "(?:son|daughter|wife|brother|sister|father|mother|husband)"


class Rule(NamedTuple):
    """a and b are the groups of subject and object (0: none); gender_* become known; attr of the subject is the object."""

    name: str
    pattern: str
    a: int = 1
    b: int = 0
    gender_a: str | None = None
    gender_b: str | None = None
    attr: str | None = None
    least: int = 1


#: Fixed values, from here to DUTIES: patterns of names and relations, in the order in which they are believed.
#: Names in chapters, with the number of times that a name must be found.
CHAPTER_NAMES = (
    Rule("speech", rf"[‘’']{_N}\s+(?:said|spoke|asked|replied|answered|told|addressed|continued|recounted)"),
    Rule("vocative", rf"O\s+{_N}!", least=5),
    Rule("titled", rf"(?:King|Prince|Sage|Rishi|Queen|Princess|Maharaja)\s+{_N}", least=3),
    Rule("kin", rf"{_N}’s\s+{_KIN}", least=3),
    Rule("frequent", r"([A-Z](?<![\p{L}\p{N}_][A-Z])[a-z]{3,}+)(?![\p{L}\p{N}_])", least=50),
)
#: Relations in chapters.
CHAPTER_RELATIONS = (
    Rule("son of", rf"{_N},?\s+(?:the\s+)?son\s+of\s+{_N}", 1, 2, "Male", "Male", "father"),
    Rule("daughter of", rf"{_N},?\s+(?:the\s+)?daughter\s+of\s+{_N}", 1, 2, "Female", None, "father"),
    Rule("wife", rf"{_N}’s\s+wife,?\s+{_N}", 1, 2, "Male", "Female", "wife"),
    Rule("brother", rf"{_N}’s\s+brother,?\s+{_N}", 1, 2, "Male", "Male", "sibling"),
    Rule("sister", rf"{_N}’s\s+sister,?\s+{_N}", 1, 2, None, "Female", "sibling"),
    Rule("mother", rf"{_N}’s\s+mother,?\s+{_N}", 1, 2, None, "Female", "mother"),
    Rule("father", rf"{_N}’s\s+father,?\s+{_N}", 1, 2, None, "Male", "father"),
)
#: Relations in notes; a note's rules come before the next note's.
NOTE_RELATIONS = (
    Rule("was son of", rf"{_N}\s+was\s+(?:the\s+)?(?:son|child)\s+of\s+{_N}", 1, 2, "Male", None, "father"),
    Rule("was daughter of", rf"{_N}\s+was\s+(?:the\s+)?daughter\s+of\s+{_N}", 1, 2, "Female", None, "father"),
    Rule("was wife of", rf"{_N}\s+was\s+(?:the\s+)?wife\s+of\s+{_N}", 2, 1, "Male", "Female", "wife"),
    Rule("son", rf"{_N}’s\s+son,?\s+{_N}", 2, 1, "Male", None, "father"),
)
#: Duty and caste of titles, first come first.
DUTIES = (
    ("King", "King", "Kshatriya"),
    ("Queen", "Queen", "Kshatriya"),
    ("Prince", "Prince", "Kshatriya"),
    ("Princess", "Princess", "Kshatriya"),
    ("Sage", "Sage", "Brahmin"),
    ("Rishi", "Sage", "Brahmin"),
    ("Maharaja", "King", "Kshatriya"),
)
#: Who is a woman by title; and what notes say at their start, of rulers, of kin, and of other names.
WOMEN = r"(?:Queen|Princess)\s+([A-Z][a-z]+)"
SUBJECT = r"^([A-Z][\w-]+)\.\s+(?:He|She|It|The|This|One|A )"
RULER = r"^([A-Z][\w-]+),?\s+(?:the\s+)?(?:king|queen|prince|princess|ruler|chief) of\s+[A-Z][\w-]+"
KIN = (rf"([A-Z][\w'-]+)’s\s+{_KIN}", r"(?:son|daughter|wife|brother|sister) of\s+([A-Z][\w'-]+)")
ALSO = r"(?i)([A-Z][\w-]+)[\s,]+(?:is\s+)?also\s+(?:known|called)\s+as\s+([A-Z][\w-]+)"
KING_OF = rf"{_N},?\s+(?:the\s+)?king\s+of\s+{_N}"


def note_entries(notes: DataFrame, volume: str, text: str) -> DataFrame:
    """volume, entry, n and body: notes begin with a number at the start of a line, and end before the next such line."""
    parts = F.split(F.concat(F.lit("\n"), F.col(text)), r"\n(?=[0-9]+\s)")
    rows = notes.select(volume, F.posexplode(parts).alias("entry", "_part")).filter("entry > 0")
    n = F.regexp_extract("_part", r"^([0-9]+)\s", 1)
    return rows.select(volume, "entry", n.cast("long").alias("n"), T.squeeze(F.regexp_replace("_part", r"^[0-9]+\s+", "")).alias("body"))


def facts(rows: DataFrame, rules: tuple[Rule, ...], text: str, *keep: str) -> DataFrame:
    """keep, rule (its number), place, a, b, gender_a, gender_b, attr of every match."""
    def matches(number: int, rule: Rule):
        def fact(match: Column, place: Column) -> Column:
            return F.struct(
                F.lit(number).alias("rule"),
                place.alias("place"),
                F.regexp_extract(match, rule.pattern, rule.a).alias("a"),
                (F.regexp_extract(match, rule.pattern, rule.b) if rule.b else F.lit(None).cast("string")).alias("b"),
                F.lit(rule.gender_a).cast("string").alias("gender_a"),
                F.lit(rule.gender_b).cast("string").alias("gender_b"),
                F.lit(rule.attr).cast("string").alias("attr"),
            )

        return F.transform(F.regexp_extract_all(F.col(text), F.lit(rule.pattern), 0), fact)

    found = [matches(number, rule) for number, rule in enumerate(rules)]
    return rows.select(*keep, F.explode(F.concat(*found)).alias("_f")).select(*keep, "_f.*")


def frequent_names(rows: DataFrame, text: str, rules: tuple[Rule, ...] = CHAPTER_NAMES) -> DataFrame:
    """rule, word and n of names that are found often enough for the rule that finds them."""
    by = lambda number: lambda w: F.struct(F.lit(number).alias("rule"), w.alias("word"))
    each = (F.transform(F.regexp_extract_all(F.col(text), F.lit(r.pattern), r.a), by(number)) for number, r in enumerate(rules))
    found = rows.select(F.inline(F.concat(*each))).groupBy("rule", "word").agg(F.count(F.lit(1)).alias("n"))
    least = F.element_at(F.array(*(F.lit(r.least) for r in rules)), F.col("rule") + 1)
    return found.filter(F.col("n") >= least).select(F.element_at(F.array(*(F.lit(r.name) for r in rules)), F.col("rule") + 1).alias("rule"), "word", "n")


def title_genders(rows: DataFrame, text: str, titled: DataFrame) -> DataFrame:
    """word and gender: Female if a queen's or princess's name begins with the word, else Male."""
    queens = rows.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(WOMEN), 1)).alias("q")).distinct()
    queens = queens.select(F.explode(F.transform(F.sequence(F.lit(3), F.greatest(F.length("q"), F.lit(3))), lambda k: F.substring("q", F.lit(1), k))).alias("word")).distinct()
    return titled.join(queens.withColumn("_f", F.lit(True)), "word", "left").select("word", F.when(F.col("_f"), "Female").otherwise("Male").alias("gender"))


def note_names(entries: DataFrame) -> DataFrame:
    """entry's volume and number, name and gender (null if unknown) of the subjects and kin that notes name."""
    body = F.col("body")
    subject = F.regexp_extract(body, SUBJECT, 1)
    head = F.substring(body, 1, 50)
    gender = F.when(F.contains(head, F.lit(". She ")), "Female").when(F.contains(head, F.lit(". He ")), "Male")
    ruler = F.regexp_extract(body, RULER, 1)
    kin = F.concat(*(F.regexp_extract_all(body, F.lit(p), 1) for p in KIN))
    pair = lambda n, g: F.struct(n.alias("name"), g.cast("string").alias("gender"))
    is_king = F.when(F.contains(F.lower(F.substring(body, 1, 40)), F.lit("king")), "Male")
    every = F.concat(F.array(pair(subject, gender), pair(ruler, is_king)), F.transform(kin, lambda k: pair(k, F.lit(None))))
    return entries.select("volume", "entry", F.explode(every).alias("x")).select("volume", "entry", "x.name", "x.gender").filter("name <> ''")


def aka(entries: DataFrame) -> DataFrame:
    """volume, entry, a and b of `a is also known as b`; letter case doesn't matter to the pattern."""
    rows = entries.select("volume", "entry", F.posexplode(F.regexp_extract_all("body", F.lit(ALSO), 0)).alias("place", "m"))
    return rows.select("volume", "entry", "place", F.regexp_extract("m", ALSO, 1).alias("a"), F.regexp_extract("m", ALSO, 2).alias("b"))


def duties(rows: DataFrame, text: str) -> DataFrame:
    """word, duty and caste by the first title that goes before it, in the order of DUTIES."""
    rules = tuple(Rule(title, rf"\b{title}\s+{_N}") for title, _, _ in DUTIES)
    first = facts(rows, rules, text).groupBy(F.col("a").alias("word")).agg(F.min("rule").alias("rule"))
    at = lambda i: F.element_at(F.array(*(F.lit(d[i]) for d in DUTIES)), F.col("rule") + 1)
    return first.select("word", at(1).alias("duty"), at(2).alias("caste"))


def dynasties(rows: DataFrame, text: str, order: str) -> DataFrame:
    """word and the first place that it is king of."""
    rule = (Rule("king of", KING_OF, 1, 2),)
    return facts(rows, rule, text, order).groupBy(F.col("a").alias("word")).agg(F.min_by("b", F.struct(order, "place")).alias("dynasty"))


def parents(found: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """child, role and parent: the first fact for each child and role; order has the columns that order facts."""
    own = found.filter(F.col("attr").isin("father", "mother")).select(T.key_of(F.col("a")).alias("child"), F.col("attr").alias("role"), T.key_of(F.col("b")).alias("parent"), F.struct(*order, "rule", "place").alias("_o"))
    return own.groupBy("child", "role").agg(F.min_by("parent", "_o").alias("parent"))


def spouses(found: DataFrame) -> DataFrame:
    """a, b and relation (what b is to a), both ways."""
    own = found.filter("attr = 'wife'").select(T.key_of(F.col("a")).alias("husband"), T.key_of(F.col("b")).alias("wife"))
    one = own.select(F.col("husband").alias("a"), F.col("wife").alias("b"), F.lit("Wife").alias("relation"))
    return one.unionByName(own.select(F.col("wife").alias("a"), F.col("husband").alias("b"), F.lit("Husband").alias("relation"))).distinct()


def chapters(texts: DataFrame, volume: str, text: str) -> DataFrame:
    """volume, ord, chapter and content, of texts with marker lines; what is before the first marker is left out."""
    marker = r"--- Chapter ([0-9]+)(?:\([0-9]+\))? ---"
    parts = F.split(F.col(text), rf"(?={marker})")
    rows = texts.select(volume, F.posexplode(parts).alias("ord", "_part")).filter(F.col("_part").rlike(f"^{marker}"))
    return rows.select(volume, "ord", F.regexp_extract("_part", marker, 1).cast("long").alias("chapter"), F.regexp_replace("_part", f"^{marker}", "").alias("content"))


def note_refs(lines: DataFrame, line: str, *keep: str) -> DataFrame:
    """A row n for each {n} in a line."""
    return lines.select(*keep, F.explode(F.regexp_extract_all(F.col(line), F.lit(r"\{([0-9]+)\}"), 1)).alias("n")).withColumn("n", F.col("n").cast("long"))

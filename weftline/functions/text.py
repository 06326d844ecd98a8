"""Column functions over text; all of them run inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values, here and in the patterns of this module: quotation marks, and the marks that may close a sentence.
QUOTES = "‘’“”'\""
CLOSERS = ".!?’”'\"):"
#: A run of letters and digits; a name is a run of one capital and two or more small letters.
RUN = r"[\p{L}\p{N}_]+"
NAME = r"^[A-Z][a-z]{2,}$"
#: A run that is a name. The letter beyond 16 bits, which \p{L} has too, makes Java look back by whole characters.
NAME_RUN = r"[A-Z](?<![\p{L}\p{N}_" "\U00010400" r"][A-Z])[a-z]{2,}+(?![\p{L}\p{N}_])"


def squeeze(text: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def ends_mid_sentence(text: Column) -> Column:
    """Whether a text, without the digits at its end, stops before a closing mark; false for nothing."""
    body = F.regexp_replace(F.regexp_replace(text, r"(?U)\s+$", ""), r"[0-9]+$", "")
    return (body != "") & ~F.contains(F.lit(CLOSERS), F.right(body, F.lit(1)))


def tag_note_refs(text: Column) -> Column:
    """Numbers that follow a word and its marks as {N} before the marks: first those that touch, then those after a space."""
    marks = r"[.,;:!?'\"‘’“”)]"
    touching = F.regexp_replace(text, rf"([a-zA-Z)])({marks}*?)(\d{{1,4}})(?=[\s.,;:!?'\"‘’“”)]|$)", r"$1{$3}$2")
    return F.regexp_replace(touching, r"([a-zA-Z])([.,;:!?'\"‘’“”])\s+(\d{1,4})(?=\s[A-Z'\"‘“])", r"$1{$3}$2 ")


def joined_lines(lines: Column) -> Column:
    """The non-empty squeezed lines as one text; a hyphen at the end of a line goes with the break."""
    own = F.filter(F.transform(lines, squeeze), lambda x: x != "")
    return F.aggregate(
        own,
        F.lit(""),
        lambda acc, x: F.when(acc == "", x).when(acc.endswith("-"), F.concat(F.substring(acc, F.lit(1), F.length(acc) - 1), x)).otherwise(F.concat(acc, F.lit(" "), x)),
    )


def line_kind(line: Column) -> Column:
    """What a line of contents is: section, SECTION, chapter, count, parva, PARVA; null for others."""
    return (
        F.when(line.rlike(r"^Section\s+[A-Z][a-z]"), "section")
        .when(line.rlike(r"^SECTION\s+[A-Z]{3,}"), "SECTION")
        .when(line.rlike(r"^Chapter\s+[0-9]+(\([0-9]+\))?\s*:"), "chapter")
        .when(line.rlike(r"^This parva has\s+"), "count")
        .when(line.rlike(r"^[A-Z].*[Pp]arva\s*$") & (F.length(line) < 80), "parva")
        .when(line.rlike(r"^[A-Z]{2,}[\s-]+[A-Z]{2,}.*PARVA"), "PARVA")
    )


def chapter_ids(text: Column) -> Column:
    """Ids of chapters that a text announces, N(M) also as N."""
    ids = F.regexp_extract_all(text, F.lit(r"Chapter\s+([0-9]+(?:\([0-9]+\))?)\s*:"), 1)
    return F.array_distinct(F.flatten(F.transform(ids, lambda x: F.array(x, F.regexp_extract(x, r"^([0-9]+)", 1)))))


def chapter_marker(text: Column, x0: Column, past_section: Column) -> Column:
    """The id of the chapter that a block opens; bare numbers count at the right of the page, once a section has begun."""
    spelled = F.regexp_extract(text, r"^(?:CHAPTER|Chapter)\s+([0-9]+(?:\([0-9]+\))?)$", 1)
    pair = F.regexp_extract(text, r"^([0-9]+)\s*\([0-9]+\)\s*[0-9]*$", 1)
    inner = F.regexp_extract(text, r"^[0-9]+\s*\(([0-9]+)\)\s*[0-9]*$", 1)
    placed = (x0 >= 200) & past_section
    return (
        F.when(spelled != "", spelled)
        .when(placed & (pair != ""), F.concat(pair, F.lit("("), inner, F.lit(")")))
        .when(placed & text.rlike("^[0-9]+$"), text)
    )


def is_running_header(text: Column, word: str) -> Column:
    return (F.length(text) < 80) & F.contains(F.lower(text), F.lit(word))


def space_after_number(line: Column) -> Column:
    return F.regexp_replace(line, "^([0-9]+)([A-Za-z])", "$1 $2")


def replaced(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """All rules (old, new), one after the other."""
    for old, new in rules:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def rules_hit(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """How many rules found something to replace when their turn came."""
    hits = F.lit(0).cast("long")
    for old, new in rules:
        hits = hits + F.contains(text, F.lit(old)).cast("long")
        text = F.replace(text, F.lit(old), F.lit(new))
    return hits


def key_of(name: Column) -> Column:
    """Lower case, no white space at the ends, spaces as underscores."""
    return F.replace(F.lower(F.regexp_replace(name, r"(?U)^\s+|\s+$", "")), F.lit(" "), F.lit("_"))


def ref(key: Column) -> Column:
    return F.concat(F.lit("@"), key)


def is_ref(value: Column) -> Column:
    return value.startswith("@")


def deref(value: Column) -> Column:
    return F.when(is_ref(value), F.substring(value, 2, 1 << 30)).otherwise(value)


def name_shape(name: Column) -> Column:
    """What a name must be besides not being listed: three characters or more, no hyphen at the end."""
    return (F.length(name) >= 3) & ~name.endswith("-")


def english_suffix(word: Column) -> Column:
    """Whether a word ends as English words do."""
    w = F.lower(word)
    n = F.length(w)
    third = F.substring(w, F.greatest(n - 2, F.lit(1)), F.lit(1))
    return (
        (w.endswith("ly") & (n > 4))
        | ((w.endswith("ing") | w.endswith("tion") | w.endswith("sion") | w.endswith("ness") | w.endswith("ment")) & (n > 5))
        | (w.endswith("ed") & (n > 4) & ~F.contains(F.lit("aeiou"), third))
    )


def percent(part: Column, whole: Column) -> Column:
    """One decimal and a percent sign; 0% of nothing."""
    return F.when(whole > 0, F.format_string("%.1f%%", part * 100.0 / whole)).otherwise("0%")


def is_drop_cap(text: Column) -> Column:
    """A capital by itself, perhaps with quotes."""
    return text.rlike(rf"^[{QUOTES} \s]*[A-Z][{QUOTES} \s]*$")


def appearance(volume: Column, chapters: Column) -> Column:
    """Vol1:ch3,7,10 of a volume and an array of chapter numbers."""
    return F.concat(F.lit("Vol"), volume, F.lit(":ch"), F.array_join(F.transform(F.array_sort(chapters), lambda c: c.cast("string")), ","))


def default_relation(relation: Column, gender: Column) -> Column:
    return F.coalesce(relation, F.when(gender == "Female", "Wife").when(gender == "Male", "Husband").otherwise("Spouse"))


def names(text: Column) -> Column:
    """All names in a text, in order."""
    return F.regexp_extract_all(text, F.lit(NAME_RUN), 0)


def first_names(text: Column, n: int) -> Column:
    """The first n names in a text, which is read no further; empty where there are fewer."""
    pattern = f"({NAME_RUN})"
    for _ in range(n - 1):
        pattern = f"({NAME_RUN})(?:.*?{pattern})?"
    return F.array(*(F.regexp_extract(text, f"(?s){pattern}", i + 1) for i in range(n)))

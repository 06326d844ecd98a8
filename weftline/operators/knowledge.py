"""From texts to linked people: one plan over notes and chapters.

The log of all facts has one order: names in notes (volume, entry, then what the note
begins with, kin, ruler, other names), names in chapters by rule, relations in
chapters by rule and place, relations in notes by entry. Order numbers come from a
prefix scan. From there on everything is a fold, a join or a fixpoint over the log
(`people.py`), cleaning of references, and documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as T
from weftline.operators import extract, graph, people, scan

_ORDER = ["phase", "p1", "p2", "p3", "p4", "sub", "a", "b"]
_LOG = ["phase", "p1", "p2", "p3", "p4", "sub", "kind", "a", "b", "gender", "attr"]


def _row(phase: int, places: Sequence[Column], sub: int, kind: str, a: Column, b: Column | None = None, gender: Column | None = None, attr: Column | None = None) -> list[Column]:
    none = F.lit(None).cast("string")
    p = [x.cast("long").alias(f"p{i + 1}") for i, x in enumerate([*places, *[F.lit(0)] * (4 - len(places))])]
    return [F.lit(phase).alias("phase"), *p, F.lit(sub).alias("sub"), F.lit(kind).alias("kind"), a.alias("a"), (none if b is None else b).alias("b"), (none if gender is None else gender).cast("string").alias("gender"), (none if attr is None else attr).alias("attr")]


def note_log(entries: DataFrame) -> DataFrame:
    """Names of notes (volume, entry, body) in the order in which a note gives them, and its other names."""
    body = F.col("body")
    one = lambda step, name, gender=None: F.transform(name, lambda x, i: F.struct(F.lit(step).alias("step"), i.alias("place"), x.alias("a"), F.lit(None).cast("string").alias("b"), (F.lit(None) if gender is None else gender).cast("string").alias("gender")))
    head = F.substring(body, 1, 50)
    gender = F.when(F.contains(head, F.lit(". She ")), "Female").when(F.contains(head, F.lit(". He ")), "Male")
    king = F.when(F.contains(F.lower(F.substring(body, 1, 40)), F.lit("king")), "Male")
    also = F.transform(
        F.regexp_extract_all(body, F.lit(extract.ALSO), 0),
        lambda x, i: F.struct(F.lit(4).alias("step"), i.alias("place"), F.regexp_extract(x, extract.ALSO, 1).alias("a"), F.regexp_extract(x, extract.ALSO, 2).alias("b"), F.lit(None).cast("string").alias("gender")),
    )
    kin = [one(i + 1, F.regexp_extract_all(body, F.lit(p), 1)) for i, p in enumerate(extract.KIN)]
    every = F.concat(one(0, F.array(F.regexp_extract(body, extract.SUBJECT, 1)), gender), *kin, one(3, F.array(F.regexp_extract(body, extract.RULER, 1)), king), also)
    rows = entries.select("volume", "entry", F.explode(every).alias("x")).select("volume", "entry", "x.*").filter("a <> ''")
    return rows.select(*_row(0, [F.col(c) for c in ("volume", "entry", "step", "place")], 0, "name", F.col("a"), F.col("b"), F.col("gender")))


def name_log(chapters: DataFrame) -> DataFrame:
    """Names in chapters (column text) that are found often enough, each once for its rule; titles give a gender."""
    found = graph.stored(extract.frequent_names(chapters, "text"), "names")
    titled = extract.title_genders(chapters, "text", found.filter("rule = 'titled'").select("word"))
    rank = F.array_position(F.array(*(F.lit(r.name) for r in extract.CHAPTER_NAMES)), F.col("rule"))
    rows = found.join(titled.withColumn("rule", F.lit("titled")), ["rule", "word"], "left")
    return rows.select(*_row(1, [rank], 0, "name", F.col("word"), gender=F.col("gender")))


def relation_log(rows: DataFrame, rules: tuple[extract.Rule, ...], text: str, phase: int, places: Sequence[str]) -> DataFrame:
    """For each relation the two names that it asks for, and the relation; places has the columns that order it, `rule` and `place` among them."""
    found = extract.facts(rows, rules, text, *(p for p in places if p not in ("rule", "place")))
    at = [F.col(p) for p in places]
    a, b, none = F.col("a"), F.col("b"), F.lit(None).cast("string")
    three = [
        F.struct(*_row(phase, at, 0, "name", a, gender=F.col("gender_a")), b.alias("other")),
        F.struct(*_row(phase, at, 1, "name", b, gender=F.col("gender_b")), a.alias("other")),
        F.struct(*_row(phase, at, 2, "relation", a, b, attr=F.col("attr")), none.alias("other")),
    ]
    return found.select(F.inline(F.array(*three)))


def log(entries: DataFrame, chapters: DataFrame, noise: Sequence[str], skip: Sequence[str]) -> DataFrame:
    """ord, kind (name or relation), a, b, gender and attr of all facts whose names are valid, in order. entries: volume, entry,
    body; chapters: volume, chapter (a number), text."""
    parts = [
        note_log(entries).withColumn("other", F.col("b")),
        name_log(chapters).withColumn("other", F.lit(None).cast("string")),
        relation_log(chapters, extract.CHAPTER_RELATIONS, "text", 2, ("rule", "volume", "chapter", "place")),
        relation_log(entries, extract.NOTE_RELATIONS, "body", 3, ("volume", "entry", "rule", "place")),
    ]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    good = lambda c: T.name_shape(F.col(c)) & ~F.col(c).isin(*noise) & ~F.lower(c).isin(*skip)
    every = every.filter(good("a") & (F.col("b").isNull() | good("b")) & (F.col("other").isNull() | good("other"))).select(*_LOG)
    # stored, as ranges are drawn from a first pass over the rows: texts are read once
    return scan.ranked(graph.stored(every, "unordered"), [], _ORDER, "ord", "n_facts").select("ord", "kind", "a", "b", "gender", "attr")


def facts(log: DataFrame, seeds: DataFrame, mapping: DataFrame) -> DataFrame:
    """The log as facts (people.FACT) of resolved keys: who is created and when, aliases, and relations, in their order."""
    nodes, aliases = people.united_aliases(log.filter("kind = 'name'"), seeds, mapping)
    rel = people.keyed(log.filter("kind = 'relation'").select("ord", "attr", "a", "b"), mapping, ka="a", kb="b")
    ord_ = lambda more: (F.col("ord") * 4 + more).alias("ord")
    spouse = lambda other, relation: F.array(F.struct(F.col(other).alias("key"), F.lit(relation).alias("relation"))).alias("spouses")
    wives, siblings = rel.filter("attr = 'wife'"), rel.filter("attr = 'sibling'")
    rows = [
        nodes.select("key", (F.col("created") * 4).alias("ord"), "name", "gender"),
        aliases.select("key", ord_(1), F.array("alias").alias("aliases")),
        rel.filter("attr = 'father'").select(F.col("ka").alias("key"), ord_(2), F.col("kb").alias("father")),
        rel.filter("attr = 'mother'").select(F.col("ka").alias("key"), ord_(2), F.col("kb").alias("mother")),
        wives.select(F.col("ka").alias("key"), ord_(2), spouse("kb", "Wife")),
        wives.select(F.col("kb").alias("key"), ord_(3), spouse("ka", "Husband")),
        siblings.select(F.col("ka").alias("key"), ord_(2), F.array("kb").alias("siblings")),
        siblings.select(F.col("kb").alias("key"), ord_(3), F.array("ka").alias("siblings")),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    kinds = dict(x.split(maxsplit=1) for x in _fields(people.FACT))
    return out.select(*((F.col(c) if c in out.columns else F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()))


def _fields(ddl: str) -> list[str]:
    """The fields of a schema string, at its upper level."""
    out, depth = [""], 0
    for c in ddl:
        depth += {"<": 1, ">": -1}.get(c, 0)
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return [x.strip() for x in out]


def cleaned(records: DataFrame, created: DataFrame, noise: Sequence[str], skip: Sequence[str]) -> DataFrame:
    """Records (people.RECORD) with valid names, and with references that hold: to others that are there, spouses who aren't
    each other's parents, and, of two who are each other's father (or mother), that of the one created first (created: key, created)."""
    low = F.lower("name")
    kept = people.valid(records, ["name"], noise, skip).filter(~low.isin(*noise))
    entry = lambda role, ref, relation=None: F.struct(F.lit(role).alias("role"), ref.alias("ref"), (F.lit(None).cast("string") if relation is None else relation).alias("relation"))
    refs = F.concat(F.array(entry("father", F.col("father")), entry("mother", F.col("mother"))), F.transform("siblings", lambda s: entry("sibling", s)), F.transform("spouses", lambda s: entry("spouse", s["key"], s["relation"])))
    rows = kept.select("key", F.posexplode(refs).alias("at", "r")).select("key", "at", "r.*").filter("ref IS NOT NULL AND ref <> key")
    rows = rows.join(kept.select(F.col("key").alias("ref")), "ref", "left_semi").select("key", "ref", "role", "relation", "at")
    parents = rows.filter("role IN ('father', 'mother')")
    holding = graph.without_circles(parents.join(created, "key"), "key", "ref", "role", "created").drop("created")
    married = graph.not_parental(rows.filter("role = 'spouse'"), parents, "key", "ref", "key", "ref")
    every = holding.unionByName(married.select(*rows.columns)).unionByName(rows.filter("role = 'sibling'"))
    mine = lambda role: F.array_sort(F.collect_list(F.when(F.col("role") == role, F.struct("at", "ref", "relation"))))
    one = every.groupBy("key").agg(
        F.max(F.when(F.col("role") == "father", F.col("ref"))).alias("father"),
        F.max(F.when(F.col("role") == "mother", F.col("ref"))).alias("mother"),
        F.transform(mine("sibling"), lambda x: x["ref"]).alias("siblings"),
        F.transform(mine("spouse"), lambda x: F.struct(x["ref"].alias("key"), x["relation"].alias("relation"))).alias("spouses"),
    )
    ok = lambda a: (F.length(a) >= 3) & ~a.endswith("-") & ~a.isin(*noise) & ~F.lower(a).isin(*skip) & (a != F.col("name"))
    own = kept.drop("father", "mother", "siblings", "spouses").withColumn("aliases", F.filter("aliases", ok)).join(one, "key", "left")
    for c in ("siblings", "spouses"):
        own = own.withColumn(c, F.coalesce(c, F.array().cast(records.schema[c].dataType)))
    return own.select(*records.columns)


def titled(records: DataFrame, chapters: DataFrame, mapping: DataFrame, noise: Sequence[str], skip: Sequence[str]) -> DataFrame:
    """Records with duty and caste by the first title in the order of extract.DUTIES, and the first valid place that they are
    king of, where none is set; only of those who are there, by alias or name."""
    by_key = lambda words: people.keyed(words, mapping, key="a")
    rules = tuple(extract.Rule(title, rf"\b{title}\s+{extract._N}") for title, _, _ in extract.DUTIES)
    first = by_key(extract.facts(chapters, rules, "text")).groupBy("key").agg(F.min("rule").alias("_rule"))
    king = extract.facts(chapters, (extract.Rule("king of", extract.KING_OF, 1, 2),), "text", "volume", "chapter")
    place = by_key(people.valid(king, ["b"], noise, skip)).groupBy("key").agg(F.min_by("b", F.struct("volume", "chapter", "place")).alias("_place"))
    at = lambda i: F.get(F.array(*(F.lit(d[i]) for d in extract.DUTIES)), F.col("_rule"))
    out = records.join(first, "key", "left").join(place, "key", "left")
    return out.withColumns({"duty": F.coalesce("duty", at(1)), "caste": F.coalesce("caste", at(2)), "dynasty": F.coalesce("dynasty", "_place")}).select(*records.columns)


def build(entries: DataFrame, chapters: DataFrame, seeds: DataFrame, mapping: DataFrame, rules: DataFrame | None, noise: Sequence[str], skip: Sequence[str]) -> DataFrame:
    """The people of a book as records (people.RECORD). seeds (key, name, gender) and mapping (alias_key, key) are known before;
    rules (old_key, new_key, ord) merge records; without them, a person whose name is an alias of another, by the earliest
    such alias, is merged into that one."""
    with graph.scratch(entries.sparkSession) as keep:
        facts_ = graph.stored(facts(log(entries, chapters, noise, skip), seeds, mapping), "facts")
        created = facts_.filter("name IS NOT NULL").groupBy("key").agg(F.min("ord").alias("created"))
        records = graph.stored(people.upserted(facts_), "records")
        if rules is None:
            said = facts_.filter("aliases IS NOT NULL").select("key", "ord", T.key_of(F.col("aliases")[0]).alias("old_key")).filter("old_key <> key")
            rules = said.groupBy("old_key").agg(F.min_by("key", "ord").alias("new_key"), F.min("ord").alias("ord"))
        merged = people.merged_records(records, rules)
        return keep(titled(cleaned(merged, created, noise, skip), chapters, mapping, noise, skip), "people")

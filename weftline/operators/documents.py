"""Documents of people: all that a record says, and what others say about it.

Spouses, their genders and children meet in one aggregation by person and spouse, so a person with many of both costs no
more than their number. What comes of it, events and lineage are sent to the person as rows of one shape, and meet the record
in one aggregation by key, instead of a join for each part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from weftline.functions import text as T
from weftline.operators import graph


def _message(kind: Column, ord: Column, a: Column, b: Column, kids: Column | None = None) -> Column:
    none = F.lit(None).cast("array<string>")
    return F.struct(kind.alias("kind"), ord.cast("long").alias("ord"), a.cast("string").alias("a"), b.cast("string").alias("b"), (none if kids is None else kids).alias("kids"))


def _sent(df: DataFrame, key: str, kind: str, ord: Column, a: Column, b: Column) -> DataFrame:
    return df.select(F.col(key).alias("key"), _message(F.lit(kind), ord, a, b).alias("m"))


def _families(records: DataFrame, born: Column) -> DataFrame:
    """Messages of kind spouse (in their order, with relation and children) and child (of no spouse), for each person."""
    parents = F.array_distinct(F.array("father", "mother"))
    other = F.when(F.col("_p") == F.col("father"), F.col("mother")).otherwise(F.col("father"))
    kids = records.withColumn("_p", F.explode(parents)).filter("_p IS NOT NULL").select(F.col("_p").alias("key"), other.alias("s"), F.struct(born.cast("long").alias("ord"), F.col("key").alias("a")).alias("kid"))
    wed = records.select("key", F.posexplode("spouses").alias("at", "s")).select("key", F.col("s.key").alias("s"), "at", F.nullif("s.relation", F.lit("")).alias("relation")).filter("s IS NOT NULL")
    asks = wed.filter("relation IS NULL").select("key", "s").distinct()
    genders = asks.join(records.select(F.col("key").alias("s"), "gender"), "s").select("key", "s", "gender")
    rows = wed.unionByName(kids, allowMissingColumns=True).unionByName(genders, allowMissingColumns=True)
    # the relation is that of the first of several equal spouses; struct: it may be null
    met = rows.groupBy("key", "s").agg(F.min("at").alias("at"), F.min_by(F.struct("relation"), "at")["relation"].alias("relation"), F.max("gender").alias("gender"), F.array_sort(F.collect_list("kid")).alias("kids"))
    spouse = _message(F.lit("spouse"), F.col("at"), F.col("s"), T.default_relation(F.col("relation"), F.col("gender")), F.transform("kids", lambda k: T.ref(k["a"])))
    alone = F.transform("kids", lambda k: _message(F.lit("child"), k["ord"], k["a"], F.col("s")))
    return met.select("key", F.explode(F.when(F.col("at").isNotNull(), F.array(spouse)).otherwise(alone)).alias("m"))


def _lineage(records: DataFrame) -> DataFrame:
    """key, gf and ggf: grandfather, and his father, as far as all of them are there."""
    up = lambda a, b: records.select(F.col("key").alias(a), F.col("father").alias(b))
    two = up("key", "_f").filter("_f IS NOT NULL").join(up("_f", "gf").filter("gf IS NOT NULL"), "_f")
    three = two.join(up("gf", "_g"), "gf")  # he must be there
    here = records.select(F.col("key").alias("_g"), F.col("key").alias("ggf"))
    return three.join(here, "_g", "left").select("key", "gf", "ggf")


def documents(records: DataFrame, events: DataFrame, order: str | None = None) -> DataFrame:
    """The document of each record (columns of people.RECORD, one row for a key). events: key, ord, event.

    name, alias_names (by code points), gender, father, mother, spouse (key, relation, children), children of no spouse,
    lineage, the record's other fields, and major_events in order. References begin with @. A relation that isn't given
    follows from the spouse's gender. A child goes to the spouse who is its other parent. Children come by `order`, a column of
    the records, then by key. What is empty is null, but for alias_names; keys that have no record get nothing.
    """
    none = F.lit(None)
    born = F.lit(0) if order is None else F.col(order)
    said = (
        _families(records, born)
        .unionByName(_sent(events, "key", "event", F.col("ord"), F.col("event"), none))
        .unionByName(_sent(_lineage(records), "key", "lineage", F.lit(0), F.col("gf"), F.col("ggf")))
    )
    fields = [c for c in records.columns if c not in ("key", order)]
    own = records.select("key", F.struct(*fields).alias("r"))
    met = own.unionByName(said, allowMissingColumns=True).groupBy("key").agg(F.first("r", ignorenulls=True).alias("r"), F.array_sort(F.collect_list("m")).alias("m"))
    met = met.filter("r IS NOT NULL").select("key", "r.*", "m")

    of = lambda kind: F.filter("m", lambda x: x["kind"] == kind)
    filled = lambda c: F.when(F.size(c) > 0, c)
    refs = lambda c: F.transform(c, T.ref)
    met = met.withColumns({"_wed": of("spouse"), "_kids": of("child"), "_line": F.get(of("lineage"), F.lit(0))})
    spouse = lambda x: F.struct(T.ref(x["a"]).alias("key"), x["b"].alias("relation"), x["kids"].alias("children"))
    line = F.when(F.col("_line").isNotNull(), F.struct(T.ref(F.col("_line.a")).alias("grandfather"), T.ref(F.col("_line.b")).alias("great_grandfather")))
    text = lambda c: F.nullif(F.col(c), F.lit("")).alias(c)
    return met.select(
        "key", "name", F.array_sort(F.coalesce("aliases", F.array().cast("array<string>"))).alias("alias_names"), "gender",
        T.ref(F.nullif("father", F.lit(""))).alias("father"), T.ref(F.nullif("mother", F.lit(""))).alias("mother"),
        filled(F.transform("_wed", spouse)).alias("spouse"), filled(F.transform("_kids", lambda x: T.ref(x["a"]))).alias("children"),
        text("caste"), text("duty"), text("dynasty"), text("status"), T.ref(F.nullif("kingdom", F.lit(""))).alias("kingdom"), text("political_role"),
        *(filled(F.col(c)).alias(c) for c in ("skills", "divine_weapons", "titles", "traits", "character_arc")),
        filled(F.col("relationships")).alias("key_relationships"), filled(refs("important_locations")).alias("important_locations"),
        line.alias("lineage"), filled(F.transform(of("event"), lambda x: T.ref(x["a"]))).alias("major_events"),
    )


def figures() -> dict[str, Column]:
    """The conditions that the twenty figures of a build count, over documents()."""
    there = {
        "father": "father", "mother": "mother", "spouse": "spouse", "caste": "caste", "duty": "duty", "dynasty": "dynasty", "status": "status", "kingdom": "kingdom",
        "skills": "skills", "weapons": "divine_weapons", "traits": "traits", "arc": "character_arc", "lineage": "lineage", "key_relationships": "key_relationships",
    }
    theirs = F.coalesce(F.exists("spouse", lambda s: F.size(s["children"]) > 0), F.lit(False))
    out = {"total": F.lit(True), "with_aliases": F.size("alias_names") > 0, "with_children": F.col("children").isNotNull() | theirs}
    out |= {f"with_{name}": F.col(c).isNotNull() for name, c in there.items()}
    return out | {"males": F.col("gender") == "Male", "females": F.col("gender") == "Female", "unknowns": F.col("gender") == "Unknown"}


def written(docs: DataFrame, path: str) -> dict[str, int]:
    """Write documents as a table; the figures are observed on the way, in the tasks that write, so there is no second pass."""
    seen = Observation()
    docs.observe(seen, *(F.count_if(c).alias(name) for name, c in figures().items())).write.parquet(path)
    return dict(seen.get)


def read_figures(docs: DataFrame, what: str = "documents") -> tuple[DataFrame, DataFrame]:
    """The documents as they were written to the shared folder, and their figures as a row."""
    spark = docs.sparkSession
    found: dict[str, int] = {}
    out = graph.stored(docs, what, lambda df, path: found.update(written(df, path)))
    return out, spark.range(1).select(*(F.lit(found[n]).cast("long").alias(n) for n in figures()))

"""Entities from a log of facts: folds, aliases, merges, removals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as T


def fold(facts: DataFrame, key: str, order: str, first: Sequence[str] = (), last: Sequence[str] = (), lists: Sequence[str] = ()) -> DataFrame:
    """One row for each key: the first or last value that isn't null or empty, by order, and lists in order, each item once."""
    none = lambda c: F.nullif(F.col(c).cast("string"), F.lit(""))
    one = [F.min_by(c, F.when(none(c).isNotNull(), F.col(order))).alias(c) for c in first]
    one += [F.max_by(c, F.when(none(c).isNotNull(), F.col(order))).alias(c) for c in last]
    many = [
        F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.coalesce(F.col(c), F.array()).alias("v")))), lambda x: x["v"]))).alias(c)
        for c in lists
    ]
    return facts.groupBy(key).agg(*one, *many)


def alias_map(aliases: DataFrame, alias: str, key: str, order: str) -> DataFrame:
    """alias_key and key; of several claims the last one holds; an alias that is its own key is none."""
    own = aliases.select(T.key_of(F.col(alias)).alias("alias_key"), F.col(key).alias("key"), F.col(order).alias("_o")).filter("alias_key <> key")
    return own.groupBy("alias_key").agg(F.max_by("key", "_o").alias("key"))


def resolved(df: DataFrame, name: str, mapping: DataFrame, out: str = "key") -> DataFrame:
    """The key of each name: by its alias, else its own."""
    own = df.withColumn("_k", T.key_of(F.col(name)))
    return own.join(mapping.select(F.col("alias_key").alias("_k"), F.col("key").alias("_to")), "_k", "left").withColumn(out, F.coalesce("_to", "_k")).drop("_k", "_to")


def valid_names(names: DataFrame, name: str, noise: DataFrame, skip: DataFrame) -> DataFrame:
    """Names of the right shape that neither list has (column word): noise as written, skip in lower case."""
    shaped = names.filter(T.name_shape(F.col(name)))
    kept = shaped.join(noise.select(F.col("word").alias(name)), name, "left_anti")
    return kept.withColumn("_low", F.lower(name)).join(skip.select(F.col("word").alias("_low")), "_low", "left_anti").drop("_low")


def remapped(df: DataFrame, columns: Sequence[str], mapping: DataFrame) -> DataFrame:
    """The columns with old_key replaced by new_key; the map has no chains."""
    for c in columns:
        df = df.join(mapping.select(F.col("old_key").alias(c), F.col("new_key").alias("_new")), c, "left").withColumn(c, F.coalesce("_new", c)).drop("_new")
    return df


def merged(nodes: DataFrame, edges: DataFrame, mapping: DataFrame, key: str = "key", ends: Sequence[str] = ("src", "dst"), order: str = "ord", first: Sequence[str] = (), lists: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """A rule holds if both of its keys exist. What the merged row has fills what is missing; edges go over, without loops and twice."""
    here = nodes.select(F.col(key).alias("old_key")).distinct()
    rules = mapping.join(here, "old_key", "left_semi").join(here.withColumnRenamed("old_key", "new_key"), "new_key", "left_semi").filter("old_key <> new_key")
    own = remapped(nodes.withColumn("_was", F.col(key)), [key], rules)
    own = own.withColumn("_rank", F.struct((F.col("_was") != F.col(key)).alias("moved"), F.col(order).alias("o")))
    out = remapped(edges, ends, rules).filter(F.col(ends[0]) != F.col(ends[1])).distinct()
    return fold(own, key, "_rank", first=first, lists=lists), out


def existing(edges: DataFrame, ends: Sequence[str], nodes: DataFrame, key: str = "key") -> DataFrame:
    """Edges with both ends among the nodes."""
    for c in ends:
        edges = edges.join(nodes.select(F.col(key).alias(c)).distinct(), c, "left_semi")
    return edges


def without(nodes: DataFrame, edges: DataFrame, noise: DataFrame, key: str = "key", ends: Sequence[str] = ("src", "dst")) -> tuple[DataFrame, DataFrame]:
    """Nodes that the list (column word) hasn't, and edges that don't touch it."""
    own = nodes.join(noise.select(F.col("word").alias(key)), key, "left_anti")
    for c in ends:
        edges = edges.join(noise.select(F.col("word").alias(c)), c, "left_anti")
    return own, edges


def with_gender(facts: DataFrame, key: str, gender: str, order: str) -> DataFrame:
    """The first gender that is known for each key, else Unknown."""
    known = F.when(F.col(gender).isNotNull() & (F.col(gender) != "Unknown"), F.col(order))
    return facts.groupBy(key).agg(F.coalesce(F.min_by(gender, known), F.lit("Unknown")).alias(gender))


def plural_aliases_removed(aliases: Column) -> Column:
    """An array of aliases without those that are another one with an s."""
    return F.filter(aliases, lambda a: ~(a.endswith("s") & F.array_contains(aliases, F.substring(a, F.lit(1), F.length(a) - 1))))


def first_known(members: DataFrame, index: DataFrame, key: str, names: str) -> DataFrame:
    """key and id of each member: the id of the first of its names (an array, the name before its aliases) that the index (word,
    id, ord) has; of several ids of one word the first one. Null if it has none."""
    words = members.select(key, F.posexplode(names).alias("_at", "word"))
    hits = words.join(index, "word").groupBy(key).agg(F.min_by("id", F.struct("_at", "ord")).alias("id"))
    return members.select(key).join(hits, key, "left")


def spouse_keys(people: DataFrame, key: str, spouses: str) -> DataFrame:
    """key and the keys of its spouses (an array of references with relations), each once, in order."""
    return people.select(key, F.array_distinct(F.transform(F.col(spouses), lambda s: T.deref(s["ref"]))).alias("spouse_keys"))


def keyed(words: DataFrame, index: DataFrame) -> DataFrame:
    """Rows with the id of their word, a row for each of several ids (index: word, id)."""
    return words.join(index.select("word", "id").distinct(), "word")

"""From counted words to records: variants, spelling clusters, known records, one entry for each.

A cluster takes the record of the first of its names that is known, so it has one at most, and clusters that meet the
same record, or come to the same new key, are one entry: the components of clusters and records are the groups by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators import fuzzy, graph


def clustered(counted: DataFrame) -> DataFrame:
    """word, n, root, cluster, best: counted words (word, n) by their variant forest, and the roots by the spelling pairs of a rare
    and a frequent one (by their totals). best is a cluster's root with the largest total; of equal ones the first by letters."""
    forest = graph.roots(fuzzy.variant_parents(counted, "word"), "word", "parent").select(F.col("key").alias("word"), "root")
    words = graph.stored(forest.join(counted, "word").select("word", "n", "root"), "words")
    totals = graph.stored(words.groupBy("root").agg(F.sum("n").alias("total")), "totals")
    pairs = fuzzy.spelling_clusters(fuzzy.spelling_pairs(totals, "root", "total")).select(F.col("id").alias("root"), "component")
    own = totals.join(pairs, "root", "left").withColumn("cluster", F.coalesce("component", "root"))
    best = own.groupBy("cluster").agg(F.min_by("root", F.struct((-F.col("total")).alias("t"), "root")).alias("best"))
    return words.join(own.join(best, "cluster").select("root", "cluster", "best"), "root").select("word", "n", "root", "cluster", "best")


def entries(clusters: DataFrame, index: DataFrame) -> DataFrame:
    """key, name, alias_names, n, n_clusters and known: an entry for each record that clusters (see clustered) meet, and for
    each other cluster.

    index: word, id, is_name, ord: the names and aliases of the records. A cluster's best name is looked up first, then its
    other words in the order of code points; a name counts before an alias, and the first by ord, then id, of equal ones.
    A record keeps its name and brings its aliases. New keys are best names in small letters; the most frequent best
    name gives the name. Aliases that are another name with an s go.
    """
    hits = clusters.join(index.select("word", "id", "is_name", "ord"), "word").groupBy("cluster").agg(F.min_by("id", F.struct((F.col("word") != F.col("best")).alias("b"), "word", (~F.col("is_name")).alias("a"), "ord", "id")).alias("id"))
    sums = clusters.groupBy("cluster", "best").agg(F.sum("n").alias("n")).join(hits, "cluster", "left")
    keyed = sums.select("cluster", "best", "n", F.coalesce("id", F.lower("best")).alias("key"))
    names = index.filter("is_name").groupBy(F.col("id").alias("key")).agg(F.min_by("word", F.struct("ord", "word")).alias("_known"))
    one = keyed.groupBy("key").agg(F.min_by("best", F.struct((-F.col("n")).alias("t"), "best")).alias("_best"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_clusters"))
    one = one.join(names, "key", "left").select("key", F.coalesce("_known", "_best").alias("name"), "n", "n_clusters", F.col("_known").isNotNull().alias("known"))
    words = clusters.join(keyed.select("cluster", "key"), "cluster").select("key", "word")
    words = words.unionByName(index.select(F.col("id").alias("key"), "word")).distinct()
    said = one.join(words, "key").filter("word <> name")
    # the word that a plural needs is a row of the same key, or its name
    base = words.unionByName(one.select("key", F.col("name").alias("word"))).distinct()
    plural = base.select("key", F.concat("word", F.lit("s")).alias("word"))
    lists = said.select("key", "word").join(plural, ["key", "word"], "left_anti").groupBy("key").agg(F.array_sort(F.collect_list("word")).alias("alias_names"))
    return one.join(lists, "key", "left").select("key", "name", F.coalesce("alias_names", F.array().cast("array<string>")).alias("alias_names"), "n", "n_clusters", "known")

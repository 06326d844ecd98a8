"""Spelling variants: blocked edit-distance join, variant forest, clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions.text import english_suffix
from weftline.operators.graph import components


def spelling_pairs(words: DataFrame, word: str, count: str, least: int = 3, shortest: int = 5) -> DataFrame:
    """a < b with the same first letter, one edit apart, of words of `shortest` letters or more of which one occurs `least` times.

    Two words that are one edit apart have the same letters before or after the edit: they share their first half, or their
    second half, when cut for the shorter of them. So blocks are halves of words rather than first letters.
    """
    own = words.filter(F.length(word) >= shortest).select(F.col(word).alias("w"), F.col(count).alias("n"), F.length(word).alias("len"))
    sizes = own.withColumn("cut_for", F.explode(F.array(F.col("len"), F.col("len") - 1)))
    half = F.floor(F.col("cut_for") / 2).cast("int")
    heads = F.concat(F.lit("<"), F.substring(F.col("w"), F.lit(1), half))
    tails = F.concat(F.lit(">"), F.substring(F.col("w"), F.col("len") - (F.col("cut_for") - half) + 1, F.col("cut_for") - half))
    keyed = sizes.withColumn("block", F.explode(F.array(heads, tails))).select("cut_for", "block", "w", "n", "len")
    left = keyed.select("cut_for", "block", F.col("w").alias("a"), F.col("n").alias("n_a"), F.col("len").alias("len_a"))
    right = keyed.select("cut_for", "block", F.col("w").alias("b"), F.col("n").alias("n_b"), F.col("len").alias("len_b"))
    pairs = left.join(right, ["cut_for", "block"]).filter(
        (F.col("a") < F.col("b"))
        & (F.least("len_a", "len_b") == F.col("cut_for"))
        & (F.greatest("n_a", "n_b") >= least)
        & (F.substring("a", 1, 1) == F.substring("b", 1, 1))
        & (F.levenshtein("a", "b", 1) == 1)
    )
    return pairs.select("a", "b", "n_a", "n_b").distinct()


def variant_parents(words: DataFrame, word: str) -> DataFrame:
    """word and parent: the word without its final s, else with its doubled final vowel made single, if that is a word too."""
    own = words.select(F.col(word).alias("word")).distinct()
    known = lambda c: own.select(F.col("word").alias(c))
    cut = F.substring("word", F.lit(1), F.length("word") - 1)
    based = own.withColumn("_p", F.when(F.col("word").endswith("s"), cut)).withColumn("_v", F.when(F.col("word").rlike("(aa|ee|ii|oo|uu)$"), cut))
    based = based.join(known("_p").withColumn("_hp", F.lit(True)), "_p", "left").join(known("_v").withColumn("_hv", F.lit(True)), "_v", "left")
    return based.select("word", F.when(F.col("_hp"), F.col("_p")).when(F.col("_hv"), F.col("_v")).alias("parent"))


def spelling_clusters(pairs: DataFrame, low: int = 3, high: int = 20, shortest: int = 7) -> DataFrame:
    """id and component over pairs of a rare word of enough letters and a frequent one."""
    rare = F.when(F.col("n_a") <= F.col("n_b"), F.col("a")).otherwise(F.col("b"))
    gate = (F.least("n_a", "n_b") <= low) & (F.greatest("n_a", "n_b") >= high) & (F.length(rare) >= shortest)
    return components(pairs.filter(gate).select("a", "b"))


def best_names(members: DataFrame, word: str, count: str, cluster: str) -> DataFrame:
    """Each cluster's most frequent word (equal ones: the first by letters), its total, and its words."""
    best = F.min_by(word, F.struct((-F.col(count)).alias("n"), F.col(word).alias("w")))
    return members.groupBy(cluster).agg(best.alias("best"), F.sum(count).alias("n_total"), F.array_sort(F.collect_list(word)).alias("words"))


def variant_totals(counted: DataFrame, forest: DataFrame) -> DataFrame:
    """root, n_total and variants (word, n; the most frequent first) of the groups with two words or more; counted has word and
    n, forest word and root."""
    each = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "word")))
    groups = forest.join(counted, "word").groupBy("root").agg(F.sum("n").alias("n_total"), each.alias("_e")).filter(F.size("_e") > 1)
    return groups.select("root", "n_total", F.transform("_e", lambda x: F.struct(x["word"].alias("word"), (-x["o"]).alias("n"))).alias("variants"))


def english_words(words: DataFrame, word: str, dictionary: DataFrame) -> DataFrame:
    """Words that a dictionary has (column word, lower case) or that end as English words do."""
    known = dictionary.select(F.col("word").alias("_low"), F.lit(True).alias("_known")).distinct()
    own = words.withColumn("_low", F.lower(word)).join(known, "_low", "left")
    return own.filter(F.coalesce("_known", F.lit(False)) | english_suffix(F.col(word))).drop("_low", "_known")

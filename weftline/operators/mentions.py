"""Mention counts: names in texts, counted by source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as T


def name_rows(docs: DataFrame, text: str, *keep: str) -> DataFrame:
    """A row for each name in each text."""
    return docs.select(*keep, F.explode(T.names(F.col(text))).alias("word"))


def counts(words: DataFrame, source: Column, sources: Sequence[str], least: int = 1) -> DataFrame:
    """word, n_<source> for each source, n_total; 0 where a source hasn't the word. One shuffle of partial sums."""
    each = [F.count_if(source == s).alias(f"n_{s}") for s in sources]
    return words.groupBy("word").agg(*each, F.count(F.lit(1)).alias("n_total")).filter(F.col("n_total") >= least)


def top(df: DataFrame, n: int, count: str, key: str) -> DataFrame:
    """The n rows with the largest counts, equal ones by key."""
    return df.orderBy(F.desc(count), F.asc(key)).limit(n)


def appearances(rows: DataFrame, word: str, volume: str, chapter: str) -> DataFrame:
    """word, count, and its appearances by volume, such as `Vol1:ch3,7 Vol2:ch1`. Places are made distinct before they are collected."""
    places = rows.groupBy(word, volume, chapter).agg(F.count(F.lit(1)).alias("n"))
    volumes = places.groupBy(word, volume).agg(F.sum("n").alias("n"), F.collect_list(chapter).alias("chapters"))
    each = F.struct(F.col(volume).alias("volume"), T.appearance(F.col(volume).cast("string"), F.col("chapters")).alias("at"))
    done = volumes.groupBy(word).agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(each)).alias("each"))
    return done.select(word, F.col("n").alias("n_mentions"), F.array_join(F.transform("each", lambda x: x["at"]), " ").alias("appearance"))


def of_records(words: DataFrame, index: DataFrame) -> DataFrame:
    """id, n_mentions, n_places and appearance of each record of the index (word, id): a word counts for all records that it names.

    words: word, volume, chapter, and null chapters in notes, which count as mentions but aren't places. What is frequent is
    summed up before it meets the index, by word and place.
    """
    named = index.select("word", "id").distinct()
    places = words.groupBy("word", "volume", "chapter").agg(F.count(F.lit(1)).alias("n")).join(named, "word").groupBy("id", "volume", "chapter").agg(F.sum("n").alias("n"))
    volumes = places.groupBy("id", "volume").agg(F.sum("n").alias("n"), F.collect_list("chapter").alias("chapters"))
    at = F.when(F.size("chapters") > 0, F.struct("volume", T.appearance(F.col("volume").cast("string"), F.col("chapters")).alias("at")))
    done = volumes.groupBy("id").agg(F.sum("n").alias("n"), F.sum(F.size("chapters")).alias("n_places"), F.array_sort(F.collect_list(at)).alias("each"))
    out = named.select("id").distinct().join(done, "id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return out.select("id", zero("n").alias("n_mentions"), zero("n_places").alias("n_places"), F.array_join(F.transform(F.coalesce("each", F.array().cast(done.schema["each"].dataType)), lambda x: x["at"]), " ").alias("appearance"))

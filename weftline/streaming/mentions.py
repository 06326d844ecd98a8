"""Mention counts kept up to date as new texts arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators import mentions


def running_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """word and n of a stream of texts, for the output modes complete and update; the state is a row for each word."""
    return mentions.name_rows(texts, text).groupBy("word").agg(F.count(F.lit(1)).alias("n"))

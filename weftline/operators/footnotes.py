"""References against definitions: anti join, as-of mapping, totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as T


def unmatched(refs: DataFrame, defs: DataFrame, on: Sequence[str]) -> DataFrame:
    """References without a definition."""
    return refs.join(defs.select(*on).distinct(), list(on), "left_anti")


def clamped_runs(groups: DataFrame, def_runs: DataFrame, by: Sequence[str], run: str = "run") -> DataFrame:
    """The run of each group, not beyond the last run of definitions."""
    last = def_runs.groupBy(*by).agg(F.max(run).alias("_last"))
    return groups.join(last, list(by), "left").withColumn(run, F.least(run, F.coalesce("_last", F.col(run)))).drop("_last")


def verified(refs: DataFrame, defs: DataFrame, on: Sequence[str], by: str) -> DataFrame:
    """For each value of `by`, and null for all: references, those matched, the share as text, and whether all are."""
    known = defs.select(*on).distinct().withColumn("_hit", F.lit(1))
    marked = refs.join(known, list(on), "left")
    total = marked.rollup(by).agg(F.count(F.lit(1)).alias("n_refs"), F.count("_hit").alias("n_matched"), F.bool_and(F.col("_hit").isNotNull()).alias("all_ok"))
    return total.withColumn("share", T.percent(F.col("n_matched"), F.col("n_refs")))

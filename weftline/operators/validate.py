"""Checks of a knowledge graph; each gives its violations as rows (check, source_id, ref)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.functions import text as T
from weftline.operators import scan


def missing_refs(check: str, rows: DataFrame, source_id: str, ref: str, targets: DataFrame, key: str) -> DataFrame:
    """References (values that begin with @; arrays are taken apart) to keys that aren't there."""
    own = rows.select(F.col(source_id).cast("string").alias("source_id"), (F.explode(ref) if dict(rows.dtypes)[ref].startswith("array") else F.col(ref)).alias("ref"))
    wanted = own.filter(T.is_ref(F.col("ref"))).withColumn("_key", T.deref(F.col("ref")))
    known = targets.select(F.col(key).cast("string").alias("_key")).distinct()
    return wanted.join(known, "_key", "left_anti").select(F.lit(check).alias("check"), "source_id", "ref")


def not_continuous(check: str, rows: DataFrame, source_id: str, order: str, number: str) -> DataFrame:
    """One violation if the numbers, in order, aren't 1, 2, 3 and so on. The order is that of the whole table, by a prefix scan."""
    bad = scan.out_of_order(rows, [], [order], number)
    first = bad.agg(F.min(F.struct(F.col(order), F.col(source_id).cast("string").alias("i"), F.col(number).cast("string").alias("n"))).alias("x")).filter("x IS NOT NULL")
    return first.select(F.lit(check).alias("check"), F.col("x.i").alias("source_id"), F.col("x.n").alias("ref"))


def not_monotonic(check: str, rows: DataFrame, source_id: str, order: str, value: str) -> DataFrame:
    """A violation for each row whose value is below that of the row before, in the order of the whole table, by a prefix scan."""
    bad = scan.steps_back(rows, [], [order], value)
    return bad.select(F.lit(check).alias("check"), F.col(source_id).cast("string").alias("source_id"), F.col(value).cast("string").alias("ref"))


def summary(spark, violations: list[DataFrame], checks: list[str]) -> DataFrame:
    """check, n_violations and ok, for every check."""
    every = violations[0]
    for v in violations[1:]:
        every = every.unionByName(v)
    names = spark.createDataFrame([(c,) for c in checks], "check string")
    n = every.groupBy("check").agg(F.count(F.lit(1)).alias("n"))
    return names.join(n, "check", "left").select("check", F.coalesce("n", F.lit(0)).cast("long").alias("n_violations"), (F.coalesce("n", F.lit(0)) == 0).alias("ok"))

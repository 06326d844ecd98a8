"""Operators over ordered rows: fills, runs, continuity, islands.

Each takes the columns that name a sequence (partitions) and its order. A
sequence is ordered inside its own partition, by Spark's windows; different
sequences are independent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def _w(by: Sequence[str], order: Sequence[str]):
    return W.partitionBy(*by).orderBy(*order)


def forward_fill(df: DataFrame, by: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """The last value that isn't null, up to this row."""
    return df.withColumn(name, F.last(value, ignorenulls=True).over(_w(by, order).rowsBetween(W.unboundedPreceding, 0)))


def runs(df: DataFrame, by: Sequence[str], order: Sequence[str], number: str, threshold: Column | int, name: str = "run") -> DataFrame:
    """Numbered runs: a new one begins at a 1 if the numbers since the last 1 reached the threshold.

    A run's maximum is at or above the threshold exactly when that of the stretch between its last 1 and the next is: so
    two running windows do, and no row has to wait for the state of the one before.
    """
    w = _w(by, order)
    stretch = df.withColumn("_stretch", F.sum((F.col(number) == 1).cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)))
    tops = stretch.groupBy(*by, "_stretch").agg(F.max(number).alias("_top"))
    t = W.partitionBy(*by).orderBy("_stretch")
    limit = F.lit(threshold) if isinstance(threshold, int) else threshold
    splits = tops.withColumn("_split", F.coalesce(F.lag("_top").over(t) >= limit, F.lit(False)).cast("int"))
    splits = splits.withColumn(name, F.sum("_split").over(t.rowsBetween(W.unboundedPreceding, 0)).cast("long"))
    return stretch.join(splits.select(*by, "_stretch", name), [*by, "_stretch"]).drop("_stretch")


def ref_runs(groups: DataFrame, by: Sequence[str], order: Sequence[str], low: str, high: str, threshold: int, first: int = 3, name: str = "run") -> DataFrame:
    """Runs over groups of numbers with their least and greatest: a group whose least is `first` or below begins a new run
    if the greatest since the last such group reached the threshold."""
    w = _w(by, order)
    is_first = F.coalesce(F.col(low) <= first, F.lit(False)) & (F.row_number().over(w) > 1)
    marked = groups.withColumn("_first", is_first)
    marked = marked.withColumn("_stretch", F.sum(F.col("_first").cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)))
    tops = marked.groupBy(*by, "_stretch").agg(F.max(high).alias("_top"))
    t = W.partitionBy(*by).orderBy("_stretch")
    splits = tops.withColumn("_split", F.coalesce(F.lag("_top").over(t) >= threshold, F.lit(False)).cast("int"))
    splits = splits.withColumn(name, F.sum("_split").over(t.rowsBetween(W.unboundedPreceding, 0)).cast("long"))
    return marked.join(splits.select(*by, "_stretch", name), [*by, "_stretch"]).drop("_stretch", "_first")


#: The thresholds that are tried, in order.
THRESHOLDS = (2, 3, 4, 5, 6, 8, 10, 15, 20, 30, 50, 100)


def best_threshold(numbers: DataFrame, groups: DataFrame, by: Sequence[str], number: str, order: Sequence[str], low: str, high: str, group_order: Sequence[str], thresholds: Sequence[int] = THRESHOLDS) -> DataFrame:
    """by, threshold, and the two numbers of runs: the threshold at which numbers and groups have the most similar counts of runs, the earliest of equals.

    Stretches and their tops don't depend on the threshold: they are made once, and each threshold counts the tops that reach it.
    """

    def n_runs(rows: DataFrame, starts: Column, top: str, ordered: Sequence[str], name: str) -> DataFrame:
        stretch = rows.withColumn("_stretch", F.sum(starts.cast("int")).over(_w(by, ordered).rowsBetween(W.unboundedPreceding, 0)))
        tops = stretch.groupBy(*by, "_stretch").agg(F.max(top).alias("_top"))
        before = tops.withColumn("_before", F.lag("_top").over(W.partitionBy(*by).orderBy("_stretch")))
        return before.groupBy(*by).agg(F.array(*((F.count_if(F.col("_before") >= t) + 1) for t in thresholds)).alias(name))

    a = n_runs(numbers, F.col(number) == 1, number, order, "_a")
    first = F.coalesce(F.col(low) <= 3, F.lit(False)) & (F.row_number().over(_w(by, group_order)) > 1)
    b = n_runs(groups.withColumn("_first", first), F.col("_first"), high, group_order, "_b")
    tried = [F.struct(F.abs(F.col("_a")[i] - F.col("_b")[i]).alias("diff"), F.lit(i).alias("i"), F.lit(t).cast("long").alias("threshold"), F.col("_a")[i].alias("n"), F.col("_b")[i].alias("m")) for i, t in enumerate(thresholds)]
    best = a.join(b, list(by)).withColumn("_best", F.array_min(F.array(*tried)))
    return best.select(*by, F.col("_best.threshold").alias("threshold"), F.col("_best.n").alias("n_number_runs"), F.col("_best.m").alias("n_group_runs"))


def run_headers(df: DataFrame, by: Sequence[str], run: str, label: str, order: str) -> DataFrame:
    """First and last label of each run, and where it begins."""
    return df.groupBy(*by, run).agg(F.min_by(label, order).alias("first"), F.max_by(label, order).alias("last"), F.min(order).alias("start"))


def with_headers(lines: DataFrame, headers: DataFrame, by: Sequence[str], order: str, line: str) -> DataFrame:
    """Lines with each run's header (columns by, start, header) before its first line, after an empty line."""
    body = lines.select(*by, F.col(order).alias("_at"), F.lit(2).alias("_part"), F.col(line).alias("line"))
    blank = headers.select(*by, F.col("start").alias("_at"), F.lit(0).alias("_part"), F.lit("").alias("line"))
    head = headers.select(*by, F.col("start").alias("_at"), F.lit(1).alias("_part"), F.col("header").alias("line"))
    every = body.unionByName(blank).unionByName(head)
    return every.withColumn("ord", F.row_number().over(W.partitionBy(*by).orderBy("_at", "_part"))).select(*by, "ord", "line")


def section_headers(lines: DataFrame, headers: DataFrame, by: Sequence[str], order: str, line: str, threshold: int = 10) -> DataFrame:
    """Lines of notes with the headers of their runs: by, ord (from 0) and line. headers: by, idx (from 0), section, chapters.

    Old marker lines (---) go. The header with a run's number comes before the run's first numbered line, after an empty line
    if the line before has text; empty chapters are left out. Runs beyond the last header get none, as it stands already.
    """
    kept = lines.select(*by, F.col(order).alias("_at"), F.coalesce(line, F.lit("")).alias("line")).filter(~F.col("line").startswith("---"))
    kept = kept.withColumn("_n", F.nullif(F.regexp_extract("line", r"^\s*([0-9]+)\s+\S", 1), F.lit("")).cast("long"))
    firsts = runs(kept.filter("_n IS NOT NULL"), by, ["_at"], "_n", threshold, "idx").groupBy(*by, "idx").agg(F.min("_at").alias("_at"))
    heads = firsts.join(headers.select(*by, "idx", F.array("section", "chapters").alias("_head")), [*by, "idx"]).drop("idx")
    before = F.lag("line").over(_w(by, ["_at"]))
    own = kept.withColumn("_gap", F.coalesce(before.rlike(r"\S"), F.lit(False))).join(heads, [*by, "_at"], "left")
    gap = F.when(F.col("_gap"), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    head = F.when(F.col("_head").isNotNull(), F.concat(gap, F.filter("_head", lambda h: F.coalesce(h, F.lit("")) != ""))).otherwise(F.array().cast("array<string>"))
    rows = own.select(*by, "_at", F.posexplode(F.concat(head, F.array("line"))).alias("_k", "line"))
    return rows.select(*by, (F.row_number().over(_w(by, ["_at", "_k"])) - 1).cast("long").alias("ord"), "line")


def out_of_order(df: DataFrame, by: Sequence[str], order: Sequence[str], number: str) -> DataFrame:
    """Rows whose number isn't their place in the sequence; expected has the place."""
    return df.withColumn("expected", F.row_number().over(_w(by, order)).cast("long")).filter(F.col(number) != F.col("expected"))


def steps_back(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Rows whose value is below that of the row before; previous has that."""
    return df.withColumn("previous", F.lag(value).over(_w(by, order))).filter(F.col(value) < F.col("previous"))


def earliest(df: DataFrame, by: Sequence[str], order: str, wanted: Sequence[Column], default: Column, name: str = "page") -> DataFrame:
    """For each sequence the first place where the first of the conditions holds that holds anywhere; else the default aggregate."""
    found = [F.min(F.when(c, F.col(order))) for c in wanted]
    return df.groupBy(*by).agg(F.coalesce(*found, default).alias(name))


def before_repeat(df: DataFrame, by: Sequence[str], order: Sequence[str], key: str) -> DataFrame:
    """The rows of a sequence before the first one whose key (if not null) was there already."""
    seen = F.row_number().over(W.partitionBy(*by, key).orderBy(*order))
    marked = df.withColumn("_again", (F.col(key).isNotNull() & (seen > 1)).cast("int"))
    marked = marked.withColumn("_again", F.max("_again").over(_w(by, order).rowsBetween(W.unboundedPreceding, 0)))
    return marked.filter("_again = 0").drop("_again")


def islands(df: DataFrame, by: Sequence[str], order: Sequence[str], starts: Column, name: str = "island") -> DataFrame:
    """Numbers the stretches of a sequence; starts says (it may look back) whether a row begins one."""
    return df.withColumn("_starts", starts.cast("int")).withColumn(name, F.sum("_starts").over(_w(by, order).rowsBetween(W.unboundedPreceding, 0)).cast("long")).drop("_starts")


def positional_zip(left: DataFrame, right: DataFrame, by: Sequence[str], left_order: Sequence[str], right_order: Sequence[str]) -> DataFrame:
    """Row by row: the n-th of a sequence with the n-th of the other; the left one's rows all stay. position counts from 1."""
    a = left.withColumn("position", F.row_number().over(_w(by, left_order)).cast("long"))
    b = right.withColumn("position", F.row_number().over(_w(by, right_order)).cast("long"))
    return a.join(b, [*by, "position"], "left")


def truncate_before(df: DataFrame, by: Sequence[str], order: str, marker: Column) -> DataFrame:
    """Rows from the first marker on; all of a sequence without one."""
    first = F.min(F.when(marker, F.col(order))).over(W.partitionBy(*by))
    return df.withColumn("_first", first).filter(F.col("_first").isNull() | (F.col(order) >= F.col("_first"))).drop("_first")


def distinct_counts(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """For each sequence how many different values each column has (n_<column>), as of chapters, paragraphs and notes."""
    return df.groupBy(*by).agg(*(F.count_distinct(c).alias(f"n_{c}") for c in columns))

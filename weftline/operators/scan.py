"""Prefix scans: numbers and neighbours in the order of a whole table, without a task that sees all of its rows.

Rows are dealt out by ranges of (group, order) and sorted there. What goes before a
partition follows from one row for each partition and group in it: offsets are sums
over those rows, neighbours across a border are their edges. A group of any size is
spread over partitions, so few large groups cost no more than many small ones.

Defined results: null groups are a group, and come first, as nulls of the order do;
rows that tie in the order get different numbers, in an order of their own; an empty
table gives an empty table; other columns are kept (names with _ at both ends are the scan's).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.operators.graph import stored

_ROW = (1 << 33) - 1  # monotonically_increasing_id has the partition above this many rows


def dealt(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows in ranges, written to the shared folder, with _part_ and _row_ (their place in it)."""
    keys = [*group, *order, "_tie_"]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.withColumn("_tie_", F.monotonically_increasing_id()).repartitionByRange(n, *keys).sortWithinPartitions(*keys).drop("_tie_")
    at = F.monotonically_increasing_id()
    return stored(rows.select("*", F.shiftright(at, 33).alias("_part_"), at.bitwiseAND(_ROW).alias("_row_")), "scan")


def _same(a: DataFrame, b: DataFrame, group: Sequence[str]):
    on = a["_part_"] == b["_at_"]
    for g in group:
        on = on & a[g].eqNullSafe(b[f"_{g}_"])
    return on


def ranked(df: DataFrame, group: Sequence[str], order: Sequence[str], position: str = "position", size: str = "size") -> DataFrame:
    """The rows with their number in the group, from 0, and the size of the group."""
    rows = dealt(df, group, order)
    each = rows.groupBy(*group, "_part_").agg(F.min("_row_").alias("_first_"), F.count(F.lit(1)).alias("_n_"))
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))  # a row for each partition at most
    before = F.coalesce(F.sum("_n_").over(whole.orderBy("_part_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    each = each.select(*(F.col(g).alias(f"_{g}_") for g in group), F.col("_part_").alias("_at_"), (before - F.col("_first_")).alias("_shift_"), F.sum("_n_").over(whole).alias("_size_"))
    each = each if group else F.broadcast(each)
    out = rows.join(each, _same(rows, each, group))
    return out.select(*df.columns, (F.col("_row_") + F.col("_shift_")).alias(position), F.col("_size_").alias(size))


def with_previous(df: DataFrame, group: Sequence[str], order: Sequence[str], column: str, previous: str = "previous") -> DataFrame:
    """The rows with the column's value in the row before it in its group (null for the first)."""
    rows = dealt(df, group, order)
    inside = Window.partitionBy("_part_", *group).orderBy("_row_")
    last = rows.groupBy(*group, "_part_").agg(F.max_by(F.struct(column), "_row_").alias("_last_"))
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    edge = last.select(*(F.col(g).alias(f"_{g}_") for g in group), F.col("_part_").alias("_at_"), F.lag("_last_").over(whole.orderBy("_part_")).alias("_edge_"))
    rows = rows.withColumn("_before_", F.lag(F.struct(column)).over(inside))
    out = rows.join(edge, _same(rows, edge, group))
    return out.select(*df.columns, F.coalesce("_before_", "_edge_")[column].alias(previous))


def out_of_order(df: DataFrame, group: Sequence[str], order: Sequence[str], number: str) -> DataFrame:
    """Rows whose number isn't their place (from 1) in the group; expected has the place."""
    out = ranked(df, group, order, "expected", "_size").drop("_size")
    return out.withColumn("expected", F.col("expected") + 1).filter(F.col(number) != F.col("expected"))


def steps_back(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Rows whose value is below that of the row before; previous has that."""
    return with_previous(df, group, order, value).filter(F.col(value) < F.col("previous"))


def zipped(left: DataFrame, right: DataFrame, group: Sequence[str], left_order: Sequence[str], right_order: Sequence[str]) -> DataFrame:
    """Row by row: the n-th of a group with the n-th of the other's (groups aren't null); the left one's rows all stay. position counts from 1."""
    place = (F.col("position") + 1).alias("position")
    a, b = (ranked(df, group, order).drop("size").withColumn("position", place) for df, order in ((left, left_order), (right, right_order)))
    return a.join(b, [*group, "position"], "left")

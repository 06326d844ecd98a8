"""Keyword search and styles for a map of places."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def search(df: DataFrame, query: str, columns: Sequence[str]) -> DataFrame:
    """Rows that have the query, trimmed and in lower case, in one of the columns; none for an empty query."""
    wanted = query.strip().lower()
    if not wanted:
        return df.limit(0)
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.contains(F.lower(F.col(c).cast("string")), F.lit(wanted)), F.lit(False))
    return df.filter(hit)


def styled(df: DataFrame, kind: str, styles: dict[str, tuple[str, int]], default: tuple[str, int]) -> DataFrame:
    """Rows with colour and radius by kind."""
    table = F.create_map(*(x for k, (colour, radius) in styles.items() for x in (F.lit(k), F.struct(F.lit(colour).alias("colour"), F.lit(radius).alias("radius")))))
    style = F.coalesce(F.try_element_at(table, F.col(kind)), F.struct(F.lit(default[0]).alias("colour"), F.lit(default[1]).alias("radius")))
    return df.withColumn("colour", style["colour"]).withColumn("radius", style["radius"])


def popup(df: DataFrame, lat: str, lng: str) -> DataFrame:
    """Rows with a position of two decimals, as in 29.16°N, 78.02°E."""
    return df.withColumn("position", F.format_string("%.2f°N, %.2f°E", lat, lng))


def type_counts(df: DataFrame, kind: str, together: dict[str, str]) -> DataFrame:
    """Counts by type, where types that are counted together (type -> common name) have one row."""
    name = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for pair in together.items() for x in pair)), F.col(kind)), F.col(kind))
    return df.groupBy(name.alias("kind")).agg(F.count(F.lit(1)).alias("n"))

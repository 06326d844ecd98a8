"""Documents from nodes, edges and events; cross-links; statistics; JSON."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import geo
from weftline.session import tasks


def events_by(events: DataFrame, key: str, order: str, event: str) -> DataFrame:
    """key, n_events, and its events in order."""
    each = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(event).alias("e"))))
    return events.groupBy(key).agg(F.count(F.lit(1)).alias("n_events"), F.transform(each, lambda x: x["e"]).alias("events"))


def crosslinked(items: DataFrame, key: str, linked: DataFrame, linked_key: str, name: str) -> DataFrame:
    """Items with the events of their key; items without any have null there."""
    return items.join(linked.select(F.col(linked_key).alias(key), F.col("events").alias(name)), key, "left")


def histogram(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


#: Keys of a place that one row holds at most, and tasks that share a cell of the map.
BLOCK, SLICES = 256, 16


def _places(points: DataFrame, key: str, lat: str, lng: str, order: Column | None) -> DataFrame:
    """lat, lng, block and keys: each place once, with its keys in blocks; with an order they are structs (ord, key)."""
    own = points.filter(F.col(key).isNotNull() & F.col(lat).isNotNull() & F.col(lng).isNotNull())
    own = own.select(F.col(lat).alias("lat"), F.col(lng).alias("lng"), (F.col(key) if order is None else F.struct(order.alias("ord"), F.col(key).alias("key"))).alias("_k"))
    one = own.groupBy("lat", "lng").agg(F.sort_array(F.collect_list("_k")).alias("_all"))
    starts = F.sequence(F.lit(1), F.size("_all"), F.lit(BLOCK))
    return one.select("lat", "lng", F.posexplode(F.transform(starts, lambda i: F.slice("_all", i, BLOCK))).alias("block", "keys"))


def _near_places(points: DataFrame, key: str, lat: str, lng: str, km: float, order: Column | None = None) -> DataFrame:
    """Ordered pairs of places no more than km apart, each with itself too: keys_a, keys_b, km, and a's cell, slice, lat, lng, block.

    Places are put into cells of latitude as high as the distance, and there into cells of longitude as wide as the distance
    can be at the end of the neighbouring cell that is nearer to a pole: a partner lies in the same cell or next to it. All
    longitudes are one cell where the distance reaches around the pole. A cell is dealt out in slices that each meet all that
    is around it, so neither few cells nor a small file of points leave the pairs to few tasks.
    """
    height = math.degrees(km / geo.RADIUS_KM)
    half = math.sin(min(km / geo.RADIUS_KM, math.pi) / 2)

    def n_cells(row: Column) -> Column:
        farthest = F.greatest(F.abs(row - 1), F.abs(row + 2)) * height
        part = F.lit(half) / F.cos(F.radians(farthest))
        return F.when((farthest < 89) & (part < 0.99), F.greatest(F.floor(F.lit(360.0) / F.degrees(2 * F.asin(part))), F.lit(1))).otherwise(F.lit(1)).cast("long")

    def column(x: str, row: Column) -> Column:
        return F.floor(F.pmod(F.col(x), F.lit(360.0)) * n_cells(row) / 360.0).cast("long")

    n = tasks(points.sparkSession)
    cell = ["_row", "_column", "_slice"]
    places = _places(points, key, lat, lng, order)
    own = places.select(F.col("lat").alias("lat_a"), F.col("lng").alias("lng_a"), F.col("block").alias("block_a"), F.col("keys").alias("keys_a"))
    own = own.withColumn("_row", F.floor(F.col("lat_a") / height)).withColumn("_column", column("lng_a", F.col("_row")))
    own = own.withColumn("_slice", F.pmod(F.xxhash64("lat_a", "lng_a", "block_a"), F.lit(SLICES)))
    other = places.select(F.col("lat").alias("lat_b"), F.col("lng").alias("lng_b"), F.col("keys").alias("keys_b"))
    other = other.withColumn("_row", F.explode(F.array(*(F.floor(F.col("lat_b") / height) + d for d in (-1, 0, 1)))))
    around = F.array_distinct(F.array(*(F.pmod(column("lng_b", F.col("_row")) + d, n_cells(F.col("_row"))) for d in (-1, 0, 1))))
    other = other.withColumn("_column", F.explode(around)).withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SLICES - 1).cast("long"))))
    pairs = own.repartition(n, *cell).hint("merge").join(other.repartition(n, *cell), cell)
    pairs = pairs.withColumn("_km", geo.haversine_km(F.col("lat_a"), F.col("lng_a"), F.col("lat_b"), F.col("lng_b")))
    return pairs.filter(F.col("_km") <= km).select(*cell, "lat_a", "lng_a", "block_a", "keys_a", "keys_b", geo.rounded_km(F.col("_km")).alias("km"))


def nearby(points: DataFrame, key: str, lat: str, lng: str, km: float) -> DataFrame:
    """Ordered pairs of points no more than km apart: key, other, km. Distances are those of places; points of one place share them."""
    near = _near_places(points, key, lat, lng, km)
    return near.select(F.explode("keys_a").alias("a"), "keys_b", "km").select("a", F.explode("keys_b").alias("b"), "km").filter("a <> b")


def nearby_of_places(points: DataFrame, key: str, lat: str, lng: str, km: float, order: Column) -> DataFrame:
    """keys and neighbours (other, km): the keys (distinct ones) of a place, at most BLOCK in a row, and all keys no more than km
    away, themselves included, by distance, equal ones by `order`. A key's own list is that of its place without itself."""
    near = _near_places(points, key, lat, lng, km, order)
    # the tasks of the pairs hold all of a place, so there is no shuffle here
    met = near.groupBy("_row", "_column", "_slice", "lat_a", "lng_a", "block_a").agg(F.first("keys_a").alias("keys_a"), F.collect_list(F.struct("km", "keys_b")).alias("_met"))
    each = F.sort_array(F.flatten(F.transform("_met", lambda x: F.transform(x["keys_b"], lambda k: F.struct(x["km"].alias("km"), k["ord"].alias("ord"), k["key"].alias("key"))))))
    return met.select(F.transform("keys_a", lambda k: k["key"]).alias("keys"), F.transform(each, lambda x: F.struct(x["key"].alias("other"), x["km"].alias("km"))).alias("neighbours"))


def nearby_lists(pairs: DataFrame, order: DataFrame) -> DataFrame:
    """key and its neighbours (other, km) by distance, equal ones in the order of the source (columns key, ord)."""
    placed = pairs.join(order.select(F.col("key").alias("b"), "ord"), "b")
    each = F.array_sort(F.collect_list(F.struct("km", "ord", "b")))
    return placed.groupBy(F.col("a").alias("key")).agg(F.transform(each, lambda x: F.struct(x["b"].alias("other"), x["km"].alias("km"))).alias("neighbours"))


def as_json(df: DataFrame, key: str, pretty: bool = False) -> DataFrame:
    """id and record of each row; fields without a value are left out."""
    fields = [c for c in df.columns if c != key]
    return df.select(F.concat(F.lit("@"), F.col(key).cast("string")).alias("id"), F.to_json(F.struct(*fields), {"pretty": str(pretty).lower()}).alias("record"))


def one_object(records: DataFrame) -> DataFrame:
    """All records as one JSON object, for small exports: the rows of a book's knowledge graph, not of a corpus."""
    each = F.array_sort(F.collect_list(F.struct("id", "record")))
    pieces = F.transform(each, lambda x: F.concat(F.lit('"'), x["id"], F.lit('": '), x["record"]))
    return records.agg(F.concat(F.lit("{"), F.array_join(pieces, ", "), F.lit("}")).alias("json"))


def from_object(df: DataFrame, json: str, schema: str) -> DataFrame:
    """id and record (a struct) of a JSON object of objects."""
    return df.select(F.explode(F.from_json(F.col(json), f"map<string,{schema}>")).alias("id", "record"))


def statistics(df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """One row with the number of rows for which each condition holds."""
    return df.agg(*(F.count_if(c).alias(name) for name, c in metrics.items()))


def characters(nodes: DataFrame, children: DataFrame, lineage: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nodes with children and lineage; empty texts and lists as null, so that JSON leaves them out."""
    out = nodes.join(children.select(F.col("parent").alias("key"), "children"), "key", "left").join(lineage, "key", "left")
    kinds = dict(nodes.dtypes)
    clean = [F.when(F.size(c) > 0, F.col(c)).alias(c) if kinds[c].startswith("array") else F.nullif(F.col(c), F.lit("")).alias(c) if kinds[c] == "string" else F.col(c) for c in columns]
    return out.select("key", *clean, "children", "grandfather", "great_grandfather")

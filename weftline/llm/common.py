"""Helpers that several operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators import graph

#: Separators of words; str.split of bytes cuts at the same six characters.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or the checkpoint folder of the context."""
    return graph.shared_folder(spark)


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write a table to the shared folder and read it back: it cuts the lineage and outlives lost executors."""
    return graph.stored(df, what)


scratch = graph.scratch


def let(value: Column, body) -> Column:
    """body(value) with value computed once for each row."""
    return F.transform(F.array(value), body)[0]


def text_of(docs: DataFrame, column: str = "text") -> Column:
    """The text column as it is, null as empty."""
    return F.coalesce(docs[column].cast("string"), F.lit(""))


def sampled(ids: DataFrame, n: int, most: int) -> DataFrame:
    """At most `most` of n distinct ids (column doc_id), those with the least hashes. Hashes above a bound that the numbers
    give go before any sorting, so that the sort sees little more than what stays."""
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32))
    share = min(1.0, (most + 6 * most**0.5 + 20) / max(n, 1))
    return ids.filter(h < int(share * (1 << 32))).distinct().orderBy(h, "doc_id").limit(most)


def texts_of(docs: DataFrame, ids: DataFrame, doc_id: str, text: str, longest: int) -> DataFrame:
    """doc_id, text and the other columns of the sampled ids (few): one text for each, the first by bytes of those that have
    `longest` bytes or less."""
    rows = docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[text], F.lit("")).cast("binary").alias("text")).filter(F.length("text") <= longest)
    others = [c for c in ids.columns if c != "doc_id"]
    return rows.join(F.broadcast(ids), "doc_id").groupBy("doc_id", *others).agg(F.min("text").alias("text"))


_kept: dict[object, object] = {}


def kept(key: object, make: Callable[[], object]) -> object:
    """In tasks: what make() gives, kept in the Python worker for its next task. A worker keeps one thing at a time."""
    if key not in _kept:
        keep_nothing()
        _kept[key] = make()
    return _kept[key]


def keep_nothing() -> None:
    """In tasks that keep nothing: lets go of what the worker still holds for another operator, and gives free memory back
    to the system, which other processes of the executor need."""
    _kept.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """While it is open, what is executed sends this many rows at most to Python at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)

"""Relationship edges: symmetric closure, conflicts, children, lineage, components."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The tables of the open scratches of this thread or task, outermost first.
_SCRATCH: ContextVar[tuple[list[str], ...]] = ContextVar("scratch", default=())


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or the checkpoint folder of the context."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found
    kept = spark.sparkContext._jsc.sc().getCheckpointDir()
    if kept.isDefined():
        return kept.get()
    if not spark.sparkContext.master.partition("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='weftline-')}")  # a single process, as in tests
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def stored(df: DataFrame, what: str = "graph", write: Callable[[DataFrame, str], None] | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: it cuts the lineage and outlives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    if open_ := _SCRATCH.get():
        open_[-1].append(path)
    (write or (lambda d, to: d.write.parquet(to)))(df, path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables that are stored while it is open are removed at its end; what it gives, keep(table, name), stores one that stays."""
    own: list[str] = []
    around = _SCRATCH.get()
    mark = _SCRATCH.set((*around, own))

    def keep(df: DataFrame, what: str) -> DataFrame:
        out = stored(df, what)
        path = own.pop()
        if around:  # it stays as long as what is stored around it
            around[-1].append(path)
        return out

    try:
        yield keep
    finally:
        _SCRATCH.reset(mark)
        for path in own:
            removed(spark, path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a table or folder, wherever it is."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def symmetric(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Each edge both ways, once, without loops."""
    one = edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
    return one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct()


def not_parental(spouses: DataFrame, parents: DataFrame, a: str = "a", b: str = "b", child: str = "child", parent: str = "parent") -> DataFrame:
    """Spouse edges between people of whom neither is the other's parent."""
    both = parents.select(F.col(child).alias(a), F.col(parent).alias(b))
    both = both.unionByName(both.select(F.col(b).alias(a), F.col(a).alias(b))).distinct()
    return spouses.join(both, [a, b], "left_anti")


def without_circles(parents: DataFrame, child: str = "child", parent: str = "parent", role: str = "role", order: str = "ord") -> DataFrame:
    """Of two people who are each other's parent in the same role, the one that comes later loses that parent."""
    back = parents.select(F.col(parent).alias(child), F.col(child).alias(parent), role, F.col(order).alias("_other"))
    return parents.join(back, [child, parent, role], "left").filter(F.col("_other").isNull() | (F.col(order) <= F.col("_other"))).drop("_other")


def children(parents: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """parent, n_children and the children in order."""
    own = parents.select(F.col(parent).alias("parent"), F.col(child).alias("child")).filter("parent IS NOT NULL").distinct()
    return own.groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"), F.array_sort(F.collect_list("child")).alias("children"))


def attributed_children(parents: DataFrame, spouses: DataFrame) -> DataFrame:
    """parent, child and spouse: who of the parent's spouses is the child's other parent; null if none is."""
    own = parents.select("parent", "child").distinct()
    other = own.withColumnRenamed("parent", "spouse")
    married = spouses.select(F.col("a").alias("parent"), F.col("b").alias("spouse")).distinct()
    pairs = own.join(other, "child").filter("parent <> spouse").join(married, ["parent", "spouse"], "left_semi")
    one = pairs.groupBy("parent", "child").agg(F.min("spouse").alias("spouse"))
    return own.join(one, ["parent", "child"], "left")


def lineage(fathers: DataFrame, key: str = "key", father: str = "father") -> DataFrame:
    """key, grandfather and great_grandfather, of those who have a grandfather."""
    up = lambda a, b: fathers.select(F.col(key).alias(a), F.col(father).alias(b)).filter(F.col(b).isNotNull())
    two = up("key", "_f").join(up("_f", "grandfather"), "_f")
    return two.join(up("grandfather", "great_grandfather"), "grandfather", "left").select("key", "grandfather", "great_grandfather")


def roots(parents: DataFrame, key: str = "key", parent: str = "parent") -> DataFrame:
    """key and root of a forest (parent null for roots); keys that end in a cycle have its least key as root.

    Each round doubles the step; all keys of a path are done when their step reaches its end. The least key on the way is
    doubled too, which is that of the whole cycle once the steps are longer than all keys are many.
    """
    with scratch(parents.sparkSession) as keep:
        up = F.coalesce(F.col(parent), F.col(key))
        step = stored(parents.select(F.col(key).alias("key"), up.alias("root"), up.alias("low"), F.col(parent).isNull().alias("done")), "roots")
        left, reach, n = step.filter("NOT done").count(), 1, step.count()
        while left and reach <= 2 * n:
            above = step.select(F.col("key").alias("root"), F.col("root").alias("_root"), F.col("low").alias("_low"), F.col("done").alias("_done"))
            step = step.join(above, "root", "left").select("key", F.coalesce("_root", "root").alias("root"), F.least("low", "_low").alias("low"), F.coalesce(F.col("done") | F.col("_done"), F.lit(True)).alias("done"))
            step, reach = stored(step, "roots"), reach * 2
            left = step.filter("NOT done").count()
        return keep(step.select("key", F.when(F.col("done"), F.col("root")).otherwise(F.col("low")).alias("root")), "roots")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """id and component (the smallest id reached), of the ids in edges, any direction.

    Alternating stars: each round hangs the neighbours of every node on the smallest node in sight, first those above it,
    then those below. The number of rounds is logarithmic; each is written to the shared folder. Nothing is collected but
    a fingerprint.
    """
    with scratch(edges.sparkSession) as keep:
        links = stored(edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
        before = None
        while True:
            both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            links = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
            least = links.groupBy("u").agg(F.min("v").alias("m"))
            lower = links.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            links = stored(lower.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
            mark = tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())
            if mark == before:
                own = links.select(F.col("u").alias("id"), F.col("v").alias("component"))
                return keep(own.unionByName(links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()), "component")
            before = mark

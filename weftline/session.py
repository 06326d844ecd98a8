"""Session settings that the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_spark(app: str = "weftline", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with adaptive execution and UTC; a cluster's own settings win where they are given."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the Parquet tables of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks(spark: SparkSession) -> int:
    """Tasks for work that is much larger than the rows it is made of, which one task would read: four for each core, or as shuffles have."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)

"""Text and JSON artefacts of books: reading and writing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

_NAME = r"volume_([0-9]+)_([a-z]+)\.txt$"


def volumes(spark: SparkSession, path: str) -> DataFrame:
    """volume, kind and text of files named volume_<n>_<kind>.txt, a row for each file."""
    own = spark.read.text(path, wholetext=True).withColumn("_file", F.input_file_name())
    own = own.select(F.regexp_extract("_file", _NAME, 1).alias("volume"), F.regexp_extract("_file", _NAME, 2).alias("kind"), F.col("value").alias("text"))
    return own.filter("volume <> ''").withColumn("volume", F.col("volume").cast("int"))


def lines(books: DataFrame) -> DataFrame:
    """volume, kind, ord and line."""
    return books.select("volume", "kind", F.posexplode(F.split("text", "\n")).alias("ord", "line"))


def volume_ranges(spark: SparkSession, starts: dict[int, int], n_pages: int) -> DataFrame:
    """volume, start_page and end_page (exclusive) of volumes that follow each other in one file."""
    own = spark.createDataFrame(sorted(starts.items()), "volume int, start_page int")
    return own.withColumn("end_page", F.coalesce(F.lead("start_page").over(W.orderBy("volume")), F.lit(n_pages)))


def write_lines(rows: DataFrame, path: str) -> None:
    """Lines (volume, kind, ord, line) as text, a folder for each volume and kind, in order."""
    ordered = rows.repartition("volume", "kind").sortWithinPartitions("volume", "kind", "ord")
    ordered.select("volume", "kind", "line").write.partitionBy("volume", "kind").text(path)


def json_objects(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """id (without its @) and the fields of each record of a JSON object of objects."""
    own = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", f"map<string,{schema}>")).alias("id", "record"))
    return own.select(F.ltrim(F.col("id"), F.lit("@")).alias("id"), "record.*")


def name_index(people: DataFrame, name: str = "Name", aliases: str = "Alias_names") -> DataFrame:
    """word and id: every name and alias of every record."""
    words = F.array_distinct(F.concat(F.array(name), F.coalesce(aliases, F.array().cast("array<string>"))))
    return people.select(F.explode(words).alias("word"), "id").filter("word IS NOT NULL").distinct()

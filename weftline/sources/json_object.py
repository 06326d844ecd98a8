"""One JSON object of many records, written and read in parts.

    write(records, path)            # records: id, record (JSON), as assemble.as_json gives them
    read(spark, path, "struct<Name:string>")

A task writes the entries of its range of ids, in order, to a file of its own name, and
tells the driver only which file and how many entries. The commit puts the files of the
tasks that count into the order of their ranges and adds the brackets and commas between
them as files of a few bytes: the object is the folder's files, one after the other
(`cat folder/*`). A task that runs twice leaves one file, as only one of its messages is
committed; files that no message names are removed, as are all files of a failed write.

Defined results: ids are written once for each row, in code-point order; null ids and
records are left out; no records give an empty object.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


def _store(path: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return fs.LocalFileSystem(), path


@dataclass
class Part(WriterCommitMessage):
    number: int
    name: str
    n_entries: int


class ObjectWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.path, self.pretty = options["path"], str(options.get("pretty", "false")).lower() == "true"
        self.staging = f"_parts-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator) -> Part:
        store, path = _store(self.path)
        folder = posixpath.join(path, self.staging)
        store.create_dir(folder, recursive=True)
        number, name, n = TaskContext.get().partitionId(), uuid.uuid4().hex, 0
        with store.open_output_stream(posixpath.join(folder, name)) as out:
            for row in iterator:
                if row[0] is None or row[1] is None:
                    continue
                record = json.dumps(json.loads(row[1]), indent=2, ensure_ascii=False).replace("\n", "\n  ") if self.pretty else row[1]
                out.write(f"{',\n' if n else ''}{'  ' if self.pretty else ''}{json.dumps(row[0], ensure_ascii=False)}: {record}".encode())
                n += 1
        return Part(number, name, n)

    def commit(self, messages: list) -> None:
        store, path = _store(self.path)
        parts = sorted((m for m in messages if m is not None and m.n_entries), key=lambda m: m.number)
        place = 0

        def named(kind: str) -> str:
            nonlocal place
            place += 1
            return posixpath.join(path, f"{place - 1:09d}-{kind}")

        def mark(kind: str, text: bytes) -> None:
            with store.open_output_stream(named(kind)) as out:
                out.write(text)

        mark("open", b"{\n")
        for i, part in enumerate(parts):
            if i:
                mark("comma", b",\n")
            store.move(posixpath.join(path, self.staging, part.name), named("part"))
        mark("close", b"\n}\n")
        self._cleared(store, path)

    def abort(self, messages: list) -> None:
        self._cleared(*_store(self.path))

    def _cleared(self, store, path: str) -> None:
        from pyarrow import fs

        staging = posixpath.join(path, self.staging)
        if store.get_file_info(staging).type != fs.FileType.NotFound:
            store.delete_dir(staging)


class JsonObject(DataSource):
    @classmethod
    def name(cls) -> str:
        return "json_object"

    def schema(self) -> str:
        return "id string, record string"

    def writer(self, schema, overwrite: bool) -> ObjectWriter:
        return ObjectWriter(self.options)


def write(records: DataFrame, path: str, pretty: bool = False, parts: int | None = None) -> None:
    """Write records (id, record) as one object into a new folder."""
    spark = records.sparkSession
    spark.dataSource.register(JsonObject)
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = records.select("id", "record").repartitionByRange(n, "id").sortWithinPartitions("id")
    ranges.write.format("json_object").option("path", path).option("pretty", str(pretty).lower()).mode("append").save()


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """id and record (of the schema) of an object that was written without pretty: its lines are read in parallel."""
    lines = spark.read.text(f"{path}/*-part").select(F.concat(F.lit("{"), F.regexp_replace("value", ",$", ""), F.lit("}")).alias("value"))
    return lines.select(F.explode(F.from_json("value", f"map<string,{schema}>")).alias("id", "record"))

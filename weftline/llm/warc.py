"""WARC archives: a writer, and a reader that salvages what damaged archives still hold.

write_archives() puts one record for each row into archives of one gzip member
per record. Of rows with equal payloads the one with the largest id becomes the
response; the others are written as revisits of it. Equal payloads are found by
an aggregation over digests (partial maxima first) that is joined back to the
rows; a digest that a large part of the rows share is split by the skew join of
adaptive execution.

read_archives() reads files member by member. A record counts only if it is
whole: its gzip checksum, its Content-Length, its end and its block digest hold.
After a failed check the reader searches for the next gzip member that can be
decompressed, or the next version line, goes on there, and logs the bytes
between as a quarantined gap.

A task writes its archives into a folder of its own, hidden from readers, and
renames it when it is done. A task that runs again, after its executor was lost,
finds the finished folder and keeps it, so every row is written exactly once.

Defined results: a null payload is empty; a null URL gives a record without a
target; rows that repeat the largest id of a payload are all responses; a row
without an id revisits the response of its payload, or is a response itself if
no row of the payload has an id; an empty table gives no archives and an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import scratch, shared_dir, stored
from weftline.operators.graph import removed

#: Compressed bytes after which a new archive is begun; rows of payloads of at least LEAST bytes can be revisits.
ARCHIVE_BYTES = 16 << 20
LEAST = 0
LEVEL = 4
#: Bytes that are decompressed at a time.
STEP = 1 << 16
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MEMBER = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_HEADER_END, _RECORD_END = b"\r\n\r\n", b"\r\n\r\n"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(page_id: object, url: str | None, payload: bytes, refers_to: object = None, digest: str | None = None) -> bytes:
    """One WARC record: a response, or a revisit (with an empty block) if refers_to is given."""
    revisit = refers_to is not None
    block = b"" if revisit else b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest or base32_sha1(payload)}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%/:=&?~#+!$,;'@()*[]"))
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + _HEADER_END + block + _RECORD_END


class Found(NamedTuple):
    """A record (why is "") or a gap. Places are bytes of the file."""

    start: int
    end: int
    why: str
    headers: dict[str, str]
    payload: bytes


def _record_at(data: bytes, at: int) -> tuple[int, dict[str, str], bytes] | str:
    """The record that starts at a place of decompressed data: where it ends, headers and payload; or what is wrong."""
    if not VERSION.match(data, at):
        return "no version line"
    end = data.find(_HEADER_END, at)
    if end < 0:
        return "headers don't end"
    headers = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return "header without a colon"
        headers[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    if not (headers.get("content-length") or "").isdigit():
        return "no content length"
    start = end + len(_HEADER_END)
    stop = start + int(headers["content-length"])
    if data[stop : stop + len(_RECORD_END)] != _RECORD_END:
        return "record doesn't end where its length says"
    block = data[start:stop]
    if (digest := headers.get("warc-block-digest", "")).startswith("sha1:") and digest[5:] != base32_sha1(block):
        return "block digest differs"
    payload = block
    if headers.get("warc-type") == "response" and block.startswith(b"HTTP/"):
        payload = block[block.find(_HEADER_END) + len(_HEADER_END) :] if _HEADER_END in block else b""
    return stop + len(_RECORD_END), headers, payload


def _member_at(data: bytes, at: int) -> tuple[int, bytes] | str:
    """The gzip member at a place: where it ends, and its content; or what is wrong."""
    machine, out, place = zlib.decompressobj(31), [], at
    try:
        while not machine.eof:
            if place >= len(data):
                return "gzip member doesn't end"
            out.append(machine.decompress(data[place : place + STEP]))
            place += STEP
    except zlib.error as error:
        return f"gzip: {error}"[:80]
    return min(place, len(data)) - len(machine.unused_data), b"".join(out)


def salvage(data: bytes) -> Iterator[Found]:
    """All whole records of an archive, and the gaps between them, in order."""
    at, gap, why = 0, None, ""
    member_at = version_at = -1  # the next places to look at
    while at < len(data):
        found: list[Found] = []
        if data.startswith(MEMBER, at):
            member = _member_at(data, at)
            if isinstance(member, str):
                wrong, end = member, at
            else:
                end, content = member
                wrong, inner, good = "", 0, 0
                while inner < len(content):
                    record = _record_at(content, inner)
                    if isinstance(record, str):
                        wrong = record
                        following = VERSION.search(content, inner + 1)
                        if not following:
                            break
                        inner = following.start()
                        continue
                    inner, headers, payload = record
                    found.append(Found(at, end, "", headers, payload))
                    good += 1
                if not content:
                    wrong = "empty member"
        else:
            record = _record_at(data, at)
            wrong, end = (record, at) if isinstance(record, str) else ("", record[0])
            if not wrong:
                found = [Found(at, end, "", record[1], record[2])]
        if found:
            if gap is not None:
                yield Found(gap, at, why, {}, b"")
                gap = None
            yield from found
            if wrong:
                yield Found(at, end, f"in a member: {wrong}", {}, b"")
            at = end
            continue
        if gap is None:
            gap, why = at, wrong
        if end > at:  # a whole member without a record
            at = end
            continue
        if member_at <= at:
            member_at = data.find(MEMBER, at + 1) % (len(data) + 1)  # -1: the end
        if version_at <= at:
            version = VERSION.search(data, at + 1)
            version_at = version.start() if version else len(data)
        at = min(member_at, version_at)
    if gap is not None:
        yield Found(gap, len(data), why, {}, b"")


def with_types(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", least: int = LEAST) -> DataFrame:
    """page_id, url, payload and refers_to (null for responses)."""
    rows = pages.select(pages[page_id].alias("page_id"), pages[url].alias("url"), F.coalesce(pages[payload], F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.when(F.length("payload") >= least, F.unhex(F.sha1("payload"))))
    shared = rows.groupBy("digest").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND digest IS NOT NULL")
    joined = rows.join(shared, "digest", "left")
    return joined.select("page_id", "url", "payload", F.when(F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")).alias("refers_to"))


def write_archives(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Rows as with_types() gives them, as archives below the folder (a URI). Returns part, archives and n_records of each task."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        part = TaskContext.get().partitionId()
        done, own = f"{root}/part-{part:06d}", f"{root}/_part-{part:06d}-{uuid.uuid4().hex}"
        n_archives = n_records = size = 0
        out = None
        for batch in batches:
            for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    if not n_archives:
                        store.create_dir(own, recursive=True)
                    out, size = store.open_output_stream(f"{own}/{n_archives:05d}.warc.gz", compression=None), 0
                    n_archives += 1
                machine = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                member = machine.compress(record_bytes(page_id, url, payload, refers_to)) + machine.flush()
                out.write(member)
                n_records, size = n_records + 1, size + len(member)
                if size >= archive_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        if n_archives:
            if store.get_file_info(done).type == fs.FileType.NotFound:
                try:
                    store.move(own, done)
                except OSError:
                    if store.get_file_info(done).type == fs.FileType.NotFound:
                        raise
            if store.get_file_info(own).type != fs.FileType.NotFound:
                store.delete_dir(own)
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([n_archives], pa.int64()), pa.array([n_records], pa.int64())], names=["part", "archives", "n_records"])

    return rows.select("page_id", "url", "payload", "refers_to").mapInArrow(write, "part long, archives long, n_records long")


FIELDS = "file string, start long, end long, gap string, record_id string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary"


def read_archives(spark: SparkSession, paths: str | list[str], with_payload: bool = True) -> DataFrame:
    """A row for each record, and one for each quarantined gap (gap says why; its other columns are null).

    payload_bytes and payload_digest are those of the full payload: measured for records that hold it, and as the headers
    give them for revisits.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").option("recursiveFileLookup", "true").load(paths).select("path", "content")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1), strict=True):
                rows, held = [], 0
                for x in salvage(content.as_py()):
                    if x.why:
                        rows.append((file.as_py(), x.start, x.end, x.why, *[None] * 6))
                    else:
                        h = x.headers
                        revisit = h.get("warc-type") == "revisit"
                        n_bytes = int(h["x-payload-length"]) if revisit and h.get("x-payload-length", "").isdigit() else len(x.payload)
                        digest = h.get("warc-payload-digest", "").removeprefix("sha1:") if revisit else base32_sha1(x.payload)
                        rows.append((file.as_py(), x.start, x.end, None, h.get("warc-record-id"), h.get("warc-type"), h.get("warc-refers-to"), n_bytes, digest, x.payload if with_payload else None))
                        held += len(x.payload) * with_payload
                    if len(rows) >= 5000 or held > 8 << 20:
                        yield result(rows)
                        rows, held = [], 0
                yield result(rows)

    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in FIELDS.split(", ")]

    def result(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return files.mapInArrow(read, FIELDS)


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write the pages as archives into the shared folder, and read those back: page_id, payload_bytes, payload_digest, record_type, refers_to.
    Only that table stays; the archives are removed once it is written."""
    with scratch(pages.sparkSession) as keep:
        return _round_trip(pages, page_id, url, payload, keep)


def _round_trip(pages: DataFrame, page_id: str, url: str, payload: str, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    spark = pages.sparkSession
    folder = f"{shared_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    kind = pages.schema[page_id].dataType.simpleString()
    written = stored(write_archives(with_types(pages, page_id, url, payload), folder), "warc-parts").agg(F.sum("n_records")).first()[0]
    if not written:
        return spark.createDataFrame([], f"page_id {kind}, payload_bytes long, payload_digest string, record_type string, refers_to {kind}")
    back = read_archives(spark, folder, with_payload=False).filter("gap IS NULL")
    number = lambda c: F.nullif(F.regexp_extract(c, "^<urn:page:(.*)>$", 1), F.lit("")).cast(kind)
    out = keep(back.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to")), "warc-records")
    removed(spark, folder)
    return out


#: Base32 of a SHA-1: 5 hexadecimal digits make 4 characters.
_BASE32 = """list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1, 1)), 'string_agg', '')"""

ORACLE_SQL = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages), l AS (SELECT h, max(page_id) AS last FROM p GROUP BY h)
SELECT page_id, strlen(t)::BIGINT AS payload_bytes, {_BASE32.replace("substr(h,", "substr(p.h,")} AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to
FROM p JOIN l ON p.h = l.h"""

"""URL verdicts by cascades of Bloom filters.

A listed key is a host and a path, written together: `example.net/en/` lists the
paths that start with /en/ on example.net and its subdomains. A list is compiled
against the keys that the corpus really holds: the first filter of a cascade
encodes the listed keys; the keys of the corpus that pass it but aren't listed
are encoded by the second one; the listed keys that pass that one by the third,
and so on until no key passes wrongly. For any key of the corpus the number of
filters that it passes then tells exactly whether it is listed, so URLs are
judged without a join.

Keys of the corpus are made distinct by one aggregation with partial sums; the
filters are small (a few bits for each listed key) and are sent to all tasks.
Their size is checked against MAX_BYTES. A longer list is taken in parts, by a hash
of its keys and by their shapes, with a pass over the URLs for each; a URL is listed
if any part lists one of its keys, so no task ever holds more than one part.

Defined results: a null URL or one without `://` has an empty host and path,
matches nothing and gets the method's verdict allow; repeated rows give repeated
results; an empty table gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import scratch, stored

#: Bytes that the filters of one list may take, and levels of a cascade.
MAX_BYTES = 64 << 20
MAX_LEVELS = 64
#: Shapes (labels of the host, characters of the path) of a part of the list; a URL has one key at most for each.
MAX_SHAPES = 256
#: Bits that a listed key may take in all levels together.
KEY_BITS = 48

URL_PATTERN = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    key: str
    verdict: str


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL_PATTERN, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL_PATTERN, 2), F.lit(""))


def shape(key: str) -> tuple[int, int]:
    """Labels of the host and characters of the path."""
    host, slash, path = key.partition("/")
    return host.count(".") + 1, len(slash + path)


def keys_of(host: str, path: str, shapes: list[tuple[int, int]]) -> list[str]:
    """The keys of a URL that have one of the shapes, the longest first."""
    labels = host.split(".")
    found = [".".join(labels[-n:]) + path[:size] for n, size in shapes if n <= len(labels) and size <= len(path)] if host else []
    return sorted(found, key=len, reverse=True)


class Bloom(NamedTuple):
    bits: np.ndarray
    size: int
    hashes: int
    seed: int

    @staticmethod
    def sized(n: int, rate: float, seed: int) -> Bloom:
        size = max(64, math.ceil(-n * math.log(rate) / math.log(2) ** 2))
        return Bloom(np.zeros(-(-size // 64), np.uint64), size, max(1, min(20, round(-math.log2(rate)))), seed)

    def at(self, keys: list[str]) -> np.ndarray:
        """Positions of each key's bits."""
        h = np.array([xxhash.xxh3_64_intdigest(k, self.seed) for k in keys], np.uint64)
        with np.errstate(over="ignore"):
            step = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(17) | np.uint64(1)
            return ((h[:, None] + np.arange(self.hashes, dtype=np.uint64) * step[:, None]) % np.uint64(self.size)).astype(np.int64)

    def has(self, keys: list[str]) -> np.ndarray:
        at = self.at(keys)
        return ((self.bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).all(axis=1) if keys else np.zeros(0, bool)


def passing(keys: DataFrame, bloom: Bloom) -> DataFrame:
    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(bloom.has(batch.column(0).to_pylist())))

    return keys.mapInArrow(test, "key string")


def encoded(keys: DataFrame, n: int, rate: float, seed: int) -> Bloom:
    """A filter of these n keys; only words of the filter reach the driver."""
    empty = Bloom.sized(n, rate, seed)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = empty.at(batch.column(0).to_pylist()).ravel() if batch.num_rows else np.zeros(0, np.int64)
            word, where = np.unique(at >> 6, return_inverse=True)
            bits = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(bits, where, np.uint64(1) << (at & 63).astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.int64()), pa.array(bits.view(np.int64), pa.int64())], names=["word", "bits"])

    found = keys.mapInArrow(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).collect()
    for word, bits in found:
        empty.bits[word] = np.int64(bits).view(np.uint64)
    return empty


class Cascade(NamedTuple):
    levels: list[Bloom]

    def has(self, keys: list[str]) -> np.ndarray:
        """Exact for keys of the corpus that it was compiled against."""
        inside, open_ = np.zeros(len(keys), bool), np.arange(len(keys))
        for level in self.levels:
            if not len(open_):
                break
            open_ = open_[level.has([keys[i] for i in open_])]
            inside[open_] ^= True
        return inside


def compiled(listed: DataFrame, corpus: DataFrame) -> Cascade:
    """The cascade of the listed keys (column key) against all keys of the corpus (column key, distinct)."""
    inside = stored(listed.select("key").distinct().join(corpus.select("key"), "key", "left_semi"), "listed")
    outside = stored(corpus.select("key").join(listed.select("key"), "key", "left_anti"), "unlisted")
    n_inside, n_outside, levels = inside.count(), outside.count(), []
    while n_inside:
        if len(levels) == MAX_LEVELS:
            raise ValueError("the cascade doesn't end: two keys have the same hash")
        rate = min(0.5, max(1e-6, 0.7 * n_inside / max(1, n_outside))) if not levels else 0.5
        levels.append(encoded(inside, n_inside, rate, len(levels) + 1))
        wrong = stored(passing(outside, levels[-1]), "passing")
        inside, outside, n_inside, n_outside = wrong, inside, wrong.count(), n_inside
    return Cascade(levels)


def corpus_keys(urls: DataFrame, shapes: list[tuple[int, int]]) -> DataFrame:
    """All distinct keys of the URLs (columns host, path) that have one of the shapes."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = {k for host, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for k in keys_of(host, path, shapes)}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(own), pa.string())], names=["key"])

    return urls.select("host", "path").mapInArrow(keys, "key string").distinct()


def parts_of(listed: DataFrame, max_bytes: int = MAX_BYTES, max_shapes: int = MAX_SHAPES) -> list[tuple[list[tuple[int, int]], DataFrame]]:
    """The list (column key) in parts, each with its shapes: few enough shapes, and keys that fit into max_bytes."""
    with_shape = listed.select("key", *_shape_columns())
    shapes = sorted((r.labels, r.chars, r.n) for r in with_shape.groupBy("labels", "chars").agg(F.count(F.lit(1)).alias("n")).collect())  # as many as paths have lengths
    found = []
    for i in range(0, len(shapes), max_shapes):
        own = shapes[i : i + max_shapes]
        low, high = own[0][:2], own[-1][:2]
        at = F.struct("labels", "chars")
        keys = with_shape.filter((at >= F.struct(*map(F.lit, low))) & (at <= F.struct(*map(F.lit, high)))).select("key")
        n = max(1, -(-sum(x[2] for x in own) * KEY_BITS // (8 * max_bytes)))
        found += [([x[:2] for x in own], keys.filter(F.pmod(F.xxhash64("key"), F.lit(n)) == k) if n > 1 else keys) for k in range(n)]
    return found


def judge(pages: DataFrame, rules: list[Rule], listed: DataFrame, page_id: str = "page_id", url: str = "url", max_bytes: int = MAX_BYTES, max_shapes: int = MAX_SHAPES) -> DataFrame:
    """page_id, host, path, the longest rule that fits, and the verdict; without a rule, block if a key of the URL is listed.

    rules are few and given in full; listed (column key) may be long.
    """
    with scratch(pages.sparkSession) as keep:
        return _judged(pages, rules, listed, page_id, url, max_bytes, max_shapes, keep)


def _judged(pages: DataFrame, rules: list[Rule], listed: DataFrame, page_id: str, url: str, max_bytes: int, max_shapes: int, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    spark = pages.sparkSession
    kind = pages.schema[page_id].dataType.simpleString()
    urls = pages.select(pages[page_id].alias("page_id"), host_of(pages[url]).alias("host"), path_of(pages[url]).alias("path"), F.lit(False).alias("listed"))
    parts = parts_of(listed, max_bytes, max_shapes)
    for shapes, keys in parts:
        cascade = compiled(keys, stored(corpus_keys(urls, shapes), "keys"))

        def mark(batches: Iterator[pa.RecordBatch], shapes=shapes, cascade=cascade) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own, has = _lookup(batch, shapes, {"listed": cascade})
                hit = [yes or not has["listed"].isdisjoint(x) for yes, x in zip(batch.column(3).to_pylist(), own, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(hit, pa.bool_())], names=["page_id", "host", "path", "listed"])

        urls = urls.mapInArrow(mark, f"page_id {kind}, host string, path string, listed boolean")
        if len(parts) > 1:
            urls = keep(urls, "marked")
    shapes = sorted({shape(r.key) for r in rules})
    corpus = stored(corpus_keys(urls, shapes), "keys")
    cascades = {v: compiled(spark.createDataFrame([(r.key,) for r in rules if r.verdict == v], "key string"), corpus) for v in ("block", "allow")}

    def verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, has = _lookup(batch, shapes, cascades)
            rule = [next((k for k in x if k in has["block"] or k in has["allow"]), None) for x in own]
            verdict = [("allow" if r in has["allow"] else "block") if r else "block" if hit else "allow" for r, hit in zip(rule, batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names=["page_id", "host", "path", "rule", "verdict"])

    return urls.mapInArrow(verdicts, f"page_id {kind}, host string, path string, rule string, verdict string")


def _lookup(batch: pa.RecordBatch, shapes: list[tuple[int, int]], cascades: dict[str, Cascade]) -> tuple[list[list[str]], dict[str, set[str]]]:
    """The keys of each URL (columns 1 and 2: host and path), and those of all that each cascade has."""
    own = [keys_of(h, p, shapes) for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
    every = sorted({k for x in own for k in x})
    return own, {name: {k for k, yes in zip(every, c.has(every), strict=True) if yes} for name, c in cascades.items()}


def _shape_columns() -> list[Column]:
    host, path = F.substring_index("key", "/", 1), F.regexp_extract("key", "(?s)^[^/]*(.*)$", 1)
    return [(F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1).alias("labels"), F.length(path).alias("chars")]


#: The rules and the listed keys of the registered query.
RULES = [Rule("net/", "block"), Rule("example.net/en/", "allow"), Rule("example.com/de/", "block"), Rule("org/fr/", "allow")]
LISTED_SITES = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
LISTED = [f"{site}.example.{top}/" for site in LISTED_SITES for top in ("com", "net", "org")]

_HOST = f"translate(coalesce(regexp_extract(url, '{URL_PATTERN}', 1), ''), '{_UPPER}', '{_LOWER}')"
_FITS = "((host = k.h OR ends_with(host, '.' || k.h)) AND starts_with(path, k.p))"


def _values(keys: list[str]) -> str:
    return ", ".join(f"('{k}', '{k.partition('/')[0]}', '/{k.partition('/')[2]}')" for k in keys)


ORACLE_SQL = f"""WITH u AS (SELECT page_id, {_HOST} AS host, coalesce(regexp_extract(url, '{URL_PATTERN}', 2), '') AS path FROM pages),
r(k, h, p) AS (VALUES {_values([r.key for r in RULES])}),
l(k, h, p) AS (VALUES {_values(LISTED)}),
m AS (SELECT page_id, host, path, (SELECT k.k FROM r AS k WHERE {_FITS} ORDER BY length(k.k) DESC LIMIT 1) AS rule,
        (SELECT count(*) FROM l AS k WHERE {_FITS}) AS n_listed FROM u)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ({", ".join(repr(r.key) for r in RULES if r.verdict == "allow")}) THEN 'allow' WHEN rule IS NOT NULL OR n_listed > 0 THEN 'block' ELSE 'allow' END AS verdict
FROM m"""

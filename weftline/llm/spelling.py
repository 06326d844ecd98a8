"""Groups of spelling variants: words one edit apart, each led to a far more frequent form.

Words are counted over all texts. To find those that differ by one inserted, deleted
or replaced letter, they are put into blocks: for a pair whose shorter word has s
letters, everything before and behind the edit is equal, so if the edit lies in the
stretch [lo, hi) of the shorter word, both share the letters before lo and the last
s - hi letters. A block is (s, lo, hi, those letters), and begins with the two halves.
A block of more than MOST_LETTERS letters is cut: its words go to the two halves of
its stretch, again and again. A stretch of one letter can't hold more words than the
alphabet allows, so every block is bounded, whatever the vocabulary.

Inside a block the letters of the stretch are searched with a bit-sliced position
index: for each position and letter, a bitset over the block's words. The words of s
letters ask, all at once: the recurrences keep, for each of them, the set of words
that agree so far, that agree with one letter replaced, and that agree with one
letter more (whose positions are shifted by one), 64 words in one operation. A pair
lies in the stretch of its first differing letter in exactly one block, which is the
one that reports it.

Defined results: null, empty texts and texts without letters have no words; a null id
counts as an empty one in the hash that garbles runs; repeated rows count again; ties
of forms go to the smallest word; an empty table gives an empty table; texts of any
length are read in whole, and words may have any length; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import keep_nothing, let, scratch, stored
from weftline.operators import graph

#: Least letters and occurrences of a word, and how often more its form must occur.
LEAST_LETTERS = 7
LEAST_COUNT = 2
RATIO = 10
#: Of how many runs of a document one loses a letter (by its hash), as the contract of the query says.
GARBLED = 31
#: Letters of a block's stretch that are searched at once.
MOST_LETTERS = 1 << 16

_RUN = "[A-Za-zÀ-ÿ]"


def runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_LETTERS, garbled: int | None = GARBLED) -> DataFrame:
    """A row `word` for each maximal run of Latin letters, A-Z in lower case; where the divisor divides the hash of id and
    run, the run loses a letter. Runs under the least number of letters are left out."""
    found = F.explode(F.regexp_extract_all(docs[text].cast("string"), F.lit(f"{_RUN}{{{least},}}"), F.lit(0)))
    rows = docs.select(F.coalesce(docs[doc_id].cast("string"), F.lit("")).alias("id"), found.alias("run"))
    low = F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    if garbled is None:
        return rows.select(low.alias("word"))
    hashed = lambda run: F.crc32(F.concat("id", F.lit(":"), run).cast("binary"))
    at = lambda h, run: (h % F.length(run)).cast("int")
    less = lambda h, run: F.concat(F.substring(run, F.lit(1), at(h, run)), F.substring(run, at(h, run) + 2, F.length(run)))
    word = let(low, lambda run: let(hashed(run), lambda h: F.when(h % garbled == 0, less(h, run)).otherwise(run)))
    return rows.select(word.alias("word")).filter(F.length("word") >= least)


def vocabulary(words: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """word and n of those that occur often enough."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def _stretch(size: Column, lo: Column, hi: Column) -> Column:
    """word, n, s, lo, hi and the ends that a block's words share."""
    w = F.col("word")
    tail = size - hi
    return F.struct(size.alias("s"), lo.alias("lo"), hi.alias("hi"), F.substring(w, F.lit(1), lo).alias("head"), F.substring(w, F.length(w) - tail + 1, tail).alias("tail"))


_BLOCK = ["s", "lo", "hi", "head", "tail"]


def blocks(words: DataFrame, most_letters: int = MOST_LETTERS) -> DataFrame:
    """word, n and block (s, lo, hi, head, tail) of blocks with a word that can ask and another one, none above the bound that
    can still be cut."""
    size = F.length("word")
    halves = [x for s in (size, size - 1) for x in (_stretch(s, F.lit(0), F.floor(s / 2).cast("int")), _stretch(s, F.floor(s / 2).cast("int"), s))]
    rows = words.filter(size > 1).select("word", "n", F.explode(F.array(*halves)).alias("b")).select("word", "n", "b.*")
    done = None
    while True:
        rows = stored(rows, "stretches")
        asks = F.when(F.length("word") == F.col("s"), 1).otherwise(0)
        each = rows.groupBy(*_BLOCK).agg(F.count(F.lit(1)).alias("size"), F.sum(asks).alias("asking")).filter("size > 1 AND asking > 0")
        wide = (F.col("size") * (F.col("hi") - F.col("lo") + 1) > most_letters) & (F.col("hi") - F.col("lo") > 1)
        each = stored(each.select(*_BLOCK, wide.alias("wide")), "blocks")
        small = rows.join(each.filter("NOT wide").drop("wide"), _BLOCK)
        done = small if done is None else done.unionByName(small)
        if each.filter("wide").isEmpty():
            return done
        middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        halves = F.array(_stretch(F.col("s"), F.col("lo"), middle), _stretch(F.col("s"), middle, F.col("hi")))
        rows = rows.join(each.filter("wide").drop("wide"), _BLOCK).select("word", "n", F.explode(halves).alias("b")).select("word", "n", "b.*")


class PositionIndex:
    """Bitsets over words (arrays of letter codes, 0 behind the end), for each position and letter."""

    def __init__(self, letters: np.ndarray):
        self.n, self.width = letters.shape
        self.alphabet, codes = np.unique(letters, return_inverse=True)
        self.codes = codes.reshape(letters.shape)
        lanes = -(-self.n // 64)
        self.bits = np.zeros((self.width, len(self.alphabet), lanes), np.uint64)
        for p in range(self.width):
            held, own = np.unique(self.codes[:, p], return_inverse=True)
            flags = np.zeros((len(held), lanes * 64), np.uint8)
            flags[own, np.arange(self.n)] = 1
            self.bits[p, held] = np.packbits(flags, axis=1, bitorder="little").view(np.uint64)
        self.every = np.packbits(np.arange(lanes * 64) < self.n, bitorder="little").view(np.uint64)

    def members(self, flags: np.ndarray) -> np.ndarray:
        """The bitset of the words that are flagged."""
        padded = np.zeros(len(self.every) * 64, bool)
        padded[: self.n] = flags
        return np.packbits(padded, bitorder="little").view(np.uint64)

    def one_edit(self, asking: np.ndarray, length: int, same: np.ndarray, longer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (asking word, word) of words with `length` letters and, within the sets of words that are as long or one letter
        longer, those that differ by one replaced or one inserted letter."""
        shape = (len(asking), len(self.every))
        exact = np.broadcast_to(self.every, shape).copy()
        replaced, inserted = np.zeros(shape, np.uint64), exact.copy()  # a letter more may come first of all
        for p in range(length):
            own = self.codes[asking, p]
            here = self.bits[p][own]
            replaced &= here
            replaced |= exact  # any letter at p
            exact &= here
            inserted &= self.bits[p + 1][own]
            inserted |= exact
        replaced &= ~exact & same
        inserted &= longer
        flags = np.unpackbits((replaced | inserted).view(np.uint8), axis=1, bitorder="little")
        row, found = np.nonzero(flags[:, : self.n])
        return asking[row], found


def _pairs_of(words: list[str], s: int, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (indices) of a block whose first differing letter lies in its stretch, the first of each pair with s letters."""
    size = np.array([len(w) for w in words])
    width = hi - lo + 1
    raw = "".join(w[lo : len(w) - (s - hi)].ljust(width, "\0") for w in words).encode("latin-1")
    letters = np.frombuffer(raw, np.uint8).reshape(len(words), width)
    index = PositionIndex(letters)
    asking = np.flatnonzero(size == s)
    a, b = index.one_edit(asking, hi - lo, index.members(size == s), index.members(size == s + 1))
    once = (size[b] > s) | (a < b)
    a, b = a[once], b[once]
    differs = letters[a] != letters[b]
    first = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
    own = (first < hi - lo) | (hi == s)
    return a[own], b[own]


_PAIRS = pa.schema([("word", pa.string()), ("n", pa.int64()), ("near", pa.string()), ("near_n", pa.int64())])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of the blocks of a partition, whose rows lie next to each other."""
    keep_nothing()
    block, words, counts = None, [], []

    def found() -> Iterator[pa.RecordBatch]:
        a, b = _pairs_of(words, *block[:3])
        for at in range(0, len(a), 10_000):
            left, right = a[at : at + 10_000].tolist(), b[at : at + 10_000].tolist()
            yield pa.RecordBatch.from_arrays([pa.array([words[i] for i in left], pa.string()), pa.array([counts[i] for i in left], pa.int64()), pa.array([words[i] for i in right], pa.string()), pa.array([counts[i] for i in right], pa.int64())], schema=_PAIRS)

    for batch in batches:
        for s, lo, hi, head, tail, word, n in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
            if block != (s, lo, hi, head, tail):
                if len(words) > 1:
                    yield from found()
                block, words, counts = (s, lo, hi, head, tail), [], []
            words.append(word)
            counts.append(n)
    if len(words) > 1:
        yield from found()


def near_pairs(words: DataFrame, most_letters: int = MOST_LETTERS) -> DataFrame:
    """word, n, near and near_n: each pair of words (word, n) one edit apart once."""
    rows = blocks(words, most_letters)
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.select(*_BLOCK, "word", "n").repartition(parts, *_BLOCK).sortWithinPartitions(*_BLOCK)
    return rows.mapInArrow(_search, "word string, n long, near string, near_n long")


def groups(words: DataFrame, ratio: int = RATIO, most_letters: int = MOST_LETTERS) -> DataFrame:
    """word, n, n_near, form, form_n and root of each word (word, n)."""
    with scratch(words.sparkSession) as keep:
        words = stored(words, "words")
        pairs = near_pairs(words, most_letters)
        pairs = pairs.select(F.explode(F.array(F.struct("word", "n", "near", "near_n"), F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))).alias("p")).select("p.*")
        best = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("form"))).alias("best"))
        led = -F.col("best.m") >= ratio * F.col("n")
        out = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(led, F.col("best.form")).alias("form"), F.when(led, -F.col("best.m")).alias("form_n"))
        out = stored(out, "forms")
        roots = graph.roots(out.filter("form IS NOT NULL"), "word", "form").withColumnRenamed("key", "word")
        return keep(out.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word")), "spelling")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", garbled: int | None = GARBLED, least: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """The groups of the words of all texts."""
    return groups(vocabulary(runs(docs, doc_id, text, least, garbled), least_count), ratio)


#: DuckDB has no CRC-32: it is folded over bytes and bits. Words are near if one without some letter is the other, or both without the same one are equal.
_CRC = "xor(list_reduce(flatten(list_transform(string_split(s, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END)), lambda c, b: list_reduce(range(0, 8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)), 4294967295), 4294967295)"

ORACLE_SQL = f"""
WITH RECURSIVE found AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{7,}}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
), counted AS (
  SELECT doc_id, run, count(*) AS n, coalesce(doc_id::VARCHAR, '') || ':' || run AS s FROM found GROUP BY doc_id, run
), hashed AS (
  SELECT run, n, {_CRC} AS h FROM counted
), garbled AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM garbled WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), less AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)
), pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form, CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n FROM words w LEFT JOIN best b ON w.word = b.word
), walk AS (
  SELECT word, word AS root, form AS next FROM forms
  UNION ALL
  SELECT w.word, f.word, f.form FROM walk w JOIN forms f ON f.word = w.next
)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, w.root FROM forms f JOIN walk w ON w.word = f.word WHERE w.next IS NULL
"""

"""Jaccard self-join of documents on word n-grams, with count-vector R-trees.

Two documents are linked when their sets of 5-word shingles have a Jaccard
similarity of 0.8 or more. The join is exact; nothing is sampled or capped.

1. Equal sets are one class; its smallest id stands for it. From here on there
   are classes only.
2. A class is a point: its shingles are hashed into GROUPS groups, and the group
   counts are the coordinates. Trees over all points of a corpus would have to be
   built somewhere, so points are first put into blocks: shingles have one order
   for the whole corpus (rare ones by hash, then the frequent ones, which only
   makes blocks small, and has no effect on the result). Of linked sets, the
   smaller has one of its first n - ceil(8n/9) + 1 shingles among the first
   n - ceil(4n/5) + 1 of the other, and one more for each PER_KEY shingles if both
   prefixes are as much longer. Each such shingle is a block; blocks with the same
   points are one block with a weight.
3. An R-tree over the points of a block is searched with the bound that the sum
   of the coordinate minima puts on the overlap. In a first turn, each point takes
   the nearest one in its tile (at most TILE points of a block) that the bound
   doesn't rule out; these pairs are verified on the shingles of the whole texts and
   joined to components, so groups of near copies come together without all their
   pairs.
4. What is left are blocks with points of several components. They are searched
   for all pairs between components; parts of a tree that hold nothing but the
   own component are passed over. Pairs must be found in as many blocks as step 2
   says; they are verified, and the components joined on. Blocks of more than
   BLOCK points are dealt out: by size range first (linked sizes differ by a
   quarter at most), then those of the largest component against the others,
   and the others against each other, in tiles of BLOCK points.

Every link comes through a tree. Keys are shuffled once; the rows of a frequent key
are counted in many tasks, and the skew join of adaptive execution splits it where
its blocks are joined back. What is written in between is removed when the result is written.

Defined results: an empty or null text has no shingles and is linked with
nothing; rows without an id are linked with nothing and have no component; rows
that repeat an id are one document for linking, with a row each in the result;
an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from weftline.llm.common import batches_of, keep_nothing, scratch, stored
from weftline.operators.graph import components
from weftline.llm.shingles import in_steps, mix, shingle_sets

#: Similarity as a fraction, groups of the count vectors, points of a leaf, of a tile of the first turn, and of a tile of the last.
NUMERATOR, DENOMINATOR = 4, 5
GROUPS = 512
LEAF = 16
TILE = 256
BLOCK = 512
#: Counts are single bytes; this one stands for any higher count.
MOST = 255
#: Shingles that are counted at once, the share of documents that makes one frequent there, and the most that are kept as such.
COUNTED = 1 << 20
FREQUENT = 1000
MOST_FREQUENT = 100_000
#: A pair must share one key, and one more for each PER_KEY shingles of the smaller set.
PER_KEY = 30
#: Rows that a Python worker holds at once.
ROWS = 1500
#: Ids that are sent to all tasks at most (8 bytes each); beyond, both sides are shuffled.
MOST_SENT = 500_000


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[text], F.lit("")).cast("binary").alias("text"))


def _batch(columns: list, fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


_SKETCH = [("doc_id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("counts", pa.binary()), ("shingle", pa.int64()), ("seen", pa.int64())]


def sketches(rows: DataFrame) -> DataFrame:
    """For each document its set's size, two hashes and group counts; and rows (shingle, seen) for shingles that many documents of a run have."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_nothing()
        held: list[np.ndarray] = []
        n_held = n_docs = 0

        def frequent() -> pa.RecordBatch:
            shingle, seen = np.unique(np.concatenate(held), return_counts=True)
            often = seen >= max(6, n_docs / FREQUENT)
            m = int(often.sum())
            return _batch([[None] * m, [None] * m, [None] * m, [None] * m, [None] * m, shingle[often].view(np.int64), seen[often]], _SKETCH)

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in in_steps(texts):
                sets, first = shingle_sets(texts[a:b])
                n = np.diff(first)
                owner = np.repeat(np.arange(b - a), n)
                counts = np.bincount(owner * GROUPS + (sets & np.uint64(GROUPS - 1)).astype(np.int64), minlength=(b - a) * GROUPS)
                counts = np.minimum(counts, MOST).astype(np.uint8).tobytes()
                sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(sets ^ np.uint64(0x5BF03635)))])
                xors = np.concatenate([[np.uint64(0)], np.bitwise_xor.accumulate(mix(sets + np.uint64(0x2F0B4C47)))])
                s1, s2 = sums[first[1:]] - sums[first[:-1]], xors[first[1:]] ^ xors[first[:-1]]
                size = GROUPS
                yield _batch([ids[a:b], n, s1.view(np.int64), s2.view(np.int64), [counts[i * size : (i + 1) * size] for i in range(b - a)], [None] * (b - a), [None] * (b - a)], _SKETCH)
                held.append(sets)
                n_held, n_docs = n_held + len(sets), n_docs + b - a
                if n_held >= COUNTED:
                    yield frequent()
                    held, n_held, n_docs = [], 0, 0
        if held:
            yield frequent()

    return rows.mapInArrow(sketch, "doc_id long, n long, s1 long, s2 long, counts binary, shingle long, seen long")


_KEY = [("key", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("index", pa.bool_()), ("late", pa.bool_())]


def block_keys(rows: DataFrame, frequent: np.ndarray) -> DataFrame:
    """The shingles of each set's prefixes: key, id, n, whether it is in the shorter prefix, which holds for the smaller set of a
    pair (index), and whether it is a frequent one (late)."""
    spark = rows.sparkSession
    late = spark.sparkContext.broadcast(np.sort(frequent))  # MOST_FREQUENT at most

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_nothing()
        last = late.value
        for batch in batches:
            ids, texts = np.asarray(batch.column(0)), batch.column(1).to_pylist()
            for a, b in in_steps(texts):
                sets, first = shingle_sets(texts[a:b])
                n = np.diff(first)
                owner = np.repeat(np.arange(b - a), n)
                is_late = last[np.minimum(np.searchsorted(last, sets), len(last) - 1)] == sets if len(last) else np.zeros(len(sets), bool)
                order = np.lexsort((sets, is_late, owner))
                rank = np.arange(len(sets)) - np.repeat(first[:-1], n)  # the place in the order
                size = np.repeat(n, n)
                probe = size - -(-size * NUMERATOR // DENOMINATOR) + 1 + size // PER_KEY
                index = size - -(-size * 2 * NUMERATOR // (NUMERATOR + DENOMINATOR)) + 1 + size // PER_KEY
                keep = np.flatnonzero(rank < probe)
                yield _batch([sets[order[keep]].view(np.int64), ids[a:b][owner[keep]], size[keep], (rank < index)[keep], is_late[order[keep]]], _KEY)

    return rows.mapInArrow(keys, "key long, id long, n long, index boolean, late boolean")


def may_link(n_a, n_b, overlap):
    """Whether sets of these sizes with this overlap at most can be similar; exact when it is the overlap."""
    return overlap * (NUMERATOR + DENOMINATOR) >= (n_a + n_b) * NUMERATOR


_LANES = np.uint64(0x00FF00FF00FF00FF)


def overlap_bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sum of coordinate minima; without bound where both have a count of MOST, which may be higher."""
    least = np.minimum(a, b)
    words = least.view(np.uint64)  # eight counts each; their sums stay below 16 bits
    sums = ((words & _LANES) + ((words >> np.uint64(8)) & _LANES)).sum(axis=-1, dtype=np.uint64)
    total = sum((sums >> np.uint64(k)) & np.uint64(0xFFFF) for k in (0, 16, 32, 48)).astype(np.int64)
    return total + (least == MOST).any(axis=-1) * (1 << 40) if least.size and least.max() == MOST else total


class Tree:
    """An R-tree over count vectors: leaves of LEAF points, packed by size and then along the widest coordinate, under nodes of
    LEAF leaves. Nodes know the most of each coordinate, the least size, and the component if they hold only one."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, component: np.ndarray):
        slab = np.argsort(sizes, kind="stable")
        width = LEAF * LEAF
        parts = []
        for i in range(0, len(slab), width):
            part = slab[i : i + width]
            parts.append(part[np.argsort(points[part][:, points[part].var(axis=0, dtype=np.float32).argmax()], kind="stable")])
        self.order = np.concatenate(parts)
        self.levels = [(points[self.order], sizes[self.order], component[self.order], component[self.order])]
        for _ in range(2):
            high, least, low, top = self.levels[-1]
            at = np.arange(0, len(high), LEAF)
            self.levels.append((np.maximum.reduceat(high, at), np.minimum.reduceat(least, at), np.minimum.reduceat(low, at), np.maximum.reduceat(top, at)))

    def search(self, points: np.ndarray, sizes: np.ndarray, component: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For a few points at once, those of other components that the bound doesn't rule out: the places of both (in what
        was given, and in what the tree was built from), and the bound."""
        at = np.arange(len(self.levels[2][0]))
        for level in (2, 1):
            fits = np.concatenate([self._fits(level, part, points, sizes, component)[0].any(axis=0) for part in self._parts(at)] or [np.zeros(0, bool)])
            at = (at[fits][:, None] * LEAF + np.arange(LEAF)).ravel()
            at = at[at < len(self.levels[level - 1][0])]
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for part in self._parts(at):
            fits, bound = self._fits(0, part, points, sizes, component)
            i, j = np.nonzero(fits)
            found.append((i, self.order[part[j]], bound[i, j]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    @staticmethod
    def _parts(at: np.ndarray) -> list[np.ndarray]:
        """So many that the counts of a leaf against them stay small."""
        return [at[i : i + LEAF * LEAF] for i in range(0, len(at), LEAF * LEAF)]

    def _fits(self, level: int, at: np.ndarray, points: np.ndarray, sizes: np.ndarray, component: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        high, least, low, top = (x[at] for x in self.levels[level])
        others = (low != component[:, None]) | (top != component[:, None])
        bound = np.minimum(overlap_bound(points[:, None, :], high), sizes[:, None])
        return others & may_link(sizes[:, None], least, bound), bound


_PAIR = [("a", pa.int64()), ("b", pa.int64()), ("least", pa.int64()), ("shared", pa.int64())]


def tree_pairs(rows: DataFrame, nearest: bool) -> DataFrame:
    """rows (key, left, right, tile, id, n, index, weight, component, counts), sorted by key, left, right within partitions, to
    candidate pairs (a, b) of different components, with the size of the smaller set and the weight of the blocks they were
    found in (shared). nearest: for each point only the pair with the highest bound."""

    def may_meet(i, j, n, index):
        """Whether the block's key is in the prefixes that it must be in, for the pairs i, j."""
        return np.where(n[i] < n[j], index[i], np.where(n[i] > n[j], index[j], index[i] | index[j]))

    def best(of: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The places of the highest bound for each value of `of`."""
        order = np.lexsort((-bound, of))
        first = np.ones(len(order), bool)
        first[1:] = of[order][1:] != of[order][:-1]
        return order[first]

    def of_large(tile, left, right, ids, n, index, component, counts) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (places of rows) of one block: within a tile, or between the tiles left and right."""
        own, other = np.flatnonzero(tile == left), np.flatnonzero(tile == right)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        if len(own) and len(other):
            tree = Tree(counts[other], n[other], component[other])
            own = own[np.lexsort((n[own], component[own]))]
            for k in range(0, len(own), LEAF):
                part = own[k : k + LEAF]
                i, j, bound = tree.search(counts[part], n[part], component[part])
                i, j = part[i], other[j]
                good = may_meet(i, j, n, index)
                if left == right:
                    good = good & (ids[j] > ids[i])
                i, j, bound = i[good], j[good], bound[good]
                if nearest and len(i):
                    at = best(i, bound / (n[i] + n[j]))
                    i, j = i[at], j[at]
                found.append((i, j))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def of_leaves(start, ids, n, index, component, counts) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of all blocks that are a tree of a single leaf: start marks the first row of each row's block."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for d in range(1, LEAF):
            i = np.flatnonzero(start[d:] == start[:-d])
            if not len(i):
                break
            fits = (component[i] != component[i + d]) & may_meet(i, i + d, n, index)
            i = i[fits]
            i = i[may_link(n[i], n[i + d], np.minimum(n[i], n[i + d]))]
            bound = np.minimum(overlap_bound(counts[i], counts[i + d]), np.minimum(n[i], n[i + d]))
            near = may_link(n[i], n[i + d], bound)
            found.append((i[near], i[near] + d, (bound / (n[i] + n[i + d]))[near]))
        i, j, bound = (np.concatenate(x) for x in zip(*found, strict=True))
        if nearest and len(i):
            at = best(i, bound)
            i, j = i[at], j[at]
        return i, j

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_nothing()
        rest: list[pa.RecordBatch] = []

        def found(table: pa.Table) -> pa.RecordBatch:
            key, left, right, tile, ids, n, weight, component = (table.column(c).to_numpy() for c in ("key", "left", "right", "tile", "id", "n", "weight", "component"))
            index = table.column("index").to_numpy(zero_copy_only=False).astype(bool)
            counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.uint8).reshape(-1, GROUPS)
            new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (left[1:] != left[:-1]) | (right[1:] != right[:-1])]))
            length = np.diff(np.append(new, len(key)))
            start = np.repeat(new, length)
            leaf = np.flatnonzero(np.repeat((length <= LEAF), length) & (left == right))
            i, j = of_leaves(*(x[leaf] for x in (start, ids, n, index, component, counts)))
            every = [(leaf[i], leaf[j])]
            for a, size in zip(new, length, strict=True):
                if size > LEAF or left[a] != right[a]:
                    s = slice(a, a + size)
                    i, j = of_large(tile[s], left[a], right[a], ids[s], n[s], index[s], component[s], counts[s])
                    every.append((i + a, j + a))
            i, j = (np.concatenate(x) for x in zip(*every, strict=True))
            pair, where = np.unique(np.column_stack([np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j]), np.minimum(n[i], n[j])]), axis=0, return_inverse=True)
            shared = np.bincount(where.ravel(), weight[i], minlength=len(pair)).astype(np.int64)
            return _batch([*pair.T, shared], _PAIR)

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.column_stack([batch.column(i).to_numpy() for i in range(3)])
            cut = len(key) - int(np.argmax(np.any(key[::-1] != key[-1], axis=1))) if np.any(key != key[-1]) else 0
            if cut:
                yield found(pa.Table.from_batches([*rest, batch.slice(0, cut)]).combine_chunks())
                rest = []
            rest.append(batch.slice(cut))
        if rest:
            yield found(pa.Table.from_batches(rest).combine_chunks())

    return rows.mapInArrow(pairs, "a long, b long, least long, shared long")


def enough(least: Column, shared: Column) -> Column:
    """Whether a pair shares as many keys as its smaller set asks for."""
    return shared > F.floor(least / PER_KEY)


def _of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts whose doc_id is wanted; ids are sent to all tasks if they are few enough."""
    wanted = stored(wanted, "wanted")
    return texts.join(F.broadcast(wanted) if wanted.count() <= MOST_SENT else wanted, "doc_id", "left_semi")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are similar; texts has doc_id and text."""
    own = stored(_of(texts, pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()), "texts")
    both = pairs.join(own.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").join(own.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_nothing()
        for batch in batches:
            texts_a, texts_b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for at, end in in_steps([a + b for a, b in zip(texts_a, texts_b, strict=True)]):
                part, m = batch.slice(at, end - at), end - at
                sets, first = shingle_sets(texts_a[at:end] + texts_b[at:end])
                good = []
                for i in range(m):
                    x, y = sets[first[i] : first[i + 1]], sets[first[m + i] : first[m + i + 1]]
                    same = np.concatenate([x, y])
                    same.sort()
                    good.append(bool(len(x) and may_link(len(x), len(y), int((same[1:] == same[:-1]).sum()))))
                yield part.select([0, 1]).filter(pa.array(good))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(verify, "a long, b long")


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and class_id (the smallest id with an equal set) of each row."""
    with batches_of(docs.sparkSession, ROWS), scratch(docs.sparkSession) as keep:
        return keep(_join(docs, doc_id, text), "components")


def most_frequent(seen: DataFrame) -> np.ndarray:
    """The shingles (column shingle) with the highest values of seen, MOST_FREQUENT at most: all from a step of seen on."""
    steps = seen.groupBy(F.floor(F.log2("seen") * 8).alias("step")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("step")).collect()  # 512 rows at most
    least, total = None, 0
    for r in steps:
        total += r.n
        if total > MOST_FREQUENT:
            break
        least = r.step
    if least is None:
        return np.zeros(0, np.uint64)
    return np.array([r.shingle for r in seen.filter(F.floor(F.log2("seen") * 8) >= least).select("shingle").collect()], np.int64).view(np.uint64)


def blocks_of(keys: DataFrame) -> DataFrame:
    """keys (key, id, n, index, late) of blocks with two points or more, of points with enough of them; of blocks with the same points one stays, with their number as weight.

    Keys are shuffled once. The rows of a frequent key go to as many tasks as there are partitions, each of which counts its own.
    """
    salts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = keys.withColumn("salt", F.when(F.col("late"), F.pmod(F.xxhash64("id"), F.lit(salts))).otherwise(0).cast("int")).repartition("key", "salt")
    mark = lambda seed: F.bit_xor(F.xxhash64("id", "index", F.lit(seed)))
    part = W.partitionBy("key", "salt")
    own = own.withColumns({"size": F.count(F.lit(1)).over(part), "indexed": F.max("index").over(part), "m1": mark(1).over(part), "m2": mark(2).over(part)})
    own = stored(own.filter("late OR (size > 1 AND indexed)").drop("late"), "keys")
    parts = own.groupBy("key", "salt", "size", "indexed", "m1", "m2").agg(F.lit(1))
    block = parts.groupBy("key").agg(F.sum("size").alias("size"), F.max("indexed").alias("indexed"), F.bit_xor("m1").alias("m1"), F.bit_xor("m2").alias("m2")).filter("size > 1 AND indexed")
    block = stored(block.groupBy("size", "m1", "m2").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("weight")).select("key", "size", "weight"), "block")
    own = stored(own.select("key", "id", "n", "index").join(block, "key"), "in-blocks")
    busy = own.groupBy("id").agg(F.sum("weight").alias("shared"), F.max("n").alias("n")).filter(enough(F.ceil(F.col("n") * NUMERATOR / DENOMINATOR), F.col("shared")))
    return own.join(busy.select("id"), "id", "left_semi")


def _dealt(rows: DataFrame, point: DataFrame) -> DataFrame:
    """Rows with their counts, those of a key, left and right together and sorted."""
    own = rows.join(point.select("id", "counts"), "id").select("key", "left", "right", "tile", "id", "n", "index", "weight", "component", "counts")
    return own.repartition("key", "left", "right").sortWithinPartitions("key", "left", "right", "id")


def in_tiles(blocks: DataFrame) -> DataFrame:
    """Blocks in tiles of about TILE points, each searched by itself."""
    tile = F.pmod(F.xxhash64("key", "id"), F.ceil(F.col("size") / TILE)).cast("long")
    return blocks.withColumns({"component": F.col("id"), "tile": tile, "left": tile, "right": tile})


def between(blocks: DataFrame) -> DataFrame:
    """Blocks (with component) that hold several components, in tiles that together hold all pairs between components."""
    of_key = blocks.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
    own = blocks.drop("size").join(of_key.select("key", "size"), "key")
    small = own.filter(F.col("size") <= BLOCK).drop("size").withColumns({c: F.lit(0).cast("long") for c in ("tile", "left", "right")})
    # large blocks: each point in its size range and in the next one, then the largest component apart
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.01 * DENOMINATOR / NUMERATOR)))
    large = own.filter(F.col("size") > BLOCK).drop("size").withColumn("range", F.explode(F.array(step, step + 1)))
    in_range = large.groupBy("key", "range", "component").agg(F.count(F.lit(1)).alias("m"))
    in_range = in_range.groupBy("key", "range").agg(F.max(F.struct("m", "component")).alias("top"), F.sum("m").alias("all"))
    in_range = in_range.select("key", "range", F.col("top.component").alias("main"), F.ceil(F.col("top.m") / BLOCK).alias("n_main"), F.ceil((F.col("all") - F.col("top.m")) / BLOCK).alias("n_rest")).filter("n_rest > 0")
    large = large.join(in_range, ["key", "range"]).withColumn("is_main", F.col("component") == F.col("main"))
    tile = F.when(F.col("is_main"), -1 - F.pmod(F.xxhash64("id"), F.col("n_main"))).otherwise(F.pmod(F.xxhash64("id"), F.col("n_rest"))).cast("long")
    to = lambda a, b: F.sequence(F.lit(a).cast("long"), b.cast("long"))
    rest, main = to(0, F.col("n_rest") - 1), F.transform(to(1, F.col("n_main")), lambda k: -k)
    large = large.withColumn("tile", tile).withColumn("other", F.explode(F.when(F.col("is_main"), rest).otherwise(F.concat(rest, main))))
    large = large.withColumns({"left": F.greatest("tile", "other"), "right": F.least("tile", "other"), "key": F.xxhash64("key", "range")})
    return small.unionByName(large.select(*small.columns))


def _join(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    rows = _texts(docs, doc_id, text)
    sketch = stored(sketches(rows), "sketches")
    sets = sketch.filter("n IS NOT NULL").drop("shingle", "seen")
    frequent = most_frequent(stored(sketch.filter("seen IS NOT NULL").groupBy("shingle").agg(F.sum("seen").alias("seen")), "seen"))

    filled = sets.filter("n > 0 AND doc_id IS NOT NULL")
    classes = stored(filled.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("class_id"), F.max("counts").alias("counts")), "classes")
    members = stored(sets.drop("counts").join(classes.drop("counts"), ["n", "s1", "s2"], "left").select("doc_id", "n", "class_id"), "members")
    point = classes.select(F.col("class_id").alias("id"), "n", "counts")

    heads = _of(rows, classes.select(F.col("class_id").alias("doc_id")).distinct())
    blocks = stored(blocks_of(block_keys(heads, frequent)), "blocks")
    near = tree_pairs(_dealt(in_tiles(blocks), point), nearest=True).select("a", "b").distinct()
    links = stored(verified(stored(near, "near"), rows), "near-links")
    named = blocks.join(components(links), "id", "left").withColumn("component", F.coalesce("component", "id"))
    pairs = tree_pairs(_dealt(between(stored(named, "named")), point), nearest=False).groupBy("a", "b").agg(F.min("least").alias("least"), F.sum("shared").alias("shared"))
    pairs = stored(pairs.filter(enough(F.col("least"), F.col("shared"))).select("a", "b"), "pairs")
    linked = components(links.unionByName(verified(pairs, rows)))

    named = members.join(linked.withColumnRenamed("id", "class_id"), "class_id", "left")
    kind = docs.schema[doc_id].dataType
    of_class = F.coalesce("component", "class_id")
    alone = (F.col("n") == 0) | F.col("doc_id").isNull()
    return named.select(
        F.col("doc_id").cast(kind).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(of_class).cast(kind).alias("component_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).cast(kind).alias("class_id"),
    )


def clean(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group of linked ones, that with the smallest id. Of rows that repeat an id the one with the least
    text (by bytes, null first) stays, and of those the least by its other columns, as JSON. Rows without an id stay."""
    kept = join(docs, doc_id, text).filter("doc_id = component_id").select(F.col("doc_id").alias(doc_id)).distinct()
    named = docs.filter(F.col(doc_id).isNotNull()).join(kept, doc_id, "left_semi")
    least = F.struct(F.col(text).cast("binary").alias("t"), F.to_json(F.struct(*(F.col(c) for c in docs.columns if c not in (doc_id, text)), F.lit(0).alias("_"))).alias("o"))
    named = named.groupBy(doc_id).agg(F.min_by(F.struct(*docs.columns), least).alias("_row")).select("_row.*")
    return named.unionByName(docs.filter(F.col(doc_id).isNull())).select(*docs.columns)


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: The same rows by all shared shingles; for small tables.
ORACLE_SQL = f"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda t: t <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, sh FROM (SELECT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(generate_series(1, len(ws) - 4), lambda i: array_to_string(ws[i:i + 4], ' ')) ELSE [array_to_string(ws, ' ')] END) AS sh FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n, md5(string_agg(sh, chr(10) ORDER BY sh)) AS set FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
y AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id AS id, doc_id AS other FROM n UNION SELECT r.id, y.b FROM r JOIN y ON r.other = y.a),
c AS (SELECT id, min(other) AS component FROM r GROUP BY id), m AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY set) AS class FROM n)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.component, w.doc_id) AS component_id, coalesce(m.class, w.doc_id) AS class_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.id = w.doc_id LEFT JOIN m ON m.doc_id = w.doc_id"""

"""Benchmark decontamination by q-gram filtering and banded alignment.

Texts and benchmark items are folded: lower case (character by character), each
run of characters that are no letters, digits or marks as one space. The windows
of an item are its runs of WINDOW characters, one from each character on; a shorter
item is one window. A document leaks an item when some part of it is within the
edit budget of one of the item's windows. Items of fewer than SHORT characters
allow no edits: they leak where they stand whole, between spaces or ends.

By the q-gram lemma, two strings of which one has w characters and that are at most
e edits apart share w + 1 - q(e + 1) q-grams, on diagonals (place in the document
minus place in the item) that differ by e at most. All q-grams of a document are
looked up in the index of the items; hits are put into bands of STRIPE + e
neighbouring diagonals that overlap by e, so that every match lies in one band.
The window slides over the hits of a band; each that holds as many as the bound is
verified, character by character first, then by an alignment within the band.
Texts are searched in stretches of about HITS hits, which overlap by the length of
a match, so memory is bounded even where texts and items repeat themselves.

Documents are read once, in whole, without a shuffle. The index of the items
is sent to all tasks; distinct items are counted first, and those of more than
PART_BYTES are taken in parts, with a pass over the documents for each.

Defined results: null and empty texts leak nothing; null and empty items, and those
without letters or digits, are never found; equal items are found each by its own
id, which has its own type and may be null; repeated rows are found as often as they
come; clean judges each row by its own text, whatever its id is, null included;
empty tables give an empty result; other columns are not looked at.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import to_arrow_type

from weftline.llm.shingles import in_steps

Q = 10
WINDOW = 100
#: Edits for each character of a window, the length from which items allow any, and new diagonals of a band.
BUDGET = 0.08
SHORT = 20
STRIPE = 16
#: Windows of a band that one alignment may leave out, and hits that are held at once.
BLOCK = 16
HITS = 500_000
PART_BYTES = 1 << 20
_TABLE = 1 << 22
_SPACE = 32


def _fold() -> np.ndarray:
    """The folded character of each of the first 65,536; a zero stays, and ends what is before it."""
    out = np.full(1 << 16, _SPACE, np.uint16)
    for code in range(1, 1 << 16):
        c = chr(code)
        if c.isalnum() or unicodedata.category(c)[0] == "M":
            low = c.lower()
            out[code] = ord(low) if len(low) == 1 and ord(low) < 1 << 16 else code
    out[0] = 0
    return out


_FOLD = _fold()
_FACTORS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(1, max(Q, SHORT) + 1)], np.uint64)


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def folded(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The folded characters, and the place of each in raw. Characters beyond the first 65,536 count as letters."""
    out = _FOLD[np.minimum(raw, 0xFFFF)]
    far = raw > 0xFFFF
    out[far] = (raw[far] & 0x7FFF | 0x8000).astype(np.uint16)
    space = out == _SPACE
    keep = np.ones(len(out), bool)
    keep[1:] = ~(space[1:] & (space[:-1] | (out[:-1] == 0)))
    place = np.flatnonzero(keep)
    return out[place], place


def grams(data: np.ndarray, size: int = Q) -> np.ndarray:
    """A hash of the characters (size of them) from each place on."""
    n = max(0, len(data) - size + 1)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out += (data[k : k + n].astype(np.uint64) + np.uint64(1)) * _FACTORS[k]
    out = (out ^ (out >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(29))


def edits_allowed(size: np.ndarray) -> np.ndarray:
    """The budget of a window, lowered where the lemma would ask for no q-gram at all."""
    return np.maximum(0, np.minimum((size * BUDGET).astype(np.int64), size // Q - 1))


class Index(NamedTuple):
    """The items, the windows' size, edits and bound in each, and where each q-gram occurs; short holds, for each length,
    the hashes and numbers of the short items."""

    item: np.ndarray
    size: np.ndarray
    width: np.ndarray
    edits: np.ndarray
    bound: np.ndarray
    text: np.ndarray  # all items, one after the other
    start: np.ndarray
    table: np.ndarray
    gram: np.ndarray  # sorted, distinct
    first: np.ndarray
    row: np.ndarray
    place: np.ndarray
    short: dict


def index(items: list[tuple[int, str]]) -> Index:
    """Of numbered items. Those with equal folded texts have one number."""
    own, texts, grams_of, short = [], [], [], {}
    for item, raw in items:
        data, _ = folded(codes(raw.replace("\0", " ")))
        data = data[int(len(data) > 0 and data[0] == _SPACE) : len(data) - int(len(data) > 1 and data[-1] == _SPACE)]
        if 0 < len(data) < SHORT:
            short.setdefault(len(data), []).append((item, data))
        elif len(data):
            grams_of.append(grams(data))
            own.append(item)
            texts.append(data)
    size = np.array([len(t) for t in texts], np.int64)
    width = np.minimum(size, WINDOW)
    edits = edits_allowed(width)
    every = np.concatenate(grams_of) if own else np.zeros(0, np.uint64)
    n = size - Q + 1
    row = np.repeat(np.arange(len(own)), n)
    place = np.arange(len(every)) - np.repeat(np.cumsum(n) - n, n)
    order = np.argsort(every, kind="stable")
    gram, first = np.unique(every[order], return_index=True)
    table = np.zeros(_TABLE, bool)
    table[(gram >> np.uint64(42)).astype(np.int64)] = True
    text = np.concatenate([*texts, np.zeros(WINDOW, np.uint16)])
    tables = {k: (np.array([grams(d, k)[0] for _, d in x]), np.array([i for i, _ in x]), np.stack([d for _, d in x])) for k, x in short.items()}
    return Index(np.array(own, np.int64), size, width, edits, width + 1 - Q * (edits + 1), text, np.cumsum(size) - size, table, gram, np.append(first, len(every)), row[order], place[order], tables)


def short_hits(ix: Index, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """item, begin and length in data of the short items that stand between spaces or ends."""
    found = [(np.zeros(0, np.int64),) * 3]
    closed = np.append((data == _SPACE) | (data == 0), True)
    begins = np.flatnonzero(closed[:-2] & ~closed[1:-1]) + 1
    for k, (hashes, items, texts) in ix.short.items():
        at = begins[begins + k < len(closed)]
        at = at[closed[at + k]]
        order = np.argsort(hashes, kind="stable")
        own = np.zeros(len(at), np.uint64)
        for i in range(k):
            own += (data[at + i].astype(np.uint64) + np.uint64(1)) * _FACTORS[i]
        own = (own ^ (own >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        own ^= own >> np.uint64(29)
        low, high = np.searchsorted(hashes[order], own, "left"), np.searchsorted(hashes[order], own, "right")
        n = high - low
        hit = order[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        at = np.repeat(at, n)
        same = (data[at[:, None] + np.arange(k)] == texts[hit]).all(axis=1)
        found.append((items[hit[same]], at[same], np.full(int(same.sum()), k)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def stretches(ix: Index, data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in data of q-grams that the items have, and the rows of these; stretch by stretch, overlapping by more than a match."""
    g = grams(data)
    at = np.flatnonzero(ix.table[(g >> np.uint64(42)).astype(np.int64)])
    row = np.minimum(np.searchsorted(ix.gram, g[at]), len(ix.gram) - 1)
    same = ix.gram[row] == g[at]
    at, row = at[same], row[same]
    hits = np.cumsum(ix.first[row + 1] - ix.first[row])
    overlap = 2 * WINDOW
    a = 0
    while a < len(at):
        b = int(np.searchsorted(hits, hits[a] + HITS, "right"))
        b = max(b, int(np.searchsorted(at, at[a] + 2 * overlap)))
        yield at[a:b], row[a:b]
        if b >= len(at):
            return
        a = max(a + 1, int(np.searchsorted(at, at[b] - overlap)))


def candidates(ix: Index, data: np.ndarray, zero: np.ndarray, at: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """text, item, first character of the window in the item, where the band would begin the window in data, and where one of
    its hits would, of all windows whose hits in a band reach the bound; at and row are those of stretches()."""
    n = ix.first[row + 1] - ix.first[row]
    hit = np.repeat(ix.first[row] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    at = np.repeat(at, n)
    item, place = ix.row[hit], ix.place[hit]
    shift = int(ix.size.max())
    diagonal = at - place + shift  # from 0 on
    band = diagonal // STRIPE
    both = (diagonal % STRIPE < ix.edits[item]) & (band > 0)
    bands = (len(data) + shift) // STRIPE + 1
    key = ((np.searchsorted(zero, at, "right") - 1) * len(ix.item) + item) * bands + band
    key, place, at = np.concatenate([key, key[both] - 1]), np.concatenate([place, place[both]]), np.concatenate([at, at[both]])
    _, where, count = np.unique(key, return_inverse=True, return_counts=True)
    keep = count[where.ravel()] >= ix.bound[key // bands % len(ix.item)]
    key, place, at = key[keep], place[keep], at[keep]
    order = np.lexsort((place, key))
    key, place, at = key[order], place[order], at[order]
    item = key // bands % len(ix.item)
    # as many hits as the bound, from each on, that fit into a window; the windows that hold them begin at low to high
    last = np.arange(len(key)) + ix.bound[item] - 1
    i = np.flatnonzero(last < len(key))
    i = i[(key[last[i]] == key[i]) & (place[last[i]] - place[i] <= ix.width[item[i]] - Q)]
    low = np.maximum(0, place[last[i]] - (ix.width[item[i]] - Q))
    high = np.minimum(place[i], (ix.size - ix.width)[item[i]])
    again = np.flatnonzero(key[i[1:]] == key[i[:-1]]) + 1
    low[again] = np.maximum(low[again], high[again - 1] + 1)  # each once
    n = np.maximum(0, high - low + 1)
    begin = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    i = np.repeat(i, n)
    return key[i] // bands // len(ix.item), item[i], begin, key[i] % bands * STRIPE - shift + begin, at[i] - place[i] + begin


def verbatim(ix: Index, data: np.ndarray, item: np.ndarray, begin: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which windows stand in data at these places character by character."""
    step = np.arange(WINDOW)
    there = at[:, None] + step
    same = (data[np.clip(there, 0, len(data) - 1)] == ix.text[(ix.start[item] + begin)[:, None] + step]) & (there >= 0) & (there < len(data))
    return (same | (step >= ix.width[item][:, None])).all(axis=1)


def aligned(ix: Index, data: np.ndarray, item: np.ndarray, begin: np.ndarray, diagonal: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each band: the least number of edits between its window and a part of data within low..high, and where that part ends."""
    edits = int(ix.edits.max(initial=0))
    width = STRIPE + 3 * edits + 1
    base = (diagonal - edits)[:, None] + np.arange(width)
    cost = np.zeros(base.shape, np.int32)
    cost[(base < low[:, None]) | (base > high[:, None])] = 1 << 20
    result, end = np.full(len(item), 1 << 20), np.zeros(len(item), np.int64)
    steps = np.arange(width, dtype=np.int32)
    first = ix.start[item] + begin
    for r in range(WINDOW):
        place = base + r
        inside = (place >= low[:, None]) & (place < high[:, None])
        char = np.where(inside, data[np.clip(place, 0, len(data) - 1)], 0)
        down = cost + (char != ix.text[first + r][:, None]) + (~inside) * (1 << 20)
        down[:, :-1] = np.minimum(down[:, :-1], cost[:, 1:] + 1)
        cost = np.minimum.accumulate(down - steps, axis=1) + steps
        done = ix.width[item] == r + 1
        if done.any():
            best = cost[done].argmin(axis=1)
            result[done] = cost[done, best]
            end[done] = base[done, best] + r + 1
    return result, end


def in_chunks(f, *columns: np.ndarray) -> np.ndarray:
    """What f returns for 4,096 rows at a time, one after the other."""
    return np.concatenate([np.atleast_2d(f(*(x[i : i + 4096] for x in columns))) for i in range(0, max(1, len(columns[0])), 4096)], axis=1)


def verified(ix: Index, data: np.ndarray, text: np.ndarray, item: np.ndarray, begin: np.ndarray, diagonal: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edits and end of each window, as of aligned; many edits for those that can't be within the budget.

    A window that begins d characters later in the same band has at most d edits less, as long as places outside the text are
    taken for wrong characters. So the first of each block of windows is aligned in this way, and leaves out others of its block."""
    same = in_chunks(lambda i, b, a: verbatim(ix, data, i, b, a), item, begin, at)[0]
    edits, end = np.where(same, 0, 1 << 20), at + ix.width[item]
    rest = np.flatnonzero(~same)
    block = np.column_stack([text, item, diagonal - begin, begin // BLOCK])[rest]
    head = np.ones(len(rest), bool)
    head[1:] = (block[1:] != block[:-1]).any(axis=1)
    first = rest[head]
    far = np.full(len(first), 1 << 40)
    least = in_chunks(lambda *x: np.stack(aligned(ix, data, *x)), item[first], begin[first], diagonal[first], -far, far)[0]
    mine = np.cumsum(head) - 1
    rest = rest[least[mine] - (begin[rest] - begin[first][mine]) <= ix.edits[item[rest]]]
    edits[rest], end[rest] = in_chunks(lambda *x: np.stack(aligned(ix, data, *x)), item[rest], begin[rest], diagonal[rest], low[rest], high[rest])
    return edits, end


def found(ix: Index, texts: list[str]) -> list[np.ndarray]:
    """Columns text (its number), item, start, end (code points), edits and windows of every leaked item of every text."""
    raw = codes("\0" + "\0".join(t.replace("\0", " ") for t in texts) + "\0")
    data, place = folded(raw)
    zero = np.flatnonzero(data == 0)
    item, begin, size = short_hits(ix, data)
    text = np.searchsorted(zero, begin, "right") - 1
    every = [np.column_stack([text, item, np.zeros_like(item), begin, begin + size, np.zeros_like(item)])]
    for at, row in stretches(ix, data) if len(ix.item) and len(data) >= Q else ():
        text, item, window, diagonal, at = candidates(ix, data, zero, at, row)
        if len(window):
            edits, end = verified(ix, data, text, item, window, diagonal, at, zero[text] + 1, zero[text + 1])
            good = edits <= ix.edits[item]
            text, item, window, edits, end = (x[good] for x in (text, item, window, edits, end))
            begin = np.maximum(zero[text] + 1, end - ix.width[item])
            every.append(_best(np.column_stack([text, ix.item[item], window, begin, end, edits])))
    text, item, window, begin, end, edits = np.concatenate(every).T
    if not len(text):
        return [np.zeros(0, np.int64)] * 6
    offset = place[zero[text]] + 1
    start, stop = place[begin] - offset, place[end - 1] + 1 - offset
    key, where = np.unique(np.column_stack([text, item]), axis=0, return_inverse=True)
    where, m = where.ravel(), len(key)
    first, last, fewest = np.full(m, 1 << 60), np.zeros(m, np.int64), np.full(m, 1 << 20)
    np.minimum.at(first, where, start)
    np.maximum.at(last, where, stop)
    np.minimum.at(fewest, where, edits)
    pairs = np.unique(np.column_stack([where, window]), axis=0)[:, 0]
    return [key[:, 0], key[:, 1], first, last, fewest, np.bincount(pairs, minlength=m)]


def _best(rows: np.ndarray) -> np.ndarray:
    """Of rows (text, item, window, begin, end, edits) one for each window with the least edits, and those that begin first and
    end last of each text and item."""
    keep = np.zeros(len(rows), bool)
    for order, n in ((np.lexsort((rows[:, 5], rows[:, 2], rows[:, 1], rows[:, 0])), 3), (np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0])), 2), (np.lexsort((-rows[:, 4], rows[:, 1], rows[:, 0])), 2)):
        own = rows[order][:, :n]
        new = np.ones(len(own), bool)
        new[1:] = (own[1:] != own[:-1]).any(axis=1)
        keep[order[new]] = True
    return rows[keep]


def _items(benchmark: DataFrame, item_id: str, item_text: str) -> DataFrame:
    return benchmark.select(benchmark[item_id].alias("item_id"), F.coalesce(benchmark[item_text], F.lit("")).cast("string").alias("text")).filter("text <> ''")


def indexes(items: DataFrame, id_type: pa.DataType) -> Iterator[tuple[Index, pa.Array]]:
    """The index of each part of the distinct texts, and the least id of each of its items."""
    one = items.groupBy("text").agg(F.min("item_id").alias("item_id"))
    size = one.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = size // PART_BYTES + 1
    for k in range(parts):
        own = one.filter(F.pmod(F.xxhash64("text"), F.lit(parts)) == k).orderBy("text").collect()
        yield index([(i, r.text) for i, r in enumerate(own)]), pa.array([r.item_id for r in own], id_type)


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """A row for each document and item that it leaks: the part of the text (start, end) that the matching windows span, the
    fewest edits of a window, and how many of the item's windows match."""
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text")).filter("length(text) > 0")
    kind, item_kind = docs.schema[doc_id].dataType.simpleString(), benchmark.schema[item_id].dataType
    items, out = _items(benchmark, item_id, item_text), None
    names = ["doc_id", "item_id", "start", "end", "edits", "n_windows"]
    for part in indexes(items, to_arrow_type(item_kind)):
        sent = docs.sparkSession.sparkContext.broadcast(part)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ix, ids = sent.value
            for batch in batches:
                texts = batch.column(1).to_pylist()
                for a, b in in_steps(texts):
                    row, item, *columns = found(ix, texts[a:b])
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row + a)), ids.take(pa.array(item)), *(pa.array(c, pa.int64()) for c in columns)], names=names)

        own = rows.mapInArrow(search, f"doc_id {kind}, item_id {item_kind.simpleString()}, start long, end long, edits long, n_windows long")
        out = own if out is None else out.unionByName(own)
    if items.count() == items.select("text").distinct().count():
        return out
    twins = items.withColumn("_first", F.min("item_id").over(W.partitionBy("text"))).select("_first", F.col("item_id").alias("_own"))
    return out.join(twins, F.col("item_id").eqNullSafe(F.col("_first"))).withColumn("item_id", F.col("_own")).select(*names)


def clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_text: str = "text") -> DataFrame:
    """The rows that leak no item. Each row is judged by its own text, so null and repeated ids need no join."""
    at = docs.columns.index(text)
    for ix, _ in indexes(_items(benchmark.select(F.lit(0).alias("item_id"), benchmark[item_text].alias("text")), "item_id", "text"), pa.int64()):
        sent = docs.sparkSession.sparkContext.broadcast(ix)

        def keep(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = ["" if x is None else x for x in batch.column(at).to_pylist()]
                good = np.ones(len(texts), bool)
                for a, b in in_steps(texts):
                    good[found(sent.value, texts[a:b])[0] + a] = False
                yield batch.filter(pa.array(good))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs

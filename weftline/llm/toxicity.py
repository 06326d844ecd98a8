"""Toxicity scores from averaged subword embeddings and a linear softmax.

A word, lower-cased and without punctuation, is put between < and >; its
subwords are its byte n-grams of length 3 to 5 and the whole of it, hashed into
BUCKETS vectors. Every subword of the training texts has one, however rare it is;
those that training never met count as nothing. A word's vector is the mean of its
subwords' vectors, a text's vector the mean of its words' vectors, and a linear
softmax gives the two classes. Vectors and softmax are trained together in numpy
(minibatch Adam), so a misspelling that was never seen is judged by the subwords it
shares. Small samples are cut into as many batches as large ones, for as many steps.

Training uses at most MOST_TOXIC + MOST_CLEAN labelled documents (taken by a hash
of their id; one text for each id, in whole, if it has LONGEST bytes or less), weighted
so that the classes have the shares that they have among all training labels. Scoring reads every text in whole; as
all is linear up to the softmax, it needs one number for each bucket, which is
sent to all tasks (1 MB).

Defined results: a null or empty text is scored by the bias alone; labels that
are null, or whose document is missing, are not used; with labels of one class
only, or none, all scores are the share of label 1 (0 without labels); repeated
rows get equal scores; an empty table gives an empty result; other columns are
not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import keep_nothing, sampled, texts_of
from weftline.llm.shingles import _powers_to, in_steps, mix

BUCKETS = 1 << 18
DIMENSIONS = 4
LENGTHS = (3, 4, 5)
#: Words without a vector that are added to each text, so that single words of short texts don't decide alone.
PAD = 50
THRESHOLD = 0.3
#: The bound of the training sample, and how it is trained.
MOST_TOXIC, MOST_CLEAN = 1500, 2500
LONGEST = 1 << 18
#: Bytes of text at a time in training, and in scoring.
FIT_STEP, STEP = 1 << 16, 1 << 18
EPOCHS, BATCH, RATE, DECAY, START = 14, 250, 0.05, 1e-4, 0.01
#: Batches of an epoch, at least; what the full sample makes.
LEAST_BATCHES = (MOST_TOXIC + MOST_CLEAN) // BATCH

#: Means of many words are small numbers; they are scaled up before the softmax.
SCALE = 20.0

#: Letters, digits and all bytes of other scripts make words; A-Z are lower-cased; anything else separates.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[48:58], _FOLD[97:123], _FOLD[128:] = np.arange(48, 58), np.arange(97, 123), np.arange(128, 256)
_FOLD[65:91] = np.arange(97, 123)


def subwords(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """buckets of all subwords, the weight of each in its text's mean, and the text it is in."""
    raw = _FOLD[np.frombuffer(b" ".join(texts), np.uint8)]
    first = np.cumsum([0] + [len(t) + 1 for t in texts])
    letter = np.concatenate([[False], raw != 32, [False]])
    start, end = np.flatnonzero(~letter[:-1] & letter[1:]), np.flatnonzero(letter[:-1] & ~letter[1:])
    n = len(start)
    # each word with its two marks, one after the other
    size = end - start + 2
    at = np.cumsum(size) - size
    data = np.full(int(size.sum()), 60, np.uint8)
    word = np.repeat(np.arange(n), size)
    place = np.arange(len(data)) - np.repeat(at, size)
    inside = (place > 0) & (place < np.repeat(size, size) - 1)
    data[inside] = raw[np.repeat(start, size)[inside] + place[inside] - 1]
    data[at + size - 1] = 62
    powers, inverse = _powers_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    hashes, owner = [(sums[at + size] - sums[at]) * inverse[at]], [np.arange(n)]
    left = np.repeat(size, size) - place  # bytes of the word from here on
    for k in LENGTHS:
        i = np.flatnonzero((left >= k) & (np.repeat(size, size) > k))
        hashes.append((sums[i + k] - sums[i]) * inverse[i] + np.uint64(k))
        owner.append(word[i])
    bucket = (mix(np.concatenate(hashes)) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
    owner = np.concatenate(owner)
    text_of = np.searchsorted(first, start, "right") - 1
    n_words = np.bincount(text_of, minlength=len(texts))
    each = 1.0 / (np.bincount(owner, minlength=n) * (n_words[text_of] + PAD)) if n else np.zeros(0)
    return bucket, each[owner].astype(np.float32), text_of[owner]


class Model(NamedTuple):
    """What is left of vectors and softmax for scoring: a number for each bucket, and the bias."""

    table: np.ndarray
    bias: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        out = np.full(len(texts), self.bias)
        for a, b in in_steps(texts, STEP):
            bucket, weight, text = subwords(texts[a:b])
            out[a:b] += np.bincount(text, self.table[bucket] * weight, minlength=b - a)
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


class _Batch(NamedTuple):
    rows: np.ndarray  # buckets in use
    cell_row: np.ndarray  # of each cell, the place of its bucket in rows
    cell_weight: np.ndarray
    cell_text: np.ndarray
    has: np.ndarray  # the texts with cells
    by_text: np.ndarray  # where their cells begin
    label: np.ndarray
    weight: np.ndarray


def _batch(texts: list[bytes], label: np.ndarray, weight: np.ndarray) -> _Batch:
    cells: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for a, b in in_steps(texts, FIT_STEP):
        bucket, w, text = subwords(texts[a:b])
        key, where = np.unique(text * BUCKETS + bucket, return_inverse=True)
        cells.append(((key // BUCKETS + a).astype(np.int16), (key % BUCKETS).astype(np.int32), np.bincount(where, w, minlength=len(key)).astype(np.float32)))
    cell_text, bucket, w = (np.concatenate([c[i] for c in cells]) for i in range(3))
    rows, cell_row = np.unique(bucket, return_inverse=True)
    has = np.unique(cell_text)
    return _Batch(rows, cell_row.astype(np.int32), w, cell_text, has, np.searchsorted(cell_text, has), label, weight)


def fit(texts: list[bytes], labels: np.ndarray, weights: np.ndarray, seed: int = 7, epochs: int = EPOCHS) -> Model:
    """Vectors and softmax trained together; weights are those of the examples."""
    own = [i for i, t in enumerate(texts) if t.translate(None, b" \t\n\x0b\x0c\r").strip()]
    texts, labels, weights = [texts[i] for i in own], labels[own], weights[own]
    share = float((labels * weights).sum() / max(weights.sum(), 1e-9))
    if share in (0.0, 1.0):
        return Model(np.zeros(BUCKETS, np.float32), 500.0 if share else -500.0)
    random = np.random.default_rng(seed)
    order = random.permutation(len(texts))
    n_batches = max(-(-len(order) // BATCH), min(len(order), LEAST_BATCHES))
    batches = [_batch([texts[i] for i in part], labels[part], weights[part] / weights.mean()) for part in np.array_split(order, n_batches)]
    met = np.zeros(BUCKETS, bool)
    for b in batches:
        met[b.rows] = True
    vectors = random.normal(0, START, (BUCKETS, DIMENSIONS)).astype(np.float32)
    softmax = random.normal(0, 0.3, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.log(np.array([1 - share, share], np.float32))
    moments = [(np.zeros_like(x), np.zeros_like(x)) for x in (vectors, softmax, bias)]
    step = 0

    def adam(value: np.ndarray, of: tuple[np.ndarray, np.ndarray], slope: np.ndarray, rows: object, rate: float) -> None:
        m = of[0][rows] = 0.9 * of[0][rows] + 0.1 * slope
        v = of[1][rows] = 0.98 * of[1][rows] + 0.02 * slope * slope
        value[rows] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.98**step)) + 1e-7)

    for epoch in range(epochs):
        for k in random.permutation(len(batches)):
            b = batches[k]
            step += 1
            rate = RATE * (1 - epoch / epochs)
            own = vectors[b.rows]
            mean = np.zeros((len(b.label), DIMENSIONS), np.float32)
            mean[b.has] = np.add.reduceat(own[b.cell_row] * b.cell_weight[:, None], b.by_text)
            z = SCALE * mean @ softmax + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(p)), b.label] -= 1
            p *= (b.weight / len(p))[:, None]
            to_mean = SCALE * p @ softmax.T
            to_rows = np.column_stack([np.bincount(b.cell_row, to_mean[b.cell_text, d] * b.cell_weight, minlength=len(b.rows)) for d in range(DIMENSIONS)]) + DECAY * own
            adam(softmax, moments[1], SCALE * mean.T @ p, slice(None), rate)
            adam(bias, moments[2], p.sum(axis=0), slice(None), rate)
            adam(vectors, moments[0], to_rows, b.rows, rate)
    vectors[~met] = 0
    return Model((SCALE * vectors @ (softmax[:, 1] - softmax[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def held_out(doc_id: Column) -> Column:
    """A fixed quarter of the ids, by CRC-32 of the id as text."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", most: tuple[int, int] = (MOST_CLEAN, MOST_TOXIC)) -> Model:
    """A model of the labels outside the held-out quarter."""
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label")).filter((F.col("label").isin(0, 1)) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    total = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [sampled(known.filter(F.col("label") == v).select("doc_id"), total.get(v, 0), most[v]).withColumn("label", F.lit(v)) for v in (0, 1)]
    rows = texts_of(docs, parts[0].unionByName(parts[1]), doc_id, text, LONGEST).orderBy("doc_id", "label").collect()  # sum(most) rows of LONGEST bytes at most
    label_of = np.array([r.label for r in rows], np.int64)
    seen = np.bincount(label_of, minlength=2)
    weight = np.array([total.get(v, 0) / max(1, seen[v]) for v in (0, 1)])
    return fit([bytes(r.text) for r in rows], label_of, weight[label_of] if len(rows) else np.zeros(0))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for each row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[doc_id].dataType.simpleString()

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_nothing()
        for batch in batches:
            own = sent.value.scores(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own, pa.float64()), pa.array((own >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(docs[doc_id].alias("doc_id"), held_out(docs[doc_id]).alias("held_out"), F.coalesce(docs[text], F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(scores, f"doc_id {kind}, held_out boolean, score double, predicted int")


def clean(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold. The score is taken row by row, so repeated ids need no join."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, doc_id, text))
    at = docs.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_nothing()
        for batch in batches:
            own = model.value.scores([b"" if x is None else x.encode() for x in batch.column(at).to_pylist()])
            yield batch.filter(pa.array(own < threshold))

    return docs.mapInArrow(keep, docs.schema)

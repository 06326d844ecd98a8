"""Quality scores from weak labels.

Heuristic labellers look at every text in whole and vote good, bad, or not at
all. Documents are counted by their pattern of votes (at most 3 to the number of
labellers rows). Expectation-maximisation on those counts estimates the share of
good documents and how often each labeller votes which way on good and on bad
ones; a majority vote starts it. The posterior of a document's pattern is its
weak label.

The weak labels of at most SAMPLE documents (taken by a hash of their id; one text for
each id, in whole, if it has LONGEST bytes or less) train a linear scorer over hashed features: words, shapes of words,
and words that repeat the one before. It scores every text, with one number for
each of BUCKETS hashed features sent to all tasks (1 MB).

Defined results: a null or empty text gets the bad vote of the lines, and the scorer's
bias as score; a document without an id is scored, but no example; rows that repeat
an id are all counted and scored, and one example at most; equal texts get equal scores; an empty table gives an empty result; other columns are
not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import sampled, texts_of
from weftline.llm.shingles import _powers_to, in_steps, mix, word_hashes

BUCKETS = 1 << 18
SAMPLE = 6000
LONGEST = 1 << 18
ROUNDS, SPEED, DECAY = 150, 0.1, 1e-4
EM_ROUNDS = 200
#: A labeller is taken to be better than chance: a bad vote is this much (in log odds) for bad at least, a good vote for
#: good; no vote says nothing.
LEAST_ODDS = 0.1
THRESHOLD = 0.5

LABELLERS = ("symbols", "marks", "endings", "capitals", "variety", "repeats", "lines", "prose")
_SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
_UPPER = np.isin(np.arange(256), np.arange(65, 91))
_LOWER = np.isin(np.arange(256), np.arange(97, 123))
_STOPS = np.isin(np.arange(256), list(b".!?"))
_MARKS = np.isin(np.arange(256), [x for x in range(33, 127) if not chr(x).isalnum()])
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[48:58], _SHAPE[97:123], _SHAPE[65:91], _SHAPE[128:] = 48, 97, 65, 97


class Words(NamedTuple):
    """Words of some texts: hash, shape, the text of each, whether it repeats the one before; and the number in each text."""

    hash: np.ndarray
    shape: np.ndarray
    owner: np.ndarray
    again: np.ndarray
    count: np.ndarray


def _sum(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, values, minlength=n)


def words(texts: list[bytes]) -> Words:
    data = b" ".join(texts)
    first = np.cumsum([0] + [len(t) + 1 for t in texts])
    hashes, at = word_hashes(data)
    owner = np.searchsorted(first, at, "right") - 1
    kind = _SHAPE[np.frombuffer(data, np.uint8)]
    inside = ~_SPACE[np.frombuffer(data, np.uint8)]
    start = np.zeros(len(kind), bool)
    start[at] = True
    keep = inside.copy()
    keep[1:] &= start[1:] | (kind[1:] != kind[:-1])
    place = np.flatnonzero(keep)
    begin = np.searchsorted(place, at)
    end = np.append(begin[1:], len(place)) if len(at) else begin
    powers, inverse = _powers_to(len(place) + 1)
    sums = np.zeros(len(place) + 1, np.uint64)
    np.cumsum((kind[place].astype(np.uint64) + np.uint64(1)) * powers[: len(place)], out=sums[1:])
    shape = mix((sums[end] - sums[begin]) * inverse[begin] + np.uint64(77)) if len(at) else hashes
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    return Words(hashes, shape, owner, again, np.bincount(owner, minlength=len(texts)))


def votes(texts: list[bytes]) -> np.ndarray:
    """A row for each text: 1 good, -1 bad, 0 no vote, in the order of LABELLERS."""
    n = len(texts)
    w = words(texts)
    raw = np.frombuffer(b" ".join(texts), np.uint8)
    text_of = np.repeat(np.arange(n), [len(t) + 1 for t in texts])[: len(raw)]
    count = np.maximum(w.count, 1)
    symbols, upper, lower = (_sum(t[raw], text_of, n) for t in (_SYMBOLS, _UPPER, _LOWER))
    letters = _sum(~_SPACE[raw], text_of, n)
    order = np.lexsort((w.hash, w.owner))
    new = np.ones(len(order), bool)
    new[1:] = (w.hash[order][1:] != w.hash[order][:-1]) | (w.owner[order][1:] != w.owner[order][:-1])
    distinct = np.bincount(w.owner[order][new], minlength=n)
    again = _sum(w.again, w.owner, n)
    n_lines, same_lines, ended = np.zeros(n), np.zeros(n), np.zeros(n)
    for i, t in enumerate(texts):
        lines = [x for x in (x.strip() for x in t.split(b"\n")) if x]
        n_lines[i], same_lines[i] = len(lines), len(lines) - len(set(lines))
        ended[i] = sum(x[-1:] in b".!?" for x in lines)
    marks = _sum(_MARKS[raw], text_of, n)
    last = np.append(_SPACE[raw], True)
    open_ends = _sum(_MARKS[raw] & last[1:], text_of, n)
    stops = _sum(_STOPS[raw], text_of, n)
    lines = np.maximum(n_lines, 1)
    none = np.zeros(n, np.int8)

    def vote(bad: np.ndarray, good: np.ndarray) -> np.ndarray:
        return np.where(bad, -1, np.where(good, 1, none)).astype(np.int8)

    return np.column_stack(
        [
            vote(symbols > 0.1 * count, none > 0),
            vote(marks > 0.12 * letters, none > 0),
            vote(open_ends > 0.5 * count, (open_ends < 0.3 * count) & (w.count >= 5)),
            vote((upper > lower) & (w.count >= 5), none > 0),
            vote((distinct < 0.3 * count) & (w.count >= 30), (distinct > 0.45 * count) & (w.count >= 30)),
            vote(again > 0.2 * count, none > 0),
            vote((same_lines > 0.3 * lines) | (w.count == 0), none > 0),
            vote((stops < count / 100) & (w.count >= 20), (ended >= 0.5 * lines) & (stops < 0.3 * count) & (symbols < 0.02 * count)),
        ]
    )


class Labels(NamedTuple):
    """What expectation-maximisation found: the share of good documents, and log odds of good for each labeller's vote (-1, 0, 1)."""

    share: float
    odds: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        total = np.log(self.share / (1 - self.share)) + self.odds[np.arange(self.odds.shape[0]), votes.astype(np.int64) + 1].sum(axis=-1)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS) -> Labels:
    """Expectation-maximisation over patterns of votes, each with the number of its documents."""
    k = patterns.shape[1]
    is_vote = patterns[:, :, None] == np.array([-1, 0, 1])
    good = 1 / (1 + np.exp(-patterns.sum(axis=1).astype(float)))
    model = Labels(0.5, np.zeros((k, 3)))
    for _ in range(rounds):
        rates = []
        for part in (good, 1 - good):
            seen = ((part * counts)[:, None, None] * is_vote).sum(axis=0) + 1
            rates.append(seen / seen.sum(axis=1, keepdims=True))
        share = float(np.clip((good * counts).sum() / max(counts.sum(), 1), 0.01, 0.99))
        odds = np.log(rates[0] / rates[1])
        odds[:, 0], odds[:, 1], odds[:, 2] = np.minimum(odds[:, 0], -LEAST_ODDS), 0, np.maximum(odds[:, 2], 0)
        model = Labels(share, odds)
        after = model.posterior(patterns)
        if np.abs(after - good).max(initial=0) < 1e-6:
            break
        good = after
    return model


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """buckets, weights and text numbers of the hashed features of all words."""
    w = words(texts)
    each = 1.0 / np.maximum(w.count, 1)[w.owner]
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    bucket = np.concatenate([w.hash >> shift, mix(w.shape) >> shift, np.full(int(w.again.sum()), 1, np.uint64)]).astype(np.int64)
    weight = np.concatenate([0.3 * each, each, each[w.again]])
    return bucket, weight, np.concatenate([w.owner, w.owner, w.owner[w.again]])


class Scorer(NamedTuple):
    table: np.ndarray
    bias: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        out = np.full(len(texts), self.bias)
        for a, b in in_steps(texts):
            bucket, weight, text = features(texts[a:b])
            out[a:b] += np.bincount(text, self.table[bucket] * weight, minlength=b - a)
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def fit(texts: list[bytes], labels: np.ndarray, rounds: int = ROUNDS) -> Scorer:
    """Logistic regression on soft labels, by Adam on all examples at once."""
    if not texts:
        return Scorer(np.zeros(BUCKETS, np.float32), 0.0)
    parts = []
    for a, b in in_steps(texts):
        bucket, weight, text = features(texts[a:b])
        key, where = np.unique(text * BUCKETS + bucket, return_inverse=True)
        parts.append((key // BUCKETS + a, key % BUCKETS, np.bincount(where, weight, minlength=len(key))))
    text, bucket, weight = (np.concatenate([p[i] for p in parts]) for i in range(3))
    row, cell = np.unique(bucket, return_inverse=True)
    share = float(np.clip(labels.mean(), 0.01, 0.99))
    theta, bias = np.zeros(len(row)), np.log(share / (1 - share))
    m, v = np.zeros(len(row) + 1), np.zeros(len(row) + 1)
    for step in range(1, rounds + 1):
        z = bias + np.bincount(text, theta[cell] * weight, minlength=len(texts))
        wrong = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels) / len(texts)
        slope = np.append(np.bincount(cell, wrong[text] * weight, minlength=len(row)) + DECAY * theta / len(texts), wrong.sum())
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope * slope
        move = SPEED * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        theta, bias = theta - move[:-1], bias - move[-1]
    table = np.zeros(BUCKETS, np.float32)
    table[row] = theta
    return Scorer(table, float(bias))


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[text], F.lit("")).cast("binary").alias("text"))


def vote_counts(rows: DataFrame) -> DataFrame:
    """pattern (votes as -, 0 and + in the order of LABELLERS) and the number of documents, over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            own = np.concatenate([votes(texts[a:b]) for a, b in in_steps(texts)]) if texts else np.zeros((0, len(LABELLERS)), np.int8)
            pattern, n = np.unique(own, axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(["".join("-0+"[x + 1] for x in p) for p in pattern], pa.string()), pa.array(n, pa.int64())], names=["pattern", "n"])

    return rows.mapInArrow(count, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> tuple[Labels, Scorer]:
    rows = _rows(docs, doc_id, text)
    found = vote_counts(rows).orderBy("pattern").collect()  # 3 ** len(LABELLERS) rows at most
    patterns = np.array([["-0+".index(x) - 1 for x in r.pattern] for r in found], np.int8).reshape(-1, len(LABELLERS))
    labels = estimate(patterns, np.array([r.n for r in found], float))
    ids = docs.select(docs[doc_id].alias("doc_id")).filter("doc_id IS NOT NULL")
    ids = sampled(ids, sum(r.n for r in found), sample)
    own = [bytes(r.text) for r in texts_of(docs, ids, doc_id, text, LONGEST).orderBy("doc_id").select("text").collect()]  # sample rows of LONGEST bytes at most
    weak = labels.posterior(np.concatenate([votes(own[a:b]) for a, b in in_steps(own)])) if own else np.zeros(0)
    return labels, fit(own, weak)


def score(docs: DataFrame, labels: Labels, scorer: Scorer, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, weak_label (the posterior of good), score and kept for each row."""
    sent = docs.sparkSession.sparkContext.broadcast((labels, scorer))
    kind = docs.schema[doc_id].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, scorer = sent.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            weak = np.concatenate([labels.posterior(votes(texts[a:b])) for a, b in in_steps(texts)]) if texts else np.zeros(0)
            own = scorer.scores(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(weak, pa.float64()), pa.array(own, pa.float64()), pa.array(own >= threshold)], names=["doc_id", "weak_label", "score", "kept"])

    return _rows(docs, doc_id, text).mapInArrow(judge, f"doc_id {kind}, weak_label double, score double, kept boolean")

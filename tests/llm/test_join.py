import random
from collections import defaultdict

import numpy as np
import pytest

from weftline.llm import ngram_join
from weftline.llm.shingles import shingle_sets


def expected(rows):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(i for i in sets if sets[i])
    for k, a in enumerate(keys):
        for b in keys[k + 1 :]:
            same = len(sets[a] & sets[b])
            if 100 * same >= 80 * (len(sets[a]) + len(sets[b]) - same):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    texts = [None, "", " \n", "one", "ONE", "one two three", "one two three four five"]
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([4, 12, 40, 120, 600]))]
        for _ in range(rng.choice([1, 2, 9])):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 40))):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(" ".join(own))
    texts += [passage + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.randint(5, 60))) for _ in range(25)]
    texts += texts[10:14] + [passage] * 5
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_join_equals_all_pairs(spark, seed, monkeypatch):
    if seed == 2:  # blocks in tiles, and trees of several nodes
        monkeypatch.setattr(ngram_join, "TILE", 5)
        monkeypatch.setattr(ngram_join, "BLOCK", 6)
        monkeypatch.setattr(ngram_join, "LEAF", 2)
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, component string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(df).collect()}
    assert got == expected(rows)


def test_odd_rows(spark):
    text = "a b c d e f g h"
    rows = [(None, text), (5, text), (5, text), (9, text.upper()), (None, None)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, component_id string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(df).collect()), key=str)
    assert got == [(5, 4, 5), (5, 4, 5), (9, 4, 5), (None, 0, None), (None, 4, None)]
    assert ngram_join.join(df.limit(0)).count() == 0
    kept = ngram_join.clean(df)
    assert kept.columns == df.columns and sorted(map(str, (r.doc_id for r in kept.collect()))) == ["5", "None", "None"]


def test_tree_misses_nothing():
    rng = np.random.default_rng(3)
    points = rng.poisson(1.5, (300, ngram_join.GROUPS)).astype(np.uint8)
    points[50:80] = points[50] + (rng.random((30, ngram_join.GROUPS)) < 0.05)
    sizes = points.sum(axis=1).astype(np.int64)
    component = rng.integers(0, 4, 300)
    component[50:80] = 9
    tree = ngram_join.Tree(points, sizes, component)
    some = np.arange(0, 300, 7)
    i, j, bound = tree.search(points[some], sizes[some], component[some])
    for k, own in enumerate(some):
        overlap = np.minimum(np.minimum(points[own], points).sum(axis=1), sizes[own])
        wanted = np.flatnonzero(ngram_join.may_link(sizes[own], sizes, overlap) & (component != component[own]))
        assert sorted(j[i == k]) == wanted.tolist() and (bound[i == k] == overlap[j[i == k]]).all()


def test_all_pairs_between_components_meet_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    rng = random.Random(4)
    rows = [(key, 100 * key + i, rng.choice([20, 24, 30, 90]), True, 1, 40, rng.choice([1, 1, 1, 2, 3]) * 1000) for key in range(3) for i in range(6 + 20 * key)]
    df = spark.createDataFrame(rows, "key long, id long, n long, index boolean, weight long, size long, component long")
    tiles = defaultdict(list)
    for r in ngram_join.between(df).collect():
        tiles[r.key, r.left, r.right].append(r)
    assert max(map(len, tiles.values())) <= 4 * 7
    met = {tuple(sorted((a.id, b.id))) for t in tiles.values() for a in t for b in t if a.tile == a.left and b.tile == b.right and a.id != b.id}
    for a in rows:
        for b in rows:
            if a[0] == b[0] and a[1] < b[1] and a[6] != b[6] and 5 * min(a[2], b[2]) >= 4 * max(a[2], b[2]):
                assert (a[1], b[1]) in met


def test_shingles_are_distinct_sets():
    texts = [b"a b c d e a b c d e f", b"", b"A  b\tC d E", b"x y"]
    sets, first = shingle_sets(texts)
    assert np.diff(first).tolist() == [6, 0, 1, 1]
    counts = defaultdict(int)
    for h in sets.tolist():
        counts[h] += 1
    assert max(counts.values()) == 2  # `a b c d e` in two texts


def test_of_rows_that_repeat_an_id_the_least_text_stays(spark):
    rows = [(1, "b", "x", 1), (1, "a", "y", 2), (1, "a", "x", 2), (2, "c", "z", 1), (2, None, "z", 1), (None, "b", "q", 1), (None, "b", "q", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, component_id int")
    for n in (1, 5):
        got = ngram_join.clean(docs.repartition(n))
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, [(1, "a", "x", 2), (2, None, "z", 1), (None, "b", "q", 1), (None, "b", "q", 1)]))
        assert got.columns == docs.columns

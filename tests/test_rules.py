"""Fixes from tables of rules, against replace() in order."""

import random

from weftline.operators import rules

SCHEMA = "volume int, kind string, ord long, old string, new string"


def plain(text, own):
    hits = []
    for ord, old, new in own:
        if text is not None and old in text:
            text = text.replace(old, new)
            hits.append(ord)
    return text, hits


def test_fix_is_replace_in_order():
    rng = random.Random(5)
    word = lambda least, most: "".join(rng.choice("ab\n’") for _ in range(rng.randint(least, most)))
    for _ in range(3000):
        pairs = [(word(1, 4), word(0, 4)) for _ in range(rng.randint(1, 12))]
        text = word(0, 40)
        want = plain(text, [(i, a, b) for i, (a, b) in enumerate(pairs)])
        assert rules.fix(text, pairs, rules._machine(pairs), max(len(a) for a, _ in pairs)) == want


def test_groups_turns_and_nulls(spark):
    rng = random.Random(8)
    texts, own = [], []
    for v in (1, 2, None):
        for kind in ("notes", None):
            texts += [(v, kind, i, None if i == 3 else "".join(rng.choice("abc ") for _ in range(rng.choice((0, 5, 60))))) for i in range(12)]
            own += [(v, kind, rng.randrange(10**6), "".join(rng.choice("abc") for _ in range(rng.randint(0, 3))), rng.choice((None, "", "a", "bb", "cab"))) for _ in range(30)]
    texts += texts[:5]
    df = spark.createDataFrame([(*t, "x") for t in texts], "volume int, kind string, line int, text string, old string")
    want = sorted(repr((v, k, i, *plain(t, sorted((o, a, b) for x, y, o, a, b in own if (x, y) == (v, k) and a and b is not None)))) for v, k, i, t in texts)
    for at_once in (7, 10**6):
        out = rules.fixed(df, spark.createDataFrame(own, SCHEMA), ["volume", "kind"], at_once=at_once)
        assert out.columns == ["volume", "kind", "line", "text", "old", "hits"]
        rows = out.collect()
        assert sorted(repr((r.volume, r.kind, r.line, r.text, r.hits)) for r in rows) == want
        counts = {(r.volume, r.kind, r.ord): r.n_texts for r in rules.counted(out, ["volume", "kind"]).collect()}
        assert sum(counts.values()) == sum(len(r.hits) for r in rows) > 0


def test_nothing(spark):
    texts = spark.createDataFrame([(1, "notes", "ab")], "volume int, kind string, text string")
    none = spark.createDataFrame([], SCHEMA)
    assert [(r.text, r.hits) for r in rules.fixed(texts, none, ["volume", "kind"]).collect()] == [("ab", [])]
    one = spark.createDataFrame([(1, "notes", 0, "a", "b")], SCHEMA)
    assert rules.fixed(texts.filter("false"), one, ["volume", "kind"]).count() == 0


def test_texts_are_taken_a_few_at_a_time(spark):
    import pyarrow as pa

    told = {(1,): [(7, "a", "b"), (8, "bb", "c")]}
    batch = pa.RecordBatch.from_pydict({"volume": [1] * 1000, "text": ["aab" if i % 2 else None for i in range(1000)], "hits": pa.array([[]] * 1000, pa.list_(pa.int64()))})
    out = list(rules._pass(told, ["volume"], "text", ["volume", "text", "hits"])(iter([batch])))
    assert max(b.num_rows for b in out) == rules.HELD and sum(b.num_rows for b in out) == 1000
    assert [r["text"] for b in out for r in b.to_pylist()] == ["cb" if i % 2 else None for i in range(1000)]
    df = spark.createDataFrame([(1, i, "aab") for i in range(20)] + [(2, 0, "aab"), (1, 0, None)], "volume int, line int, text string")
    own = spark.createDataFrame([(1, None, 7, "a", "b"), (1, None, 8, "bb", "c")], SCHEMA).drop("kind")
    for at_once in (1, 10):
        hits = rules.fixed(df, own, ["volume"], at_once=at_once, hits_only=True)
        assert hits.columns == ["volume", "hits"] and hits.count() == 22
        assert sorted(rules.counted(hits, ["volume"]).collect()) == [(1, 7, 20), (1, 8, 20)]

import random
import zlib

import numpy as np

from weftline.llm import common, quality_model, toxicity

BAD = ["moronic", "idiot", "scumbag", "worthless"]


def sentence(rng, n):
    return " ".join("".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 7))) for _ in range(n))


def test_toxicity(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(900):
        text = sentence(rng, rng.randint(10, 80)).split()
        toxic = int(rng.random() < 0.3)
        for _ in range(toxic * max(2, len(text) // 15)):
            text.insert(rng.randrange(len(text)), rng.choice(BAD))
        rows.append((i, " ".join(text), "clash"))
        labels.append((i, toxic))
    rows += [(1000, None, ""), (1001, "", ""), (1002, "an idiotic, idi0t scumbags person " + sentence(rng, 30), ""), (1003, "word " * 30_000, ""), (None, "text", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    marks = spark.createDataFrame([*labels, (None, 1), (5000, 1), (3, None)], "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.train(docs, marks)).collect()
    assert len(got) == len(rows)
    score = {r.doc_id: r for r in got}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(score[i].held_out == (i in set(held)) for i, _ in labels)
    truth = dict(labels)
    right = sum(score[i].predicted == truth[i] for i in held)
    assert right / len(held) > 0.9
    assert score[1002].score > 0.3  # words that were never seen, but their parts were
    assert score[1000].score == score[1001].score and 0 <= score[1003].score <= 1
    assert toxicity.score(docs.limit(0), toxicity.train(docs.limit(0), marks.limit(0))).count() == 0
    kept = toxicity.clean(docs, marks)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.score < toxicity.THRESHOLD}
    one_class = toxicity.train(docs, spark.createDataFrame([(0, 0), (1, 0)], "doc_id long, toxic int"))
    assert toxicity.score(docs, one_class).filter("score > 0.001").count() == 0


def test_toxicity_with_few_toxic_examples():
    rng = random.Random(5)
    text = lambda word, n: " ".join(w for i in range(n) for w in (sentence(rng, 6), word)).encode()
    texts = [text(BAD[i % 4], 4) if i < 12 else text("and", 4) for i in range(90)]
    model = toxicity.fit(texts, np.array([int(i < 12) for i in range(90)]), np.ones(90))
    assert (model.scores([text(BAD[i % 4], 4) for i in range(20)]) >= toxicity.THRESHOLD).mean() >= 0.9
    assert (model.scores([text("and", 4) for _ in range(40)]) >= toxicity.THRESHOLD).mean() <= 0.1


def test_toxicity_of_a_rare_insult():
    rng = random.Random(6)
    text = lambda word: " ".join(w for i in range(4) for w in (sentence(rng, 6), word)).encode()
    texts = [text("and") for _ in range(300)] + [text(rng.choice(BAD)) for _ in range(100)] + [text("zwygglok") for _ in range(6)]
    model = toxicity.fit(texts, np.array([0] * 300 + [1] * 106), np.ones(406))
    assert (model.scores([text("zwygglok") for _ in range(20)]) >= toxicity.THRESHOLD).mean() >= 0.9
    assert (model.scores([text("and") for _ in range(20)]) >= toxicity.THRESHOLD).mean() <= 0.1


def by_hand(text):
    """Weights of a text's subwords, written out."""
    import re

    words = re.findall(r"[a-z0-9\x80-\xff]+", text.decode("latin-1").translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})))
    found = {}
    for w in words:
        own = [f"<{w}>"] + [f"<{w}>"[i : i + k] for k in toxicity.LENGTHS if k < len(w) + 2 for i in range(len(w) + 3 - k)]
        for x in own:
            found[x] = found.get(x, 0) + 1 / len(own) / (len(words) + toxicity.PAD)
    return found


def test_scores_equal_a_dense_softmax_over_subwords():
    rng = random.Random(8)
    texts = [f"{sentence(rng, rng.randint(3, 30))}{' ' + rng.choice(BAD) * (i % 3 == 0)} Ünd {i}!".encode() for i in range(120)] + [b"", b"?"]
    labels = np.array([int(i % 3 == 0) for i in range(120)] + [0, 0])
    weights = [by_hand(t) for t in texts]
    column = {x: i for i, x in enumerate(sorted({x for w in weights for x in w}))}
    dense = np.zeros((len(texts), len(column)))
    for i, w in enumerate(weights):
        for x, v in w.items():
            dense[i, column[x]] = v
    bucket, weight, text = toxicity.subwords(texts)
    sums = np.zeros((len(texts), toxicity.BUCKETS), np.float32)
    np.add.at(sums, (text, bucket), weight)
    same = [(np.sort(sums[i][sums[i] > 0])[-5:], np.sort(dense[i][dense[i] > 0])[-5:]) for i in range(len(texts))]
    assert sum(len(x) == len(y) and np.allclose(x, y, atol=1e-6) for x, y in same) >= 0.9 * len(texts)  # but for buckets that two subwords share
    assert np.allclose(sums.sum(axis=1), dense.sum(axis=1), atol=1e-5)
    model = toxicity.fit(texts, labels, np.ones(len(texts)))
    assert np.allclose(model.scores(texts), 1 / (1 + np.exp(-(model.bias + sums @ model.table))), atol=1e-4)
    theta, bias = np.zeros(len(column)), 0.0
    for _ in range(3000):  # plain gradient descent on the dense matrix
        wrong = 1 / (1 + np.exp(-(20 * dense @ theta + bias))) - labels
        theta, bias = theta - 2 * 20 * dense.T @ wrong / len(texts), bias - 2 * wrong.mean()
    plain = 1 / (1 + np.exp(-(20 * dense @ theta + bias))) >= 0.5
    assert (plain == (model.scores(texts) >= 0.5)).mean() > 0.95


def test_em_equals_a_loop_over_documents():
    rng = random.Random(9)
    docs = [tuple(rng.choice([-1, 0, 1, 1]) if rng.random() < 0.5 else (1 if g else -1) for _ in range(3)) for g in (rng.random() < 0.7 for _ in range(300))]
    good = [1 / (1 + np.exp(-sum(d))) for d in docs]
    for _ in range(quality_model.EM_ROUNDS):
        share, odds = min(max(sum(good) / len(docs), 0.01), 0.99), []
        for k in range(3):
            rate = []
            for part in (good, [1 - g for g in good]):
                seen = [1 + sum(p for p, d in zip(part, docs, strict=True) if d[k] == v) for v in (-1, 0, 1)]
                rate.append([x / sum(seen) for x in seen])
            bad_odds, good_odds = np.log(rate[0][0] / rate[1][0]), np.log(rate[0][2] / rate[1][2])
            odds.append((min(bad_odds, -quality_model.LEAST_ODDS), 0.0, max(good_odds, 0.0)))
        after = [1 / (1 + np.exp(-(np.log(share / (1 - share)) + sum(odds[k][d[k] + 1] for k in range(3))))) for d in docs]
        done = max(abs(a - b) for a, b in zip(after, good, strict=True)) < 1e-6
        good = after
        if done:
            break
    pattern, n = np.unique(np.array(docs, np.int8), axis=0, return_counts=True)
    model = quality_model.estimate(pattern, n.astype(float))
    assert np.allclose(model.posterior(np.array(docs, np.int8)), good, atol=1e-4)


def test_samples_are_bounded(spark):
    ids = spark.range(5000).withColumnRenamed("id", "doc_id")
    assert common.sampled(ids, 5000, 300).count() == 300 and common.sampled(ids, 5000, 9000).count() == 5000
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (2, "x" * 100), (3, None)], "doc_id long, text string")
    got = common.texts_of(docs, spark.createDataFrame([(1,), (2,), (3,)], "doc_id long"), "doc_id", "text", 50)
    assert sorted((r.doc_id, bytes(r.text)) for r in got.collect()) == [(1, b"a"), (3, b"")]


def test_em_finds_the_accuracies():
    rng = np.random.default_rng(4)
    good = rng.random(20_000) < 0.8
    rates = [0.95, 0.8, 0.7]
    votes = np.column_stack([np.where(rng.random(len(good)) < 0.3, 0, np.where((rng.random(len(good)) < r) == good, 1, -1)) for r in rates]).astype(np.int8)
    pattern, n = np.unique(votes, axis=0, return_counts=True)
    model = quality_model.estimate(pattern, n.astype(float))
    assert abs(model.share - 0.8) < 0.06
    strength = model.odds[:, 2] - model.odds[:, 0]
    assert strength[0] > strength[1] > strength[2]


def test_quality(spark):
    rng = random.Random(2)
    rows = []
    for i in range(300):
        text = ". ".join(sentence(rng, 9).capitalize() for _ in range(6)) + "."
        kind = i % 5
        if kind == 3:
            text = " ".join(w + rng.choice(["###", "$$$", "***"]) for w in text.split())
        if kind == 4:
            text = "\n".join(w * 1 for w in [" ".join([w] * 12) for w in text.split()[:8]])
        rows.append((i, text, "clash"))
    rows += [(900, None, ""), (901, "", ""), (902, "Good words here. " * 10_000, ""), (None, rows[0][1], "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = {r.doc_id: r for r in quality_model.score(docs, *quality_model.train(docs)).collect()}
    assert len(got) == len(rows)
    assert sum(got[i].kept for i in range(300) if i % 5 < 3) >= 176
    assert sum(got[i].kept for i in range(300) if i % 5 > 2) <= 12
    assert got[900].score == got[901].score and got[None].score == got[0].score
    assert quality_model.score(docs.limit(0), *quality_model.train(docs.limit(0))).count() == 0

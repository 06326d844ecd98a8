import random
import re
import zlib
from collections import Counter

import pytest

from weftline.llm import spelling


def near(a, b):
    """Whether one inserted, deleted or replaced letter makes one of the other."""
    a, b = sorted((a, b), key=len)
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def brute_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def brute_groups(words):
    form, out = {}, []
    for w, n in words.items():
        found = [v for v in words if near(w, v)]
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * n else None
        out.append([w, n, len(found), form[w], words.get(form[w])])
    for row in out:
        root = row[0]
        while form[root]:
            root = form[root]
        row.append(root)
    return sorted(map(repr, map(tuple, out)))


def got(df):
    return sorted(map(repr, map(tuple, df.select("word", "n", "n_near", "form", "form_n", "root").collect())))


def test_texts_as_by_hand(spark):
    rnd = random.Random(3)
    stems = ["Wanderer", "straßen", "collègue", "aaaaaaaa", "ababababab", "Möglichkeit", "÷×÷×÷×÷", "internationalisation"]
    letters = "abéxÿ"
    rows = [(None, None), (4, ""), (5, "1 2 ... kurz"), (6, "Äußerung ÄUßERUNG äUßerung"), (7, "x" * 3000 + " " + "x" * 2999)]
    for i in range(120):
        words = []
        for _ in range(60):
            w = list(rnd.choice(stems))
            for _ in range(rnd.choice((0, 0, 0, 1, 1, 2))):
                at = rnd.randrange(len(w))
                w[at : at + rnd.randint(0, 1)] = rnd.choice((letters[rnd.randrange(5)], ""))
            words.append("".join(w))
        rows.append((i % 100, ", ".join(words)))
    rows += rows[:5]
    docs = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n int")
    words = brute_words(rows)
    assert len(words) > 300
    assert got(spelling.variants(docs)) == brute_groups(words)
    assert spelling.variants(docs.filter("false")).count() == 0


@pytest.mark.parametrize("most_letters", [1, 200, 1 << 16])
def test_blocks_of_any_size(spark, most_letters):
    rnd = random.Random(most_letters)
    words = {"".join(rnd.choice("ab") for _ in range(rnd.randint(5, 9))): rnd.choice((2, 3, 40, 500)) for _ in range(400)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert got(spelling.groups(df, most_letters=most_letters)) == brute_groups(words)


def test_each_pair_is_found_once(spark):
    words = ["aaaaaaa", "aaaaaaaa", "aaaabaaa", "baaaaaaa", "aaaaaaab", "aaabaaa"]
    pairs = [frozenset((r["word"], r["near"])) for r in spelling.near_pairs(spark.createDataFrame([(w, 2) for w in words], "word string, n long"), 1).collect()]
    want = [frozenset((a, b)) for i, a in enumerate(words) for b in words[:i] if near(a, b)]
    assert sorted(map(sorted, pairs)) == sorted(map(sorted, want))

import hashlib
import zlib

import pytest
from pyspark.sql import types as T

from weftline.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, level string, _tree int"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def folded(nodes, arity):
    """The levels of a tree, from its leaves."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + arity]) for i in range(0, len(levels[-1]), arity)])
    return levels


def own_siblings(levels, at, arity):
    out = []
    for level in levels[:-1]:
        first = at // arity * arity
        out.append((level[first:at], level[at + 1 : first + arity]))
        at //= arity
    return out


def brute(rows, arity=2):
    def leaf(row, more=0):
        fields = (row["doc_id"], row["source"], row["lang"], None if row["n_chars"] is None else row["n_chars"] + more, row["text"])
        return sha(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields))

    trees = {}
    for row in rows:
        trees.setdefault(row["lang"], []).append((row["doc_id"] is not None, row["doc_id"] or 0, leaf(row), row))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    levels = {k: folded([x[2] for x in sorted(trees[k], key=lambda x: x[:3])], arity) for k in langs}
    top = folded([levels[k][-1][0] for k in langs], arity)
    out = []
    for number, k in enumerate(langs):
        for at, (_, _, own, row) in enumerate(sorted(trees[k], key=lambda x: x[:3])):
            path = own_siblings(levels[k], at, arity) + own_siblings(top, number, arity)
            acc = leaf(row, int(row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0))
            for before, after in path:
                acc = sha(*before, acc, *after)
            out.append((row["doc_id"], own, levels[k][-1][0], top[-1][0], sha(*(x for before, after in path for x in (*before, *after))), acc, acc == top[-1][0]))
    return out


def rows_of(spark, n):
    texts = [None, "", "a", "öß 漢", "a:b-", "x" * 50_000]
    made = [(i * 3 % 101 if i % 17 else None, texts[i % 6], [None, "en", "de", "en", "en", "é"][i * i % 6], None if i % 5 == 0 else f"s{i % 3}", None if i % 4 == 0 else i, "x", i) for i in range(n)]
    made += made[:3]  # repeated rows
    return spark.createDataFrame(made, SCHEMA)


@pytest.mark.parametrize(("arity", "small", "n"), [(2, 20_000, 40), (2, 0, 13), (5, 0, 30)])
def test_as_by_hand(spark, monkeypatch, arity, small, n):
    monkeypatch.setattr(merkle, "SMALL", small)
    docs = rows_of(spark, n)
    got = merkle.manifest(docs, arity=arity, tampered=merkle.tampering(docs)).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute([r.asDict() for r in docs.collect()], arity)))


def test_few_and_no_rows(spark):
    docs = rows_of(spark, 30)
    one = docs.filter("_tree = 1").limit(1)
    got = merkle.manifest(one, tampered=merkle.tampering(one)).drop("path").first()
    assert got["root"] == got["subroot"] == got["leaf"] and got["proof_sha256"] == sha("")
    none = merkle.manifest(docs.filter("false"), tampered=merkle.tampering(docs))
    assert none.count() == 0 and isinstance(none.schema["verified"].dataType, T.BooleanType)


def test_a_change_anywhere_changes_the_root(spark):
    docs = rows_of(spark, 20)
    root = merkle.manifest(docs).first()["root"]
    other = docs.withColumn("text", docs.text.substr(2, 10)) if docs.count() else docs
    assert merkle.manifest(other).first()["root"] != root
    assert all(r["verified"] for r in merkle.manifest(docs).collect())

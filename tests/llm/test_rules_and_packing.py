import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weftline.llm import packing, quality_rules, token_counts
from weftline.llm.segments import Tokens, arcs, as_bytes, default_tokenizer
from weftline.llm.transducer import Transducer

DOCS = "doc_id long, text string, _l string, _w string, n_chars long"
LONG = "word " * 30_000
TEXTS = [
    None,
    "",
    " \n\t ",
    "It's we'll don't, he said. 123 ½ ²x É É ﬁ İ ß Σς it’s—ok",
    "a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|>",
    "naïve café señor, straße. Ünder",
    "x" * 5000,
    LONG,
    "漢字 かな 😀 ok.",
    "The same text twice, for copies.",
    "The same text twice, for copies.",
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "clash", "clash", 7) for i, t in enumerate(TEXTS)], DOCS)


@pytest.fixture(scope="module")
def ids():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return {i: tokenizer.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(TEXTS)}


def test_counts_are_the_library_s(docs, ids):
    for chunk in (1 << 16, 7):
        got = {r.doc_id: r for r in token_counts.counts(docs, chunk=chunk).collect()}
        assert {i: r.n_tokens for i, r in got.items()} == {i: len(x) for i, x in ids.items()}
        assert all(r.n_bytes == len((TEXTS[i] or "").encode()) and r.over_limit == (r.n_tokens > 2048) for i, r in got.items())
    assert token_counts.counts(docs.limit(0)).count() == 0


ODD = ["..'s '.' 'rx 'r 're 'VE 'v' '' 's's 't't' don''t 'l 'll 'lll 'é", "Привет Ελλάς мир, š č Ž ı ŉ ǅ", "andandonnatti " * 300, "a\u0301 a\u00a0b \u2028 \x00\x1f", "ab" * 700 + "'"]


def test_maps_compose_at_any_place(ids):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = [t or "" for t in TEXTS if t != LONG] + ODD
    wanted = [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]
    machine = Transducer(default_tokenizer(), most_states=50)  # forgets its states before each batch
    for chunk in (1, 2, 7, 100_000):
        assert machine.counts([t.encode() for t in texts], chunk).tolist() == wanted


def test_a_map_for_every_state():
    machine = Transducer(default_tokenizer())
    data = np.frombuffer(b"erstanding, it's 12 words ", np.uint8)
    before = [b"und", b"x.", b"'", b"it's", b"9", b" "]
    start, stop = np.array([0]), np.array([len(data)])
    ends, total = machine.run(data, start, stop)
    for text in before:
        own = np.frombuffer(text, np.uint8)
        state, count = machine.run(own, np.array([0]), np.array([len(own)]))
        met, at_end, more = machine.entered(data, start, stop, state)
        whole = machine.run(np.concatenate([own, data]), np.array([0]), np.array([len(own) + len(data)]))
        assert (ends[0] if met[0] else at_end[0]) == whole[0][0] and count[0] + total[0] + more[0] == whole[1][0]


def test_counts_of_another_tokenizer(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["Hello there, it's 12.", "", "a  b\n"]
    wanted = [len(Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.n_tokens for r in token_counts.counts(df, tokenizer=path).orderBy("doc_id").collect()] == wanted


def test_runs_are_forgotten_without_harm():
    machine = arcs(default_tokenizer(), as_bytes)
    size, machine.size = machine.size, 3
    runs = [f"w{i} x. y{i}".encode().split() for i in range(40)]
    wanted = [[as_bytes(i) for i in Tokens(default_tokenizer()).ids(own)] for own in runs]
    assert [machine.read([own])[0] for own in runs + runs] == wanted + wanted
    machine.size = size


def checked(rows, ids, tokens=2048, segments=64, loss=packing.MAX_LOSS):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for doc, own in ids.items():
        own, at = [*own, 1], 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(own))
            assert r.ids_crc32 == zlib.crc32(np.array(own[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(own)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= tokens and len(own) <= segments and at & (at - 1) == 0 and sum(r.loss_tokens for r in own) <= loss
    return sequences


def test_packing(docs, ids):
    checked(packing.pack_documents(docs).collect(), ids)
    checked(packing.pack_documents(docs, segments=2).collect(), ids, segments=2)
    small = checked(packing.pack_documents(docs, tokens=64, loss=64).collect(), ids, tokens=64)
    assert sum(len(x) for x in small.values()) >= sum(len(x) + 1 for x in ids.values()) / 64
    assert packing.pack_documents(docs.limit(0)).count() == 0
    # each limit binds: no sequence could be as full without it
    all_loss = checked(packing.pack_documents(docs, loss=512, loss_share=F.lit(1.0)).collect(), ids, loss=512)
    assert max(sum(r.length for r in s) for s in all_loss.values()) == 512
    own = checked(packing.pack_documents(docs, loss_share=F.when(F.col("doc_id") != 7, F.lit(1.0))).collect(), ids)
    assert {r.loss_tokens for s in own.values() for r in s if r.doc_id == 7} == {0}
    row = packing.pack_documents(docs.filter("doc_id = 9"), with_ids=True).orderBy("start").collect()
    assert b"".join(bytes(r.ids) for r in row) == np.array([*ids[9], 1], "<u4").tobytes()


def test_loss_limit():
    packer, out = packing.Packer(tokens=16, segments=3, loss=8, pool=4), []
    for i in range(40):
        length = i % 20 + 1
        out += packer.add(packing.Piece(i, 0, length, length // 2 + length % 2, None, length))
    out += packer.end()
    assert all(sum(p.length for p in s) <= 16 and len(s) <= 3 and sum(p.loss for p in s) <= 8 for s in out)
    assert sum(p.length for s in out for p in s) == sum(i % 20 + 1 for i in range(40))


PROSE = "The quick brown fox jumps over the lazy dog and then walks home along the river, as it does each day."


def test_rules(spark):
    repeated = " ".join(["one two three four five six seven eight nine ten"] * 4)
    junk = "\n".join(["a ### b $$$ c %%% d &&& e *** f ||| g"] * 1 + ["x| y| z| w| v| u| t| s|", "Home"])
    texts = {1: PROSE, 2: None, 3: "", 4: repeated, 5: PROSE + "\nAnd so on.\nAnd so on.\nHome", 6: PROSE + "\n" + junk * 6, 7: PROSE + "\nAll rights reserved.", 8: LONG, 9: PROSE + "\nHome » News » Local » Weather\nTous droits réservés.\nStartseite", 10: PROSE}
    df = spark.createDataFrame([(i, t, "a", "b", 7) for i, t in texts.items()], DOCS)
    got = {r.doc_id: r for r in quality_rules.report(df).collect()}
    for i, t in texts.items():
        words = (t or "").encode().split()
        lines = [x for x in (t or "").split("\n") if x.strip()]
        windows = defaultdict(list)
        for k in range(len(words) - 7):
            windows[tuple(words[k : k + 8])].append(k)
        marked = {k + o for at in windows.values() if len(at) > 1 for k in at for o in range(8)}
        assert (got[i].n_words, got[i].n_repeat_words) == (len(words), len(marked))
        assert got[i].n_dup_lines == len(lines) - len(set(lines))
        assert got[i].word_chars == sum(len(w.decode()) for w in words)
    assert {i for i, r in got.items() if r.kept} == {1, 5, 7, 9, 10}
    clean = {r.doc_id: r for r in quality_rules.clean(df).collect()}
    assert clean[5].text == PROSE + "\nAnd so on." and clean[7].text == clean[9].text == PROSE and clean[7].n_chars == len(PROSE) and clean[5]._l == "a"
    assert quality_rules.report(df.limit(0)).count() == 0


def test_workers_keep_one_machine():
    from weftline.llm import common

    common.keep_nothing()
    made = []
    for key in ("a", "a", "b", "a"):
        assert common.kept(key, lambda k=key: made.append(k) or k) == key
    assert made == ["a", "b", "a"]  # b took the place of a
    common.keep_nothing()
    assert common.kept("a", lambda: "new") == "new"
    common.keep_nothing()

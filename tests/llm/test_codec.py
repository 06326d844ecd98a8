import hashlib
import random

import numpy as np
import pytest

from weftline.llm import bpe_codec, transducer
from weftline.llm.segments import default_tokenizer

POOLS = ["abcdefghijklmnopqrstuvwxyz'  .,!", "aàâäéèêëîïôöùûüçñßÀÉ '’-–—“”…", "漢字仮名交じり文かなカナ、。 ab", "हिन्दी भाषा में ", "한국어 텍스트각", "<|startoftext|>endoftext| ", "̀́aeoAẸ x", "".join(map(chr, range(0x20, 0x250))), "😀👍🏽‍🚀 a", "arvelstd'", "".join(map(chr, range(1, 0x80)))]
HAND = ["", " ", "Hello wörld's 漢字 <|endoftext|> it's", "'re 're''s !'s 'x 'r 'R e'vE", "x\x00\x01y\x7fz\x1f", "İSTANBUL ΣΑΣ ǅ ẞ ﬁ", "1234 ½ Ⅷ ٣", "漢字、かな。" * 400 + "abc.def's,x" * 300, "ab" * 2000]


@pytest.fixture(scope="module")
def codec():
    return bpe_codec.Codec(default_tokenizer())


def texts():
    rnd = random.Random(11)
    return HAND + ["".join(rnd.choice(POOLS[k % len(POOLS)]) for _ in range(rnd.randint(0, 50))) for k in range(600)]


def test_as_the_library(codec):
    tokenizer, every = codec.encoder.tokens.tokenizer, texts()
    want = [e.ids for e in tokenizer.encode_batch(every, add_special_tokens=False)]
    for lane in (1, 256):
        assert [x.tolist() for x in codec.encoder.encode([x.encode() for x in every], lane)] == want
    for block in (1, 7, 1 << 16):
        assert ["".join(codec.decoder.blocks(np.array(x, np.uint32), block)) for x in want] == [tokenizer.decode(x, skip_special_tokens=False) for x in want]


def test_counts_of_any_script(codec):
    machine, every = transducer.Transducer(default_tokenizer()), texts()
    want = [len(e.ids) for e in codec.encoder.tokens.tokenizer.encode_batch(every, add_special_tokens=False)]
    for chunk in (3, 256):
        assert machine.counts([x.encode() for x in every], chunk).tolist() == want


def test_a_forgetful_table_changes_nothing(codec):
    small = bpe_codec.Encoder(default_tokenizer(), most_states=50)
    every = [x.encode() for x in texts()]
    for a in range(0, len(every), 100):
        assert [x.tolist() for x in small.encode(every[a : a + 100])] == [x.tolist() for x in codec.encoder.encode(every[a : a + 100])]


def test_states_hold_no_more_than_the_lookahead(codec):
    codec.encoder.encode([x.encode() for x in texts()])
    assert 0 < max(map(codec.encoder.unsettled, codec.encoder.states)) <= codec.encoder.lookahead


def merged(text, pairs, ids):
    """Tokens of a text: again and again the merge of the lowest rank, leftmost first."""
    own = [ids[c] for c in text]
    while True:
        ranks = [(pairs[p], i) for i, p in enumerate(zip(own, own[1:], strict=False)) if p in pairs]
        if not ranks:
            return own
        rank, i = min(ranks)
        own[i : i + 2] = [rank]


@pytest.mark.parametrize("seed", range(30))
def test_lookahead_is_sufficient(seed):
    """Boundaries that lie the lookahead behind don't change, whatever follows, for merge lists made at random."""
    rnd = random.Random(seed)
    text_of = dict(enumerate("abc"))
    pairs = {}
    while len(pairs) < 12:
        pair = (rnd.choice(list(text_of)), rnd.choice(list(text_of)))
        text = text_of[pair[0]] + text_of[pair[1]]
        if text not in text_of.values():
            pairs[pair] = len(text_of)
            text_of[len(text_of)] = text
    ids = {t: i for i, t in text_of.items()}
    ahead = bpe_codec.lookahead(list(pairs), {i: len(t) for i, t in text_of.items()}, pairs)
    for _ in range(60):
        text = "".join(rnd.choice("abc") for _ in range(80))
        ends = lambda t: set(np.cumsum([len(text_of[i]) for i in merged(t, pairs, ids)]).tolist())
        whole = ends(text)
        for n in range(1, 80):
            settled = max(0, n - ahead)
            assert {x for x in ends(text[:n]) if x <= settled} == {x for x in whole if x <= settled}


def test_lists_that_do_not_build_on_each_other_are_refused():
    with pytest.raises(ValueError, match="two merges"):
        bpe_codec.lookahead([(0, 1), (3, 2), (1, 2), (0, 4)], {0: 1, 1: 1, 2: 1, 3: 2, 4: 2, 5: 3}, {(0, 1): 3, (3, 2): 5, (1, 2): 4, (0, 4): 5})


def test_bytes_that_are_no_text(codec):
    from tokenizers import Tokenizer, decoders, models

    letters = bpe_codec.byte_letters()
    own = Tokenizer(models.BPE(vocab={c: b for b, c in letters.items()}, merges=[]))
    own.decoder = decoders.ByteLevel()
    decoder, raw = bpe_codec.Decoder(own), "é漢😀".encode()[:-1] + b"\xc3(\xff"
    for block in (1, 2, 100):
        assert "".join(decoder.blocks(np.frombuffer(raw, np.uint8), block)) == own.decode(list(raw), skip_special_tokens=False) == raw.decode("utf-8", "replace")


def test_rows(spark, codec):
    rows = [(1, None, "x"), (2, "", "x"), (3, "Hello <|endoftext|> ok", "x"), (3, "Hello <|endoftext|> ok", "x"), (None, "a b " * 30_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    tokenizer = codec.encoder.tokens.tokenizer

    def want(doc_id, text):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        return doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), np.array(ids, "<u4").tobytes(), decoded

    got = [(*r[:4], bytes(r[4]), r[5]) for r in bpe_codec.coded(docs, with_ids=True).collect()]
    assert sorted(map(repr, got)) == sorted(repr(want(*r[:2])) for r in rows)
    assert bpe_codec.coded(docs.filter("false")).count() == 0

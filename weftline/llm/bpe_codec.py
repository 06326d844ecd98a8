"""BPE encoding and decoding as streams.

Encoding is a transducer over bytes with bounded lookahead. The merge list says how far
a merge can depend on what follows: whether a rule is applied at a place depends, at
its right end, on rules of lower rank that take its last token away, and these on
others of lower rank yet; `lookahead` adds up the longest such chain. So a boundary
between tokens is settled once that many bytes behind it are read, or earlier. The
state of the transducer holds, of all places from which a token may still be open, the
tokens on the way there that are not settled. What all of them begin with is emitted;
the rest is never longer than the lookahead, so the memory is constant. States and
transitions are determinised when they are first met (`transducer.py`, whose alphabet
and pre-tokenizer this is) and held in a bounded table.

Many texts run side by side: they are cut behind white space, where the transducer is
always in its first state, and each byte moves all of them at once.

Decoding turns ids into bytes and bytes into text with a machine that keeps the bytes
of an open character between calls, so ids may come in blocks of any size.

Defined results: null and empty texts have no ids, and their decoded text is empty;
repeated rows give repeated results; an empty table gives an empty table; texts of any
length are encoded in whole; other columns are not looked at. A tokenizer of another
kind (see `segments.Tokens`), or whose merges are not in the order in which they build
on each other, is refused.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import kept
from weftline.llm.segments import byte_letters, default_tokenizer
from weftline.llm.shingles import in_steps
from weftline.llm.transducer import _END, _NONE, _SPACES, Merges, Transducer

#: Bytes of a lane, and ids that are decoded at once.
LANE = 256
BLOCK = 1 << 16
#: Runs without white space from this length on get a space where a piece ends anyway: behind a letter, before a mark that opens no contraction.
LONG_RUN = 1024
_LONG_RUN = re.compile(rb"[^ \t-\r]{%d,}" % LONG_RUN)
_PIECE_END = re.compile("(?<=[a-z\u3040-\u309f\u30a1-\u30fa\u4e00-\u9fff\uac00-\ud7a3])(?=[.,;:!?()\u3001\u3002\u300c-\u300f\uff01\uff08\uff09\uff0c\uff1a\uff1b\uff1f])")
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[*_SPACES]] = True


def lookahead(pairs: list[tuple[int, int]], size: dict[int, int], joined: dict[tuple[int, int], int]) -> int:
    """Bytes behind a boundary that settle it. pairs: the merges by rank, size: bytes of a token, joined: what a merge makes.

    reach[rule] is how far behind its right end a rule may depend on the text: a rule of lower rank takes the last of its
    tokens (its right part, or the last part of that) together with what follows, or one that ends inside it does so to
    its first. Ranks fall along a chain, so one pass in their order finds the longest.
    """
    made: dict[int, tuple[int, int]] = {}
    right: dict[int, int] = {}  # token: the furthest that a rule with it on the left reaches behind it
    left: dict[int, int] = {}  # token: the furthest that a rule with it on the right reaches behind it
    most = 0
    for pair in pairs:
        a, b = pair
        new = joined[pair]
        if new in made or new in right or new in left:
            raise ValueError("a token is made by two merges, or used before it is made")
        reach, t = 0, b
        while t is not None:
            reach = max(reach, right.get(t, 0))
            t = made[t][1] if t in made else None
        t = a
        while t is not None:
            reach = max(reach, left.get(t, 0) - size[b] - size[a] + size[t])
            t = made[t][0] if t in made else None
        right[a] = max(right.get(a, 0), size[b] + reach)
        left[b] = max(left.get(b, 0), reach)
        made[new] = pair
        most = max(most, size[new] - 1 + reach)
    return most


def lookahead_of(merges: Merges) -> int:
    size = {i: len(raw) - (raw[-1] == _END) for i, raw in merges.raw.items()}
    ids = {t: i for i, t in merges.text.items()}
    return lookahead(merges.pairs, size, {(a, b): ids[merges.text[a] + merges.text[b]] for a, b in merges.pairs})


def _spaced(run: re.Match) -> bytes:
    """A run with a space at the ends of pieces; bytes of special tokens stay as they are."""
    return _PIECE_END.sub(" ", run[0].decode("utf-8", "surrogateescape")).encode("utf-8", "surrogateescape")


class Encoder(Transducer):
    """Transitions that emit token ids. A place is its distance from here, the last token before it, and the tokens before
    it that are not settled."""

    nothing = ()
    begin = ((0, _NONE, ()),)
    closed = ()

    def __init__(self, path: str, **more):
        super().__init__(path, **more)
        if not self.splits:
            raise ValueError("a tokenizer of another kind")
        self.lookahead = lookahead_of(self.merges)

    def forget(self) -> None:
        self.emissions: dict[tuple, int] = {(): 0}
        self._arrays = None
        super().forget()

    def coded(self, emitted: tuple) -> int:
        if (n := self.emissions.get(emitted)) is None:
            n = self.emissions[emitted] = len(self.emissions)
            self._arrays = None
        return n

    def special(self, number: int) -> tuple:
        return (self.characters.ids[number],)

    def _read(self, part: bytes, places: tuple, more: bytes) -> tuple[bytes, tuple, tuple]:
        """The open part and its places after more bytes of the piece, and the tokens that are settled by them."""
        ids, is_open, follows, out = self.merges.ids, self.merges.open, self.merges.follows, ()
        for byte in more:
            part += bytes([byte])
            open_places, here = [], None
            for n, last, pending in places:
                text = part[-n - 1 :]
                if here is None and (found := ids.get(text)) is not None and follows(last, found):
                    here = (0, found, (*pending, found))
                if text in is_open:
                    open_places.append((n + 1, last, pending))
            if byte == _END:
                return b"", (), out + here[2]
            open_places.append(here)
            first, last = min(x[2] for x in open_places), max(x[2] for x in open_places)
            settled = next((i for i, (a, b) in enumerate(zip(first, last, strict=False)) if a != b), min(len(first), len(last)))
            out += here[2][:settled]
            places = tuple((n, t, pending[settled:]) for n, t, pending in open_places)
            part = part[len(part) - open_places[0][0] :]
        return part, places, out

    def unsettled(self, state: tuple) -> int:
        """Bytes that a state has read and not emitted tokens for."""
        raw = self.merges.raw
        return max((n + sum(len(raw[i]) for i in pending) for n, _, pending in state[3]), default=0) + len(state[1])

    def pool(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all emissions, where those of each begin, and how many they are."""
        if self._arrays is None:
            n = np.array([len(x) for x in self.emissions], np.int64)
            self._arrays = np.array([i for x in self.emissions for i in x], np.uint32), np.cumsum(n) - n, n
        return self._arrays

    def encode(self, texts: list[bytes], lane: int = LANE) -> list[np.ndarray]:
        """The token ids of each text."""
        if not texts:
            return []
        if len(self.states) > self.most:
            self.forget()
        texts = [_LONG_RUN.sub(_spaced, x) if len(x) >= LONG_RUN else x for x in self.characters.prepared(texts)]
        data = np.frombuffer(b"".join(t + b" " for t in texts), np.uint8)
        end = np.cumsum([len(t) + 1 for t in texts])
        space = np.flatnonzero(_IS_SPACE[data])
        cuts = np.unique(np.concatenate([[0], space[np.searchsorted(space, np.arange(lane, len(data), lane))] + 1, end]))
        start, size = cuts[:-1], np.diff(cuts)
        order = np.argsort(-size, kind="stable")
        at, size = start[order], size[order]
        state = np.zeros(len(at), np.int32)
        active = np.searchsorted(-size, -np.arange(int(size.max())), "left")
        lanes, emitted = [], []
        for j, n in enumerate(active.tolist()):
            state[:n], out = self.step(state[:n], data[at[:n] + j])
            some = np.flatnonzero(out)
            lanes.append(some)
            emitted.append(out[some])
        whose, code = order[np.concatenate(lanes)], np.concatenate(emitted)
        code = code[np.argsort(whose, kind="stable")]
        ids, first, n = self.pool()
        n_ids = n[code]
        stop = np.cumsum(n_ids)
        every = ids[np.repeat(first[code] - (stop - n_ids), n_ids) + np.arange(int(stop[-1]) if len(stop) else 0)]
        in_lane = np.bincount(whose, n[np.concatenate(emitted)], len(start)).astype(np.int64)
        in_text = np.add.reduceat(in_lane, np.searchsorted(start, np.append(0, end[:-1])))
        return np.split(every, np.cumsum(in_text)[:-1])


class Decoder:
    """Ids in blocks in, text out. Without a decoder of its own a tokenizer's tokens are written with a space between them;
    a byte-level one writes their bytes."""

    def __init__(self, tokenizer):
        self.byte_level = (json.loads(tokenizer.to_str()).get("decoder") or {}).get("type") == "ByteLevel"
        byte_of = {c: b for b, c in byte_letters().items()}
        tokens = {i: t for t, i in tokenizer.get_vocab(with_added_tokens=True).items()}
        raw = [tokens.get(i, "") for i in range(max(tokens, default=-1) + 1)]
        own = [bytes(byte_of[c] for c in t) if self.byte_level and all(c in byte_of for c in t) else t.encode() for t in raw]
        own = own if self.byte_level else [b" " + t for t in own]
        self.bytes = np.frombuffer(b"".join(own), np.uint8)
        self.size = np.array([len(x) for x in own], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.begin()

    def begin(self) -> None:
        self.fresh, self.machine = True, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: np.ndarray) -> str:
        """The text that is complete with these ids."""
        n = self.size[ids]
        stop = np.cumsum(n)
        data = self.bytes[np.repeat(self.first[ids] - (stop - n), n) + np.arange(int(stop[-1]) if len(stop) else 0)]
        if self.fresh and len(ids) and not self.byte_level:
            data = data[1:]  # no space before the first token
        self.fresh &= not len(ids)
        return self.machine.decode(data.tobytes())

    def end(self) -> str:
        """What an open character becomes at the end."""
        return self.machine.decode(b"", True)

    def blocks(self, ids: np.ndarray, block: int = BLOCK) -> Iterator[str]:
        self.begin()
        for at in range(0, len(ids), block):
            yield self.feed(ids[at : at + block])
        yield self.end()


class Codec:
    def __init__(self, path: str):
        self.encoder = Encoder(path)
        self.decoder = Decoder(self.encoder.tokens.tokenizer)


def codec(path: str) -> Codec:
    """The codec of a tokenizer, kept in the worker process from one task to the next."""
    return kept(("codec", path), lambda: Codec(path))


def coded(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row; with_ids adds the ids (little-endian, 32 bits) and the
    decoded text."""
    path = tokenizer or default_tokenizer()
    kind = docs.schema[doc_id].dataType.simpleString()

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in in_steps(texts):
                found = own.encoder.encode(texts[a:b])
                ids_hash, text_hash, decoded = [], [], []
                for ids in found:
                    ids_hash.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                    digest, parts = hashlib.sha256(), []
                    for part in own.decoder.blocks(ids):
                        digest.update(part.encode())
                        if with_ids:
                            parts.append(part)
                    text_hash.append(digest.hexdigest())
                    decoded.append("".join(parts))
                columns = [batch.column(0).slice(a, b - a), pa.array([len(x) for x in found], pa.int64()), pa.array(ids_hash), pa.array(text_hash)]
                if with_ids:
                    columns += [pa.array([x.astype("<u4").tobytes() for x in found], pa.binary()), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary, decoded string" * with_ids
    names = [x.split()[0] for x in fields.split(", ")]
    rows = docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[text], F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(code, fields)

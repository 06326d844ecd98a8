"""A BPE tokenizer as a deterministic transducer over bytes that emits token counts.

A piece of the pre-tokenizer is read byte by byte. The state is what the merges
of its further tokens can depend on: of all places from which a token of the
vocabulary may still be open, the last token before it and how many tokens that
is less than here. Of the tokens that can end at a byte exactly one goes with
the last token before it, in that merging the two gives the two again; so the
next state follows from the state and the byte, and the transition emits how
many tokens the prefix gains (a number below zero takes tokens back that a
longer one replaces). The end of a piece is a byte of its own, which emits the
rest. Around the pieces, the pre-tokenizer's pattern and the lower-casing are
states too: inside letters, inside marks, after an apostrophe that may open a
contraction, and inside a character of several bytes. Characters of any script are
read like that; what they are, and how they look in lower case, the tokenizer's own
normaliser and pre-tokenizer say, once for each character. Only runs with characters
that compose with others, or vanish, are given to the normaliser before they are read,
and strings of special tokens are replaced by bytes that UTF-8 has not.

States and transitions are determinised when they are first met and held in a
hash table that is emptied when it has grown to MOST_STATES, so memory is
bounded and results are not affected.

A chunk of bytes is a map of states: what it emits and where it ends for each
state it is entered in. It is first evaluated for the state between pieces; for
another state, both are followed until they meet, from where on the two agree.
Neighbouring maps compose into the map of both.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np

from weftline.llm.common import kept
from weftline.llm.segments import Tokens, byte_letters

#: States in the table at most, and bytes of a chunk.
MOST_STATES = 300_000
CHUNK = 256

_SPACES = b" \t\n\x0b\x0c\r"
#: Kinds of states: between pieces, in letters, in marks, after an apostrophe, and after one with r, v or l.
_BETWEEN, _LETTERS, _MARKS, _APOSTROPHE = range(4)
_OPENED = {b"r": 4, b"v": 5, b"l": 6}
#: The contractions of the pre-tokenizer's pattern.
_SHORT, _LONG = (b"s", b"t", b"m", b"d"), {4: (b"r", b"e"), 5: (b"v", b"e"), 6: (b"l", b"l")}
_END = 0xFF  # no byte of UTF-8
_SPECIAL = 0xF8  # nor are these, which stand for special tokens
_NONE = 0xFFFF
_ZERO = 1 << 15
_PLAIN = np.zeros(256, bool)
_PLAIN[[*_SPACES, *range(0x21, 0x7F), *range(0x80, 0xF8)]] = True
#: Hangul letters that compose with each other.
_JAMO = (range(0x1100, 0x1200), range(0xA960, 0xA980), range(0xD7B0, 0xD800))


class Characters:
    """What the tokenizer's normaliser and pre-tokenizer make of characters."""

    def __init__(self, tokens: Tokens):
        self.normal, self.pre = tokens.tokenizer.normalizer.normalize_str, tokens.tokenizer.pre_tokenizer.pre_tokenize_str
        self.special = {x: i for i, x in sorted((i, t.content) for i, t in tokens.tokenizer.get_added_tokens_decoder().items())}
        self.cut = re.compile("|".join(f"({re.escape(x)})" for x in self.special) or "(?!)")
        self.ids = list(self.special.values())
        self.known: dict[bytes, tuple[str, bytes]] = {}
        self.asked = np.zeros(0x110000, np.int8)  # 1: changes in letter case only, 2: is given to the normaliser
        self.asked[[*_SPACES]] = 1

    def alone(self, c: str) -> bool:
        """Whether the normaliser does no more to the character than changing its letter case, whatever stands next to it."""
        return unicodedata.category(c)[0] in "LNPS" and not unicodedata.combining(c) and not any(ord(c) in x for x in _JAMO) and unicodedata.normalize("NFC", c) == c and len(self.normal(c)) == 1

    def __getitem__(self, char: bytes) -> tuple[str, bytes]:
        """Kind (L, N, Z for white space, or O) and bytes in lower case."""
        if (found := self.known.get(char)) is None:
            c = char.decode("utf-8", "replace")
            low = self.normal(c) if self.alone(c) else c
            pieces = [len(self.pre(x + low)) for x in "a!"]
            letters = "".join(x for x, _ in self.pre("a" + low))
            kind = "Z" if letters == "a" else "L" if pieces[0] == 1 else "O" if pieces[1] == 1 else "N"
            if len(self.known) > 1 << 16:
                self.known.clear()
            found = self.known[char] = kind, low.encode()
        return found

    def prepared(self, texts: list[bytes]) -> list[bytes]:
        """The texts as transitions read them."""
        joined = b" ".join(texts)
        data = np.frombuffer(joined, np.uint8)
        lead = np.flatnonzero(data >= 0xC0)
        if len(lead):
            try:
                joined.decode()
            except UnicodeDecodeError:
                return self.prepared([x.decode("utf-8", "replace").encode() for x in texts])
        odd = np.flatnonzero(~_PLAIN[data])
        if len(lead):
            padded = np.append(data, np.zeros(3, np.uint8)).astype(np.int32)
            first, size = padded[lead], 2 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0)
            code = np.where(size == 2, first & 31, np.where(size == 3, first & 15, first & 7))
            for k in range(1, 4):
                code = np.where(size > k, code << 6 | padded[lead + k] & 63, code)
            for c in np.unique(code[self.asked[code] == 0]).tolist():
                self.asked[c] = 1 if self.alone(chr(c)) else 2
            odd = np.concatenate([odd[data[odd] < 0xC0], lead[self.asked[code] == 2]])
        else:
            odd = odd[data[odd] < 0xC0]
        if not len(odd) and b"<|" not in joined and not any(x.encode() in joined for x in self.special if "<|" not in x):
            return texts
        end = np.cumsum([len(x) + 1 for x in texts])
        wrong = set(np.searchsorted(end, odd, "right").tolist())
        return [self._fixed(x.decode()) if i in wrong or any(y.encode() in x for y in self.special) else x for i, x in enumerate(texts)]

    def _fixed(self, text: str) -> bytes:
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += (self._normal(text[at : m.start()]), bytes([_SPECIAL + m.lastindex - 1]))
            at = m.end()
        return b"".join([*out, self._normal(text[at:])])

    def _normal(self, text: str) -> bytes:
        def run(m: re.Match) -> str:
            return self.normal(m[0]) if any(self.asked[ord(c)] == 2 or c < "!" or c == "\x7f" for c in m[0]) else m[0]

        return re.sub("[^ \t-\r]+", run, text).encode()


class Merges:
    """The vocabulary's merges over two alphabets, bytes inside a piece and bytes at its end, by the library's own BPE model."""

    def __init__(self, tokens: Tokens):
        import json

        from tokenizers.models import BPE

        model = json.loads(tokens.tokenizer.to_str())["model"]
        byte_of = {c: b for b, c in byte_letters().items()}
        ends = model["end_of_word_suffix"]

        def own(token: str) -> str:
            last = token.endswith(ends)
            raw = [byte_of[c] for c in (token[: -len(ends)] if last else token)]
            return "".join(map(chr, raw[:-1])) + chr(raw[-1] + 256 * last)

        special = {x["content"] for x in json.loads(tokens.tokenizer.to_str())["added_tokens"]}
        vocab = {own(t): i for t, i in model["vocab"].items() if t not in special}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.model = BPE(vocab=vocab, merges=[(own(a), own(b)) for a, b in pairs])
        self.pairs = [(vocab[own(a)], vocab[own(b)]) for a, b in pairs]
        self.text = {i: t for t, i in vocab.items()}
        raw = {i: bytes(ord(c) & 0xFF for c in t) + bytes([_END] if ord(t[-1]) > 255 else []) for i, t in self.text.items()}
        self.raw = raw
        self.ids = {b: i for i, b in raw.items()}
        self.open = {b[:n] for b in self.ids for n in range(len(b))}

    def follows(self, last: int, token: int) -> bool:
        """Whether merging the text of both gives both."""
        both = [token] if last == _NONE else [last, token]
        return [t.id for t in self.model.tokenize("".join(self.text[i] for i in both))] == both


class Transducer:
    """next state and emitted count for arrays of states and bytes."""

    nothing: object = 0  # what a transition emits that emits nothing
    begin: object = array("H", [0, _NONE, _ZERO]).tobytes()
    closed: object = b""

    def __init__(self, path: str, most_states: int = MOST_STATES):
        self.tokens = Tokens(path)
        self.most = most_states
        self.splits = self.tokens.splits and len(self.tokens.tokenizer.get_added_tokens_decoder()) <= _END - _SPECIAL
        if self.splits:
            self.merges, self.characters = Merges(self.tokens), Characters(self.tokens)
            self.forget()

    def coded(self, emitted) -> int:
        """What stands for it in the table of transitions, 0 for nothing."""
        return emitted

    def special(self, number: int):
        return 1

    def forget(self) -> None:
        self.number: dict[tuple, int] = {(_BETWEEN, b"", b"", self.closed): 0}
        self.states: list[tuple] = list(self.number)
        self.used = 0
        self._room(1 << 16)

    def _room(self, size: int) -> None:
        self.keys, self.next, self.emits = np.full(size, -1, np.int64), np.zeros(size, np.int32), np.zeros(size, np.int32)
        self.shift = np.uint64(64 - (size.bit_length() - 1))

    def _slots(self, key: np.ndarray) -> np.ndarray:
        """Where each key is, or the free place where it would be."""
        slot = ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)
        there = self.keys[slot]
        far = np.flatnonzero((there != key) & (there != -1))
        while len(far):
            slot[far] = (slot[far] + 1) & (len(self.keys) - 1)
            there = self.keys[slot[far]]
            far = far[(there != key[far]) & (there != -1)]
        return slot

    def step(self, state: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = state.astype(np.int64) << 8 | byte
        slot = self._slots(key)
        missing = self.keys[slot] == -1
        if missing.any():
            self._compile(np.unique(key[missing]))
            slot = self._slots(key)
        return self.next[slot], self.emits[slot]

    def _compile(self, keys: np.ndarray) -> None:
        to, emitted = np.zeros(len(keys), np.int32), np.zeros(len(keys), np.int32)
        for i, key in enumerate(keys.tolist()):
            after, out = self._after(self.states[key >> 8], key & 255)
            emitted[i] = self.coded(out)
            if (n := self.number.get(after)) is None:
                n = self.number[after] = len(self.states)
                self.states.append(after)
            to[i] = n
        while 2 * (self.used + len(keys)) > len(self.keys):
            old = self.keys, self.next, self.emits
            self._room(2 * len(self.keys))
            held = old[0] != -1
            self._put(*(x[held] for x in old))
        self._put(keys, to, emitted)
        self.used += len(keys)

    def _put(self, keys: np.ndarray, to: np.ndarray, emitted: np.ndarray) -> None:
        rest = np.arange(len(keys))
        while len(rest):
            slot = self._slots(keys[rest])
            self.keys[slot] = keys[rest]
            won = self.keys[slot] == keys[rest]  # of several for one free place, one gets it
            at = slot[won]
            self.next[at], self.emits[at] = to[rest[won]], emitted[rest[won]]
            rest = rest[~won]

    # one transition: a state is (kind, bytes of an open character, open part of the piece, places in it)

    def _after(self, state: tuple, byte: int) -> tuple[tuple, object]:
        kind, lead, part, places = state
        if byte >= _SPECIAL:
            n = self._character(kind, part, places, "Z", b"")[1]
            return self.states[0], n + self.special(byte - _SPECIAL)
        char = lead + bytes([byte])
        if byte >= 0xC0:
            return (kind, bytes([byte]), part, places), self.nothing
        if byte >= 0x80:
            if not lead:  # a chunk that begins inside a character is evaluated from here for the time being
                return self.states[0], self.nothing
            if len(char) < 2 + (lead[0] >= 0xE0) + (lead[0] >= 0xF0):
                return (kind, char, part, places), self.nothing
        else:
            char = bytes([byte])
        return self._character(kind, part, places, *(("Z", b"") if byte in _SPACES else self.characters[char]))

    def _character(self, kind: int, part: bytes, places, sort: str, low: bytes) -> tuple[tuple, object]:
        n = self.nothing
        if kind >= _APOSTROPHE:
            opened = _LONG.get(kind, (b"", b""))
            if kind == _APOSTROPHE and low in _SHORT or kind != _APOSTROPHE and low == opened[1]:
                return self.states[0], self._piece(b"'" + opened[0] + low)
            if kind == _APOSTROPHE and low in _OPENED:
                return (_OPENED[low], b"", b"", self.closed), self.nothing
            if kind == _APOSTROPHE and sort == "O":
                kind, (part, places, n) = _MARKS, self._read(b"", self.begin, b"'")
            elif kind == _APOSTROPHE:
                kind, n = _BETWEEN, self._piece(b"'")
            else:
                n = self._piece(b"'")
                kind, (part, places, more) = _LETTERS, self._read(b"", self.begin, opened[0])
                n += more
        if kind == _LETTERS and sort == "L" or kind == _MARKS and sort == "O":
            part, places, more = self._read(part, places, low)
            return (kind, b"", part, places), n + more
        if kind != _BETWEEN:
            n += self._read(part, places, bytes([_END]))[2]
        if sort == "Z":
            return self.states[0], n
        if sort == "N":
            return self.states[0], n + self._piece(low)
        if low == b"'":
            return (_APOSTROPHE, b"", b"", self.closed), n
        part, places, more = self._read(b"", self.begin, low)
        return (_LETTERS if sort == "L" else _MARKS, b"", part, places), n + more

    def _piece(self, whole: bytes):
        return self._read(b"", self.begin, whole + bytes([_END]))[2]

    def _read(self, part: bytes, places: bytes, more: bytes) -> tuple[bytes, bytes, int]:
        """The open part and its places after more bytes of the piece, and the tokens that are gained. A place is its
        distance from here, the last token before it, and its tokens less those here."""
        ids, is_open, follows, gained = self.merges.ids, self.merges.open, self.merges.follows, 0
        for byte in more:
            own = array("H", places)
            part += bytes([byte])
            kept, token, rise = [], None, 0
            for i in range(0, len(own), 3):
                n = own[i] + 1
                text = part[-n:]
                if token is None and (found := ids.get(text)) is not None and follows(own[i + 1], found):
                    token, rise = found, own[i + 2] - _ZERO + 1
                if text in is_open:
                    kept += (n, own[i + 1], own[i + 2])
            for i in range(2, len(kept), 3):
                kept[i] -= rise
            if byte != _END:
                part = part[-kept[0] :] if kept else b""
            places = array("H", [*kept, 0, token, _ZERO]).tobytes()
            gained += rise
        return part, places, gained

    # maps of chunks

    def run(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each chunk, entered between pieces: the state at its end, and what it emits."""
        order = np.argsort(start - end, kind="stable")
        at, size = start[order], (end - start)[order]
        state, total = np.zeros(len(at), np.int32), np.zeros(len(at), np.int64)
        active = np.searchsorted(-size, -np.arange(int(size.max(initial=0))), "left")
        for j, n in enumerate(active.tolist()):
            state[:n], emitted = self.step(state[:n], data[at[:n] + j])
            total[:n] += emitted
        back = np.empty(len(at), np.int64)
        back[order] = np.arange(len(at))
        return state[back], total[back]

    def entered(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For chunks that are entered in these states: whether that meets the map's state between pieces, the state
        at the end if it doesn't, and what is emitted more."""
        n = len(start)
        met, at_end, more = np.zeros(n, bool), state.copy(), np.zeros(n, np.int64)
        lane, at, a, b = np.arange(n), start.copy(), np.zeros(n, np.int32), state.copy()
        while True:
            met[lane[a == b]] = True
            on = (a != b) & (at < end[lane])
            at_end[lane] = b
            lane, at, a, b = lane[on], at[on], a[on], b[on]
            if not len(lane):
                return met, at_end, more
            byte = data[at]
            both, emitted = self.step(np.concatenate([a, b]), np.concatenate([byte, byte]))
            a, b, at = both[: len(lane)], both[len(lane) :], at + 1
            more[lane] += emitted[len(lane) :].astype(np.int64) - emitted[: len(lane)]

    def counts(self, texts: list[bytes], chunk: int = CHUNK) -> np.ndarray:
        """The number of tokens of each text, by composing the maps of its chunks pairwise."""
        if not self.splits:
            return np.array([len(x) for x in self.tokens.ids(texts)], np.int64)
        if len(self.states) > self.most:
            self.forget()
        texts = self.characters.prepared(texts)
        data = np.frombuffer(b"".join(t + b" " for t in texts), np.uint8)
        end = np.cumsum([len(t) + 1 for t in texts])
        first = np.append(0, end[:-1])
        n = -(-(end - first) // chunk)
        text = np.repeat(np.arange(len(texts)), n)
        start = first[text] + (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)) * chunk
        stop = np.minimum(start + chunk, end[text])
        exits, total = self.run(data, start, stop)
        while len(text) > len(texts):
            rank = np.arange(len(text)) - np.searchsorted(text, text)
            left = np.flatnonzero((rank % 2 == 0) & (np.append(text[1:], -1) == text))
            right = left + 1
            met, at_end, more = self.entered(data, start[right], stop[right], exits[left])
            exits[left] = np.where(met, exits[right], at_end)
            total[left] += total[right] + more
            stop[left] = stop[right]
            keep = np.ones(len(text), bool)
            keep[right] = False
            text, start, stop, exits, total = (x[keep] for x in (text, start, stop, exits, total))
        return total


def transducer(path: str) -> Transducer:
    """The transducer of a tokenizer, kept in the worker process from one task to the next."""
    return kept(("transducer", path), lambda: Transducer(path))

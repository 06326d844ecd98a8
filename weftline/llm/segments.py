"""A lazily compiled transducer for tokenizers that never merge across ASCII white space.

The tokenizer's pre-tokenizer drops white space, and its normaliser (NFC, lower
case) works inside a run of other characters, so the tokens of a text are the
tokens of its runs, one after the other. The machine reads a text as runs: an
arc carries one run as its label (all bytes of the run on a single, path-compressed
arc) and what the tokenizer emits for it. Arcs are compiled by the tokenizer
itself the first time a run is met. They are held in two generations of bounded
size: runs that are still in use move to the young one, the others are compiled
again if they come back, so memory is bounded and results are not affected.
"""

from __future__ import annotations

import gc
import json
import os
import re
from array import array
from collections import ChainMap
from collections.abc import Callable

from weftline.llm.common import kept

#: Arcs in a generation; runs longer than LONG bytes are given to the tokenizer each time.
GENERATION = 350_000
#: Pieces that are held in a generation, of runs that have several.
PIECES = 40_000
LONG = 64


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: The pattern of the tokenizer's pre-tokenizer, and the same for the characters of PLAIN.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff"
PLAIN = re.compile(f"[!-@\\[-`{{-~{_LETTERS}]+").fullmatch
_PLAIN_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9]+").findall


def byte_letters() -> dict[int, str]:
    """The characters that byte-level vocabularies write for bytes."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Tokens:
    """Token ids of runs, as the tokenizers library gives them without adding special tokens.

    Runs of lower-case Latin-1 letters, digits and ASCII marks are not changed by the normaliser; they are cut into the
    pre-tokenizer's pieces here, and the library's BPE model is asked for each new piece. All others go through the whole
    tokenizer. splits says whether the tokenizer is of the kind that the module is about; if not, a text is one run.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        steps = (config.get("normalizer") or {}).get("normalizers", [])
        pre = (config.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.splits = (
            [x["type"] for x in steps] == ["NFC", "Replace", "Lowercase"]
            and [x["type"] for x in pre] == ["Split", "ByteLevel"]
            and pre[0]["pattern"] == {"Regex": PATTERN}
            and not any(x["lstrip"] or x["rstrip"] or x["normalized"] or set(" \t\n\x0b\x0c\r") & set(x["content"]) or "<|" not in x["content"] for x in config["added_tokens"])
        )
        shown = byte_letters()
        self.letters = {c: "".join(shown[b] for b in chr(c).encode()) for c in range(0xDF, 0x100) if c != 0xF7}  # those of PLAIN
        self.young: dict[str, list[int]] = {}
        self.old: dict[str, list[int]] = {}

    def runs(self, text: bytes) -> list[bytes]:
        return runs_of(text) if self.splits else [text]

    def ids(self, runs: list[bytes]) -> list[list[int]]:
        out: list[list[int]] = []
        whole: list[tuple[int, str]] = []
        young, old, tokenize, letters = self.young, self.old, self.tokenizer.model.tokenize, self.letters
        for run in runs:
            text = run.decode("utf-8", "replace")
            if self.splits and run.isalpha() and run.islower():  # a single piece
                out.append([t.id for t in tokenize(text)])
                continue
            if not self.splits or "<|" in text or not PLAIN(text):
                whole.append((len(out), text))
                out.append([])
                continue
            own: list[int] = []
            for piece in _PLAIN_PIECES(text):
                ids = young.get(piece)
                if ids is None:
                    ids = old.get(piece)
                    if ids is None:
                        ids = [t.id for t in tokenize(piece if piece.isascii() else piece.translate(letters))]
                    young[piece] = ids
                own = own + ids if own else ids
            out.append(own)
        for (at, _), e in zip(whole, getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)([t for _, t in whole], add_special_tokens=False) if whole else [], strict=True):
            out[at] = e.ids
        if len(young) > PIECES:
            self.young, self.old = {}, young
        return out


def arcs(path: str, emit: Callable[[list[int]], object], size: int = GENERATION) -> Arcs:
    """The machine of a tokenizer, kept in the worker process from one task to the next; size bounds the arcs of a generation."""

    def compiled() -> Arcs:
        tokens = Tokens(path)
        machine = Arcs(tokens.ids, emit, tokens.runs, size)
        machine.splits = tokens.splits
        return machine

    return kept(("arcs", path, emit.__name__, size), compiled)


class Arcs:
    """run -> what is emitted for it; emit turns token ids into that."""

    splits = True

    def __init__(self, ids: Callable[[list[bytes]], list[list[int]]], emit: Callable[[list[int]], object], runs: Callable[[bytes], list[bytes]] | None = None, size: int = GENERATION):
        self.ids, self.emit, self.size, self.runs = ids, emit, size, runs or runs_of
        self.young: dict[bytes, object] = {}
        self.old: dict[bytes, object] = {}

    def read(self, texts: list[list[bytes]]) -> list[list]:
        """What is emitted for the runs of each text, in order; arcs that are missing are compiled first."""
        young, old = self.young, self.old
        out = [list(map(young.get, own)) for own in texts]
        holes, missing = [], {}
        for own, emitted in zip(texts, out, strict=True):
            if None in emitted:
                at = [i for i, x in enumerate(emitted) if x is None]
                holes.append((own, emitted, at))
                for i in at:
                    missing[own[i]] = None
        fresh, marked = {}, []
        for run in missing:
            found = old.get(run)
            if found is not None:
                young[run] = missing[run] = found
            elif run[-1:] in _MARKS and self.splits and len(run) > 1 and 97 <= run[-2] <= 122 and b"<|" not in run:
                marked.append(run)
                if run[:-1] not in young:
                    found = old.get(run[:-1])
                    if found is None:
                        fresh[run[:-1]] = None
                    else:
                        young[run[:-1]] = found
            else:
                fresh[run] = None
        for mark in _MARKS:
            if marked and mark not in young:
                fresh[mark] = None
        collecting = gc.isenabled()
        gc.disable()  # many small lists, and no cycles
        passing = {}
        for run, ids in zip(fresh, self.ids(list(fresh)), strict=True):
            (young if len(run) <= LONG else passing)[run] = self.emit(ids)
        if collecting:
            gc.enable()
        known = ChainMap(young, passing) if passing else young
        for run in marked:
            known[run] = known[run[:-1]] + known[run[-1:]]
        for run in missing:
            if missing[run] is None:
                missing[run] = known[run]
        for own, emitted, at in holes:
            for i in at:
                emitted[i] = missing[own[i]]
        if len(young) > self.size:
            self.young, self.old = {}, young
        return out


#: A mark after one of a-z is a piece of its own for the pre-tokenizer.
_MARKS = (b".", b",")


def runs_of(text: bytes) -> list[bytes]:
    """The runs between ASCII white space, A-Z lower-cased unless the text may hold a special token's string."""
    return text.split() if b"<|" in text else text.lower().split()


def as_bytes(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit ids."""
    return array("I", ids).tobytes()

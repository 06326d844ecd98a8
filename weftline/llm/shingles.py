"""Sets of hashed word shingles, computed with numpy for many texts at once.

Words are the runs without ASCII white space, A-Z lower-cased. The shingles of a
text are its runs of five words; a text with one to four words has its whole
sequence as its only shingle; a text without words has none. Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WORDS = 5
#: Bytes of text that are hashed at once.
STEP = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[65:91] += np.uint64(32)
_BASE = 0x9E3779B97F4A7C15
_FACTORS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base and of its inverse, n at least."""
    if len(_powers[0]) < n:
        size = max(n, STEP + STEP // 4)
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The hash and the first byte of each word."""
    raw = np.frombuffer(data, np.uint8)
    space = np.concatenate([[True], _SPACE[raw], [True]])
    start = np.flatnonzero(space[:-1] & ~space[1:])
    end = np.flatnonzero(~space[:-1] & space[1:])
    powers, inverse = _powers_to(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_LOWER[raw] * powers[:-1], out=sums[1:])
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64)), start


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of all texts, sorted in each text, and where those of each text begin (one place more than texts)."""
    data = b" ".join(texts)
    first = np.cumsum([0] + [len(t) + 1 for t in texts])
    words, at = word_hashes(data)
    owner = np.searchsorted(first, at, "right") - 1
    n = len(words)
    full = np.flatnonzero(owner[WORDS - 1 :] == owner[: n - WORDS + 1]) if n >= WORDS else np.zeros(0, np.int64)
    long = np.zeros(len(full), np.uint64)
    for k in range(WORDS):
        long += words[full + k] * _FACTORS[k]
    count = np.bincount(owner, minlength=len(texts)) if n else np.zeros(len(texts), np.int64)
    few = np.flatnonzero((count > 0) & (count < WORDS))
    begin = np.cumsum(count) - count
    short = np.zeros(len(few), np.uint64)
    for k in range(WORDS - 1):
        has = count[few] > k
        short[has] += words[begin[few[has]] + k] * _FACTORS[k]
    short += count[few].astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)
    every = mix(np.concatenate([long, short]))
    whose = np.concatenate([owner[full], few])
    order = np.lexsort((every, whose))
    every, whose = every[order], whose[order]
    new = np.ones(len(every), bool)
    new[1:] = (every[1:] != every[:-1]) | (whose[1:] != whose[:-1])
    every, whose = every[new], whose[new]
    return every, np.searchsorted(whose, np.arange(len(texts) + 1))


def in_steps(texts: list[bytes], step: int = STEP) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about step bytes each."""
    first = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > step:
            yield first, i
            first, size = i, 0
        size += len(t) + 1
    if first < len(texts):
        yield first, len(texts)

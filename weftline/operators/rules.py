"""Literal fixes by group (a volume and a kind of text), from a table of rules.

A rule can be on only if its old text stands in the text at its turn: from the start, or since an earlier rule put
something there. One scan with an Aho-Corasick automaton finds those of the start; after each replacement only the
seams around what was put in are scanned again. So a text costs one scan and its fixes, however many rules there are.

Defined results: null texts stay null with no hits; rules with a null or empty old text or a null new one are left out;
rules apply by `ord`, equal ones by old and new text; a rule with nulls in its group fits texts with nulls there.
"""

from __future__ import annotations

import contextlib
import ctypes
import heapq
from collections.abc import Callable, Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weftline.operators import scan

#: Rules that are held at once; more are taken in turns, in their order, with a pass over the texts for each.
AT_ONCE = 50_000
#: Texts that a task holds as strings at a time.
HELD = 128


def _machine(rules: Sequence[tuple[str, str]]) -> ahocorasick.Automaton:
    """An automaton over the old texts, each with the numbers of its rules."""
    numbers: dict[str, list[int]] = {}
    for i, (old, _) in enumerate(rules):
        numbers.setdefault(old, []).append(i)
    machine = ahocorasick.Automaton()
    for old, own in numbers.items():
        machine.add_word(old, own)
    machine.make_automaton()
    return machine


def fix(text: str, rules: Sequence[tuple[str, str]], machine: ahocorasick.Automaton, longest: int) -> tuple[str, list[int]]:
    """The text after all rules, and the numbers of those that found something."""
    due = sorted({i for _, own in machine.iter(text) for i in own})
    queued, hits = set(due), []
    while due:
        i = heapq.heappop(due)
        old, new = rules[i]
        pieces = text.split(old)
        if len(pieces) == 1:  # an earlier rule took it away
            continue
        hits.append(i)
        text = new.join(pieces)
        at = 0
        for piece in pieces[:-1]:
            at += len(piece)
            for _, own in machine.iter(text[max(at - longest, 0) : at + len(new) + longest]):
                for j in own:
                    if j > i and j not in queued:
                        queued.add(j)
                        heapq.heappush(due, j)
            at += len(new)
    return text, hits


def _pass(by_group: dict[tuple, list[tuple[int, str, str]]], group: Sequence[str], text: str, told: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built: dict[tuple, tuple] = {}
        for whole in batches:
            # a batch holds 10,000 texts of any length: they are taken a few at a time, so that only the batch itself is held whole
            for first in range(0, whole.num_rows, HELD):
                batch = whole.slice(first, HELD)
                texts, hits = [], []
                own = zip(*(batch.column(g).to_pylist() for g in group), strict=True) if group else [()] * batch.num_rows
                for key, value, before in zip(own, batch.column(text).to_pylist(), batch.column("hits").to_pylist(), strict=True):
                    found: list[int] = []
                    if value is not None and key in by_group:
                        if key not in built:
                            pairs = [(old, new) for _, old, new in by_group[key]]
                            built[key] = (pairs, _machine(pairs), max(len(old) for old, _ in pairs))
                        value, found = fix(value, *built[key])
                    texts.append(value if text in told else None)
                    hits.append([*before, *(by_group[key][i][0] for i in found)])
                new = {text: texts, "hits": hits}
                yield pa.RecordBatch.from_arrays([pa.array(new[c], batch.schema.field(c).type) if c in new else batch.column(c) for c in told], list(told))
            del whole
            _give_back()

    return run


def _give_back() -> None:
    """Free memory goes back to the system, which other processes of the executor need."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def fixed(texts: DataFrame, rules: DataFrame, group: Sequence[str], text: str = "text", at_once: int = AT_ONCE, hits_only: bool = False) -> DataFrame:
    """texts with all rules of their group applied in order, and `hits`: the ord of each rule that found something.

    rules: the group's columns (of the same types as those of texts), ord, old, new. With hits_only the group and hits alone
    come back, so that texts go to the tasks' Python but not out of it.
    """
    told = rules.filter("old <> '' AND new IS NOT NULL").select(*group, F.col("ord").cast("long").alias("ord"), "old", "new")
    placed = scan.ranked(told, [], ["ord", "old", "new"], "_at", "_n")
    n = placed.agg(F.max("_n")).first()[0] or 0
    out = texts.withColumn("hits", F.array().cast("array<bigint>"))
    if hits_only:
        out = out.select(*group, text, "hits")
    for first in range(0, n, at_once):
        by_group: dict[tuple, list[tuple[int, str, str]]] = {}
        for r in placed.filter(F.col("_at").between(first, first + at_once - 1)).orderBy("_at").collect():  # at_once rows at most
            by_group.setdefault(tuple(r[g] for g in group), []).append((r["ord"], r["old"], r["new"]))
        columns = [c for c in out.columns if not (hits_only and first + at_once >= n and c == text)]
        out = out.mapInArrow(_pass(by_group, group, text, columns), StructType([out.schema[c] for c in columns]))
    return out.select(*group, "hits") if hits_only else out


def counted(fixed_: DataFrame, group: Sequence[str]) -> DataFrame:
    """group, ord and n_texts: in how many texts each rule found something."""
    return fixed_.select(*group, F.explode("hits").alias("ord")).groupBy(*group, "ord").agg(F.count(F.lit(1)).alias("n_texts"))

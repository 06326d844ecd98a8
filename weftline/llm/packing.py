"""Vector bin packing of examples into training sequences.

Every example has a demand vector: tokens, one segment, and loss-bearing tokens
(those at its end that are trained on; what comes before is its context, such as a
prompt).
A sequence has a capacity in each of them. The packer fills one sequence at a
time: of the pieces at hand that fit it picks the one whose demand has the
largest dot product with what is left of the capacity, both as shares of the
whole. When none fits, the longest piece is cut so that it fills the rest, and
what was cut off goes back to the pieces at hand. Examples longer than a
sequence are first cut into whole sequences and a rest.

A sequence that can't be filled (the last ones of a partition, or one that has
run out of segments) is cut back to the largest power of two below its length,
at which sequences need no padding; what is cut off is packed on.

Packing is local to a partition, in a pool of a bounded number of pieces, so
there is no shuffle and no group; a partition leaves at most a dozen short
sequences. Sequence ids carry the partition's number.

Defined results: a null or empty text is the single end id; repeated rows are
packed as often as they come; an empty table gives an empty table; other
columns are not looked at.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm.segments import GENERATION, arcs, as_bytes, default_tokenizer

#: Limits of a sequence, and pieces that are at hand at once.
MAX_TOKENS = 2048
MAX_SEGMENTS = 64
MAX_LOSS = 1792
#: The share of an example's tokens that bear loss, from its end, where the caller doesn't know better.
LOSS_SHARE = 0.75
POOL = 1024
END = 1


class Piece(NamedTuple):
    example: object
    start: int
    length: int
    loss: int
    ids: np.ndarray | None
    total: int

    def cut(self, at: int) -> tuple[Piece, Piece]:
        """The first at tokens, and the rest; the loss-bearing tokens are the last ones of a piece."""
        later = min(self.loss, self.length - at)
        ids = (None, None) if self.ids is None else (self.ids[:at], self.ids[at:])
        return self._replace(length=at, loss=self.loss - later, ids=ids[0]), self._replace(start=self.start + at, length=self.length - at, loss=later, ids=ids[1])


class Packer:
    """Pieces in, sequences (lists of pieces) out."""

    def __init__(self, tokens: int = MAX_TOKENS, segments: int = MAX_SEGMENTS, loss: int = MAX_LOSS, pool: int = POOL):
        self.tokens, self.segments, self.loss, self.size = tokens, segments, loss, pool
        self.pool: list[Piece] = []

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        while piece.length > self.tokens or piece.loss > self.loss:
            at = min(self.tokens, piece.length)
            if piece.loss > self.loss:  # no more than the allowed loss-bearing tokens in one cut
                at = min(at, piece.length - piece.loss + self.loss)
            first, piece = piece.cut(at)
            if first.length == self.tokens:
                yield [first]
            else:
                self.pool.append(first)
        if piece.length:
            self.pool.append(piece)
        while len(self.pool) >= 2 * self.size:
            yield from self.fill(self.size)

    def end(self) -> Iterator[list[Piece]]:
        yield from self.fill(0)

    def fill(self, down_to: int) -> Iterator[list[Piece]]:
        """Sequences until no more than down_to pieces are at hand."""
        pool = self.pool
        length = np.array([p.length for p in pool] + [0] * len(pool), np.float64)
        loss = np.array([p.loss for p in pool] + [0] * len(pool), np.float64)
        while len(pool) > down_to:
            n = len(pool)
            taken: list[Piece] = []
            free, segments, free_loss = self.tokens, self.segments, self.loss

            def take(i: int) -> Piece:
                """Piece i out of the pool; the last one gets its place."""
                piece, last = pool[i], pool.pop()
                if i < len(pool):
                    pool[i] = last
                    length[i], loss[i] = last.length, last.loss
                return piece

            while pool and free and segments:
                n = len(pool)
                score = length[:n] * (free / self.tokens**2) + loss[:n] * (free_loss / self.loss**2) + segments / self.segments**2
                score[(length[:n] > free) | (loss[:n] > free_loss)] = -1
                best = int(score.argmax())
                if score[best] >= 0:
                    piece = take(best)
                else:
                    best = int(length[:n].argmax())
                    at = min(free, pool[best].length - pool[best].loss + free_loss)
                    if at <= 0:
                        break
                    piece, rest = pool[best].cut(at)
                    pool[best] = rest
                    length[best], loss[best] = rest.length, rest.loss
                taken.append(piece)
                free, segments, free_loss = free - piece.length, segments - 1, free_loss - piece.loss
            yield self.closed(taken, length, loss)

    def closed(self, taken: list[Piece], length: np.ndarray, loss: np.ndarray) -> list[Piece]:
        """The sequence, cut back to a power of two unless it is full."""
        total = sum(p.length for p in taken)
        keep = total if total == self.tokens else 1 << (total.bit_length() - 1)
        while total > keep:
            piece = taken.pop()
            total -= piece.length
            if total < keep:
                first, piece = piece.cut(keep - total)
                taken.append(first)
                total = keep
            length[len(self.pool)], loss[len(self.pool)] = piece.length, piece.loss
            self.pool.append(piece)
        return taken


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None, tokens: int = MAX_TOKENS, segments: int = MAX_SEGMENTS, loss: int = MAX_LOSS, loss_share: Column | None = None, with_ids: bool = False, arcs_held: int = GENERATION) -> DataFrame:
    """One row for each piece of each document: where it comes from, where it lies, and how many of its tokens bear loss;
    with_ids adds its token ids. loss_share is the share of each example's tokens that bear loss, from its end (null: none).
    arcs_held bounds what a worker keeps of the token machine; fewer take less memory and more time."""
    path = tokenizer or default_tokenizer()
    kind = docs.schema[doc_id].dataType.simpleString()
    fields = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long" + ", ids binary" * with_ids

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, packer = arcs(path, as_bytes, arcs_held), Packer(tokens, segments, loss)
        number = TaskContext.get().partitionId() << 36
        end, rows = as_bytes([END]), []

        def keep(sequence: list[Piece]) -> None:
            nonlocal number
            offset = 0
            for p in sequence:
                rows.append((p.example, p.start, p.length, zlib.crc32(p.ids), p.total, number, offset, p.loss, *([p.ids.tobytes()] if with_ids else [])))
                offset += p.length
            number += 1

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * (8 + with_ids)
            kinds = [id_type, *[pa.int64()] * 7, *[pa.binary()] * with_ids]
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        names = [x.split()[0] for x in fields.split(", ")]
        id_type = pa.int64()
        for batch in batches:
            id_type = batch.schema.field(0).type
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                runs = [machine.runs(x) for x in part.column(1).to_pylist()]
                for example, share, emitted in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), machine.read(runs), strict=True):
                    emitted.append(end)
                    ids = np.frombuffer(b"".join(emitted), "<u4")
                    n_loss = min(len(ids), math.ceil(len(ids) * max(0.0, share)))
                    for sequence in packer.add(Piece(example, 0, len(ids), n_loss, ids, len(ids))):
                        keep(sequence)
                if len(rows) >= 5000 or with_ids and rows:
                    yield flushed()
        for sequence in packer.end():
            keep(sequence)
        if rows:
            yield flushed()

    share = F.lit(LOSS_SHARE) if loss_share is None else F.coalesce(loss_share, F.lit(0.0))
    rows = docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[text], F.lit("")).cast("binary").alias("text"), share.cast("double").alias("share"))
    return rows.mapInArrow(pack, fields)

"""Vector bin packing of documents into training sequences.

Each example is a vector of three demands: tokens, segments (one) and tokens that bear loss. A sequence has a limit for
each. The dot-product heuristic fills one sequence at a time with the waiting example whose demands, as shares of the limits,
have the largest dot product with what is left of the sequence. Where no waiting example fits whole, the
largest is cut to the gap, so that sequences end full.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkit.llm.common import batch_of, byte_level_encoder, map_arrow
from starkit.session import stage

#: Examples that wait in a task; so many times the length of a sequence are its ids in memory.
POOL = 2048
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold; each at least 1."""

    tokens: int
    segments: int
    loss_tokens: int


@dataclass(frozen=True)
class Piece:
    """Ids of one document from ``start`` on; its first ``quiet`` ids bear no loss."""

    doc_id: int | None
    doc_tokens: int
    quiet: int
    start: int
    ids: bytes

    def __len__(self) -> int:
        return len(self.ids) // 4

    @property
    def loss(self) -> int:
        return min(len(self), max(0, self.start + len(self) - self.quiet))

    def fitting(self, tokens: float, loss_tokens: float) -> int:
        """The most ids from the front within these limits: those that bear loss come last."""
        return int(min(len(self), tokens, max(0, self.quiet - self.start) + loss_tokens))

    def split(self, at: int) -> tuple[Piece, Piece]:
        front = Piece(self.doc_id, self.doc_tokens, self.quiet, self.start, self.ids[: 4 * at])
        return front, Piece(self.doc_id, self.doc_tokens, self.quiet, self.start + at, self.ids[4 * at :])


class Pool:
    """Waiting examples of one task, each small enough for an empty sequence."""

    def __init__(self, limits: Limits, size: int = POOL):
        self.most = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
        self.demand = np.zeros((size + 1, 3))
        self.pieces: list[Piece | None] = [None] * (size + 1)
        self.free = list(range(size, -1, -1))

    def __len__(self) -> int:
        return len(self.pieces) - len(self.free)

    def add(self, piece: Piece) -> None:
        slot = self.free.pop()
        self.pieces[slot] = piece
        self.demand[slot] = len(piece), 1, piece.loss

    def take(self, slot: int) -> Piece:
        piece, self.pieces[slot] = self.pieces[slot], None
        self.demand[slot] = 0
        self.free.append(slot)
        return piece

    def sequence(self) -> list[Piece]:
        """The pieces of one sequence, taken from those that wait."""
        left, chosen = self.most.copy(), []
        while left.min() >= 1 and len(self):
            fits = (self.demand[:, 1] > 0) & (self.demand <= left).all(1)
            if fits.any():
                scores = (self.demand / self.most) @ (left / self.most)
                piece = self.take(int(np.argmax(np.where(fits, scores, -1))))
            else:
                piece = self.take(int(np.argmax(self.demand[:, 0])))
                piece, rest = piece.split(piece.fitting(left[0], left[2]))
                self.add(rest)
            left -= len(piece), 1, piece.loss
            chosen.append(piece)
        return chosen


#: Share of a sequence that may stay empty before it is cut into powers of two.
SPARE = 1 / 64


def in_powers(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """The same ids in sequences whose lengths are falling powers of two."""
    waiting = pieces[::-1]
    total = sum(map(len, pieces))
    for bit in range(total.bit_length() - 1, -1, -1):
        room, chosen = (1 << bit) * (total >> bit & 1), []
        while room:
            piece = waiting.pop()
            if len(piece) > room:
                piece, rest = piece.split(room)
                waiting.append(rest)
            chosen.append(piece)
            room -= len(piece)
        if chosen:
            yield chosen


def pack(docs: DataFrame, tokenizer: str, limits: Limits, end_id: int = 1, loss_column: str | None = None) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text) with their sequences.

    Ids of a text are followed by ``end_id``. ``loss_column`` names a column with the number of last
    tokens that bear loss (instruction data: the answer); without it all tokens do. Each id is in one piece.

    A task packs its own rows with a bounded pool, so nothing is shuffled. What is left at its end, and a sequence that another limit than that
    on tokens has closed, goes into sequences whose lengths are powers of two, which need no padding. The pieces are written once, so that
    a task that is run again cannot number them anew.

    Null text: the end id alone. Null doc_id and repeated rows: documents like others. Null loss: 0.
    Other columns are ignored. No rows: no pieces.
    """
    if min(limits.tokens, limits.segments, limits.loss_tokens) < 1:
        raise ValueError(f"limits must be at least 1: {limits}")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, pool = byte_level_encoder(tokenizer), Pool(limits)
        end = np.array([end_id], "<u4").tobytes()
        sequence_id = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []

        def emit(chosen: list[Piece]) -> None:
            nonlocal sequence_id
            offset = 0
            for piece in chosen:
                sums = zlib.crc32(piece.ids)
                rows.append((piece.doc_id, piece.start, len(piece), sums, piece.doc_tokens, sequence_id, offset))
                offset += len(piece)
            sequence_id += 1

        def close(chosen: list[Piece], last: bool = False) -> None:
            spare = limits.tokens - sum(map(len, chosen))
            for sequence in in_powers(chosen) if last or spare > limits.tokens * SPARE else [chosen]:
                emit(sequence)

        def written() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [[]] * 7
            names = [field.split()[0] for field in PIECES.split(", ")]
            rows.clear()
            return batch_of({name: (values, pa.int64()) for name, values in zip(names, columns)})

        for batch in batches:
            losses = batch.column("_loss").to_pylist()
            for doc_id, ids, loss in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text").to_pylist()), losses):
                tokens = len(ids) // 4 + 1
                quiet = 0 if loss is None else max(0, tokens - loss)
                piece = Piece(doc_id, tokens, quiet, 0, ids + end)
                while len(piece):
                    front, piece = piece.split(piece.fitting(limits.tokens, limits.loss_tokens))
                    if len(front) == limits.tokens:
                        emit([front])
                        continue
                    pool.add(front)
                    if len(pool) >= POOL:
                        close(pool.sequence())
            yield written()
        while len(pool):
            close(pool.sequence(), last=not len(pool))
        yield written()

    loss = F.lit(None).cast("long") if loss_column is None else F.coalesce(F.col(loss_column).cast("long"), F.lit(0))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", loss.alias("_loss"))
    return stage(map_arrow(rows, pieces, PIECES), "packed")

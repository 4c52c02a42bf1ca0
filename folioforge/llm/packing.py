"""Packing documents into sequences by bounded-space best fit.

Every task keeps a fixed number of open windows.  A document first fills whole windows; its
rest goes to the window it fits best, or, if none has room, the fullest window is topped up
with a cut of it and emitted, and what is left opens a window.  At a task's end its windows
are merged; at most one unfilled window per task remains, and those are merged in groups.
What a group cannot fill is cut into runs of a power of two, which need no padding.

A null text is an empty one: its piece is the end id alone.  Repeated rows and ids are packed
like any others; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, tokens

LENGTH = 2048
WINDOWS = 32
#: Unfilled windows merged by one task.
MERGE = 64
END_ID = 1
#: Bytes of text encoded at once; pieces are looked up once for all of them.
ENCODED_BYTES = 4 << 20

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, ids binary, part int"
)
COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

#: doc_id, start, ids, doc_tokens
Piece = tuple[int | None, int, np.ndarray, int]


class Packer:
    """The open windows of one task."""

    def __init__(self, length: int, windows: int) -> None:
        self.length, self.windows = length, windows
        self.room: list[int] = []
        self.held: list[list[Piece]] = []

    def _close(self, i: int) -> list[Piece]:
        self.room.pop(i)
        return self.held.pop(i)

    def _open(self, piece: Piece) -> None:
        self.room.append(self.length - len(piece[2]))
        self.held.append([piece])

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        """Place the piece; gives the sequences that this fills."""
        while len(piece[2]) >= self.length:
            head, piece = cut(piece, self.length)
            yield [head]
        n = len(piece[2])
        if not n:
            return
        fits = [(room, i) for i, room in enumerate(self.room) if room >= n]
        if fits:
            room, i = min(fits)
            self.held[i].append(piece)
            self.room[i] = room - n
            if room == n:
                yield self._close(i)
        elif len(self.room) < self.windows:
            self._open(piece)
        else:
            i = min(range(len(self.room)), key=self.room.__getitem__)
            head, rest = cut(piece, self.room[i])
            full = self._close(i)
            yield [*full, head]
            self._open(rest)

    def merge(self) -> tuple[list[list[Piece]], list[Piece]]:
        """All open windows as full sequences and one that is not full."""
        loose = [p for _, pieces in sorted(zip(self.room, self.held), key=lambda x: x[0])
                 for p in pieces]
        self.room, self.held = [], []
        return refill(loose, self.length)


def cut(piece: Piece, n: int) -> tuple[Piece, Piece]:
    doc, start, ids, total = piece
    return (doc, start, ids[:n], total), (doc, start + n, ids[n:], total)


def refill(pieces: list[Piece], length: int) -> tuple[list[list[Piece]], list[Piece]]:
    """The pieces one after the other in sequences of ``length``, and the rest."""
    full: list[list[Piece]] = []
    now: list[Piece] = []
    room = length
    for piece in pieces:
        while len(piece[2]):
            head, piece = cut(piece, room)
            now.append(head)
            room -= len(head[2])
            if not room:
                full.append(now)
                now, room = [], length
    return full, now


def powers_of_two(pieces: list[Piece]) -> list[list[Piece]]:
    """The pieces in sequences whose lengths are powers of two."""
    left = sum(len(p[2]) for p in pieces)
    found = []
    while left:
        size = 1 << (left.bit_length() - 1)
        full, rest = refill(pieces, size)
        found.append(full[0])
        pieces, left = [p for seq in full[1:] for p in seq] + rest, left - size
    return found


def rows(
    sequences: list[tuple[int, list[Piece]]], part: int, with_ids: bool
) -> dict[str, list]:
    out: dict[str, list] = {name: [] for name in [*COLUMNS, "ids", "part"]}
    for number, pieces in sequences:
        offset = 0
        for doc, start, ids, total in pieces:
            raw = ids.tobytes()
            values = (doc, start, len(ids), zlib.crc32(raw), total, number, offset,
                      raw if with_ids else None, part)
            for name, value in zip(out, values):
                out[name].append(value)
            offset += len(ids)
    return out


TYPES = pa.schema(
    [(name, pa.int64()) for name in COLUMNS] + [("ids", pa.binary()), ("part", pa.int32())]
)


def pack(
    docs: DataFrame,
    vocabulary: str | None = None,
    end_id: int = END_ID,
    length: int = LENGTH,
    windows: int = WINDOWS,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence.

    Sequences of one task are numbered from (task << 32); those merged afterwards have bit 62
    set.  ``keep_ids`` adds the ids of each piece.
    """
    spark = docs.sparkSession
    common.python_batches(spark, common.SMALL_BATCH_BYTES)
    shared = tokens.share_vocabulary(spark, vocabulary)
    end = np.array([end_id], "<u4")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker, packer = tokens.encoder(shared), Packer(length, windows)
        part = TaskContext.get().partitionId()
        number = part << 32
        for batch in common.gathered(batches, ENCODED_BYTES):
            done: list[tuple[int, list[Piece]]] = []
            names = common.column(batch, "doc_id").cast(pa.int64()).to_pylist()
            for doc, ids in zip(names, worker.encode(common.texts(batch))):
                ids = np.concatenate([ids, end])
                for sequence in packer.add((doc, 0, ids, len(ids))):
                    done.append((number, sequence))
                    number += 1
            yield pa.RecordBatch.from_pydict(rows(done, part, keep_ids), TYPES)
        full, rest = packer.merge()
        last = [(number + i, sequence) for i, sequence in enumerate(full)]
        yield pa.RecordBatch.from_pydict(rows(last, part, keep_ids), TYPES)
        # Not full: carried with its ids to the merging step, marked by a null number.
        yield pa.RecordBatch.from_pydict(rows([(None, rest)], part, True), TYPES)

    def merge(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by([("part", "ascending"), ("offset", "ascending")])
        loose = [
            (row["doc_id"], row["start"], np.frombuffer(row["ids"], "<u4"), row["doc_tokens"])
            for row in group.select(["doc_id", "start", "ids", "doc_tokens"]).to_pylist()
        ]
        full, rest = refill(loose, length)
        base = (1 << 62) | (key[0].as_py() << 32)
        done = [(base + i, seq) for i, seq in enumerate([*full, *powers_of_two(rest)])]
        return pa.Table.from_pydict(rows(done, -1, keep_ids), TYPES)

    placed = common.materialize(common.documents(docs).mapInArrow(fill, PIECES), "packed")
    unfilled = placed.where(F.col("sequence_id").isNull())
    merged = unfilled.groupBy(F.expr(f"part div {MERGE}")).applyInArrow(merge, PIECES)
    wanted = [*COLUMNS, *(["ids"] if keep_ids else [])]
    return placed.where(F.col("sequence_id").isNotNull()).select(wanted).union(
        merged.select(wanted))

"""Best-fit decreasing packing of token sequences.

Documents are encoded, ended with a token, cut where they exceed a sequence, and
packed: the longest pieces first, each into the open sequence with the least room
that still holds it, or a new one.

Which piece goes where depends on lengths alone, and pieces of one length are
alike, as are sequences with the same room. So the packing is worked out once on
how many pieces there are of each length, at most one count a length: a segment
tree over the remaining room finds the tightest open sequences in logarithmic
time, and takes runs of them at once. The outcome is a list of moves, each saying
into which sequences a run of equally long pieces goes. Every piece then finds
its move by its number among the pieces of its length. Neither the counts nor the
moves grow with the documents, and the result is that of packing the whole table
piece by piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.llm.chunk_encoding import ID, _encoder
from tillhouse.llm.columns import map_batches, sliced
from tillhouse.llm.vocabulary import read_file
from tillhouse.staging import Staging

CAPACITY = 4096
END = 1
FIELDS = ("length", "first", "pieces", "sequence", "each", "offset")


class TightestRoom:
    """A segment tree over 0..`capacity`: which amounts of room some open sequence has."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.filled = bytearray(2 * self.leaves)

    def set(self, room: int, open_: bool) -> None:
        at = self.leaves + room
        self.filled[at] = open_
        while at > 1:
            at //= 2
            self.filled[at] = self.filled[2 * at] | self.filled[2 * at + 1]

    def at_least(self, room: int) -> int | None:
        """The least amount of room that is open and not below `room`."""
        at = self.leaves + room
        if self.filled[at]:
            return room
        while at > 1 and (at % 2 or not self.filled[at + 1]):
            at //= 2
        if at <= 1:
            return None
        at += 1
        while at < self.leaves:
            at = 2 * at if self.filled[2 * at] else 2 * at + 1
        return at - self.leaves


@dataclass(frozen=True)
class Packing:
    """Moves in order of length and first number, one array a field, and the number of sequences."""

    moves: dict[str, np.ndarray]
    sequences: int

    def place(self, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces, given by length and number among the pieces of that length."""
        move = self.moves
        wide = np.int64(1 << 48)
        found = np.searchsorted(move["length"] * wide + move["first"], lengths * wide + numbers, side="right") - 1
        nth = numbers - move["first"][found]
        return (
            move["sequence"][found] + nth // move["each"][found],
            move["offset"][found] + nth % move["each"][found] * lengths,
        )


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Packing:
    """Best-fit decreasing over `counts` of pieces by length, from 1 to `capacity`.

    Runs of sequences with equal room are used from the last one opened. A
    length leaves at most two runs more than it found, and each move of a run takes
    up a length not yet in its sequences, so there are at most about `capacity` to
    the power of 1.5 moves however many pieces there are.
    """
    rooms: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    tree = TightestRoom(capacity)
    moves: list[tuple[int, ...]] = []
    opened = 0

    def leave(room: int, first: int, run: int) -> None:
        rooms[room].append((first, run))
        if len(rooms[room]) == 1:
            tree.set(room, True)

    for length in sorted(counts, reverse=True):
        left, number = counts[length], 0
        if not 1 <= length <= capacity:
            raise ValueError(f"a piece of {length} does not go into {capacity}")
        while left:
            room = tree.at_least(length)
            if room is None:
                each = capacity // length
                first, run = opened, -(-left // each)
                room, opened = capacity, opened + run
            else:
                first, run = rooms[room].pop()
                if not rooms[room]:
                    tree.set(room, False)
            each = room // length
            whole = min(run, left // each)
            offset = capacity - room
            if whole:
                moves.append((length, number, whole * each, first, each, offset))
                number, left = number + whole * each, left - whole * each
                leave(room - each * length, first, whole)
                first, run = first + whole, run - whole
            if run and left:
                moves.append((length, number, left, first, left, offset))
                leave(room - left * length, first, 1)
                first, run, left = first + 1, run - 1, 0
            if run:
                leave(room, first, run)
    moves.sort()
    table = np.array(moves, np.int64).reshape(-1, len(FIELDS))
    return Packing({name: table[:, k].copy() for k, name in enumerate(FIELDS)}, opened)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, part int, nth long"


def cut_pieces(docs: DataFrame, path: str, capacity: int, keep_ids: bool) -> DataFrame:
    """The pieces of every row, numbered within each task among those of equal length."""
    source = docs.sparkSession.sparkContext.broadcast(read_file(path))
    end = np.array([END], ID).tobytes()
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("piece", pa.int32()),
            ("start", pa.int64()),
            ("length", pa.int64()),
            ("ids_crc32", pa.int64()),
            ("ids", pa.binary()),
            ("part", pa.int32()),
            ("nth", pa.int64()),
        ]
    )
    width = capacity * ID.itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(source.value)
        part = TaskContext.get().partitionId()
        met = [0] * (capacity + 1)
        for batch in sliced(batches):
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = encoder.encode(text.as_py() or "") + end
                for piece, at in enumerate(range(0, len(ids), width)):
                    held = ids[at : at + width]
                    length = len(held) // ID.itemsize
                    kept = held if keep_ids else None
                    rows.append((doc_id, piece, at // ID.itemsize, length, zlib.crc32(held), kept, part, met[length]))
                    met[length] += 1
            columns = zip(*rows, strict=True) if rows else [()] * len(schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, field.type) for column, field in zip(columns, schema, strict=True)], schema=schema
            )
        encoder.known.rest()

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(run, PIECES)


def pack_documents(
    docs: DataFrame, staging: Staging, path: str, capacity: int = CAPACITY, keep_ids: bool = True
) -> DataFrame:
    """One row per piece of every row of `docs`: where it comes from and where it goes.

    `doc_id`, `piece` from 0, `start` (ids of its document before it), `length`,
    `ids_crc32`, `sequence_id` and `offset` (its place there, without gaps from 0), and
    with `keep_ids` its `ids`, four bytes each; see `sequences`. A document is its
    token ids and `END`; one longer than `capacity` is cut into full pieces and a
    rest, any other stays whole. Null and empty texts are `END` alone. Repeated rows
    are packed each for itself, and rows without an id as well. Pieces of one
    length are alike, so which of them goes where is free. Very long texts give many
    pieces. Other columns are not read. An empty table gives no rows.
    """
    pieces = staging.save(cut_pieces(docs, path, capacity, keep_ids), "pieces")
    by_part = staging.save(pieces.groupBy("length", "part").agg(F.count("*").alias("pieces")), "lengths")
    # At most one row for each length.
    counted = by_part.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect()
    packing = plan({row.length: row.pieces for row in counted}, capacity)
    shared = docs.sparkSession.sparkContext.broadcast(packing)

    before = F.sum("pieces").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = by_part.select("length", "part", F.coalesce(before, F.lit(0)).alias("before"))
    told = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    numbered = pieces.join(starts, ["length", "part"]).select(*told, (F.col("before") + F.col("nth")).alias("number"))

    def make():
        def place(batch: pa.RecordBatch) -> dict:
            lengths = batch.column("length").to_numpy()
            sequence, offset = shared.value.place(lengths, batch.column("number").to_numpy())
            placed = {"sequence_id": pa.array(sequence), "offset": pa.array(offset)}
            return {name: batch.column(name) for name in told} | placed

        return place

    kept = ", ids binary" if keep_ids else ""
    schema = f"doc_id long, piece int, start long, length long, ids_crc32 long{kept}, sequence_id long, offset long"
    return map_batches(numbered, make, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: `sequence_id`, `n_tokens`, `ids` and the `doc_ids` of its pieces in order.

    A sequence holds at most its capacity, so no group is larger than that.
    """
    pieces = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    joined = F.aggregate("pieces", F.lit(b""), lambda ids, piece: F.concat(ids, piece["ids"]))
    return (
        packed.groupBy("sequence_id")
        .agg(pieces.alias("pieces"))
        .select(
            "sequence_id",
            F.aggregate("pieces", F.lit(0).cast("long"), lambda n, piece: n + piece["length"]).alias("n_tokens"),
            joined.alias("ids"),
            F.col("pieces.doc_id").alias("doc_ids"),
        )
    )

"""Best-fit packing of tokenized documents into sequences of a fixed capacity.

A document's ids end with a separator. One that is longer than the capacity is
cut from its end into pieces of the full capacity; its first piece is what is
left over. Pieces are packed best fit, longest first:

- in a task, block by block of bounded size; a bin that is nearly full is
  final, an underfull one is packed again with the next block, as one item;
- the underfull bins of all tasks are merged over a tree of ever fewer tasks,
  again as items, until one task holds all that can still be merged.

Two bins of one best-fit run never fit together, so each run leaves one bin at
most that is half full or less, and only with such a bin can any other merge. Up
the tree go these small bins, and of the others that have room for the smallest
of them as many as there are small ones, those with the most room: more could
not be used. What stays behind is final. So a round leaves a small bin for each
of its tasks at most, a task gets about `merge_bins` bins, and the number of
tasks falls with each round until it is one, whatever the size of the table.

Only these bins are shuffled. Every round is written to the shared folder.

Defined results: a null text is an empty one and gives its separator alone;
repeated rows are packed one by one; a null id stays null; an empty table gives
no sequences. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinestar.llm.frames import staged
from cinestar.llm.vocabularies import byte_level_ids


@dataclass(frozen=True)
class Packing:
    """Ids in a sequence; separator id; free ids in a final bin; ids in a block, bins in a merge."""

    capacity: int = 2048
    separator: int = 0
    slack: int = 2
    block_ids: int = 4_000_000
    merge_bins: int = 10_000


class _Item:
    """A piece, or an underfull bin of several: its segments and their ids."""

    __slots__ = ("segments", "ids", "length")

    def __init__(self, segments: list, ids: list, length: int) -> None:
        self.segments, self.ids, self.length = segments, ids, length


def best_fit(items: list[_Item], capacity: int) -> list[_Item]:
    """Bins for the items, longest first, each into the fullest bin that has room."""
    bins: list[_Item] = []
    by_room: list[list[_Item]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if a bin with room r is there
    for item in sorted(items, key=lambda i: -i.length):
        fitting = rooms >> item.length
        if fitting:
            room = item.length + (fitting & -fitting).bit_length() - 1
            found = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            found.segments += item.segments
            found.ids += item.ids
            found.length += item.length
        else:
            found, room = item, capacity
            bins.append(found)
        room = capacity - found.length
        by_room[room].append(found)
        rooms |= 1 << room
    return bins


def cut(ids: bytes, capacity: int) -> Iterator[tuple[int, int, bytes]]:
    """(piece, start, ids) of a document; ids are 4 bytes each."""
    length = len(ids) // 4
    end = length if length <= capacity else (length - 1) % capacity + 1
    start = piece = 0
    while start < length:
        yield piece, start, ids[4 * start : 4 * end]
        start, end, piece = end, end + capacity, piece + 1


_SEGMENT = pa.struct(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("offset", pa.int64()),
    ]
)
_SCHEMA = (
    "length int, final boolean, ids binary, segments array<struct<doc_id:bigint,piece:int,"
    "start:bigint,length:bigint,offset:bigint>>"
)


def _rows(bins: list[_Item], final: list[bool]) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(bins), 1000):
        some = bins[k : k + 1000]
        segments = []
        for each in some:
            offset, row = 0, []
            for doc_id, piece, start, length in each.segments:
                row.append((doc_id, piece, start, length, offset))
                offset += length
            segments.append(row)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([b.length for b in some], pa.int32()),
                pa.array(final[k : k + 1000], pa.bool_()),
                pa.array([b"".join(b.ids) for b in some], pa.binary()),
                pa.array(
                    [[dict(zip(_SEGMENT.names, s, strict=True)) for s in row] for row in segments],
                    pa.list_(_SEGMENT),
                ),
            ],
            ["length", "final", "ids", "segments"],
        )


class _Packer:
    """Packs what it is given block by block; the underfull bins of a block go on to the next."""

    def __init__(self, settings: Packing) -> None:
        self.settings, self.items, self.size = settings, [], 0

    def add(self, item: _Item) -> Iterator[pa.RecordBatch]:
        self.items.append(item)
        self.size += item.length
        if self.size >= self.settings.block_ids:
            yield from self.pack(last=False)

    def pack(self, last: bool) -> Iterator[pa.RecordBatch]:
        bins = best_fit(self.items, self.settings.capacity)
        enough = self.settings.capacity - self.settings.slack
        full = [b for b in bins if b.length >= enough]
        rest = [b for b in bins if b.length < enough]
        # What half a block of underfull bins could not use now is left to the tree.
        if last or sum(b.length for b in rest) > self.settings.block_ids // 2:
            yield from _rows(rest, [False] * len(rest))
            rest = []
        yield from _rows(full, [True] * len(full))
        self.items, self.size = rest, sum(b.length for b in rest)


def pack_locally(documents: DataFrame, settings: Packing) -> DataFrame:
    """Tokenize and pack the rows (doc_id, text) of each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, packer = byte_level_ids(), _Packer(settings)
        separator = np.array([settings.separator], dtype="<u4").tobytes()
        for batch in batches:
            ids_of = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids_of, batch.column("text"), strict=True):
                ids = tokenizer.ids(text.as_py() or "") + separator
                for piece, start, part in cut(ids, settings.capacity):
                    segment = (doc_id, piece, start, len(part) // 4)
                    yield from packer.add(_Item([segment], [part], len(part) // 4))
        yield from packer.pack(last=True)

    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, _SCHEMA)


def _merge(bins: DataFrame, settings: Packing, final: bool) -> DataFrame:
    """Pack underfull bins again, as items; in the last round every bin is final."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = []
        for batch in batches:
            for row in batch.to_pylist():
                segments = [
                    (s["doc_id"], s["piece"], s["start"], s["length"]) for s in row["segments"]
                ]
                items.append(_Item(segments, [row["ids"]], row["length"]))
        # The order in which a shuffle delivers rows must not matter.
        items.sort(key=lambda i: (i.length, repr(i.segments[0])))
        packed = best_fit(items, settings.capacity)
        enough = settings.capacity - settings.slack
        yield from _rows(packed, [final or b.length >= enough for b in packed])

    return bins.mapInArrow(run, _SCHEMA)


def _mergeable(underfull: DataFrame, capacity: int) -> tuple[int, int]:
    """(longest, bins): the bins of up to that length go up the tree, and so many they are.

    One row for each length, so `capacity` rows at most, comes to the driver.
    """
    counts = {r["length"]: r["count"] for r in underfull.groupBy("length").count().collect()}
    small = {length: n for length, n in counts.items() if length <= capacity // 2}
    if not small:
        return 0, 0
    longest, bins, wanted = capacity // 2, sum(small.values()), sum(small.values())
    for length in sorted(counts.keys() - small.keys()):
        if wanted <= 0 or length > capacity - min(small):
            break
        longest, bins, wanted = length, bins + counts[length], wanted - counts[length]
    return (longest, bins) if bins > 1 else (0, 0)


def pack(
    documents: DataFrame, settings: Packing = Packing(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Sequences: (sequence_id, length, ids, segments).

    `ids` are little-endian unsigned 32-bit integers, without padding;
    `segments` tell which piece of which document lies at which offset.
    """
    rows = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    current = staged(pack_locally(rows, settings), "bins")
    done, tasks = [], None
    while True:
        underfull = current.where("not final")
        longest, bins = _mergeable(underfull, settings.capacity)
        # What goes up is few; the rest is read once, in one scan of its round.
        done.append(current.where(F.col("final") | (F.col("length") > longest)) if bins else current)
        if not bins:
            break
        going = underfull.where(F.col("length") <= longest)
        parts = max(1, -(-bins // settings.merge_bins))
        # Fewer tasks in each round, also where many bins of one length go up together.
        parts = parts if tasks is None else min(parts, max(1, tasks // 2))
        current, tasks = staged(_merge(going.repartition(parts), settings, parts == 1), "bins"), parts
        if parts == 1:
            done.append(current)
            break
    done = reduce(DataFrame.union, done)
    return done.select(
        F.monotonically_increasing_id().alias("sequence_id"), "length", "ids", "segments"
    )


def placed_pieces(sequences: DataFrame) -> DataFrame:
    """One row per piece with its place and the checksum of its ids."""
    rows = sequences.select("sequence_id", "ids", F.explode("segments").alias("s"))
    first, size = (4 * F.col("s.offset") + 1).cast("int"), (4 * F.col("s.length")).cast("int")
    return rows.select(
        "s.doc_id",
        "s.piece",
        "s.start",
        "s.length",
        F.crc32(F.substring("ids", first, size)).alias("ids_crc32"),
        "sequence_id",
        "s.offset",
    )

"""Best-fit-decreasing packing of token pieces into sequences of a fixed capacity.

Texts are encoded where they are read; only piece lengths move. Pieces are dealt evenly over packing groups of a
bounded size, and each group is packed by best fit decreasing: pieces from long to short, each into the open
sequence with the least room that still holds it. A segment tree over remaining capacities finds that
sequence in a number of steps logarithmic in the capacity. A group of that size leaves at most a handful of
sequences partly filled, so the number of sequences follows the sum of lengths at any scale.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch
from .tokens import default_path, encoder, text_batches

CAPACITY = 2048
# Pieces of one packing group; about 100 bytes each in the packing task.
GROUP = 200_000
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = _PIECES + ", sequence_id long, offset long"


class OpenBins:
    """Open bins by remaining capacity; ``take`` finds the tightest that holds a length."""

    def __init__(self, capacity: int):
        self.leaves = 1
        while self.leaves <= capacity:
            self.leaves *= 2
        self.tree = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, bin_: int) -> None:
        if not self.bins[room]:
            self._mark(room, 1)
        self.bins[room].append(bin_)

    def take(self, length: int) -> tuple[int, int] | None:
        """Remove and return ``(bin, room)`` with the least room of at least ``length``."""
        i, tree = length + self.leaves, self.tree
        while not tree[i]:
            while i & 1:  # a right child: nothing further right below this parent
                i >>= 1
            if i == 0:
                return None
            i += 1
        while i < self.leaves:
            i = 2 * i if tree[2 * i] else 2 * i + 1
        room = i - self.leaves
        found = self.bins[room].pop()
        if not self.bins[room]:
            self._mark(room, 0)
        return found, room

    def _mark(self, room: int, value: int) -> None:
        i, tree = room + self.leaves, self.tree
        tree[i] = value
        while i > 1:
            i >>= 1
            tree[i] = tree[2 * i] | tree[2 * i + 1]


def best_fit_decreasing(lengths: list[int], capacity: int = CAPACITY) -> tuple[list[int], list[int]]:
    """Bin and offset of each length, which must come in decreasing order."""
    bins, offsets, rooms, made = [], [], OpenBins(capacity), 0
    for n in lengths:
        found = rooms.take(n)
        if found is None:
            found = made, capacity
            made += 1
        bin_, room = found
        bins.append(bin_)
        offsets.append(capacity - room)
        if room > n:
            rooms.add(room - n, bin_)
    return bins, offsets


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of a document of ``n`` ids: full ones behind a first that may be shorter."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(
    docs: DataFrame, tokenizer: str | None = None, end_id: int = 0, capacity: int = CAPACITY, keep_ids: bool = False
) -> DataFrame:
    """One row per piece of every document: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``.

    A null text counts as empty; an empty one is the end id alone. Rows that repeat stay separate documents, a null
    doc_id stays null, other columns are ignored. ``ids`` are packed little-endian unsigned 32-bit integers.
    """
    path = tokenizer or default_path()

    def run(batches) -> Iterator:
        import pyarrow as pa

        encode, end = encoder(path).encode, end_id.to_bytes(4, "little")
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * keep_ids
        names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
        for whole in batches:
            for batch in text_batches(whole):
                rows: list[list] = [[] for _ in names]
                texts = [t or "" for t in batch.column(1).to_pylist()]
                for doc_id, ids in zip(batch.column(0).to_pylist(), encode(texts)):
                    ids += end
                    for k, (start, length) in enumerate(cut_points(len(ids) // 4, capacity)):
                        part = ids[4 * start : 4 * (start + length)]
                        for column, value in zip(rows, (doc_id, k, start, length, zlib.crc32(part), part)):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names=names)

    schema = _PIECES + ", ids binary" * keep_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def pack(parts: DataFrame, scratch: Scratch, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces. An empty table stays empty.

    The dealing is by row count, not by key, so no document, source or length can fill a group.
    """
    saved = scratch.save(parts.select(*[c.split()[0] for c in _PIECES.split(", ")]), "pieces")
    groups = -(-max(1, saved.count()) // group)

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        got = list(batches)
        if not sum(b.num_rows for b in got):
            return
        part = pa.Table.from_batches(got)
        length, *rest = (part[c].to_numpy().astype(np.int64) for c in ("length", "piece", "ids_crc32", "start"))
        order = np.lexsort([*rest, part["doc_id"].fill_null(-1).to_numpy(), -length])
        bins, offsets = best_fit_decreasing(length[order].tolist(), capacity)
        part = part.take(order)
        part = part.append_column("sequence_id", pa.array(np.array(bins, np.int64) + (TaskContext.get().partitionId() << 40)))
        yield from part.append_column("offset", pa.array(offsets, pa.int64())).combine_chunks().to_batches(100_000)

    return saved.repartition(groups).mapInArrow(run, _PACKED)


def sequences(packed: DataFrame, parts: DataFrame) -> DataFrame:
    """The sequences themselves: ``sequence_id, ids`` from packed rows and pieces that keep their ids."""
    keys = ["doc_id", "piece", "start"]
    right = parts.select(*[F.col(k).alias("_" + k) for k in keys], "ids")
    on = [F.col(k).eqNullSafe(F.col("_" + k)) for k in keys]
    slots = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = packed.join(right, on).groupBy("sequence_id").agg(slots.alias("slots"))
    return joined.select("sequence_id", F.expr("aggregate(slots, X'', (a, s) -> concat(a, s.ids))").alias("ids"))

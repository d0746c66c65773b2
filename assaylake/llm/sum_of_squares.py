"""Online packing of documents into windows by the sum of squares.

Documents come one after the other and are placed at once. Partially filled windows
are known by their fill level only; a level array has their number at each level. A
document of length s goes to the level h that makes the sum of the squared numbers,
over all levels of partially filled windows, least when one window moves from h to
h + s; h = 0 is a new window. So no level gathers many windows, and what comes
next finds windows of many levels. Taking a window from level h changes the sum by
1 - 2 N(h), adding one to level t by 2 N(t) + 1, or by 0 if t is full: two arrays,
of which two entries change with each document.

Each task packs the documents of its input split, so nothing is shuffled, and a lost
task is run again with the same result. A task has at most ``MOST_OPEN`` windows
open; at that number and at its end they are settled: what the levels have left
partially filled is joined and cut anew into full windows, and the rest into windows of
powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.llm.common import batch_of, texts_of
from assaylake.llm.packing import END_ID
from assaylake.llm.tokens import document_ids

CAPACITY = 1024
#: Partially filled windows of a task; their ids, of 4 bytes each, are in memory.
MOST_OPEN = 4096

_PLACED = pa.schema([
    (name, pa.int64())
    for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
])
_NEVER = np.int64(1) << 60


class Piece(NamedTuple):
    """Consecutive ids of a document, as little-endian bytes."""

    doc_id: int | None
    start: int
    ids: bytes
    doc_tokens: int

    @property
    def length(self) -> int:
        return len(self.ids) // 4

    def part(self, first: int, last: int) -> Piece:
        return self._replace(start=self.start + first, ids=self.ids[4 * first : 4 * last])


Window = list[Piece]


class Levels:
    """The level array: the number of windows at each fill level, and what a move costs."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.n = np.zeros(capacity + 1, np.int64)
        self.leave = np.full(capacity + 1, _NEVER)
        self.arrive = np.ones(capacity + 1, np.int64)
        self.leave[0] = self.arrive[capacity] = 0

    def best(self, size: int) -> int:
        """The level that ``size`` is added to; of equal ones the fullest."""
        change = self.arrive[size:] + self.leave[: self.capacity + 1 - size]
        return len(change) - 1 - int(np.argmin(change[::-1]))

    def add(self, level: int, by: int) -> None:
        if 0 < level < self.capacity:
            n = self.n[level] = self.n[level] + by
            self.leave[level] = 1 - 2 * n if n else _NEVER
            self.arrive[level] = 2 * n + 1


def settle_open(windows: list[Window], capacity: int) -> list[Window]:
    """Windows without padding that hold the same pieces, cut where it must be.

    A window whose fill is a power of two stays. The others, the fullest first, are
    one run of ids, cut into full windows and, at its end, into powers of two.
    """
    fill = [sum(p.length for p in w) for w in windows]
    done = [w for w, n in zip(windows, fill, strict=True) if n & (n - 1) == 0]
    rest = [w for _, w in sorted(((-n, k) for k, n in enumerate(fill) if n & (n - 1)))]
    total = sum(fill[k] for k in rest)
    sizes = [capacity] * (total // capacity)
    sizes += [1 << b for b in reversed(range(capacity.bit_length())) if total % capacity >> b & 1]
    run = (piece for k in rest for piece in windows[k])
    piece, at = None, 0
    for size in sizes:
        window: Window = []
        while size:
            if piece is None or at == piece.length:
                piece, at = next(run), 0
            take = min(size, piece.length - at)
            window.append(piece.part(at, at + take))
            at, size = at + take, size - take
        done.append(window)
    return done


class Packer:
    """Takes documents one by one; gives windows as they are done."""

    def __init__(self, capacity: int = CAPACITY, most_open: int = MOST_OPEN):
        if capacity & (capacity - 1):
            raise ValueError("the capacity must be a power of two")
        self.capacity, self.most_open = capacity, most_open
        self.levels = Levels(capacity)
        self.windows: dict[int, list[Window]] = {}
        self.open = 0

    def add(self, piece: Piece) -> Iterator[Window]:
        """Place a document; what is longer than a window fills windows of its own first."""
        whole = piece.length // self.capacity * self.capacity
        for at in range(0, whole, self.capacity):
            yield [piece.part(at, at + self.capacity)]
        if whole < piece.length:
            yield from self._place(piece.part(whole, piece.length))

    def _place(self, piece: Piece) -> Iterator[Window]:
        level = self.levels.best(piece.length)
        if level:
            window = self.windows[level].pop()
            self.levels.add(level, -1)
        else:
            window = []
            self.open += 1
        window.append(piece)
        level += piece.length
        if level == self.capacity:
            self.open -= 1
            yield window
            return
        self.windows.setdefault(level, []).append(window)
        self.levels.add(level, 1)
        if self.open > self.most_open:
            yield from self.finish()

    def finish(self) -> Iterator[Window]:
        """Settle all open windows."""
        left = [w for level in sorted(self.windows) for w in self.windows[level]]
        self.windows, self.open, self.levels = {}, 0, Levels(self.capacity)
        yield from settle_open(left, self.capacity)


def pack_online(
    docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, most_open: int = MOST_OPEN
) -> DataFrame:
    """One row for each piece: its place in its document and in its window.

    Columns ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``;
    ``capacity`` is a power of two. Windows are full, or their fill is a power of
    two. Documents up to ``capacity`` stay whole but for those in windows that are
    settled; longer ones fill windows of their own, and only the rest is placed.
    A window's number tells the partition that packed it, so the same partitions
    of the same rows give the same numbers. ``packing.sequences`` gives the ids.

    No document is dropped: a null or empty text is its end id; a null ``doc_id``
    stays; repeated rows are packed each time. Other columns are not read. An empty
    table gives no rows.
    """

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        packer = Packer(capacity, most_open)

        def rows(windows: Iterable[Window]) -> list[tuple]:
            nonlocal number
            out = []
            for window in windows:
                offset = 0
                for p in window:
                    out.append((p.doc_id, p.start, p.length, zlib.crc32(p.ids), p.doc_tokens, number, offset))
                    offset += p.length
                number += 1
            return out

        def batch(found: list[tuple]) -> pa.RecordBatch:
            return batch_of(_PLACED, list(zip(*found, strict=True)) if found else [[]] * len(_PLACED))

        for given in batches:
            found = []
            for doc_id, text in zip(given.column(0).to_pylist(), texts_of(given.column(1)), strict=True):
                ids = document_ids(text, vocabulary)
                ids.append(END_ID)
                found += rows(packer.add(Piece(doc_id, 0, ids.tobytes(), len(ids))))
            yield batch(found)
        yield batch(rows(packer.finish()))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        place, ", ".join(f"{name} long" for name in _PLACED.names)
    )


def padding(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sequences, tokens, padding``: a window whose fill is no power of two is padded to ``capacity``."""
    fill = packed.groupBy("sequence_id").agg(F.sum("length").alias("fill"))
    free = F.col("fill").bitwiseAND(F.col("fill") - 1) == 0
    return fill.agg(
        F.count(F.lit(1)).alias("sequences"),
        F.coalesce(F.sum("fill"), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum(F.when(free, 0).otherwise(capacity - F.col("fill"))), F.lit(0)).alias("padding"),
    )

"""Best-fit packing of documents into sequences, after dominance reduction.

Only a piece's length matters to the packing, and there are at most ``capacity``
lengths. So the documents are encoded once into pieces (written out, numbers only),
and the bin-packing instance is the histogram of lengths: at most 2048 counts, which
the driver may hold whatever the number of documents. On it:

1. Dominance reduction (Martello and Toth): for the largest open length find a set
   of at most three pieces, itself included, that every solution can be turned to
   use without another sequence; fix it, for as many sequences at once as the
   counts allow, shrink the instance, and go on until nothing more is fixed.
2. Best fit, longest first, for what remains: each piece goes to the fullest
   sequence that has room; equal sequences are filled together.

The result is a list of runs, "the next n pieces of length s go to sequences f, f+1,
..., k to each, from offset o". Pieces are ranked within their length by many tasks
and find their run by binary search.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.llm.common import batch_of, texts_of, with_rank
from assaylake.llm.tokens import document_ids
from assaylake.session import settled

CAPACITY = 2048
#: The id that ends every document.
END_ID = 0

_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
    ("length", pa.int64()), ("ids_crc32", pa.int64()),
])
_PIECES_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Run(NamedTuple):
    """``n`` pieces of one size, by rank from ``rank``, ``each`` to a sequence."""

    size: int
    rank: int
    n: int
    each: int
    sequence: int
    offset: int


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids; only the first may be short."""
    first = (n - 1) % capacity + 1
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """Every document's ids and ``END_ID``, cut into pieces of at most ``capacity``.

    A null text is an empty one, whose only id is the end. A null ``doc_id`` stays.
    """

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                ids = document_ids(text, vocabulary)
                ids.append(END_ID)
                raw = memoryview(ids.tobytes())
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    crc = zlib.crc32(raw[4 * start : 4 * (start + length)])
                    rows.append((doc_id, k, start, length, crc))
            yield batch_of(_PIECES, list(zip(*rows, strict=True)) if rows else [[]] * 5)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        encode, _PIECES_DDL
    )


class _Counts:
    """Counts by size, with neighbours by size."""

    def __init__(self, counts: dict[int, int]):
        self.n = {s: int(c) for s, c in counts.items() if c > 0}
        self.sizes = sorted(self.n)

    def take(self, size: int, n: int) -> None:
        self.n[size] -= n
        if not self.n[size]:
            del self.n[size]
            del self.sizes[bisect_left(self.sizes, size)]

    def give(self, size: int, n: int) -> None:
        if size not in self.n:
            insort(self.sizes, size)
        self.n[size] = self.n.get(size, 0) + n

    def smallest(self, n: int) -> list[int]:
        out: list[int] = []
        for s in self.sizes:
            out += [s] * min(self.n[s], n - len(out))
            if len(out) == n:
                break
        return out

    def largest_upto(self, most: int) -> int:
        """0 if there is none."""
        at = bisect_right(self.sizes, most)
        return self.sizes[at - 1] if at else 0

    def best_pair(self, most: int) -> tuple[int, int]:
        """Two items, the larger first, of the largest sum up to ``most``; (0, 0) if none."""
        best, low = (0, 0), 0
        high = bisect_right(self.sizes, most) - 1
        while 0 <= low <= high:
            p, q = self.sizes[high], self.sizes[low]
            if p + q > most:
                high -= 1
                continue
            if (low < high or self.n[p] > 1) and p + q > sum(best):
                best = (p, q)
            low += 1
        return best


def _dominating(counts: _Counts, size: int, capacity: int) -> tuple[int, ...] | None:
    """The companions of an item of ``size`` in a dominating set; ``counts`` is without it."""
    room = capacity - size
    least = counts.smallest(3)
    if not least or least[0] > room:
        return ()
    alone = counts.largest_upto(room)
    if alone == room or len(least) < 2 or least[0] + least[1] > room:
        return (alone,)
    if len(least) == 3 and sum(least) <= room:
        return None
    p, q = counts.best_pair(room)
    if alone >= p + q:
        return (alone,)
    if alone != p:
        return None
    # items of sizes q to p beside the pair, from the smallest: the condition of
    # the reduction on what stands between the two
    between: list[int] = []
    for s in counts.sizes[bisect_left(counts.sizes, q) : bisect_right(counts.sizes, p)]:
        between += [s] * min(counts.n[s] - (s == p) - (s == q), 2 - len(between))
    return (p, q) if len(between) < 2 or sum(between) > room else None


def reduce_dominated(counts: _Counts, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Fixed (set of sizes, number of sequences); ``counts`` is left with the rest."""
    fixed: list[tuple[tuple[int, ...], int]] = []
    changed = True
    while changed:
        changed = False
        for size in reversed(counts.sizes[:]):
            while counts.n.get(size):
                counts.take(size, 1)
                found = _dominating(counts, size, capacity)
                counts.give(size, 1)
                if found is None:
                    break
                members = (size, *found)
                times = min(counts.n[s] // members.count(s) for s in members)
                if len(members) == 3:
                    # the conditions look at three items of a size at the most
                    near = {*members, *counts.smallest(3)}
                    times = max(1, min(counts.n[s] // max(1, members.count(s)) - 4 for s in near))
                for s in members:
                    counts.take(s, times)
                fixed.append((members, times))
                changed = True
    return fixed


def best_fit(counts: _Counts, capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """(composition as (size, copies) pairs, number of sequences), longest pieces first."""
    open_: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}
    rooms: list[int] = []

    def put(room: int, composition: list[tuple[int, int]], times: int) -> None:
        if room not in open_:
            insort(rooms, room)
        open_.setdefault(room, []).append((composition, times))

    for size in reversed(counts.sizes):
        left = counts.n[size]
        while left:
            at = bisect_left(rooms, size)
            if at == len(rooms):
                room, composition, times = capacity, [], left
            else:
                room = rooms[at]
                composition, times = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[at]
            # the fullest sequence with room stays the fullest until it has none
            each = room // size
            filled = min(times, left // each)
            if filled:
                put(room - each * size, [*composition, (size, each)], filled)
                left -= filled * each
            if filled < times and 0 < left < each:
                put(room - left * size, [*composition, (size, left)], 1)
                filled, left = filled + 1, 0
            if composition and filled < times:
                put(room, composition, times - filled)
    return [entry for entries in open_.values() for entry in entries]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Run], int]:
    """Runs that place every piece, and the number of sequences."""
    rest = _Counts(counts)
    filled = [
        ([(s, members.count(s)) for s in dict.fromkeys(members)], times)
        for members, times in reduce_dominated(rest, capacity)
    ]
    filled += best_fit(rest, capacity)
    runs, ranks, sequence = [], dict.fromkeys(counts, 0), 0
    for composition, times in filled:
        offset = 0
        for size, each in composition:
            runs.append(Run(size, ranks[size], times * each, each, sequence, offset))
            ranks[size] += times * each
            offset += size * each
        sequence += times
    return sorted(runs), sequence


def pack_pieces(cut_docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset``. ``cut_docs`` is read twice, so it should be written out."""
    counts = {r["length"]: r["n"] for r in cut_docs.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs, _ = plan(counts, capacity)
    table = np.array(runs, np.int64).reshape(-1, 6)
    # one sorted key for (size, rank): ranks are below 2^48
    keys = (table[:, 0] << 48) + table[:, 1]
    ranked = with_rank(cut_docs, "length", counts, ["doc_id", "piece", "start", "ids_crc32"])
    held = cut_docs.sparkSession.sparkContext.broadcast((keys, table))  # bounded by the lengths
    schema = pa.schema([*_PIECES, ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, table = held.value
        for batch in batches:
            size, rank = (batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "__rank"))
            run = table[np.searchsorted(keys, (size << 48) + rank, "right") - 1]
            k = rank - run[:, 1]
            each = run[:, 3]
            columns = [batch[c] for c in _PIECES.names]
            yield batch_of(schema, [*columns, run[:, 4] + k // each, run[:, 5] + k % each * size])

    columns = [*_PIECES.names, "__rank"]
    return ranked.select(columns).mapInArrow(place, f"{_PIECES_DDL}, sequence_id long, offset long")


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """One row for each piece: where it starts in its document and where it is packed.

    Columns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.
    Sequences are numbered from 0 and filled from offset 0 without gaps. No
    document is dropped: a null or empty text is its end id; repeated rows are
    packed each time; texts longer than a sequence are cut, never shortened.
    Other columns are not read. An empty table gives no rows.
    """
    return pack_pieces(settled(pieces(docs, capacity, vocabulary), "pieces"), capacity)


def sequences(docs: DataFrame, packed: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """The packed ids: ``sequence_id, ids, doc_ids`` (the document of each place).

    ``packed`` comes from ``pack`` of the same documents, whose ``doc_id`` must be
    unique and not null here.
    """
    spans = packed.groupBy("doc_id").agg(
        F.collect_list(F.struct("sequence_id", "offset", "start", "length")).alias("spans")
    )
    schema = pa.schema([
        ("sequence_id", pa.int64()), ("offset", pa.int64()), ("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())),
    ])

    def slice_ids(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = document_ids(row["text"] or "", vocabulary)
                ids.append(END_ID)
                got = [
                    (s["sequence_id"], s["offset"], row["doc_id"], list(ids[s["start"] : s["start"] + s["length"]]))
                    for s in row["spans"]
                ]
                yield batch_of(schema, list(zip(*got, strict=True)))

    cut_ids = docs.select("doc_id", "text").join(spans, "doc_id").mapInArrow(
        slice_ids, "sequence_id long, offset long, doc_id long, ids array<int>"
    )
    # a sequence has at most ``capacity`` ids
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return cut_ids.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.flatten(F.col("parts.ids")).alias("ids"),
        F.flatten(F.transform("parts", lambda p: F.array_repeat(p["doc_id"], F.size(p["ids"])))).alias("doc_ids"),
    )

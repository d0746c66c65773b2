"""Benchmark decontamination by canonical templates.

Words of a text that a question may be re-parameterised by are replaced by typed
placeholders: numbers, names (capitalised inside a sentence) and units (after a
number). A capitalised word that opens a sentence may be a name or not, so a window with
such words has two readings: all of them are literals, or all are names. Windows of the template are joined by hash with the windows of the
benchmark's templates, so that "Tom has 3 kg" finds "Ann has 7 lb". What stood in the
slots is then compared: along one alignment each value of the benchmark must stand
for one value of the document, and the other way round. Beside that, any run of ten
words of an item that a document has word for word is a find, whatever its words are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.llm.common import batch_of, byte_slices, texts_of
from assaylake.llm.wordscan import DIGIT, LOWER, UPPER, Prefix, Words, word_hash
from assaylake.session import settled

#: Template words in a window; a shorter item is one window of its own length.
WINDOW = 10
#: Shorter items have no template, nor windows with fewer literal words.
LEAST_WORDS, LEAST_LITERALS = 5, 5
#: Share of an item's template windows that a document must have.
COVERAGE = 0.5
#: Words that are units when they follow a number.
UNITS = (
    "percent mm cm m km meter meters metre metres inch inches foot feet yard yards mile miles "
    "mg g kg gram grams kilogram kilograms ounce ounces pound pounds lb lbs ton tons "
    "ml l liter liters litre litres gallon gallons cup cups "
    "second seconds minute minutes hour hours day days week weeks month months year years "
    "cent cents dollar dollars euro euros usd eur degree degrees mph kmh"
).split()
#: Bits of the filter that windows pass before the join; its size is fixed.
FILTER_BITS = 24
#: Windows of items that are sent to all tasks; of more, each goes to so many tasks that share a document's windows.
MOST_SENT, SALTS = 100_000, 16

NUMBER, NAME, UNIT = (np.uint64(k) for k in (1, 2, 3))
#: Readings of a window: words that open sentences are literals, or names; or word for word, and what its hash is turned by.
PLAIN, NAMES, VERBATIM, _APART = 0, 1, -1, np.int64(0x5851F42D4C957F2D)

_WINDOWS = pa.schema([
    ("id", pa.int64()), ("at", pa.int64()), ("hash", pa.int64()), ("slots", pa.list_(pa.int64())),
    ("plain", pa.bool_()), ("verbatim", pa.bool_()),
])
_WINDOWS_DDL = "id long, at long, hash long, slots array<long>, plain boolean, verbatim boolean"


class Templates:
    """Template words of a list of texts: ``values`` has literals' hashes and placeholders."""

    def __init__(self, texts: list[str]):
        self.words = words = Words(texts)
        self.hashes = words.hashes()
        number = words.holds(words.kinds == DIGIT) > 0
        # a name is capitalised and not the first word of a sentence
        kinds = words.kinds
        upper = (kinds[words.first] == UPPER) & (words.last - words.first > 1)
        upper &= kinds[np.minimum(words.first + 1, max(0, len(kinds) - 1))] == LOWER
        points = words.points
        seen = np.maximum.accumulate(np.where(points == 32, -1, np.arange(len(points)))) if len(points) else points
        before = np.where(words.first > 0, seen[words.first - 1], -1) if len(words) else words.first
        opens = np.isin(points[np.maximum(before, 0)], [0, *map(ord, ".!?:;\n\r\t\"“”«»([|")]) | (before < 0)
        name = upper & ~opens & ~number
        maybe = upper & opens & ~number
        after_number = np.r_[False, number[:-1] & (words.text[1:] == words.text[:-1])] if len(words) else number
        unit = after_number.copy()
        unit[after_number] = np.isin(self.hashes[after_number], np.array([word_hash(u) for u in UNITS], np.uint64))
        slot = number | name | unit
        maybe &= ~slot
        self._maybes = np.r_[0, np.cumsum(maybe)]
        values = np.select([number, name, unit], [NUMBER, NAME, UNIT], self.hashes)
        #: By reading: which words are placeholders, and their prefix sums.
        self._slot = slot, slot | maybe
        self._slots = tuple(np.r_[0, np.cumsum(x)] for x in self._slot)
        self._prefix = Prefix(values), Prefix(np.where(maybe, NAME, values))
        self._plain = Prefix(self.hashes)

    def _starts(self, size: int) -> np.ndarray:
        start = np.arange(max(0, len(self.words) - size + 1))
        return start[self.words.text[start] == self.words.text[start + size - 1]]

    def windows(self, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """First words of the windows with enough literals, their hashes, and the reading.

        The reading ``NAMES`` has the windows in which a word opens a sentence.
        """
        start = self._starts(size)
        for reading in (PLAIN, NAMES):
            literals = size - (self._slots[reading][start + size] - self._slots[reading][start])
            on = literals >= LEAST_LITERALS
            if reading == NAMES:
                on &= self._maybes[start + size] > self._maybes[start]
            first = start[on]
            yield first, self._prefix[reading].runs(first, first + size).view(np.int64) + size, reading

    def verbatim(self, size: int, once: bool = False) -> tuple[np.ndarray, np.ndarray, int]:
        """All windows and the hashes of their words in lower case, in the form of ``windows``.

        With ``once`` a text's equal windows are one.
        """
        start = self._starts(size)
        hashes = (self._plain.runs(start, start + size).view(np.int64) + size) ^ _APART
        if once and len(start):
            text = self.words.text[start]
            order = np.lexsort((start, hashes, text))
            new = np.r_[True, (np.diff(hashes[order]) != 0) | (np.diff(text[order]) != 0)]
            keep = np.sort(order[new])
            start, hashes = start[keep], hashes[keep]
        return start, hashes, VERBATIM

    def slots_in(self, start: int, size: int, reading: int) -> np.ndarray:
        if reading == VERBATIM:
            return np.zeros(0, np.int64)
        return self.hashes[start : start + size][self._slot[reading][start : start + size]].view(np.int64)


def _rows(templates: Templates, ids: pa.Array, size: int, start: np.ndarray, hashes: np.ndarray,
          reading: int) -> pa.RecordBatch:
    text = templates.words.text[start]
    at = start - templates.words.bounds[text]
    slots = [templates.slots_in(s, size, reading) for s in start]
    flags = [np.full(len(start), reading == r) for r in (PLAIN, VERBATIM)]
    return batch_of(_WINDOWS, [ids.take(pa.array(text)), at, hashes, pa.array(slots, pa.list_(pa.int64())), *flags])


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``id, at, hash, slots, plain, verbatim, size`` of every window of the benchmark's items.

    ``plain``: no word that opens a sentence is read as a name. ``verbatim``: the
    words themselves, all of them if the item is short.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            templates = Templates(texts_of(batch.column(1)))
            n_words = np.diff(templates.words.bounds)
            for size in range(1, window + 1):
                templated = templates.windows(size) if size >= LEAST_WORDS else ()
                for start, hashes, reading in (templates.verbatim(size), *templated):
                    text = templates.words.text[start]
                    mine = n_words[text] >= window if size == window else n_words[text] == size
                    rows = _rows(templates, batch.column(0), size, start[mine], hashes[mine], reading)
                    yield rows.append_column("size", pa.array(np.full(rows.num_rows, size, np.int64)))

    return items.filter("item_id is not null").select(
        F.col("item_id").cast("long").alias("id"), F.col("text").cast("string")
    ).mapInArrow(cut, f"{_WINDOWS_DDL}, size long").distinct()


def _filter(hashes: DataFrame) -> bytes:
    """Bits of which a window's hash must hit a set one; 2 MB whatever the benchmark.

    They are set in words of 64, by the tasks; the driver gets each word that has a bit.
    """
    bit = F.col("hash").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    words = hashes.select(
        F.shiftright(bit, 6).alias("word"), F.expr("shiftleft(1L, cast(hash & 63 as int))").alias("bit")
    ).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    made = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for r in words.collect():
        made[r["word"]] = r["bits"]
    return made.tobytes()


def document_windows(docs: DataFrame, sizes: list[int], wanted, window: int = WINDOW) -> DataFrame:
    """``id, at, hash, slots, plain, verbatim`` of the documents' windows that pass the filter.

    A short item is one window, so one place of its words in a document is enough.
    """

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(wanted.value, np.uint8), bitorder="little").view(bool)
        for batch in byte_slices(batches, "text"):
            templates = Templates(texts_of(batch.column(1)))
            for size in sizes:
                templated = templates.windows(size) if size >= LEAST_WORDS else ()
                for start, hashes, reading in chain([templates.verbatim(size, once=size < window)], templated):
                    hit = bits[hashes & ((1 << FILTER_BITS) - 1)]
                    if hit.any():
                        yield _rows(templates, batch.column(0), size, start[hit], hashes[hit], reading)

    return docs.filter("doc_id is not null").select(
        F.col("doc_id").cast("long"), F.col("text").cast("string")
    ).mapInArrow(cut, _WINDOWS_DDL)


def leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """``doc_id, item_id, n_windows, item_windows, exact, coverage``: items found in documents.

    ``coverage`` is the share of the item's windows found along consistent
    alignments, and rows have at least that of the parameter; ``exact`` tells
    whether some alignment has the item's own values in all slots. An alignment is a
    difference of places in the two texts. On it, values must be in one-to-one
    relation; if they are not, only windows whose values are the item's own count.

    A run of ten words of the item, or the whole of a shorter item, that a document
    has word for word (but for case) is a find by itself, even of a single word;
    if the template's windows are not enough, the row has the verbatim ones.
    Items with fewer than five words or five literals have no template windows.
    Null texts have no words, and rows without an id take no part.
    Repeated rows are found once. Empty tables give no rows.
    """
    spark = docs.sparkSession
    asked = settled(item_windows(items, window), "item-windows")
    sizes = [r["size"] for r in asked.select("size").distinct().collect()]  # ten at the most
    wanted = spark.sparkContext.broadcast(_filter(asked.select("hash")))
    found = document_windows(docs, sizes, wanted, window).withColumnsRenamed(
        {"id": "doc_id", "plain": "doc_plain", "verbatim": "doc_verbatim"}
    )
    items_side = asked.select(
        F.col("id").alias("item_id"), F.col("at").alias("item_at"), "hash", F.col("slots").alias("item_slots"), "plain",
        "verbatim",
    )
    if asked.count() <= MOST_SENT:
        on, items_side = ["hash"], F.broadcast(items_side)
    else:  # a window that very many documents have is shared by several tasks
        on = ["hash", "salt"]
        found = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
        items_side = items_side.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    all_met = settled(
        found.join(items_side, on)
        .filter((F.size("slots") == F.size("item_slots")) & (F.col("verbatim") == F.col("doc_verbatim")))
        .select(
            "doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("shift"), "item_at",
            F.zip_with("item_slots", "slots", lambda i, d: F.struct(i.alias("i"), d.alias("d"))).alias("slots"),
            (F.col("slots") == F.col("item_slots")).alias("own"),
            (F.col("plain") & F.col("doc_plain")).alias("plain"), "verbatim",
        ).distinct(),
        "met",
    )
    met, word_for_word = all_met.filter("not verbatim"), all_met.filter("verbatim")
    along = ["doc_id", "item_id", "shift"]

    def consistent(met: DataFrame) -> DataFrame:
        values = met.filter(F.size("slots") > 0).select(*along, F.explode("slots").alias("s")).distinct()
        related = values.groupBy(*along).agg(
            F.count(F.lit(1)).alias("n"),
            F.count_distinct("s.i").alias("n_i"),
            F.count_distinct("s.d").alias("n_d"),
        ).select(*along, ((F.col("n") == F.col("n_i")) & (F.col("n") == F.col("n_d"))).alias("consistent"))
        kept = met.join(related, along, "left").filter(F.coalesce("consistent", F.lit(True)) | F.col("own"))
        return kept.select(*along, "item_at", "own")

    # names that open sentences may add windows, and take away none
    kept = consistent(met).unionByName(consistent(met.filter("plain")))
    # a window is the item's own if it is so under one of its readings
    windows = kept.groupBy(*along, "item_at").agg(F.max("own").alias("own"))
    by_shift = windows.groupBy(*along).agg(F.count(F.lit(1)).alias("n"), F.min("own").alias("own"))
    each = asked.groupBy(F.col("id").alias("item_id"), "verbatim").agg(F.count_distinct("at").alias("item_windows"))
    totals, verbatim_totals = (each.filter(c).drop("verbatim") for c in ("not verbatim", "verbatim"))
    counted = kept.groupBy("doc_id", "item_id").agg(F.count_distinct("item_at").alias("n_windows"))
    whole = by_shift.join(totals, "item_id").groupBy("doc_id", "item_id").agg(
        F.max(F.col("own") & (F.col("n") == F.col("item_windows"))).alias("exact")
    )
    share = F.col("n_windows") / F.col("item_windows")
    columns = ["doc_id", "item_id", "n_windows", "item_windows", "exact", share.alias("coverage")]
    templates = counted.join(totals, "item_id").join(whole, ["doc_id", "item_id"]).select(columns)
    # word for word: all windows along one alignment are the whole item
    runs = word_for_word.groupBy(*along).agg(F.count_distinct("item_at").alias("n"))
    longest = runs.groupBy("doc_id", "item_id").agg(F.max("n").alias("n"))
    verbatim = (
        word_for_word.groupBy("doc_id", "item_id").agg(F.count_distinct("item_at").alias("n_windows"))
        .join(longest, ["doc_id", "item_id"]).join(verbatim_totals, "item_id")
        .withColumn("exact", F.col("n") == F.col("item_windows")).select(columns)
    )
    # the template's row if it is enough by itself
    enough = templates.filter(F.col("coverage") >= coverage)
    return enough.unionByName(verbatim.join(enough, ["doc_id", "item_id"], "left_anti").select(templates.columns))


def drop_leaked(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents in which no item was found; columns and other rows as they are."""
    gone = leaks(docs, items).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)

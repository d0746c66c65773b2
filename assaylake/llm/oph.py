"""Document fingerprints: one-permutation MinHash with optimal densification.

Built of Spark's own functions only. Every shingle is hashed once; the top bits of
the hash choose one of 128 bins, each of which keeps its least hash. A bin that
stays empty copies a bin that a hash of its own number points to, trying on until
one is not empty; so the bins of two texts are filled alike. Of each bin the 8 low
bits are stored, and likeness is corrected for the matches that 8 bits give by
chance.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.llm.common import shuffle_partitions

SHINGLE = 5
#: A power of two.
BINS = 128
#: Low-order bits that are kept of each bin, 8 at the most.
BITS = 8
#: Probes of an empty bin that are tried one by one before all are looked through.
PROBES = 6

_BIN_SHIFT = 64 - (BINS.bit_length() - 1)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _shingle_hashes(text: Column) -> Column:
    """XXH64 of every run of five words; of all words if there are fewer, or none."""
    words = F.array_remove(F.split(F.lower(text), "[\\x20\\x09-\\x0D]+"), "")

    def of_hashes(h: Column) -> Column:
        runs = F.transform(
            F.slice(h, F.lit(1), F.greatest(F.size(h) - (SHINGLE - 1), F.lit(0))),
            lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, SHINGLE)]),
        )
        return F.when(F.size(h) >= SHINGLE, runs).otherwise(F.array(F.xxhash64(h)))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def _bin(h: Column) -> Column:
    return F.shiftrightunsigned(h, _BIN_SHIFT).cast("int")


def _starts_and_steps() -> tuple[list[int], list[int]]:
    """Where each bin starts to look if it is empty, and in which (odd) steps it goes round."""
    rng = np.random.default_rng(BINS)
    return rng.integers(0, BINS, BINS).tolist(), (2 * rng.integers(0, BINS // 2, BINS) + 1).tolist()


def sketch(text: Column) -> Column:
    """The kept bits of the 128 bins, less 128, as array<tinyint>. A null text is the empty one."""
    starts, steps = (F.array(*[F.lit(x) for x in xs]) for xs in _starts_and_steps())

    def of_sorted(h: Column) -> Column:
        # the hashes of a bin stand together, the least first
        return F.filter(h, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(h, i - 1))))

    def of_least(least: Column) -> Column:
        return _let(F.transform(least, _bin), lambda bins: F.transform(
            F.sequence(F.lit(0), F.lit(BINS - 1)), lambda j: kept(least, bins, j)
        ))

    def kept(least: Column, bins: Column, j: Column) -> Column:
        at = lambda b: F.nullif(F.array_position(bins, b).cast("int"), F.lit(0))
        probe = lambda t: (F.get(starts, j) + t * F.get(steps, j)).bitwiseAND(F.lit(BINS - 1))
        # the steps are odd, so going round meets every bin
        rest = F.filter(
            F.transform(F.sequence(F.lit(PROBES), F.lit(BINS - 1)), lambda t: at(probe(t))), F.isnotnull
        )
        place = F.coalesce(at(j), *[at(probe(F.lit(t))) for t in range(PROBES)], F.get(rest, F.lit(0)))
        return (F.get(least, place - 1).bitwiseAND(F.lit((1 << BITS) - 1)) - 128).cast("tinyint")

    hashes = _shingle_hashes(F.coalesce(text, F.lit("")))
    return _let(_let(F.sort_array(hashes), of_sorted), of_least)


def packed(bins: Column) -> Column:
    """The sketch as lowercase hex digits, two for each bin."""
    digits = F.array(*[F.lit(f"{k:02x}") for k in range(256)])
    return F.array_join(F.transform(bins, lambda v: F.get(digits, v.cast("int") + 128)), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two sketches, 0 to 1.

    The share of equal bins, less those that are equal by chance.
    """
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))
    chance = 2.0**-BITS
    return F.greatest(F.lit(0.0), (equal / float(BINS) - chance) / (1 - chance))


def _range_bucket(value: Column, edges: list[int]) -> Column:
    """How many of the sorted edges are below the value, by a search of two steps."""
    if not edges:
        return F.lit(0)
    width = max(1, int(len(edges) ** 0.5))
    blocks = [edges[k : k + width] for k in range(0, len(edges), width)]
    longs = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs]) if xs else F.array().cast("array<long>")
    below = lambda xs: F.size(F.filter(xs, lambda e: e < value))
    lasts = longs([b[-1] for b in blocks])
    inside = F.array(*[longs(b) for b in [*blocks, []]])
    return _let(below(lasts), lambda k: k * width + below(F.get(inside, k)))


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, bins, next_text, next_bins``: each document and the following one.

    The order is that of doc_id (null first, ties by a hash of the text); the last
    one is followed by the first. Rows are dealt into ranges of doc_id, each of
    which finds its followers alone; only the last row of a range takes the first
    row of the next range from a table with a row for each range.
    """
    spark = docs.sparkSession
    ranges = 4 * shuffle_partitions(spark)
    shares = [k / ranges for k in range(1, ranges)]
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    edges = sorted(set(ids.agg(F.percentile_approx("doc_id", shares, 10 * ranges)).first()[0] or []))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumns({
        "part": F.coalesce(_range_bucket(F.col("doc_id"), edges), F.lit(-1)), "tie": F.xxhash64("text"),
    })
    # a null id is in the part before all others
    rows = rows.withColumn("part", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(F.col("part")))
    rank = F.struct(F.col("doc_id").isNotNull().alias("has"), "doc_id", "tie")
    first = rows.groupBy("part").agg(F.min(rank).alias("f"), F.max(rank).alias("l"))
    # a row for each range: their number is bounded by the partitions
    in_order = Window.orderBy("part")
    every = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follow = first.select(
        "part", F.col("l").alias("last"),
        F.coalesce(F.lead("f").over(in_order), F.first("f").over(every)).alias("f"),
    )
    heads = rows.alias("r").join(
        F.broadcast(follow.select("f.doc_id", "f.tie", F.col("part").alias("after"))).alias("h"),
        F.col("r.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("r.tie") == F.col("h.tie")),
    ).select("after", F.col("r.text").alias("head_text")).dropDuplicates(["after"])
    heads = heads.withColumn("head_bins", sketch(F.col("head_text")))

    inside = Window.partitionBy("part").orderBy(F.asc_nulls_first("doc_id"), "tie")
    lined = rows.withColumn("bins", sketch(F.col("text"))).withColumns({
        "next_text": F.lead("text").over(inside), "next_bins": F.lead("bins").over(inside),
    })
    at_end = (F.col("part") == F.col("after")) & F.col("next_text").isNull()
    return lined.join(heads, at_end, "left").select(
        "doc_id", "text", "bins",
        F.coalesce("next_text", "head_text").alias("next_text"),
        F.coalesce("next_bins", "head_bins").alias("next_bins"),
    )


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of the text with its second half exchanged.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``. The edited text has its last floor(n_chars / 2) code points replaced
    by the first as many, or all, of the next document's (see ``with_next``).

    Null and empty texts are the same; texts without words share one fingerprint.
    Shingles are of five words, in lower case, or of all words if there are fewer.
    Repeated rows follow each other. A single document is its own next one. An empty
    table gives no rows. Other columns are not read.
    """
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.char_length("text") - half), F.substring("next_text", F.lit(1), half)
    )
    rows = with_next(docs).withColumn("edited", edited)
    rows = rows.withColumn("edited_bins", sketch(F.col("edited")))
    return rows.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        packed(F.col("bins")).alias("fingerprint"),
        packed(F.col("edited_bins")).alias("edited_fingerprint"),
        likeness(F.col("bins"), F.col("edited_bins")).alias("near_edited"),
        likeness(F.col("bins"), F.col("next_bins")).alias("near_next"),
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` of every row; see ``fingerprint_edits``. A pass without a shuffle."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), packed(sketch(F.col("text").cast("string"))).alias("fingerprint"))

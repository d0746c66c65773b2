"""Quality by importance resampling.

Two generative models of hashed n-grams are counted: of the target (documents that
are labelled good) and of the raw text (all documents). The log ratio of a document's
probabilities under them is its log importance weight; adding Gumbel noise and
keeping the k largest sums draws k documents without replacement, in proportion to
the weights.

An n-gram here is a word, a pair of words, or the like of the words' shapes (case,
digits, signs at the ends, same as the word before). Shapes carry over to words that
the target does not have.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.llm.common import batch_of, byte_slices, texts_of
from assaylake.llm.wordscan import DIGIT, LOWER, UPPER, Prefix, Words, mix
from assaylake.session import settled

#: Hash buckets of the n-grams, a power of two.
BUCKETS = 1 << 14
#: Labelled documents of each kind at the most; more are chosen by a hash of the id.
MOST_LABELLED = 20_000
#: Added to every bucket's counts.
SMOOTHING = 5.0
#: Standard errors by which a bucket's target count must differ from what the raw model
#: expects; the others, mostly words that are merely rare, weigh nothing.
SIGNIFICANT = 4.0
#: Share of the good labelled documents that the target is counted on; the cut is
#: chosen on the others, which like unlabelled documents had no part in the counts.
MODEL_SHARE = 0.67
SEED = 42

_WHITE = np.array([9, 10, 11, 12, 13, 32, 0], np.uint32)


class _Chunks(Words):
    """Runs of anything but white space."""

    def __init__(self, texts: list[str]):
        super().__init__(texts, numbers=False)
        solid = ~np.isin(self.points, _WHITE)
        edges = np.flatnonzero(np.diff(np.r_[False, solid, False].view(np.int8)))
        self.first, self.last = edges[::2], edges[1::2]
        self.bounds = np.searchsorted(self.first, self.starts)
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.bounds))


def _features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every n-gram of every text."""
    w = _Chunks(texts)
    if not len(w):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    exact = Prefix(w.points).runs(w.first, w.last)
    length = w.last - w.first
    upper, lower, digit = (w.holds(w.kinds == k) for k in (UPPER, LOWER, DIGIT))
    signs = length - upper - lower - digit
    follows = np.r_[False, w.text[1:] == w.text[:-1]]
    same = follows & np.r_[False, exact[1:] == exact[:-1]]
    tail, head = w.points[w.last - 1], w.points[w.first]
    plain = lambda c: np.where(c < 128, np.where(w.kinds[w.first] > 0, 1, c), 2)
    tail = np.where(w.kinds[w.last - 1] > 0, 0, np.minimum(tail, 128)).astype(np.uint64)
    head = np.where(w.kinds[w.first] > 0, w.kinds[w.first], plain(head)).astype(np.uint64)
    case = np.select([upper == 0, upper == length - signs - digit, upper == 1], [0, 1, 2], 3).astype(np.uint64)
    case = np.where((case == 1) & (upper == 1), 2, case).astype(np.uint64)
    shape = mix(
        case + np.uint64(4) * (digit > 0).astype(np.uint64) + np.uint64(8) * np.minimum(signs, 3).astype(np.uint64)
        + np.uint64(32) * same.astype(np.uint64) + np.uint64(64) * tail + (head << np.uint64(16))
    )
    pair = np.flatnonzero(follows)
    turn = np.uint64(0x9E3779B97F4A7C15)
    grams = [
        (w.text, exact), (w.text[pair], mix(exact[pair - 1] * turn + exact[pair])),
        (w.text, shape), (w.text[pair], mix(shape[pair - 1] * turn + shape[pair])),
    ]
    text = np.concatenate([t for t, _ in grams])
    return text, (np.concatenate([g for _, g in grams]) & np.uint64(BUCKETS - 1)).astype(np.int64)


def _chosen(labels: DataFrame, label: str, value: int, most: int) -> np.ndarray:
    """Sorted ids with this label; at most ``most``, so that they may be sent to all tasks."""
    ids = labels.filter((F.col(label) == value) & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id")
    ).distinct()
    rows = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()
    return np.sort(np.array([r["doc_id"] for r in rows], np.int64))


def bucket_counts(docs: DataFrame, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """n-grams in each bucket: of all documents, and of those with these ids.

    Each task adds up its documents; at most ``BUCKETS`` rows leave it and as many
    reach the driver.
    """
    held = docs.sparkSession.sparkContext.broadcast(target)
    schema = pa.schema([("bucket", pa.int64()), ("raw", pa.int64()), ("target", pa.int64())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, wanted = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in byte_slices(batches, "text"):
            text, bucket = _features(texts_of(batch.column(1)))
            raw += np.bincount(bucket, minlength=BUCKETS)
            ids = batch.column(0)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            good = known & np.isin(ids.fill_null(0).to_numpy(), held.value)
            wanted += np.bincount(bucket[good[text]], minlength=BUCKETS)
        at = np.flatnonzero(raw)
        yield batch_of(schema, [at, raw[at], wanted[at]])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        count, "bucket long, raw long, target long"
    ).groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()
    raw, wanted = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in rows:
        raw[r["bucket"]], wanted[r["bucket"]] = r["raw"], r["target"]
    return raw, wanted


def log_ratios(raw: np.ndarray, target: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """For each bucket the log of its probability under the target over that under the raw model.

    ``smoothing`` n-grams are added to a bucket's target count and to what the raw
    model expects there. Where the two differ by chance only, the ratio is 1.
    """
    expected = raw * (target.sum() / raw.sum())
    chance = np.abs(target - expected) <= SIGNIFICANT * np.sqrt(expected + 1)
    return np.where(chance, 0.0, np.log((target + smoothing) / (expected + smoothing)))


def weights(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """``doc_id, n_grams, log_weight`` of every row: the sum of its n-grams' log ratios."""
    held = docs.sparkSession.sparkContext.broadcast(ratios)
    schema = pa.schema([("doc_id", pa.int64()), ("n_grams", pa.int64()), ("log_weight", pa.float64())])

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            text, bucket = _features(texts_of(batch.column(1)))
            n = np.bincount(text, minlength=batch.num_rows)
            total = np.bincount(text, weights=held.value[bucket], minlength=batch.num_rows)
            yield batch_of(schema, [batch.column(0), n, total])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        score, "doc_id long, n_grams long, log_weight double"
    )


def best_cut(good: np.ndarray, bad: np.ndarray) -> float:
    """The log weight that best tells labelled good documents (at or above) from bad ones.

    The share of good ones kept and of bad ones rejected are added up; among equally
    good cuts the middle of the widest gap is taken. Without bad ones, none is cut.
    """
    if not len(good) or not len(bad):
        return -np.inf
    values = np.unique(np.r_[good, bad])
    kept = 1 - np.searchsorted(np.sort(good), values) / len(good)
    rejected = np.searchsorted(np.sort(bad), values) / len(bad)
    gain = kept + rejected
    below = np.r_[values[0], values[:-1]]
    width = np.where(np.isclose(gain, gain.max()), values - below, -1)
    at = int(width.argmax())
    return float((values[at] + below[at]) / 2)


def kth_largest(df: DataFrame, column: str, k: int, bins: int = 1024) -> float:
    """The k-th largest value, exactly, by narrowing histograms; ``df`` should be written out."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    above = 0
    while low < high:
        width = (high - low) / bins
        inside = df.filter(F.col(column).between(low, high))
        edge = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)) if width else F.lit(0)
        got = inside.groupBy(edge.alias("b")).agg(
            F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")
        ).orderBy(F.desc("b")).collect()
        for r in got:
            if above + r["n"] >= k:
                low, high = r["low"], r["high"]
                break
            above += r["n"]
    return low


def gumbel_top_k(scored: DataFrame, k: int, seed: int = SEED) -> DataFrame:
    """Adds ``sort_key`` (log weight and Gumbel noise) and ``selected`` (among the k largest).

    The noise is a function of the id and the seed. Rows that share the k-th key
    (repeated rows) are all selected. ``scored`` should be written out.
    """
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id")), 11)
    uniform = (bits.cast("double") + 0.5) / float(1 << 53)
    keyed = settled(scored.withColumn("sort_key", F.col("log_weight") - F.log(-F.log(uniform))), "keys")
    if k <= 0:
        return keyed.withColumn("selected", F.lit(False))
    return keyed.withColumn("selected", F.col("sort_key") >= F.lit(kth_largest(keyed, "sort_key", k)))


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = SEED) -> DataFrame:
    """``doc_id, n_grams, log_weight, sort_key, selected`` for every row.

    ``k`` documents are drawn; by default as many as have at least the log weight
    that best separates the labelled documents of quality 1 and 0. At most
    ``MOST_LABELLED`` documents of either label are used, and all documents for
    the raw model.

    A null text is an empty one: no n-grams, log weight 0. Rows without an id are
    scored, but never labelled; labels that are null, or contradict each other, or
    have no document, count as none. If nothing is labelled good, all weights are 0.
    An empty table gives no rows.
    """
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter(F.col("quality").isin(0, 1))
    clear = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("m")).filter(
        "quality = m"
    )
    clear = settled(clear.select("doc_id", "quality"), "labels")
    good, bad = (_chosen(clear, "quality", v, MOST_LABELLED) for v in (1, 0))
    order = np.argsort(np.random.default_rng(seed).random(len(good)))
    model, other = np.split(good[order], [max(1, int(MODEL_SHARE * len(good)))])
    raw, target = bucket_counts(docs, np.sort(model))
    ratios = log_ratios(raw, target) if target.any() else np.zeros(BUCKETS)
    scored = settled(weights(docs, ratios), "weights")
    if k is None:
        # at most twice MOST_LABELLED rows
        held = docs.sparkSession.createDataFrame(
            [(int(i), v) for ids, v in ((other, 1), (bad, 0)) for i in ids], "doc_id long, quality int"
        )
        seen = scored.join(F.broadcast(held), "doc_id").select("doc_id", "quality", "log_weight").distinct().collect()
        cut = best_cut(*(np.array([r["log_weight"] for r in seen if r["quality"] == v]) for v in (1, 0)))
        k = scored.filter(F.col("log_weight") >= F.lit(float(cut))).count()
    return gumbel_top_k(scored, k, seed)


def keep_selected(docs: DataFrame, labels: DataFrame, k: int | None = None) -> DataFrame:
    """The rows that ``resample`` selects, with all their columns.

    Rows without an id are kept, as they cannot be told apart.
    """
    gone = resample(docs, labels, k).filter("not selected and doc_id is not null").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)

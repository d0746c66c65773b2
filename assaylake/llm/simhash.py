"""SimHash fingerprints and near duplicates, with pigeonring filtering.

Pigeonring: put the segments of two fingerprints in a ring. If the fingerprints
differ in at most t of all bits, then from some segment on every chain of l
consecutive segments differs in at most l * t / m bits, m being the number of
segments. So a chain of two segments can be looked up (the first equal, the second
within its budget) and the longer chains prune what was found, before the whole
Hamming distance is taken. Nothing within the distance is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import islice, repeat
from operator import and_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.llm.common import batch_of, slices, utf8_of
from assaylake.llm.components import components
from assaylake.session import release, settled

SEGMENTS = 4
SEGMENT_BITS = 16
DISTANCE = 3
#: Words of a shingle of the fingerprint.
PRINT_WORDS = 3

_BLOCK = 1 << 14


def shingles(words: list[bytes], n: int) -> Iterator[bytes]:
    """Runs of ``n`` words joined by a space; all words if there are fewer."""
    if not words:
        return iter(())
    return map(b" ".join, zip(*(islice(words, k, None) for k in range(min(n, len(words)))), strict=False))


def shingle_hashes(words: list[bytes], n: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of every shingle, in blocks, whatever the number of words."""
    todo = shingles(words, n)
    while block := list(islice(todo, _BLOCK)):
        yield np.fromiter(map(xxhash.xxh64_intdigest, block, repeat(42)), np.uint64, len(block))


def _spread(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hashes themselves for k = 0, else other hashes made of them."""
    if not k:
        return hashes
    x = hashes + np.uint64(k * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def majority(blocks: Iterable[np.ndarray], words: int = 1) -> np.ndarray:
    """64 x ``words`` bits as uint64: 1 where over half of the hashes have it."""
    counts, n = np.zeros(64 * words, np.int64), 0
    for hashes in blocks:
        spread = np.stack([_spread(hashes, k) for k in range(words)], axis=1)
        bits = np.unpackbits(spread.view(np.uint8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.uint32)
        n += len(hashes)
    return np.packbits(2 * counts > n, bitorder="little").view(np.uint64)


def fingerprints(docs: DataFrame, shingle: int = PRINT_WORDS) -> DataFrame:
    """``doc_id, fp``: the 64-bit fingerprint of every whole text, as a signed long.

    A-Z are lower-cased, words are split at ASCII white space, repeated shingles
    count each time. A text without words, null included, has fingerprint 0.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [majority(shingle_hashes(t.lower().split(), shingle))[0] for t in utf8_of(batch.column(1))]
            yield batch_of(schema, [batch.column(0), np.array(prints, np.uint64).view(np.int64)])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        sign, "doc_id long, fp long"
    )


def _rotated(fp: Column, segments: int) -> Column:
    """The fingerprint turned so that this segment comes first (lowest)."""
    by = SEGMENT_BITS * segments
    return fp if not by else F.shiftrightunsigned(fp, by).bitwiseOR(F.shiftleft(fp, 64 - by))


def links_within(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``x, y`` (x < y): all pairs of the distinct ``fp`` that differ in at most ``distance`` bits.

    The ring has 4 segments of 16 bits. A fingerprint is stored under each of its
    4 chains of two segments, and looked up under each chain as it is and with
    every bit of the second segment turned, which is all that the budgets
    (0, then 1) allow. The lookup key has 32 bits beside the place on the ring, so
    chance finds stay few for billions of fingerprints.
    """
    if not 0 <= distance < SEGMENTS:
        raise ValueError("the distance must be below the number of segments")
    budgets = [n * distance // SEGMENTS for n in range(1, SEGMENTS + 1)]
    low = (1 << 2 * SEGMENT_BITS) - 1
    chains = F.array(*[_rotated(F.col("fp"), k).bitwiseAND(F.lit(low)) for k in range(SEGMENTS)])
    turns = [0] + [1 << (SEGMENT_BITS + b) for b in range(SEGMENT_BITS * budgets[1])]
    places = [(k, turn) for k in range(SEGMENTS) for turn in turns]

    def keyed(at: list[tuple[int, int]]) -> DataFrame:
        place = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(t).cast("long").alias("t")) for k, t in at]))
        chain = F.get("chains", F.col("at.k")).bitwiseXOR(F.col("at.t"))
        key = F.shiftleft(F.col("at.k").cast("long"), 2 * SEGMENT_BITS).bitwiseOR(chain)
        return prints.select("fp", chains.alias("chains"), place.alias("at")).select(
            "fp", key.alias("key"), F.col("at.k").alias("k")
        )

    stored = keyed([(k, 0) for k in range(SEGMENTS)]).select(F.col("fp").alias("y"), "key")
    asked = keyed(places).select(F.col("fp").alias("x"), "key", "k")
    differ = F.col("x").bitwiseXOR(F.col("y"))
    # bits that differ in the chain of three segments from the place on
    three = (1 << 3 * SEGMENT_BITS) - 1
    chain = F.lit(0)
    for k in range(SEGMENTS):
        chain = F.when(F.col("k") == k, F.bit_count(_rotated(differ, k).bitwiseAND(F.lit(three)))).otherwise(chain)
    found = asked.join(
        stored,
        (asked["key"] == stored["key"])
        & (F.col("x") < F.col("y"))
        & (chain <= budgets[2])
        & (F.bit_count(differ) <= distance),
    )
    return found.select("x", "y").distinct()


def simhash_groups(docs: DataFrame, distance: int = DISTANCE, shingle: int = PRINT_WORDS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row.

    Documents are linked if their fingerprints differ in at most ``distance`` bits;
    ``component_id`` is the least doc_id that can be reached, itself included.
    Links are searched between distinct fingerprints only, so copies are never
    paired with each other, however many there are.

    Null and empty texts share fingerprint 0. Rows that repeat a doc_id are one
    document; if their texts differ they join the groups of both. A null doc_id
    gets the id of its fingerprint's group and links no others; null if it is
    alone there. An empty table gives no rows; other columns are not read.
    """
    return _grouped(settled(fingerprints(docs, shingle), "fingerprints"), distance)


def _grouped(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of written ``doc_id, fp``, as ``simhash_groups`` says."""
    classes = settled(prints.groupBy("fp").agg(F.min("doc_id").alias("class_id")), "classes")
    links = links_within(classes.select("fp"), distance)
    a = classes.select(F.col("fp").alias("x"), F.col("class_id").alias("a"))
    b = classes.select(F.col("fp").alias("y"), F.col("class_id").alias("b"))
    between = links.join(a, "x").join(b, "y").select("a", "b")
    # a document with two fingerprints holds their classes together
    kinds = prints.filter("doc_id is not null").distinct()
    twice = kinds.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id")
    held = kinds.join(twice, "doc_id").join(classes, "fp").select(F.col("doc_id").alias("a"), "class_id")
    linked = components(between.unionByName(held.withColumnRenamed("class_id", "b")))
    groups = classes.join(linked, classes["class_id"] == linked["node"], "left").select(
        "fp", F.coalesce("component", "class_id").alias("component_id")
    )
    return prints.join(groups, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


# ---- near copies of text ----------------------------------------------------

#: Near copies: shingles of so many words, at least so similar (Jaccard).
NEAR_WORDS, NEAR_SIMILARITY = 5, 0.8
#: Shingles that so many texts of a batch have are counted, and so many of the
#: most frequent of them come last in the order of all shingles. Any order finds
#: every pair; this one keeps frequent shingles from being looked up.
FREQUENT, MOST_FREQUENT = 4, 1 << 18
#: Rounds in which a bucket is compared with one member of it, before all that
#: is still unlinked in it is compared with all others; and the size of a block.
STAR_ROUNDS, BLOCK_ROWS = 1, 256


def _least_shared(n: int) -> int:
    """Shingles that a set of ``n`` shares with any set similar enough, at the least."""
    return math.ceil(NEAR_SIMILARITY * n - 1e-9)


def _near_hashes(text: bytes) -> tuple[list[bytes], np.ndarray]:
    """The words of a text and the distinct hashes of its shingles, ascending."""
    words = text.lower().split()
    blocks = [np.unique(h) for h in shingle_hashes(words, NEAR_WORDS)]
    return words, np.unique(np.concatenate(blocks)) if blocks else np.zeros(0, np.uint64)


def _frequent(docs: DataFrame) -> np.ndarray:
    """Hashes of frequent shingles, the most frequent last."""
    schema = pa.schema([("hash", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2000):
            hashes = [_near_hashes(t)[1] for t in utf8_of(batch.column(0))]
            seen, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *hashes]), return_counts=True)
            often = n >= FREQUENT
            yield batch_of(schema, [seen[often].view(np.int64), n[often]])

    counted = docs.select(F.col("text").cast("string")).mapInArrow(count, "hash long, n long")
    most = counted.groupBy("hash").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "hash").limit(MOST_FREQUENT)
    # as a column of numbers, not as a Python row for each
    return most.select("hash").toArrow()["hash"].to_numpy()[::-1].astype(np.int64).view(np.uint64)


def _marks(hashes: np.ndarray) -> np.ndarray:
    """A bitmap of the set, of two to four bits for each element: whether an odd number of them falls on a bit."""
    bits = 64 << max(0, math.ceil(math.log2(max(1, len(hashes)) / 32)))
    odd = np.bincount((hashes % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


#: Words of 64 bits of the bitmap that travels with the members of buckets.
BRIEF = 16


def _brief(marks: np.ndarray) -> np.ndarray:
    """The bitmap with halves added until it has ``BRIEF`` words; its bound is weaker and holds."""
    while len(marks) > BRIEF:
        marks = marks[: len(marks) // 2] ^ marks[len(marks) // 2 :]
    return marks


def _sketch(docs: DataFrame) -> DataFrame:
    """``doc_id, same, n, keys, marks, brief, fp``: hash of the words, number of shingles, the first of them in the common order, bitmaps, fingerprint.

    Of two sets of similarity 0.8 or more, the first ``n - ceil(0.8 n) + 1``
    elements of each, in any order of all elements, have one in common.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("same", pa.string()), ("n", pa.int64()), ("keys", pa.list_(pa.int64())),
        ("marks", pa.list_(pa.int64())), ("brief", pa.list_(pa.int64())), ("fp", pa.int64()),
    ])
    last = docs.sparkSession.sparkContext.broadcast(_frequent(docs))

    def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = last.value
        by_hash = np.argsort(frequent)
        ascending = frequent[by_hash]
        for batch in slices(batches, 2000):
            same, n, keys, marks, prints = [], [], [], [], []
            for text in utf8_of(batch.column(1)):
                words, hashes = _near_hashes(text)
                same.append(xxhash.xxh3_128_hexdigest(b" ".join(words)))
                n.append(len(hashes))
                rank = np.zeros(len(hashes), np.int64)
                if len(ascending):
                    at = np.minimum(np.searchsorted(ascending, hashes), len(ascending) - 1)
                    rank = np.where(ascending[at] == hashes, by_hash[at] + 1, 0)
                first = np.argsort(rank, kind="stable")[: len(hashes) - _least_shared(len(hashes)) + 1]
                keys.append(hashes[first].view(np.int64))
                marks.append(_marks(hashes))
                prints.append(majority(shingle_hashes(words, PRINT_WORDS))[0])
            prints = np.array(prints, np.uint64).view(np.int64)
            yield batch_of(schema, [batch.column(0), same, n, keys, marks, list(map(_brief, marks)), prints])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        sketch, "doc_id long, same string, n long, keys array<long>, marks array<long>, brief array<long>, fp long"
    )


def _can_be_similar(x: str, y: str) -> Column:
    """Whether two members of a bucket may be similar, by their sizes and the places of the common shingle.

    At most the lesser number of shingles before the places and from them on is shared.
    """
    size = lambda side, name: F.col(f"{side}.{name}")
    small, great = F.least(size(x, "n"), size(y, "n")), F.greatest(size(x, "n"), size(y, "n"))
    shared = F.least(size(x, "at"), size(y, "at")) + F.least(
        size(x, "n") - size(x, "at"), size(y, "n") - size(y, "at")
    )
    # shared / (n + n - shared) >= similarity, less a little for rounding
    return (small >= NEAR_SIMILARITY * great - 1e-6) & (
        shared * (1 + NEAR_SIMILARITY) >= NEAR_SIMILARITY * (small + great) - 1e-6
    )


def _marks_near(left: str, right: str, sizes: Column) -> Column:
    """Whether two bitmaps differ in no more bits than similar sets, of these sizes together, may differ in elements.

    Each bit that differs stands for at least one element that only one of the
    sets has, so nothing similar is lost. Sizes of similar sets differ by a quarter
    at the most, so one bitmap is at most twice as long; its halves are then added.
    """

    def folded(mine: str, other: str) -> Column:
        half = F.greatest(F.lit(1), F.floor(F.size(mine) / 2).cast("int"))
        halves = F.zip_with(F.slice(mine, 1, half), F.slice(mine, half + 1, half), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(mine) > F.size(other), halves).otherwise(F.col(mine))

    bits = F.zip_with(folded(left, right), folded(right, left), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    differ = F.aggregate(bits, F.lit(0), lambda total, n: total + n)
    return differ * (1 + NEAR_SIMILARITY) <= (1 - NEAR_SIMILARITY) * sizes + 1e-6


def _near_by_marks(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose bitmaps allow that they are similar."""
    sized = classes.select("id", "n", "marks")
    both = (
        pairs.join(sized.toDF("a", "left_n", "left"), "a").join(sized.toDF("b", "right_n", "right"), "b")
    )
    return both.filter(_marks_near("left", "right", F.col("left_n") + F.col("right_n"))).select("a", "b")


def _similar(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose sets of shingles are similar enough.

    Bitmaps leave few pairs besides the similar ones; these are compared by the whole texts.
    """
    near = settled(_near_by_marks(pairs, classes), "near")
    ids = near.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    # a repeated doc_id would be compared again
    texts = docs.join(ids, "doc_id", "left_semi").select(
        F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")
    )
    both = (
        near.join(texts.select(F.col("id").alias("a"), F.col("text").alias("left")), "a")
        .join(texts.select(F.col("id").alias("b"), F.col("text").alias("right")), "b")
        .select("a", "b", "left", "right")
    )
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2000):
            keep = []
            for left, right in zip(utf8_of(batch.column(2)), utf8_of(batch.column(3)), strict=True):
                x, y = (set(shingles(t.lower().split(), NEAR_WORDS)) for t in (left, right))
                shared = len(x & y)
                keep.append(shared >= NEAR_SIMILARITY * (len(x) + len(y) - shared))
            yield batch_of(schema, [batch.column(0), batch.column(1)]).filter(pa.array(keep, pa.bool_()))

    found = settled(both.mapInArrow(compare, "a long, b long"), "similar")
    release(near)
    return found


def _ring_pairs(classes: DataFrame) -> DataFrame:
    """``a, b``: the classes of a SimHash group, as ``simhash_groups`` finds them, with the least one of it."""
    groups = _grouped(classes.select(F.col("id").alias("doc_id"), "fp"))
    return groups.filter("component_id <> doc_id").select(
        F.col("component_id").alias("a"), F.col("doc_id").alias("b")
    ).distinct()


def _star(members: DataFrame, turn: int) -> DataFrame:
    """``a, b``: one member of each bucket, another one each turn, with those not yet linked to it."""
    order = F.xxhash64(F.lit(turn), "id") if turn else F.col("id")
    lead = F.min(F.struct(order.alias("order"), "id", "n", "at", "component")).alias("x")
    apart = (F.col("x.component") != F.col("y.component")) & _can_be_similar("x", "y")
    return (
        members.select("key", F.struct("id", "n", "at", "component").alias("y"))
        .join(members.groupBy("key").agg(lead), "key").filter(apart)
        .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    )


def _first_of_equal(shared: DataFrame) -> DataFrame:
    """The buckets without those that have the same members as another one.

    Of such buckets the first in the common order stays, as the places of the shingles
    in any one member tell. Members are compared by number, least id and 64 bits of hash.
    """
    sets = shared.groupBy("key").agg(
        F.count(F.lit(1)).alias("members"), F.bit_xor(F.xxhash64("id")).alias("hash"),
        F.min(F.struct("id", "at")).alias("least"),
    )
    first = sets.groupBy("members", "hash", "least.id").agg(F.min_by("key", "least.at").alias("key"))
    return shared.join(first.select("key"), "key")


#: Keys before a bucket's, of a member's, that are held against those of another member.
EARLIER = 4


def _all_apart(members: DataFrame, classes: DataFrame) -> DataFrame:
    """``a, b``: all members of a bucket that are not linked yet and may be similar.

    A bucket is cut into blocks, and each pair of blocks is a group of its own, so
    a great bucket is spread over many tasks. Brief bitmaps are compared where the pairs
    meet, so few of them leave the join. Two members that also share one of the keys just before the
    bucket's meet there; as this holds for all buckets but their first, no pair is lost.
    """
    earlier = F.slice("keys", F.greatest(F.col("at") - EARLIER, F.lit(0)) + 1, F.least("at", F.lit(EARLIER)))
    blocks = members.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
    cut = members.join(blocks, "key").join(classes.select("id", "keys", "brief"), "id").select(
        "key", "blocks", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("mine"),
        F.struct("id", "n", "at", "component", earlier.alias("earlier"), "brief").alias("m"),
    )
    # in the pair (i, j) of blocks, i <= j, a member of i is on the left, one of j on the right
    left = cut.select("key", F.col("mine").alias("i"), F.explode(F.sequence("mine", F.col("blocks") - 1)).alias("j"),
                      F.col("m").alias("x"))
    right = cut.select("key", F.explode(F.sequence(F.lit(0), "mine")).alias("i"), F.col("mine").alias("j"),
                       F.col("m").alias("y"))
    apart = (F.col("x.component") != F.col("y.component")) & _can_be_similar("x", "y")
    before = F.coalesce(F.arrays_overlap("x.earlier", "y.earlier"), F.lit(False))
    near = _marks_near("x.brief", "y.brief", F.col("x.n") + F.col("y.n"))
    one, two = left.alias("l"), right.alias("r")
    same = reduce(and_, [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("key", "i", "j")])
    once = (F.col("l.i") < F.col("l.j")) | (F.col("x.id") < F.col("y.id"))
    return one.join(two, same & once & apart & ~before & near).select(
        F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")
    ).distinct()


def _linked(shared: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """``node, component`` of all classes that are linked, given the buckets ``key, id, n, at``.

    What is linked already need not be compared. So the SimHash groups are compared
    first, then each bucket with one member at a time, and then every pair in it that is still apart.
    """
    tried = settled(_ring_pairs(classes), "ring")
    # each pair has the least class of a group and one other, so the similar ones are stars already
    stars = _similar(tried, classes, docs)
    ends = stars.select(F.explode(F.array("a", "b")).alias("node"), F.col("a").alias("component"))
    linked, left = settled(ends.distinct(), "linked"), shared
    for turn in range(STAR_ROUNDS + 1):
        members = left.join(linked.withColumnRenamed("node", "id"), "id", "left").withColumn(
            "component", F.coalesce("component", "id")
        )
        mixed = members.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most"))
        mixed = mixed.filter("least <> most").select("key")
        members = settled(members.join(mixed, "key"), "mixed")
        release(left)
        if members.isEmpty():
            break
        left = members.drop("component")
        pairs = _star(members, turn) if turn < STAR_ROUNDS else _all_apart(members, classes)
        pairs = settled(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        if not pairs.isEmpty():
            tried = tried.unionByName(pairs)
            found = _similar(pairs, classes, docs)
            if not found.isEmpty():
                # what is linked already is a star of its component's least node
                stars = linked.select(F.col("node").alias("a"), F.col("component").alias("b"))
                linked = settled(components(stars.unionByName(found)), "linked")
    release(members)
    return linked


def near_copies(docs: DataFrame) -> DataFrame:
    """``doc_id, group_id``: the documents that are copies or near copies of others.

    Two texts are linked if the Jaccard similarity of their sets of five-word
    shingles (A-Z lower-cased) is at least 0.8; groups are the connected
    documents, named by their least doc_id.

    Texts of the same words are one class, so copies are never paired. SimHash groups,
    by pigeonring, come first: each class is compared with the least one of its group. What
    the fingerprints miss, or a group's least one is not similar to, is found by buckets. Classes
    meet in them, one for each shingle among the first ones of both in a common
    order of all shingles, rare ones first; a pair similar enough has such a
    shingle (prefix filter). In a bucket all pairs are compared, text against text,
    unless sizes, places and bitmaps rule them out or they are in one group already. To
    have few pairs in great groups, each bucket is compared with one member
    first. So no pair of similarity 0.8 or more is lost, and none below it linked.
    Many texts that share their rare shingles and are still not similar are
    compared with each other, pair by pair.

    Null and empty texts are copies of each other. Rows without a doc_id take no
    part. Rows that repeat a doc_id are one document.
    """
    docs = docs.filter(F.col("doc_id").isNotNull())
    sketches = settled(_sketch(docs), "sketches")
    classes = settled(
        sketches.groupBy("same").agg(
            F.min("doc_id").alias("id"), *[F.first(c).alias(c) for c in ("n", "keys", "marks", "brief", "fp")]
        ),
        "classes",
    )
    same = settled(sketches.select("doc_id", "same"), "same")
    release(sketches)
    placed = classes.select("id", "n", F.posexplode("keys").alias("at", "key"))
    buckets = placed.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most"))
    shared = settled(placed.join(buckets.filter("least <> most").select("key"), "key"), "shared")
    linked = _linked(settled(_first_of_equal(shared), "buckets"), classes, docs)
    release(shared)
    named = classes.join(linked, classes["id"] == linked["node"], "left").select(
        "same", F.coalesce("component", "id").alias("group_id"), F.col("component").isNotNull().alias("linked")
    )
    groups = settled(
        same.join(named, "same").filter("linked or doc_id <> group_id").select("doc_id", "group_id").distinct(), "groups"
    )
    release(same, classes, linked)
    return groups


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The documents less all but one of each group of ``near_copies``.

    The least doc_id of a group stays. All columns stay as they are. A repeated
    doc_id is left with one row; rows without a doc_id stay.
    """
    again = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1 and doc_id is not null")
    again = settled(again.select("doc_id"), "repeated")
    gone = settled(near_copies(docs).filter("doc_id <> group_id").select("doc_id").distinct(), "gone")
    left = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    once = left.join(again, "doc_id", "left_anti").select(docs.columns)
    first = left.join(again, "doc_id", "left_semi").select(docs.columns).dropDuplicates(["doc_id"])
    return once.unionByName(first)

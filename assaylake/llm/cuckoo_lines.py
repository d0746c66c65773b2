"""Line deduplication with sharded cuckoo filters over exact reference counts.

The exact tables say which document holds which line (postings) and how many do
(reference counts). Cuckoo filters, one for each shard of the keys, answer "surely
not" without them: when lines are dropped, only lines whose key passes the filter of
the repeated keys are looked up; when documents are added to an index, only keys
that pass are joined with what it holds. Cuckoo filters can forget a key, so deleting
documents brings lines back that are no longer repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.llm.common import batch_of, slices, texts_of
from assaylake.session import release, settled

#: A key has at least so many code points, and is repeated from so many documents on.
LEAST_CHARS, LEAST_DOCS = 40, 5
#: Keys of a shard, about, and slots of a bucket.
SHARD_KEYS, SLOTS = 1 << 15, 4
#: Filters of up to so many bytes in all are sent to the tasks that read the texts; greater ones
#: meet the keys by shard, at most about so many keys at once.
MOST_FILTER_BYTES, PROBE_KEYS = 64 << 20, 1 << 20
#: Keys of an index's shard, on average, at which all shards are split; and stashed keys at which a filter is made anew.
FULL_SHARD, MOST_STASHED = 4 * SHARD_KEYS, 64
KICKS = 200

_WHITE = "\x20\x09\x0a\x0b\x0c\x0d"


def line_key(line: str) -> tuple[int, int] | None:
    """128-bit key of a line as two signed 64-bit numbers; none if it is too short.

    White space at the ends is stripped and A-Z lower-cased.
    """
    line = line.strip(_WHITE)
    if len(line) < LEAST_CHARS:
        return None
    digest = xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass").lower())
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


# ---- the filter -------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(20)


class CuckooFilter:
    """Set of keys (hi, lo) that can be added, removed and asked for, with false positives.

    ``slots`` is an array of (buckets, 4) 16-bit marks, 0 for none; a key that finds
    no slot goes to the ``stash``, which is exact.
    """

    def __init__(self, buckets: int, slots: np.ndarray | None = None, stash: set[tuple[int, int]] | None = None):
        if buckets & (buckets - 1):
            raise ValueError("the number of buckets must be a power of two")
        self.buckets = buckets
        self.slots = np.zeros((buckets, SLOTS), np.uint16) if slots is None else slots
        self.stash = stash or set()

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        """With room for so many keys at a load of 80 %."""
        return cls(1 << max(2, int(np.ceil(np.log2(max(1, keys) / (0.8 * SLOTS))))))

    @staticmethod
    def marks(lo: np.ndarray) -> np.ndarray:
        return (lo.astype(np.int64).view(np.uint64) % np.uint64(65535)).astype(np.uint16) + np.uint16(1)

    def places(self, hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Mark and the two buckets of each key."""
        mark = self.marks(lo)
        first = (hi.astype(np.int64).view(np.uint64) >> np.uint64(8)) & np.uint64(self.buckets - 1)
        return mark, first, first ^ (_mixed(mark) & np.uint64(self.buckets - 1))

    def add(self, hi: np.ndarray, lo: np.ndarray) -> None:
        """Each key must be added once only, or removed as often."""
        turn = _mixed(np.arange(65536)) & np.uint64(self.buckets - 1)
        for k, (mark, a, b) in enumerate(zip(*(x.tolist() for x in self.places(hi, lo)), strict=True)):
            at, trail = a, []
            for kick in range(KICKS):
                for bucket in (a, b) if not kick else (at,):
                    free = np.flatnonzero(self.slots[bucket] == 0)
                    if len(free):
                        self.slots[bucket, free[0]] = mark
                        break
                else:
                    # turn one of the bucket's marks out to its other bucket
                    slot = (mark + kick) % SLOTS
                    trail.append((at, slot))
                    mark, self.slots[at, slot] = int(self.slots[at, slot]), mark
                    at ^= int(turn[mark])
                    continue
                break
            else:
                # full: undo the turns, so that no other key is lost
                for bucket, slot in reversed(trail):
                    mark, self.slots[bucket, slot] = int(self.slots[bucket, slot]), mark
                self.stash.add((int(hi[k]), int(lo[k])))

    def remove(self, hi: np.ndarray, lo: np.ndarray) -> None:
        """The keys must have been added."""
        for k, (mark, a, b) in enumerate(zip(*(x.tolist() for x in self.places(hi, lo)), strict=True)):
            if (key := (int(hi[k]), int(lo[k]))) in self.stash:
                self.stash.remove(key)
                continue
            for bucket in (a, b):
                held = np.flatnonzero(self.slots[bucket] == mark)
                if len(held):
                    self.slots[bucket, held[0]] = 0
                    break

    def has(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        mark, a, b = self.places(hi, lo)
        found = ((self.slots[a] == mark[:, None]) | (self.slots[b] == mark[:, None])).any(axis=1)
        if self.stash:
            found |= np.fromiter((k in self.stash for k in zip(hi.tolist(), lo.tolist(), strict=True)), bool, len(hi))
        return found

    def packed(self) -> bytes:
        stash = np.array(sorted(self.stash), np.int64).reshape(-1, 2)
        return np.array([self.buckets, len(stash)], np.int64).tobytes() + stash.tobytes() + self.slots.tobytes()

    @classmethod
    def unpacked(cls, raw: bytes) -> CuckooFilter:
        buckets, n = np.frombuffer(raw, np.int64, 2).tolist()
        stash = {tuple(x) for x in np.frombuffer(raw, np.int64, 2 * n, 16).reshape(-1, 2).tolist()}
        return cls(buckets, np.frombuffer(raw, np.uint16, offset=16 + 16 * n).reshape(-1, SLOTS).copy(), stash)


def shard_of(hi, shards: int):
    """Shard of a key: the same for numpy arrays and for columns."""
    return np.mod(hi, shards) if isinstance(hi, np.ndarray) else F.pmod(hi, F.lit(shards))


def build_filters(keys: DataFrame, shards: int) -> DataFrame:
    """``shard, filter``: a filter of the distinct keys ``hi, lo`` of each shard.

    With ``shards`` in proportion to the number of keys, a shard is a bounded group.
    """

    def build(shard: tuple, held: pa.Table) -> pa.Table:
        hi, lo = held["hi"].to_numpy(), held["lo"].to_numpy()
        made = CuckooFilter.sized(len(hi))
        made.add(hi, lo)
        return pa.table({"shard": [shard[0].as_py()], "filter": pa.array([made.packed()], pa.binary())})

    return keys.select(shard_of(F.col("hi"), shards).alias("shard"), "hi", "lo").groupBy("shard").applyInArrow(
        build, "shard long, filter binary"
    )


# ---- exact tables -----------------------------------------------------------

_POSTINGS = pa.schema([("doc_id", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64())])


def postings(docs: DataFrame, filters=None) -> DataFrame:
    """``doc_id, hi, lo``: the keys of each row's lines, each once.

    ``filters`` is a broadcast (shards, {shard: packed filter}); keys that do not
    pass are left out. Rows without an id have none.
    """

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, held = filters.value if filters is not None else (0, {})
        held = {s: CuckooFilter.unpacked(raw) for s, raw in held.items()}
        for batch in slices(batches, 5000):
            ids, hi, lo = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                for key in {line_key(line) for line in text.split("\n")} - {None}:
                    ids.append(doc_id)
                    hi.append(key[0])
                    lo.append(key[1])
            columns = [np.array(x, np.int64) for x in (ids, hi, lo)]
            if filters is not None:
                shard, passed = shard_of(columns[1], shards), np.zeros(len(ids), bool)
                for s in np.unique(shard).tolist():
                    if s in held:
                        at = np.flatnonzero(shard == s)
                        passed[at] = held[s].has(columns[1][at], columns[2][at])
                columns = [c[passed] for c in columns]
            yield batch_of(_POSTINGS, columns)

    return docs.filter("doc_id is not null").select(
        F.col("doc_id").cast("long"), F.col("text").cast("string")
    ).mapInArrow(read, "doc_id long, hi long, lo long")


def reference_counts(held: DataFrame) -> DataFrame:
    """``hi, lo, n_docs, last_doc``: documents that hold each key, and the largest of them.

    Two steps, first by key and document: rows that repeat a document count once,
    and a key of very many documents is summed by many tasks.
    """
    return (
        held.groupBy("hi", "lo", "doc_id").agg(F.lit(1).alias("one"))
        .groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc"))
    )


def _shards_for(keys: int) -> int:
    return max(1, -(-keys // SHARD_KEYS))


def _probed(keys: DataFrame, filters: DataFrame, shards: int, parts: int) -> DataFrame:
    """The rows of ``doc_id, hi, lo`` whose key passes its shard's filter.

    Keys and filters meet by shard; a shard's keys are dealt over ``parts`` groups by
    their document, so a key that very many documents hold is no group of one task.
    """
    part = F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int")
    dealt = keys.select(shard_of(F.col("hi"), shards).alias("shard"), part.alias("part"), "doc_id", "hi", "lo")
    copies = filters.select("shard", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "filter")

    def probe(keys: pa.Table, filters: pa.Table) -> pa.Table:
        keys = keys.select(["doc_id", "hi", "lo"])
        if not keys.num_rows or not filters.num_rows:
            return _POSTINGS.empty_table()
        held = CuckooFilter.unpacked(filters["filter"][0].as_py())
        passed = held.has(keys["hi"].to_numpy(), keys["lo"].to_numpy())
        return keys.filter(pa.array(passed)).cast(_POSTINGS)

    by = ["shard", "part"]
    return dealt.groupBy(*by).cogroup(copies.groupBy(*by)).applyInArrow(probe, "doc_id long, hi long, lo long")


def droppable(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """``doc_id, hi, lo``: the keys that each document loses, by counts of repeated keys."""
    spark = docs.sparkSession
    n = counts.count()
    shards = _shards_for(n)
    made = build_filters(counts.select("hi", "lo"), shards)
    # two bytes a slot, a load of 40 % at least: the size is known before anything is collected
    if 5 * n <= MOST_FILTER_BYTES:
        sent = spark.sparkContext.broadcast((shards, {r["shard"]: bytes(r["filter"]) for r in made.collect()}))
        maybe = postings(docs, sent)
    else:
        size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col("text").cast("string"))), F.lit(0))).first()[0]
        # a key has LEAST_CHARS bytes at least
        maybe = _probed(postings(docs), settled(made, "filters"), shards, max(1, -(-size // (LEAST_CHARS * shards * PROBE_KEYS))))
    return maybe.join(counts.select("hi", "lo", "last_doc"), ["hi", "lo"]).filter("doc_id <> last_doc").select(
        "doc_id", "hi", "lo"
    )


def cut_lines(docs: DataFrame, lost: DataFrame) -> DataFrame:
    """The documents less the lines of the keys ``lost`` (doc_id, hi, lo).

    ``doc_id, text, n_lines, n_dropped, kept_sha256``; a null text is the empty one.
    """
    # at most as many keys as the document has lines
    keys = lost.distinct().groupBy("doc_id").agg(F.collect_list(F.struct("hi", "lo")).alias("lost"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = pa.schema([
        ("doc_id", pa.int64()), ("text", pa.string()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()),
        ("kept_sha256", pa.string()),
    ])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 5000):
            texts, n_lines, n_dropped = [], [], []
            for text, gone in zip(texts_of(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                lines = text.split("\n")
                gone = {(k["hi"], k["lo"]) for k in gone or ()}
                kept = [x for x in lines if line_key(x) not in gone] if gone else lines
                texts.append("\n".join(kept) if gone else text)
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            digests = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in texts]
            yield batch_of(schema, [batch.column(0), texts, n_lines, n_dropped, digests])

    return rows.join(keys, "doc_id", "left").select("doc_id", "text", "lost").mapInArrow(
        cut, "doc_id long, text string, n_lines long, n_dropped long, kept_sha256 string"
    )


def dedupe_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped, kept_sha256`` of every row.

    A line whose key has at least 40 code points and is found in at least 5
    documents is dropped from all but the largest doc_id that holds it. The rest
    stays, joined by newlines; ``n_lines`` counts before dropping.

    A null or empty text is one empty line. Rows that repeat a doc_id are one
    document and lose the same keys; a key that a document holds twice counts once
    and goes, or stays, as a whole. Rows without an id neither count nor lose
    lines. An empty table gives no rows. Other columns are not read.
    """
    counts = settled(reference_counts(postings(docs)).filter(F.col("n_docs") >= LEAST_DOCS), "line-counts")
    return cut_lines(docs, droppable(docs, counts))


def replace_texts(docs: DataFrame) -> DataFrame:
    """The documents with ``dedupe_lines`` applied to ``text``, and ``n_chars`` to match.

    All other columns stay. Ids should be unique: of rows that repeat one, each gets
    the text of its own.
    """
    lost = droppable(docs, settled(
        reference_counts(postings(docs)).filter(F.col("n_docs") >= LEAST_DOCS), "line-counts"
    ))
    keys = lost.distinct().groupBy("doc_id").agg(F.collect_list(F.struct("hi", "lo")).alias("__lost"))
    schema = docs.schema
    at = docs.columns.index("text")
    counted = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 5000):
            texts, changed = batch.column(at).to_pylist(), []
            for k, gone in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                changed.append(bool(gone))
                if gone:
                    gone = {(x["hi"], x["lo"]) for x in gone}
                    texts[k] = "\n".join(x for x in (texts[k] or "").split("\n") if line_key(x) not in gone)
            columns = [batch.column(k) for k in range(batch.num_columns - 1)]
            columns[at] = pa.array(texts, columns[at].type)
            if counted is not None:
                old = columns[counted].to_pylist()
                new = [len(t) if c else n for t, c, n in zip(texts, changed, old, strict=True)]
                columns[counted] = pa.array(new, columns[counted].type)
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(
                [f.with_type(c.type) for f, c in zip(batch.schema, columns, strict=False)]
            ))

    return docs.join(keys, "doc_id", "left").select(*docs.columns, "__lost").mapInArrow(cut, schema)


class LineIndex:
    """Postings, reference counts and filters of a growing and shrinking corpus.

    Kept as Parquet below ``path``, a new version for each change, the version last
    written being the one in use. One writer is assumed; a change that fails half
    way leaves the former version in use.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.version = spark, path.rstrip("/"), 0

    def _write(self, what: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.path}/{what}/v{self.version + 1}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{what}/v{self.version + 1}")

    def _read(self, what: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{what}/v{self.version}")

    def _shards(self) -> int:
        """Into how many shards the filters in use are cut; it stays as the index grows."""
        return self._read("shards").first()["shards"]

    def _rebuild(self, counts: DataFrame) -> None:
        shards = _shards_for(counts.count())
        self._write("filters", build_filters(counts, shards))
        self._write("shards", self.spark.createDataFrame([(shards,)], "shards long"))

    def insert(self, docs: DataFrame) -> None:
        """Adds documents. One that the index holds already keeps its lines and gets the new ones.

        The filters take the new keys in place. Only a filter that has become full is made
        anew, from the counts of its shard; and all are when the shards have grown too large.
        """
        new = settled(postings(docs).distinct(), "new-postings")
        if not self.version:
            held = self._write("postings", new)
            self._rebuild(self._write("counts", reference_counts(held)))
            self.version += 1
            return
        held, old, filters, shards = self._read("postings"), self._read("counts"), self._read("filters"), self._shards()
        known = new.groupBy("hi", "lo").agg(F.lit(0).cast("long").alias("doc_id"))
        maybe = settled(_probed(known, filters, shards, 1).select("hi", "lo"), "maybe")
        # only rows of keys that the index may hold can be there already
        again = held.join(maybe, ["hi", "lo"], "left_semi")
        fresh = new.join(again, ["doc_id", "hi", "lo"], "left_anti").select("doc_id", "hi", "lo")
        held = self._write("postings", held.select("doc_id", "hi", "lo").unionByName(fresh))
        counts = self._write("counts", reference_counts(held))
        if counts.count() > FULL_SHARD * shards:
            self._rebuild(counts)
        else:
            # keys that do not pass are surely new, the others if the counts do not have them
            strange = known.join(maybe, ["hi", "lo"], "left_anti").select("hi", "lo").unionByName(
                maybe.join(old, ["hi", "lo"], "left_anti")
            )
            self._write("filters", self._taught(filters, strange, counts, shards))
            self._write("shards", self._read("shards"))
        self.version += 1
        release(new, maybe)

    def _taught(self, filters: DataFrame, keys: DataFrame, counts: DataFrame, shards: int) -> DataFrame:
        """The filters with these keys added; a filter without new keys stays as it is."""

        def learn(shard: tuple, filters: pa.Table, keys: pa.Table) -> pa.Table:
            held = [f.as_py() for f in filters["filter"]]
            made = CuckooFilter.unpacked(held[0]) if held else CuckooFilter.sized(keys.num_rows)
            made.add(keys["hi"].to_numpy(), keys["lo"].to_numpy())
            return pa.table({
                "shard": [shard[0].as_py()], "filter": pa.array([made.packed()], pa.binary()),
                "stashed": [len(made.stash)],
            })

        by_shard = keys.select(shard_of(F.col("hi"), shards).alias("shard"), "hi", "lo")
        taught = settled(
            filters.groupBy("shard").cogroup(by_shard.groupBy("shard")).applyInArrow(
                learn, "shard long, filter binary, stashed long"
            ),
            "taught",
        )
        full = taught.filter(F.col("stashed") > MOST_STASHED).select("shard")
        again = counts.withColumn("shard", shard_of(F.col("hi"), shards)).join(full, "shard", "left_semi")
        return taught.filter(F.col("stashed") <= MOST_STASHED).select("shard", "filter").unionByName(
            build_filters(again, shards)
        )

    def delete(self, doc_ids: DataFrame) -> None:
        """Takes documents (column ``doc_id``) out; counts are as if they had never been in.

        The filters forget the keys that no document holds any more, in place.
        """
        held, shards = self._read("postings"), self._shards()
        left = self._write("postings", held.join(doc_ids.select("doc_id").distinct(), "doc_id", "left_anti"))
        old = self._read("counts")
        counts = self._write("counts", reference_counts(left))
        dead = old.join(counts, ["hi", "lo"], "left_anti").select(
            shard_of(F.col("hi"), shards).alias("shard"), "hi", "lo"
        )

        def forget(shard: tuple, filters: pa.Table, keys: pa.Table) -> pa.Table:
            made = CuckooFilter.unpacked(filters["filter"][0].as_py())
            made.remove(keys["hi"].to_numpy(), keys["lo"].to_numpy())
            return pa.table({"shard": [shard[0].as_py()], "filter": pa.array([made.packed()], pa.binary())})

        self._write("filters", self._read("filters").groupBy("shard").cogroup(dead.groupBy("shard")).applyInArrow(
            forget, "shard long, filter binary"
        ))
        self._write("shards", self._read("shards"))
        self.version += 1

    def counts(self) -> DataFrame:
        return self._read("counts")

    def filters(self) -> DataFrame:
        return self._read("filters")

    def dedupe(self, docs: DataFrame) -> DataFrame:
        """``cut_lines`` of the documents by the counts of the index."""
        return cut_lines(docs, droppable(docs, self.counts().filter(F.col("n_docs") >= LEAST_DOCS)))

"""Sharding along a Hilbert curve over several metadata dimensions.

Every dimension is quantised at quantiles of its own values, the cell of a row gets
its place on the Hilbert curve, and the rows in curve order are cut into runs of
equal count. Neighbours on the curve are neighbours in every dimension, so a file
covers a small box and filters on any of the dimensions skip most files.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.llm.common import with_rank

SHARDS = 8
#: Bits of each dimension; dimensions times bits should stay below 15 (cells are counted on the driver).
BITS = 4
#: Accuracy of the quantiles at which a dimension is cut.
ACCURACY = 10_000


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of coordinates (below 2^bits).

    The transposed form of Skilling (2004): undo the rotations from the highest bit
    down, Gray-encode, and interleave the bits.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for bit in range(bits - 1, 0, -1):
        q = 1 << bit
        for i in range(n):
            turned = (x[i] & q) > 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] = np.where(turned, x[0] ^ (q - 1), x[0]) ^ swap
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        q = 1 << bit
        flip ^= np.where(x[n - 1] & q, q - 1, 0)
    x ^= flip
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            index = (index << 1) | ((x[i] >> bit) & 1)
    return index


#: Distinct values of a text dimension, with their counts, from which its edges are taken; and bytes of an edge.
TEXT_VALUES, EDGE_BYTES = 10_000, 256


def _is_text(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.typeName() in ("string", "binary")


def _ordinal(df: DataFrame, name: str) -> Column:
    """The dimension as something that compares in its own order: text as bytes, else a number."""
    return F.col(name).cast("binary" if _is_text(df, name) else "double")


def _text_edges(df: DataFrame, name: str, shares: Sequence[float]) -> list[bytes]:
    """Quantiles of a text dimension, by rank of its whole values.

    Of more than ``TEXT_VALUES`` distinct values a sample by hash is taken, each with
    the number of all its rows. An edge is cut to ``EDGE_BYTES``, which moves it a little.
    """
    values = df.select(_ordinal(df, name).alias("v")).filter("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    some = values.orderBy(F.xxhash64("v"), "v").limit(TEXT_VALUES).select(F.substring("v", 1, EDGE_BYTES).alias("v"), "n")
    rows = sorted((bytes(r["v"]), r["n"]) for r in some.collect())
    if not rows:
        return []
    upto = np.cumsum([n for _, n in rows])
    return [rows[int(np.searchsorted(upto, share * upto[-1]))][0] for share in shares]


def quantise(df: DataFrame, dims: Sequence[str], bits: int = BITS) -> DataFrame:
    """Adds ``__q0``, ``__q1``, ... from 0 to 2^bits - 1, in the order of ``dims``; null is 0.

    The edges of numbers are approximate quantiles over all rows, those of text
    quantiles by rank; they are a few values each.
    """
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    numbers = [d for d in dims if not _is_text(df, d)]
    found = df.agg(F.lit(0), *[
        F.percentile_approx(_ordinal(df, d), shares, ACCURACY).alias(d) for d in numbers
    ]).first()
    for i, d in enumerate(dims):
        edges = sorted(set(_text_edges(df, d, shares) if d not in numbers else found[d] or []))
        above = sum((F.when(_ordinal(df, d) > F.lit(e), 1).otherwise(0) for e in edges), F.lit(0))
        df = df.withColumn(f"__q{i}", above)
    return df


def curve_places(df: DataFrame, dims: Sequence[str], order: Sequence[str], bits: int = BITS) -> tuple[DataFrame, int]:
    """Adds ``__place``, each row's exact place from 0 in curve order, and the number of rows.

    ``order`` tells the rows of a cell apart. A cell with a third of all rows is
    ranked by many tasks.
    """
    spark, n = df.sparkSession, len(dims)
    cells = np.indices((1 << bits,) * n).reshape(n, -1).T
    curve = hilbert_index(cells, bits)
    at = sum((F.col(f"__q{i}") * (1 << bits * (n - 1 - i)) for i in range(n)), F.lit(0))
    df = quantise(df, dims, bits).withColumn("__at", at.cast("long")).drop(*[f"__q{i}" for i in range(n)])
    counts = {r["__at"]: r["n"] for r in df.groupBy("__at").agg(F.count(F.lit(1)).alias("n")).collect()}
    begin, total = [], 0
    for cell in sorted(counts, key=lambda c: curve[c]):
        begin.append((cell, int(curve[cell]), total))
        total += counts[cell]
    begins = spark.createDataFrame(begin, "__at long, __curve long, __begin long")
    ranked = with_rank(df, "__at", counts, order).join(F.broadcast(begins), "__at")  # a row for each cell
    return ranked.withColumn("__place", F.col("__begin") + F.col("__rank")).drop("__at", "__begin", "__rank"), total


def shard(docs: DataFrame, dims: Sequence[str] = ("lang", "source", "n_chars"), shards: int = SHARDS) -> DataFrame:
    """Every document's shard, by the law ``rows``: counts differ by one at the most.

    Columns ``doc_id, size, text_crc32, law, shard, slot, grown_shard, curve``:
    ``size`` is the UTF-8 length of the text plus 1, ``slot`` the place in the shard
    (from 0, in curve order), ``grown_shard`` null under this law, ``curve`` the
    Hilbert index. A null text counts as an empty one, a null dimension as its
    least value. Repeated rows are rows of their own; they follow each other or are
    apart like any two rows of a cell. Extra columns are not read. An empty table
    gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        *[F.col(d).alias(f"__d{i}") for i, d in enumerate(dims)],
    )
    placed, total = curve_places(rows, [f"__d{i}" for i in range(len(dims))], ["doc_id", "text_crc32", "size"])
    number = F.expr(f"(__place * {shards}) div {max(1, total)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", number.cast("int")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("__place") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("__curve").alias("curve"),
    )


def write_shards(docs: DataFrame, path: str, dims: Sequence[str] = ("lang", "source", "n_chars"), shards: int = SHARDS,
                 files: int = 1) -> None:
    """Writes whole documents, in curve order, as ``shard=k`` folders of about ``files`` files.

    ``doc_id`` must be unique and not null; it joins the rows with their places.
    """
    places = shard(docs, dims, shards).select("doc_id", F.col("shard").alias("__shard"), F.col("slot").alias("__slot"))
    rows = docs.join(places, "doc_id")
    (
        rows.repartitionByRange(shards * files, "__shard", "__slot").sortWithinPartitions("__shard", "__slot")
        .withColumnRenamed("__shard", "shard").drop("__slot").write.partitionBy("shard").parquet(path)
    )

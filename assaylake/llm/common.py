"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A chunk of a ranked group has at least so many rows.
LEAST_CHUNK = 128


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


#: Rows of whole texts that a Python worker gets at once.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> SparkSession:
    """Let Python workers get ``BATCH_ROWS`` rows at a time, where the session has Spark's own 10,000.

    That number is meant for short rows; ten thousand whole texts are tens of
    megabytes, held several times over by the executor and its workers.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, "10000") == "10000":
        spark.conf.set(key, str(BATCH_ROWS))
    return spark


def texts_of(column: pa.Array) -> list[str]:
    """The texts of a batch; null is the empty text."""
    return [x or "" for x in column.to_pylist()]


def utf8_of(column: pa.Array) -> list[bytes]:
    """The texts of a batch as UTF-8; null is the empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def batch_of(schema: pa.Schema, columns: Sequence) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )


def slices(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows, which bounds a kernel's memory."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def byte_slices(
    batches: Iterable[pa.RecordBatch], column: str, most: int = 1 << 20
) -> Iterator[pa.RecordBatch]:
    """The batches in pieces whose texts have about ``most`` bytes at the most.

    A single longer text is a piece of its own, and whole.
    """
    for batch in batches:
        sizes = np.array([0 if x is None else x for x in pc.binary_length(batch[column]).to_pylist()])
        first, total = 0, 0
        for at, size in enumerate(sizes):
            if total and total + size > most:
                yield batch.slice(first, at - first)
                first, total = at, 0
            total += int(size)
        if first < batch.num_rows:
            yield batch.slice(first)


def with_rank(df: DataFrame, key: str, counts: dict, order: Sequence[str]) -> DataFrame:
    """``__rank``: each row's place, from 0, among the rows of its ``key``.

    ``counts`` has the rows of each key; there must be few keys (thousands), as
    the counts are on the driver. A key's rows are dealt by a hash of ``order``
    into chunks, so that a key with a third of all rows is ranked by many tasks;
    places are by chunk and then by ``order``. Rows that are equal in ``order``
    may swap places. A null key is a key like any other.
    """
    spark = df.sparkSession
    total = sum(counts.values())
    chunk = max(LEAST_CHUNK, total // (8 * shuffle_partitions(spark)))
    kind = df.schema[key].dataType.simpleString()
    dealt = spark.createDataFrame(
        [(k, -(-n // chunk)) for k, n in counts.items()], f"__key {kind}, __chunks long"
    )
    df = df.join(F.broadcast(dealt), F.col(key).eqNullSafe(F.col("__key")))
    df = df.withColumn("__chunk", F.pmod(F.xxhash64(*order), F.col("__chunks"))).drop("__chunks")
    inside = Window.partitionBy("__key", "__chunk").orderBy(*order)
    before = Window.partitionBy("__key").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        df.groupBy("__key", "__chunk").agg(F.count(F.lit(1)).alias("__n"))
        .select(
            F.col("__key").alias("__k"),
            F.col("__chunk").alias("__c"),
            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"),
        )
    )
    ranked = df.withColumn("__place", F.row_number().over(inside) - 1)
    on = F.col("__key").eqNullSafe(F.col("__k")) & (F.col("__chunk") == F.col("__c"))
    return ranked.join(starts, on).withColumn("__rank", F.col("__start") + F.col("__place")).drop(
        "__key", "__chunk", "__k", "__c", "__start", "__place"
    )

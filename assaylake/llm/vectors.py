"""Integer vectors: what the vector operators compute with, exactly."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256
#: Doubles hold all integers up to this size; components beyond it are cut off at it.
MOST = 1 << 53
_LONG = (1 << 63) - 1


def finite(vector: str) -> Column:
    """Whether there is a vector, without null or non-finite components."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & ~odd, F.lit(False))


def scaled(vector: str, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component x as a double, within ``MOST``."""
    limit = lambda x: F.greatest(F.lit(float(-MOST)), F.least(F.lit(float(MOST)), x))
    return F.transform(vector, lambda x: F.floor(limit(x.cast("double") * F.lit(float(scale)))).cast("long"))


def integer_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, v`` of the rows whose ``embedding`` is finite."""
    return rows.filter(finite("embedding")).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        scaled("embedding", scale).alias("v"),
    )


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The vectors as rows of ``dims`` integers; shorter ones go on with zeros."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = np.fromiter((0 if n is None else n for n in pc.list_value_length(column).to_pylist()), np.int64)
    if (lengths == dims).all():
        return values.reshape(-1, dims)
    out = np.zeros((len(lengths), dims), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def fits_long(most: int, terms: int) -> bool:
    """Whether sums of ``terms`` products of numbers up to ``most`` are exact in 64 bits."""
    return most * most * max(1, terms) < 1 << 62


def clipped(values: np.ndarray) -> np.ndarray:
    """Python integers as longs; what does not fit is the nearest long."""
    if values.dtype != object:
        return values.astype(np.int64)
    return np.frompyfunc(lambda x: max(-_LONG, min(_LONG, int(x))), 1, 1)(values).astype(np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of the rows of two integer matrices, exact, as longs."""
    most = int(max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)))
    if most * most * a.shape[1] < MOST:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if fits_long(most, a.shape[1]):
        return a @ b.T
    return clipped(a.astype(object) @ b.astype(object).T)


def blocks(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The batches joined into tables of about ``rows`` rows."""
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)

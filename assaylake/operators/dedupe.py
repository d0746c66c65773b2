"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def latest_order(df: DataFrame, latest_by: Sequence[str], skip: Sequence[str] = ()) -> list[Column]:
    """Sort keys, newest first. All other columns follow as tie-breakers."""
    lead = [c for c in latest_by if c in df.columns]
    rest = [
        f.name for f in df.schema.fields
        if f.name not in lead and f.name not in skip and _orderable(f.dataType)
    ]
    return [F.col(f"`{c}`").desc_nulls_last() for c in [*lead, *rest]]


def latest_rows(df: DataFrame, keys: str | Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    """Keep the newest row of each key; null keys collapse to one row.

    The rank filter becomes a WindowGroupLimit on both sides of the exchange:
    each task keeps one row per key before it shuffles, so a key that holds a
    large share of the rows costs no more than any other.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*latest_order(df, latest_by, skip=keys))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def duplicates_removed(df: DataFrame, key: str) -> DataFrame:
    """Rows that one-row-per-key would drop; null counts as one key.

    Only the key column is read, and repeated keys are combined before the
    shuffle.
    """
    per_key = df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0).cast("long")).alias("duplicates_removed"),
    )

"""Counts and null profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column, in one pass over just these columns."""
    columns = list(columns or df.columns)
    return df.select(*[F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(c) for c in columns])


def row_count(df: DataFrame, name: str = "filas") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One labelled count per table, as one plan."""
    return reduce(
        DataFrame.unionAll,
        [row_count(df).select(F.lit(name).alias("tabla"), "filas") for name, df in tables.items()],
    )


def table_counts(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """Counts of catalog tables; a missing table is reported, not fatal."""
    parts = []
    for t in tables:
        if spark.catalog.tableExists(t):
            counted = row_count(spark.table(t)).select(
                F.lit(t).alias("tabla"), "filas", F.lit(None).cast("string").alias("error")
            )
        else:
            counted = spark.range(1).select(
                F.lit(t).alias("tabla"), F.lit(None).cast("long").alias("filas"),
                F.lit("table not found").alias("error"),
            )
        parts.append(counted)
    return reduce(DataFrame.unionAll, parts)

"""Lenient casts that keep what they could not read.

A value that a cast turns into null is lost. Here it is kept: one pass casts the rows,
notes the values that were lost, and writes rows with and without such values into two
partitions of one dataset. The load goes on with the accepted rows, and the rejected
ones tell the column and the raw value.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake.functions.columns import coerce, utf8_text

#: Partition column of the written dataset, and the list of what a row has lost.
REJECTED, LOST = "_rejected", "_lost"


class Split(NamedTuple):
    accepted: DataFrame
    #: The same columns, and ``_lost``: structs of ``column`` and ``raw``.
    rejected: DataFrame

    def values(self, *keys: str) -> DataFrame:
        """``keys..., column, raw``: one row for each value that was lost."""
        return self.rejected.select(*keys, F.explode(LOST).alias("_v")).select(*keys, "_v.column", "_v.raw")

    def summary(self) -> DataFrame:
        """``column, values``: how many values each column has lost."""
        return self.values().groupBy("column").agg(F.count(F.lit(1)).alias("values"))


def lost_values(df: DataFrame, types: Mapping[str, str]) -> Column:
    """What casting the columns to these types would lose, as an array; blank text is no value."""
    found = []
    for name, target in types.items():
        raw, source = F.col(f"`{name}`"), df.schema[name].dataType
        text = utf8_text(raw) if isinstance(source, T.BinaryType) else raw.cast("string")
        gone = raw.isNotNull() & (F.trim(text) != "") & coerce(raw, source, target).isNull()
        found.append(F.when(gone, F.struct(F.lit(name).alias("column"), text.alias("raw"))))
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def quarantine(df: DataFrame, types: Mapping[str, str], path: str) -> Split:
    """Cast the columns, write all rows below ``path`` in one pass, and read them back as two frames.

    Every row is in one of the two. Without columns to cast all rows are accepted.
    """
    types = {c: t for c, t in types.items() if c in df.columns}
    cast = {c: coerce(F.col(f"`{c}`"), df.schema[c].dataType, t) for c, t in types.items()}
    lost = lost_values(df, types) if types else F.array().cast("array<struct<column:string,raw:string>>")
    marked = df.withColumns({LOST: lost, **cast})  # all expressions read the raw columns
    marked = marked.withColumn(REJECTED, (F.size(LOST) > 0).cast("int"))
    marked.write.mode("overwrite").partitionBy(REJECTED).parquet(path)
    back = df.sparkSession.read.schema(marked.schema).parquet(path)
    accepted, rejected = (back.filter(F.col(REJECTED) == k).drop(REJECTED) for k in (0, 1))
    return Split(accepted.drop(LOST), rejected)

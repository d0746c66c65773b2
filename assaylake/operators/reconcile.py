"""Comparing two large tables by a tree of digests.

Both tables are cut into ranges of the key's hash. A range's digest is its number of
rows, the exclusive or of their hashes and a sum of other hashes, none of which depends
on order; a task sends one row for each range. Ranges whose digests agree are
done with. Those that differ are cut again, and only the rows of the ranges that
still differ are grouped by key and joined. So equal tables are read once and
nothing large is shuffled, and few differences shuffle few rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ranges that a table, and then a differing range, is cut into.
FAN = 256
_SALT = 1


def _hash(columns: Sequence[Column], salt: int = 0) -> Column:
    """Hash of values; a null counts, so values cannot trade places with nulls."""
    return F.xxhash64(F.lit(salt), *columns, *[c.isNull() for c in columns])


def _digest(prefix: str, row: Sequence[Column]) -> list[Column]:
    return [
        F.count(F.lit(1)).alias(f"{prefix}_rows"),
        F.bit_xor(_hash(row)).alias(f"{prefix}_xor"),
        F.sum(F.pmod(_hash(row, _SALT), F.lit(1 << 31))).alias(f"{prefix}_sum"),
    ]


def _apart(left: DataFrame, right: DataFrame, by: Sequence[str], row: Sequence[str]) -> DataFrame:
    """Groups of ``by`` whose digests differ, with both digests; groups are few or hold few rows."""
    columns = [F.col(f"`{c}`") for c in row]
    one = left.groupBy(*by).agg(*_digest("left", columns)).alias("l")
    two = right.groupBy(*by).agg(*_digest("right", columns)).alias("r")
    same = reduce(and_, [F.col(f"l.`{c}`").eqNullSafe(F.col(f"r.`{c}`")) for c in by])
    differs = reduce(or_, [~F.col(f"left_{d}").eqNullSafe(F.col(f"right_{d}")) for d in ("rows", "xor", "sum")])
    return one.join(two, same, "full_outer").filter(differs).select(
        *[F.coalesce(f"l.`{c}`", f"r.`{c}`").alias(c) for c in by],
        F.coalesce("left_rows", F.lit(0)).alias("left_rows"),
        F.coalesce("right_rows", F.lit(0)).alias("right_rows"),
    )


def table_differences(
    left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, fan: int = FAN
) -> DataFrame:
    """``keys..., left_rows, right_rows, changed`` of all keys whose rows differ.

    ``columns`` (default: all of ``left``) are compared, those of ``right`` cast to the
    types of ``left``. The rows of a key are compared as a bag: repeated keys and rows
    count as often as they are there, and null keys are keys like any other.
    ``changed`` names the columns whose values differ, joined by commas, where both
    tables have the key. Hashes decide, of 64 and 31 bits and with the number of rows.
    """
    keys = list(keys)
    columns = [c for c in (left.columns if columns is None else columns) if c not in keys]
    types = left.schema
    place = _hash([F.col(f"`{k}`") for k in keys], 2)

    def placed(df: DataFrame) -> DataFrame:
        values = [F.col(f"`{c}`").cast(types[c].dataType).alias(c) for c in (*keys, *columns)]
        return df.select(*values).withColumns({
            "__range": F.pmod(place, F.lit(fan)).cast("int"),
            "__part": F.pmod(F.shiftright(place, 32), F.lit(fan)).cast("int"),
        })

    one, two = placed(left), placed(right)
    whole = [*keys, *columns]
    # at most ``fan`` numbers
    ranges = [r["__range"] for r in _apart(one, two, ["__range"], whole).select("__range").collect()]
    inside = F.col("__range").isin(*ranges) if ranges else F.lit(False)
    one, two = one.filter(inside), two.filter(inside)
    # at most ``fan`` squared rows of two numbers
    parts = F.broadcast(_apart(one, two, ["__range", "__part"], whole).select("__range", "__part"))
    one, two = (df.join(parts, ["__range", "__part"], "left_semi") for df in (one, two))
    found = _apart(one, two, keys, whole)
    if not columns:
        return found.withColumn("changed", F.lit(""))

    def by_column(df: DataFrame, side: str) -> DataFrame:
        digests = [F.sum(F.pmod(_hash([F.col(f"`{c}`")]), F.lit(1 << 31))).alias(f"{side}{n}") for n, c in enumerate(columns)]
        return df.groupBy(*keys).agg(*digests)

    def joined(df: DataFrame, other: DataFrame) -> DataFrame:
        same = reduce(and_, [F.col(f"f.`{k}`").eqNullSafe(F.col(f"o.`{k}`")) for k in keys])
        return df.alias("f").join(other.alias("o"), same, "left").select("f.*", *[
            F.col(f"o.`{c}`") for c in other.columns if c not in keys
        ])

    found = joined(joined(found, by_column(one, "__l")), by_column(two, "__r"))
    differs = [F.when(F.col(f"__l{n}") != F.col(f"__r{n}"), F.lit(c)) for n, c in enumerate(columns)]
    return found.select(*keys, "left_rows", "right_rows", F.concat_ws(",", *differs).alias("changed"))

"""Extracts from raw source files or a database: head, one year, projection.

Row caps are optional and off by default. A capped extract is the first ``n``
rows in key order, so that it does not depend on file layout.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake.functions.columns import coerce, in_year
from assaylake.operators.dedupe import latest_order


# shares of the rows that the first key is looked up at
_RANGES = 1000
# rank error of the approximate percentile, as a share of all rows: 1 / accuracy
_ACCURACY = 10_000


def _ordinal(key: Column, dtype: T.DataType) -> Column:
    """A number that never falls when the key rises; of text, the first seven bytes."""
    if isinstance(dtype, T.StringType):
        head = F.rpad(F.hex(F.substring(key.cast("binary"), 1, 7)), 14, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(key).cast("double")
    if isinstance(dtype, T.DateType):
        return F.unix_date(key).cast("double")
    return key.cast("double")


def first_rows(
    df: DataFrame, n: int | None, order_by: str | Sequence[str], as_type: str | None = None
) -> DataFrame:
    """First ``n`` rows by the key columns; other columns break ties.

    ``as_type`` is the type in which the first key is ordered, for numbers that
    arrive as text; what cannot be read as that comes last, as nulls do.

    Two percentiles of the first key, next to the n-th row, cut the rows into ranges, which are
    counted. Rows of the ranges that fit into ``n`` are taken by a filter where they are
    read, however many they are; only the range in which the n-th row falls is put in order.
    """
    if n is None:
        return df
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    first = F.col(f"`{keys[0]}`")
    dtype = df.schema[keys[0]].dataType
    if as_type is not None:
        first, dtype = coerce(first, dtype, as_type), T._parse_datatype_string(as_type)
    place = _ordinal(first, dtype)
    shares = [k / _RANGES for k in range(1, _RANGES)]
    found, total = df.agg(F.percentile_approx(place, shares, _ACCURACY), F.count(place)).first()
    # the percentiles on both sides of the n-th row, one further off than the rank error
    at = math.floor(n * _RANGES / max(total, 1)) - 1
    edges = sorted({found[k] for k in (at - 1, at + 2) if 0 <= k < len(found)}) if found else []
    # range r holds the rows above edge r - 1 up to edge r; nulls are after all
    number = F.when(place.isNull(), F.lit(len(edges) + 1)).otherwise(
        reduce(add, [(place > F.lit(e)).cast("int") for e in edges], F.lit(0))
    )
    counts = dict(df.groupBy(number.alias("r")).count().collect())  # a row for each range
    left = n
    for r in range(len(edges) + 2):
        if counts.get(r, 0) > left:
            break
        left -= counts.get(r, 0)
    else:
        return df
    ties = latest_order(df, (), skip=keys)
    order = [first.asc_nulls_last(), *[F.col(f"`{k}`").asc_nulls_last() for k in keys], *ties]
    if r > len(edges):
        whole, inside = place.isNotNull(), place.isNull()
    else:
        whole = place <= F.lit(edges[r - 1]) if r else F.lit(False)
        inside = place.isNotNull()
        if r:
            inside &= place > F.lit(edges[r - 1])
        if r < len(edges):
            inside &= place <= F.lit(edges[r])
    return df.filter(whole).unionByName(df.filter(inside).orderBy(*order).limit(left))


def extract_head(df: DataFrame, n: int | None, order_by: str | Sequence[str]) -> DataFrame:
    return first_rows(df, n, order_by)


def extract_year(
    df: DataFrame,
    year: int,
    date_col: str = "CreationDate",
    columns: Sequence[str] | None = None,
    n: int | None = None,
    order_by: str | Sequence[str] = "Id",
) -> DataFrame:
    """Rows of one calendar year, projected early and optionally capped."""
    rows = df.filter(in_year(F.col(date_col), df.schema[date_col].dataType, year))
    if columns is not None:
        rows = rows.select(*columns)
    return first_rows(rows, n, order_by)


def extract_years(
    df: DataFrame, years: Sequence[int], date_col: str = "CreationDate"
) -> DataFrame:
    """Several whole years in one scan, tagged with ``anio``; no cap, no shuffle."""
    c, source = F.col(date_col), df.schema[date_col].dataType
    tagged = df.withColumn("anio", F.year(coerce(c, source, "timestamp")).cast("int"))
    if isinstance(source, T.DatetimeType):
        # one range per year, which the scan can use
        return tagged.filter(reduce(or_, [in_year(c, source, y) for y in years]))
    return tagged.filter(F.col("anio").isin(*years))


def source_year_count(df: DataFrame, year: int, date_col: str = "CreationDate") -> DataFrame:
    """How many source rows a year holds; reads the date column only."""
    return df.filter(in_year(F.col(date_col), df.schema[date_col].dataType, year)).agg(
        F.count(F.lit(1)).alias("cnt")
    )


def year_query(
    table: str,
    columns: Sequence[str],
    year: int,
    date_col: str = "CreationDate",
    n: int | None = None,
    order_by: str = "Id",
) -> str:
    """The extract as SQL for the source: projection, year range, optional cap."""
    query = (
        f"SELECT {', '.join(columns)} FROM {table} "
        f"WHERE {date_col} >= '{year:04d}-01-01' AND {date_col} < '{year + 1:04d}-01-01'"
    )
    return query if n is None else f"{query} ORDER BY {order_by} LIMIT {n}"


def jdbc_year(
    spark: SparkSession,
    url: str,
    table: str,
    columns: Sequence[str],
    year: int,
    date_col: str = "CreationDate",
    key: str = "Id",
    key_range: tuple[int, int] | None = None,
    partitions: int = 1,
    n: int | None = None,
    **options: str,
) -> DataFrame:
    """The same extract from a database, which does the projection and filter.

    With ``key_range`` the rows are read by ``partitions`` parallel connections,
    split by the key; a cap is then applied in Spark.
    """
    parallel = key_range is not None
    wanted = list(dict.fromkeys([*columns, key])) if parallel else list(columns)
    query = year_query(table, wanted, year, date_col, None if parallel else n, key)
    reader = spark.read.format("jdbc").options(url=url, dbtable=f"({query}) src", **options)
    if not parallel:
        return reader.load()
    reader = reader.options(
        partitionColumn=key, lowerBound=key_range[0], upperBound=key_range[1],
        numPartitions=partitions,
    )
    return first_rows(reader.load(), n, key).select(*columns)

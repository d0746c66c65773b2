"""Column expressions. All of them are built-ins, so they stay in codegen."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake import specs


def ts_lit(value: str | datetime) -> Column:
    """A load time as a literal. Text goes through the session zone (UTC)."""
    if isinstance(value, datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(value).cast("timestamp")


def utf8_text(c: Column) -> Column:
    """Raw bytes as text; malformed sequences become the replacement sign."""
    return F.make_valid_utf8(c.cast("string"))


def coerce(c: Column, source: T.DataType, target: str) -> Column:
    """Cast that yields null where the value cannot be read.

    Text such as '12.7' read as a whole number is truncated, as a cast without
    ANSI checks does. It goes through a decimal, which costs a failed row far
    less than a failed whole-number cast.
    """
    if isinstance(source, T.BinaryType):
        c, source = utf8_text(c), T.StringType()
    if target == "string":
        return c.cast("string")
    if target in ("long", "int") and isinstance(source, T.StringType):
        return c.try_cast("decimal(38,18)").try_cast(target)
    if target == "timestamp" and isinstance(source, T.StringType):
        return F.try_to_timestamp(c)
    if target == "timestamp" and isinstance(source, T.NumericType):
        return c.try_cast("double").try_cast("timestamp")
    return c.try_cast(target)


def in_year(c: Column, source: T.DataType, year: int) -> Column:
    """True for rows of one calendar year.

    On date and time columns this is a range with literals of the column's own
    type, so that it is pushed into the Parquet scan. Text is parsed; what does
    not parse drops out.
    """
    if isinstance(source, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        bound = source.simpleString()
        return (c >= F.lit(f"{year:04d}-01-01").cast(bound)) & (
            c < F.lit(f"{year + 1:04d}-01-01").cast(bound)
        )
    return F.year(coerce(c, source, "timestamp")) == F.lit(year)


def post_type_label(c: Column) -> Column:
    label = F.lit(specs.OTHER_POST_TYPE)
    for code, text in reversed(specs.POST_TYPES.items()):
        label = F.when(c == code, F.lit(text)).otherwise(label)
    return label


def count_if(condition: Column) -> Column:
    """Sum of 1 for matching rows and 0 for the others (0, not null, if none)."""
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0)))


def sum_or_zero(c: Column | str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0).cast("long"))


def or_zero(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0).cast("long"))


def merge_key(*parts: str) -> Column:
    """Composite key as text; null parts are left out."""
    return F.concat_ws("_", *[F.col(p).cast("string") for p in parts])

"""Bring bronze frames to the canonical schema of their entity."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake import specs
from assaylake.functions.columns import coerce, ts_lit
from assaylake.specs import EntitySpec

def normalize(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """Rename, decode, cast and order the columns in one projection.

    Known columns come first in canonical order, absent ones as typed nulls.
    Unknown columns are dropped or, for pass-through entities, kept after the
    known ones. Two input columns with one canonical name are an error.
    """
    found: dict[str, T.StructField] = {}
    extra: list[T.StructField] = []
    for f in df.schema.fields:
        name = spec.canonical(f.name)
        if name is None:
            extra.append(f)
        elif name in found:
            raise ValueError(
                f"{spec.entity}: columns {found[name].name!r} and {f.name!r} both mean {name!r}"
            )
        else:
            found[name] = f

    cols = []
    for name, target in spec.columns.items():
        if name in found:
            f = found[name]
            cols.append(coerce(df[f"`{f.name}`"], f.dataType, target).alias(name))
        else:
            cols.append(F.lit(None).cast(target).alias(name))
    for f in extra if spec.passthrough else []:
        c = df[f"`{f.name}`"]
        # a column without any value has no type that Parquet could store
        cols.append(c.cast("string").alias(f.name) if isinstance(f.dataType, T.NullType) else c)
    return df.select(*cols)


def coerce_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Lenient casts of some columns in place; unreadable values become null."""
    return df.withColumns(
        {c: coerce(F.col(c), df.schema[c].dataType, t) for c, t in types.items() if c in df.columns}
    )


def fill_defaults(df: DataFrame, spec: EntitySpec) -> DataFrame:
    return df.fillna(spec.fills)


def add_load_metadata(
    df: DataFrame,
    load_ts,
    source: str = specs.SOURCE_NAME,
    ts_col: str = "fecha_cargue",
    source_col: str = "fuente",
) -> DataFrame:
    """Load time and origin. One literal per run, so that retries agree."""
    return df.withColumns({ts_col: ts_lit(load_ts), source_col: F.lit(source)})


def to_silver(df: DataFrame, spec: EntitySpec, load_ts, source: str = specs.SOURCE_NAME) -> DataFrame:
    """Normalised, filled and stamped rows; duplicates are still present."""
    return add_load_metadata(fill_defaults(normalize(df, spec), spec), load_ts, source)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Union that fills absent columns with null. Narrow: no shuffle."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_positional(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, frames)

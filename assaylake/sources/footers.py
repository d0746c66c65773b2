"""Row counts and ranges of values from Parquet footers.

Spark's newer Parquet reader can answer counts, minima and maxima from the statistics in
the files' footers. No column is read; for a folder of years, each year is
a group of its own. The reader is chosen for these plans only.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

#: Types whose statistics are exact and of one order: no text, which may be cut off, and no doubles, for NaN.
EXACT = {"boolean", "tinyint", "smallint", "int", "bigint", "date"}
_SETTINGS = {"spark.sql.parquet.aggregatePushdown": "true"}


@contextmanager
def pushed_aggregates(spark: SparkSession) -> Iterator[None]:
    """While this lasts, aggregates over Parquet are answered from footers where that is possible."""
    sources = spark.conf.get("spark.sql.sources.useV1SourceList")
    settings = {
        **_SETTINGS,
        "spark.sql.sources.useV1SourceList": ",".join(s for s in sources.split(",") if s.strip() != "parquet"),
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def footer_plan(spark: SparkSession, path: str, columns: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """The aggregate itself, to be planned and run inside ``pushed_aggregates``."""
    df = spark.read.parquet(path)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    unfit = [c for c in columns if kinds.get(c) not in EXACT]
    if unfit:
        raise ValueError(f"no exact statistics in footers for {unfit}")
    found = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *found)


def footer_profile(spark: SparkSession, path: str, columns: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """``by..., rows, min_c, max_c, ...`` of a Parquet dataset, from its footers.

    ``columns`` are whole numbers, dates or booleans; ``by`` are partition columns. There is one row for each
    partition value, which the driver holds anyway to list the files. An empty
    dataset has 0 rows and null ranges; nulls do not count for ranges. A file in which a
    column has nulls only has no range in its footer; then the columns are read.
    """
    try:
        with pushed_aggregates(spark):
            plan = footer_plan(spark, path, columns, by)
            rows, schema = plan.collect(), plan.schema
    except Exception as e:
        if not columns or "FAILED_READ_FILE" not in str(e):
            raise
        log.warning("no ranges in some footers, columns are read: %s", path)
        plan = footer_plan(spark, path, columns, by)
        rows, schema = plan.collect(), plan.schema
    # files without rows have nothing to add up
    at = schema.names.index("rows")
    found = [(*r[:at], r[at] or 0, *r[at + 1 :]) for r in rows]
    literal = lambda r: F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, schema.fields, strict=True)])
    if not found:
        return spark.range(0).select(literal([None] * len(schema.fields)).alias("r")).select("r.*")
    return spark.range(1).select(F.inline(F.array(*map(literal, found))))

"""Bronze datasets: path convention, readers and writers."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake import specs
from assaylake.operators.normalize import union_by_name

log = logging.getLogger(__name__)

# error conditions of a dataset that is not there, or was never finished
_ABSENT = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def bronze_path(base: str, entity: str, year: int | None = None) -> str:
    """``{base}/{entity}/{year}/{entity}_{year}.parquet``, or ``all`` unsplit."""
    base = base.rstrip("/")
    if year is None:
        return f"{base}/{entity}/all/{entity}.parquet"
    return f"{base}/{entity}/{year}/{entity}_{year}.parquet"


def year_partition_path(base: str, entity: str, year: int) -> str:
    """Folder of one year in a dataset written by ``write_year_partitions``."""
    return f"{base.rstrip('/')}/{entity}/anio={year}"


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The dataset, or None when nothing is there. Other errors are raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in _ABSENT:
            return None
        raise


def is_finished(spark: SparkSession, path: str) -> bool:
    """Whether a dataset was written to its end: a single file, or a folder with ``_SUCCESS``."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(jpath):
        return False
    return not fs.getFileStatus(jpath).isDirectory() or fs.exists(
        spark._jvm.org.apache.hadoop.fs.Path(jpath, "_SUCCESS")
    )


def read_raw(spark: SparkSession, path: str, type_of: Callable[[str], str | None]) -> DataFrame:
    """A foreign file; times in nanoseconds become timestamps.

    Spark refuses such times unless they are read as long. ``type_of`` tells the type
    that a column should have, if it is known; a column that should be a timestamp
    and arrives as a long from such a file has nanoseconds.
    """
    try:
        return spark.read.parquet(path)
    except Exception as e:
        if "PARQUET_TYPE_ILLEGAL" not in str(e) and "TIMESTAMP(NANOS" not in str(e):
            raise
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    df = spark.read.parquet(path)
    return nanos_to_timestamp(df, *[
        f.name for f in df.schema.fields
        if type_of(f.name) == "timestamp" and f.dataType.simpleString() == "bigint"
    ])


def read_years(
    spark: SparkSession,
    base: str,
    entity: str,
    years: Sequence[int] = specs.DEFAULT_YEARS,
    on_missing: str = "raise",
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    path_of: Callable[[str, str, int], str] = bronze_path,
) -> DataFrame:
    """All years as one frame, each row tagged with its literal ``anio``.

    ``on_missing='raise'`` stops at an unreadable year, ``'skip'`` warns and
    goes on; nothing read at all is always an error. ``prepare`` runs on each
    year before the union, so that years of differing types still fit. The loop
    only builds the plan: scans are lazy and the union does not shuffle.
    """
    if on_missing not in ("raise", "skip"):
        raise ValueError(f"on_missing: {on_missing!r}")
    frames = []
    for year in years:
        path = path_of(base, entity, year)
        df = read_if_present(spark, path)
        if df is None:
            if on_missing == "raise":
                raise FileNotFoundError(f"bronze {entity} {year}: {path}")
            log.warning("bronze %s %s skipped: nothing at %s", entity, year, path)
            continue
        df = prepare(df) if prepare else df
        frames.append(df.withColumn("anio", F.lit(year).cast("int")))
    if not frames:
        raise RuntimeError(f"no bronze data for {entity}")
    return union_by_name(frames)


def read_year_partitions(
    spark: SparkSession, base: str, entity: str, years: Sequence[int] | None = None
) -> DataFrame:
    """Years of one schema, written by ``write_year_partitions``, in one scan.

    ``anio`` comes from the folder names, and folders of other years are not read.
    """
    df = spark.read.parquet(f"{base.rstrip('/')}/{entity}")
    df = df.withColumn("anio", F.col("anio").cast("int"))
    return df if years is None else df.filter(F.col("anio").isin(*years))


def read_all(spark: SparkSession, base: str, entity: str) -> DataFrame:
    """An entity that is not split by year."""
    path = bronze_path(base, entity)
    df = read_if_present(spark, path)
    if df is None:
        raise FileNotFoundError(f"bronze {entity}: {path}")
    return df


def nanos_to_timestamp(df: DataFrame, *columns: str) -> DataFrame:
    """Foreign nanosecond times, read as long, to timestamps.

    For files read under ``spark.sql.legacy.parquet.nanosAsLong``.
    """
    return df.withColumns(
        {c: F.timestamp_micros(F.floor(F.col(c) / F.lit(1000)).cast("long")) for c in columns}
    )


def write_bronze(df: DataFrame, path: str, overwrite: bool = True, skip_empty: bool = True) -> bool:
    """Write one bronze dataset; tells whether anything was written.

    ``overwrite=False`` leaves a finished dataset alone. An empty frame is
    skipped with a warning.
    """
    if not overwrite and is_finished(df.sparkSession, path):
        log.info("already there: %s", path)
        return False
    if skip_empty and df.isEmpty():
        log.warning("empty, skipped: %s", path)
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def write_year_partitions(
    df: DataFrame, base: str, entity: str, year_col: str = "anio", rebalance: bool = False
) -> None:
    """All years in one pass over the input, one folder per year.

    Input that is already ordered by time is written as it lies. With
    ``rebalance`` rows of one year are brought together first, which keeps the
    files few when years are mixed; a year that holds much of the data is split
    over several tasks.
    """
    df = df.withColumnRenamed(year_col, "anio")
    if rebalance:
        df = df.hint("rebalance", F.col("anio"))
    df.write.mode("overwrite").partitionBy("anio").parquet(f"{base.rstrip('/')}/{entity}")


def input_fingerprints(spark: SparkSession, inputs: Mapping[int, str]) -> DataFrame:
    """``anio, files, bytes, digest`` of each year's input, from the listing of its files.

    The digest is of paths, lengths and times, in any order. File contents stay unread.
    """
    frames = [
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        .load(path).select(F.lit(year).cast("int").alias("anio"), "path", "length", "modificationTime")
        for year, path in inputs.items()
    ]
    return reduce(DataFrame.unionAll, frames).groupBy("anio").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"),
        F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("digest"),
    )


def refresh_years(
    spark: SparkSession,
    inputs: Mapping[int, str],
    base: str,
    entity: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> list[int]:
    """Bring a dataset of years (``write_year_partitions``) up to date with its inputs; the years that were written.

    A year is stale if its input's fingerprint is not the one noted when it was
    written. Stale years are written in one pass and replace their folders; files of
    other years are not touched. A year without input files, or whose input has no rows, keeps what it has.
    """
    if not inputs:
        return []
    target, noted = f"{base.rstrip('/')}/{entity}", f"{base.rstrip('/')}/_inputs/{entity}"
    present = {y: p for y, p in inputs.items() if read_if_present(spark, p) is not None}
    for year in sorted(inputs.keys() - present.keys()):
        log.warning("input of %s %s absent: %s", entity, year, inputs[year])
    if not present:
        return []
    now = input_fingerprints(spark, present).collect()  # a row for each year
    known = read_if_present(spark, noted)
    before = {r["anio"]: r for r in known.collect()} if known is not None else {}
    stale = {}
    for r in now:
        if before.get(r["anio"]) != r:
            df = spark.read.parquet(present[r["anio"]])
            if df.isEmpty():
                log.warning("empty, skipped: %s", present[r["anio"]])
                continue
            df = prepare(df) if prepare else df
            stale[r["anio"]] = df.withColumn("anio", F.lit(r["anio"]).cast("int"))
    if not stale:
        return []
    rows = union_by_name(list(stale.values()))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("anio").parquet(target)
    noted_now = {**before, **{r["anio"]: r for r in now if r["anio"] in stale}}
    entries = spark.createDataFrame(list(noted_now.values()), "anio int, files long, bytes long, digest long")
    entries.coalesce(1).write.mode("overwrite").parquet(noted)
    return sorted(stale)


def read_back(spark: SparkSession, path: str, head: int = 5) -> tuple[int, list[str], DataFrame]:
    """Rows, columns and a small sample of a dataset just written."""
    df = spark.read.parquet(path)
    return df.count(), df.columns, df.limit(head)


# ---- inventory --------------------------------------------------------------


def file_inventory(spark: SparkSession, base: str) -> DataFrame:
    """Parquet files below ``base`` with their sizes. File contents stay unread."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(base)
        .select("path", "length")
    )


def expected_files(
    spark: SparkSession,
    base: str,
    entity: str,
    years: Sequence[int] = specs.DEFAULT_YEARS,
) -> DataFrame:
    """One row per expected year: present or missing, with the size in bytes."""
    wanted = spark.range(1).select(
        F.explode(F.array(*[F.lit(year) for year in years])).alias("anio")
    ).withColumn(
        "suffix",
        F.format_string(f"/{entity}/%d/{entity}_%d.parquet", F.col("anio"), F.col("anio")),
    )
    try:
        files = file_inventory(spark, f"{base.rstrip('/')}/{entity}")
    except AnalysisException as e:
        if e.getCondition() not in _ABSENT:
            raise
        files = spark.createDataFrame([], "path string, length long")
    # a dataset is a folder of part files, or a single file of that name
    suffix = F.regexp_extract("path", r"(/[^/]+/\d+/[^/]+?\.parquet)(?:/[^/]+)?$", 1)
    sizes = files.groupBy(suffix.alias("suffix")).agg(
        F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files")
    )
    return wanted.join(sizes, "suffix", "left").select(
        "anio",
        F.concat(F.lit(base.rstrip("/")), "suffix").alias("path"),
        F.col("files").isNotNull().alias("present"),
        F.coalesce("files", F.lit(0).cast("long")).alias("files"),
        F.coalesce("bytes", F.lit(0).cast("long")).alias("bytes"),
    )


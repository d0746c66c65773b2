"""The load chain: bronze, silver, gold. Safe to run again."""

from __future__ import annotations

import logging
from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake import specs
from assaylake.functions.columns import ts_lit
from assaylake.operators.dedupe import latest_rows
from assaylake.operators.normalize import (
    add_load_metadata,
    coerce_columns,
    fill_defaults,
    normalize,
    union_positional,
)
from assaylake.operators.profile import table_counts
from assaylake.plans.marts import MARTS, Silver, owner_totals, votes_by_post
from assaylake.plans.store import TableStore
from assaylake.sources.bronze import (
    bronze_path,
    file_inventory,
    is_finished,
    read_all,
    read_if_present,
    read_raw,
    read_years,
    write_bronze,
)
from assaylake.sources.extract import extract_year, first_rows
from assaylake.specs import BADGES, POSTS, USERS, VOTES, EntitySpec

log = logging.getLogger(__name__)

# badges cover all years in one file, so their cap is three times as high
BADGES_CAP_FACTOR = 3


# ---- bronze -----------------------------------------------------------------


def raw_path(raw: str, spec: EntitySpec, year: int | None) -> str:
    """Raw files: posts and votes by year, users and badges in one file each."""
    if spec in (POSTS, VOTES):
        return f"{raw.rstrip('/')}/{spec.entity}/{year}.parquet"
    return f"{raw.rstrip('/')}/{spec.entity}.parquet"


def _column(df: DataFrame, spec: EntitySpec, canonical: str) -> str:
    for c in df.columns:
        if spec.canonical(c) == canonical:
            return c
    raise ValueError(f"{spec.entity}: no column for {canonical!r} among {df.columns}")


def load_entity(
    spark: SparkSession,
    raw: str,
    bronze: str,
    spec: EntitySpec,
    year: int | None = None,
    cap: int | None = None,
    overwrite: bool = False,
) -> bool:
    """Copy one entity (of one year) from raw to bronze.

    A dataset that is already there is kept unless ``overwrite`` is set, and an
    empty extract is not written. Tells whether a dataset was written.
    """
    path = bronze_path(bronze, spec.entity, year)
    if not overwrite and is_finished(spark, path):
        log.info("already there: %s", path)
        return False
    source = raw_path(raw, spec, year)
    df = read_raw(spark, source, lambda name: spec.columns.get(spec.canonical(name)))
    key = _column(df, spec, spec.key)
    if spec is USERS:
        df = extract_year(df, year, _column(df, spec, "creation_date"))
        df = coerce_columns(
            df, {c: spec.columns[spec.canonical(c)] for c in df.columns
                 if spec.canonical(c) in spec.columns}
        )
    if df.isEmpty():
        log.warning("empty, skipped: %s", path)
        return False
    if cap is not None and spec is BADGES:
        cap *= BADGES_CAP_FACTOR
    # ids may be text; the first ones are the first as numbers
    rows = first_rows(df, cap, key, as_type=spec.columns[spec.key])
    return write_bronze(rows, path, skip_empty=False)


def run_bronze(
    spark: SparkSession,
    raw: str,
    bronze: str,
    years: Sequence[int] = specs.DEFAULT_YEARS,
    cap: int | None = None,
    refresh_users_year: int | None = None,
    refresh: Collection[str] = (),
) -> list[str]:
    """Load all entities.

    What is there already is kept, but for the entities named in ``refresh`` and
    the users of ``refresh_users_year``, which are replaced.
    """
    unknown = set(refresh) - {s.entity for s in (POSTS, USERS, VOTES, BADGES)}
    if unknown:
        raise ValueError(f"no such entities: {sorted(unknown)}")
    written = []
    for spec in (POSTS, USERS, VOTES):
        for year in years:
            again = spec.entity in refresh or spec is USERS and year == refresh_users_year
            if load_entity(spark, raw, bronze, spec, year, cap, overwrite=again):
                written.append(bronze_path(bronze, spec.entity, year))
    if load_entity(spark, raw, bronze, BADGES, cap=cap, overwrite=BADGES.entity in refresh):
        written.append(bronze_path(bronze, BADGES.entity))
    return written


# ---- silver -----------------------------------------------------------------


def silver_frame(
    spark: SparkSession,
    bronze: str,
    spec: EntitySpec,
    load_ts,
    years: Sequence[int] = specs.DEFAULT_YEARS,
    dedupe: bool = True,
) -> DataFrame:
    """Bronze rows of an entity, ready to be merged into its history table.

    An unreadable year stops users and is skipped for posts and votes.
    """
    if spec.yearly:
        typed = read_years(
            spark, bronze, spec.entity, years,
            on_missing="raise" if spec is USERS else "skip",
            prepare=lambda df: normalize(df, spec),
        )
    else:
        typed = normalize(read_all(spark, bronze, spec.entity), spec)
    rows = fill_defaults(typed, spec)
    if dedupe:
        rows = latest_rows(rows, spec.key, spec.latest_by)
    # constants are added last, so that they are neither shuffled nor sorted
    return add_load_metadata(rows, load_ts)


def run_silver(
    spark: SparkSession,
    bronze: str,
    store: TableStore,
    load_ts,
    years: Sequence[int] = specs.DEFAULT_YEARS,
    dedupe: bool = True,
    namespace: str = "silver",
) -> dict[str, int]:
    """Merge the four history tables; rows per table. The loads' nulls are in ``store.profiles``."""
    store.create_namespace(namespace)
    rows = {}
    for spec in (USERS, POSTS, VOTES, BADGES):
        name = f"{namespace}.{spec.table}"
        frame = silver_frame(spark, bronze, spec, load_ts, years, dedupe)
        rows[name] = store.merge(
            name, frame, spec.key, load_ts, spec.update_cols, source_unique=dedupe, by_key=dedupe, profile=True
        )
    return rows


def load_posts_simple(
    spark: SparkSession,
    bronze: str,
    store: TableStore,
    load_ts,
    years: Sequence[int] = specs.DEFAULT_YEARS,
    name: str = "silver.post_hist_simple",
) -> int:
    """Untyped posts, stacked by column position and overwritten as a whole.

    A table of its own: the marts cannot read this shape.
    """
    frames = []
    for year in years:
        path = bronze_path(bronze, POSTS.entity, year)
        one = read_if_present(spark, path)
        if one is None:
            log.warning("bronze posts %s skipped: nothing at %s", year, path)
        else:
            frames.append(one.withColumn("year", F.lit(year)))
    if not frames:
        raise RuntimeError("no bronze data for posts")
    rows = union_positional(frames).withColumns(
        {
            "load_date": F.date_format(ts_lit(load_ts), "yyyy-MM-dd HH:mm:ss"),
            "source_system": F.lit(specs.SIMPLE_SOURCE_NAME),
        }
    )
    return store.overwrite(name, rows, load_ts)


# ---- gold -------------------------------------------------------------------

# intermediate results that two marts share
NEED_VOTE_COUNTS = {"vote_stats_per_post", "user_engagement"}
NEED_OWNER_TOTALS = {"cant_post_x_user_hist", "cant_post_x_user_type_hist"}
VOTE_COUNTS = "votes_by_post"
OWNER_TOTALS = "owner_totals"


def open_silver(store: TableStore, namespace: str = "silver") -> Silver:
    return Silver(*[store.read(f"{namespace}.{s.table}") for s in (USERS, POSTS, VOTES, BADGES)])


def run_gold(
    store: TableStore,
    load_ts,
    marts: Sequence[str] = tuple(MARTS),
    namespace: str = "gold",
    silver_namespace: str = "silver",
    work: str = "work",
) -> dict[str, int]:
    """Build and merge the marts; rows per table.

    What two marts share is computed once, into work tables: votes per post,
    bucketed like the posts, and sums per owner, bucketed like the users. Their
    joins with posts and users then need no shuffle.
    """
    store.create_namespace(namespace)
    repeated = [
        t for t in (f"{silver_namespace}.{s.table}" for s in (USERS, POSTS, VOTES, BADGES))
        if not store.unique_keys(t)
    ]
    if repeated:
        # the marts count rows, which is only right with one row per key
        raise ValueError(f"loaded without dedupe, so keys may repeat: {repeated}")
    silver = open_silver(store, silver_namespace)
    if NEED_VOTE_COUNTS.issubset(marts):
        name = f"{work}.{VOTE_COUNTS}"
        store.overwrite(name, votes_by_post(silver.votes), load_ts, "PostId")
        silver = silver._replace(vote_counts=store.read(name))
    if NEED_OWNER_TOTALS.issubset(marts):
        name = f"{work}.{OWNER_TOTALS}"
        store.overwrite(name, owner_totals(silver.posts), load_ts, "user_id")
        silver = silver._replace(totals=store.read(name))
    rows = {}
    for mart in marts:
        build, keys = MARTS[mart]
        name = f"{namespace}.{mart}"
        rows[name] = store.merge(name, build(silver, load_ts), keys, load_ts)
    return rows


def verify_bronze(spark: SparkSession, bronze: str) -> DataFrame:
    """Bronze files in path order, with their sizes."""
    return file_inventory(spark, bronze).orderBy("path")


def write_listing(spark: SparkSession, bronze: str, path: str) -> tuple[int, int]:
    """Write the whole inventory as CSV; returns the number of files and their bytes."""
    files = verify_bronze(spark, bronze)
    files.write.mode("overwrite").option("header", "true").csv(path)
    n, size = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    return n, size


def verify_gold(store: TableStore, mart: str = "cant_post_x_user_hist", n: int = 10):
    """Row count and a small sample of a mart."""
    name = f"gold.{mart}"
    return table_counts(store.spark, [name]), store.sample(name, n)


def run_all(
    spark: SparkSession,
    raw: str,
    base: str,
    load_ts,
    years: Sequence[int] = specs.DEFAULT_YEARS,
    cap: int | None = None,
    buckets: int | None = None,
    marts: Sequence[str] = tuple(MARTS),
    refresh: Collection[str] = (),
) -> dict[str, int]:
    """Raw files to marts. Run again on the same input, only load times change.

    Raw files are copied once; ``refresh`` names the entities to copy again.
    """
    base = base.rstrip("/")
    run_bronze(spark, raw, f"{base}/bronze", years, cap, refresh=refresh)
    store = TableStore(spark, f"{base}/tables", buckets)
    return {
        **run_silver(spark, f"{base}/bronze", store, load_ts, years),
        **run_gold(store, load_ts, marts),
    }

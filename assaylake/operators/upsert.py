"""Upsert (MERGE) expressed as a join, for tables without row-level writes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake.functions.columns import merge_key


class MergeConflict(ValueError):
    """Several source rows match one target row."""


def any_null(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def _key_list(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _aligned(target: DataFrame, source: DataFrame, keys, update_cols):
    """Source with the target's columns and types, and the columns to update.

    The target's schema is fixed by its first write: a source that lacks one of
    its columns cannot insert, and columns the target does not have are ignored.
    """
    by_fold = {c.lower(): c for c in source.columns}
    missing = [c for c in target.columns if c.lower() not in by_fold]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    aligned = source.select(
        *[
            F.col(f"`{by_fold[f.name.lower()]}`").cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
    )
    update = (
        [c for c in target.columns if c not in keys] if update_cols is None else list(update_cols)
    )
    unknown = [c for c in update if c not in target.columns]
    if unknown:
        raise ValueError(f"target lacks update columns {unknown}")
    return aligned, update


def _merged(
    t: DataFrame, s: DataFrame, keys, update, columns, null_safe: bool, hash_source: bool = False
) -> DataFrame:
    """Full outer join; the match flag decides, so a null source value wins."""
    t = t.withColumn("_t", F.lit(True)).alias("t")
    s = s.withColumn("_s", F.lit(True)).alias("s")
    if hash_source:
        s = s.hint("shuffle_hash")
    on = [
        F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) if null_safe else F.col(f"t.{k}") == F.col(f"s.{k}")
        for k in keys
    ]
    in_target, in_source = F.col("t._t").isNotNull(), F.col("s._s").isNotNull()
    out = []
    for c in columns:
        tc, sc = F.col(f"t.{c}"), F.col(f"s.{c}")
        if c in update:
            out.append(F.when(in_source, sc).otherwise(tc).alias(c))
        else:
            out.append(F.when(in_target, tc).otherwise(sc).alias(c))
    return t.join(s, reduce(and_, on), "full_outer").select(*out)


def _merged_small(t: DataFrame, s: DataFrame, keys, update, columns) -> DataFrame:
    """Same result when the source is known to be small: the target stays put.

    The source is broadcast against the target's rows. What it must insert is
    found by a semi join that leaves at most as many keys as the source has
    rows, so that side is broadcast as well.
    """
    flagged = F.broadcast(s.withColumn("_s", F.lit(True))).alias("s")
    on = reduce(and_, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])
    in_source = F.col("s._s").isNotNull()
    kept = t.alias("t").join(flagged, on, "left").select(
        *[
            F.when(in_source, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
            if c in update else F.col(f"t.{c}")
            for c in columns
        ]
    )
    present = t.select(*keys).join(F.broadcast(s.select(*keys)), keys, "left_semi").distinct()
    return kept.unionByName(s.join(F.broadcast(present), keys, "left_anti").select(*columns))


#: A broadcast source has at most so many bytes, whatever its number of rows.
BROADCAST_BYTES = 64 << 20


def measured_bytes(df: DataFrame) -> int:
    """Size of the values, by a pass over the rows; 8 for each number."""
    sizes = [
        F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)).cast("long")
        if isinstance(f.dataType, (T.StringType, T.BinaryType))
        else F.lit(8 if isinstance(f.dataType, T.AtomicType) else 0).cast("long")
        + (F.lit(0) if isinstance(f.dataType, T.AtomicType)
           else F.length(F.to_json(F.struct(F.col(f"`{f.name}`")))).cast("long"))
        for f in df.schema.fields
    ]
    return df.agg(F.coalesce(F.sum(reduce(add, sizes)), F.lit(0))).first()[0]


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: str | Sequence[str],
    update_cols: Sequence[str] | None = None,
    drop_null_keys: bool = False,
    broadcast_rows: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    source_has_null_keys: bool = True,
    hash_source: bool = False,
) -> DataFrame:
    """Rows of ``target`` after merging ``source`` into it.

    Matched rows take ``update_cols`` (default: all but the key) from the
    source; unmatched source rows are inserted whole. The source must hold one
    row per key (``merge_conflicts`` tells).

    A single null key matches nothing: the target's ride through the join, and
    the source's pass by it, so they are inserted again by each run. Composite
    keys compare null parts as equal. If the source is known to have no null in
    a key (``source_has_null_keys=False``), the target is scanned once only.

    With ``broadcast_rows`` the source is counted up to that number and its bytes
    are measured; only if both fit is it broadcast, otherwise both sides are joined
    by shuffle. ``hash_source`` asks that join to hash the source's partitions
    instead of sorting both sides; they must fit a task's memory.
    """
    keys = _key_list(keys)
    columns = target.columns
    source, update = _aligned(target, source, keys, update_cols)
    null_key = any_null(keys)
    whole = not source_has_null_keys
    s = source if whole else source.filter(~null_key)

    fits = (
        broadcast_rows is not None
        and source.select(*keys).limit(broadcast_rows + 1).count() <= broadcast_rows
        and measured_bytes(source) <= broadcast_bytes
    )
    if len(keys) > 1 and not whole:
        # null parts are equal to each other, which only a join of their own can tell
        t, t_null = target.filter(~null_key), target.filter(null_key)
        result = (
            _merged_small(t, s, keys, update, columns) if fits
            else _merged(t, s, keys, update, columns, False, hash_source)
        )
        if drop_null_keys:
            return result.unionByName(t_null)
        s_null = source.filter(null_key)
        return result.unionByName(_merged(t_null, s_null, keys, update, columns, null_safe=True))
    if fits:
        result = _merged_small(target, s, keys, update, columns)
    else:
        result = _merged(target, s, keys, update, columns, False, hash_source)
    return result if drop_null_keys or whole else result.unionByName(source.filter(null_key))


def changed_rows(
    target: DataFrame, source: DataFrame, keys: str | Sequence[str], columns: Sequence[str],
    update_cols: Sequence[str] | None = None, hash_source: bool = False,
) -> DataFrame:
    """``old, new``: the rows that an upsert changes in these columns, as structs, before and after it.

    ``old`` is null where a row is inserted; a source row with a null in a key always is.
    The source must hold one row per key. ``hash_source`` is as in ``upsert``.
    """
    keys = _key_list(keys)
    source, update = _aligned(target, source, keys, update_cols)
    if hash_source:
        source = source.hint("shuffle_hash")
    t, s = target.withColumn("_t", F.lit(True)).alias("t"), source.alias("s")
    matched = F.col("t._t").isNotNull()
    after = {
        c: F.col(f"s.{c}") if c in update else F.when(matched, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}"))
        for c in columns
    }
    same = reduce(and_, [F.col(f"t.{c}").eqNullSafe(after[c]) for c in columns])
    joined = s.join(t, reduce(and_, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]), "left")
    return joined.filter(~matched | ~same).select(
        F.when(matched, F.struct(*[F.col(f"t.{c}") for c in columns])).alias("old"),
        F.struct(*[after[c].alias(c) for c in columns]).alias("new"),
    )


def merge_conflicts(target: DataFrame, source: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Keys with several source rows that exist in the target.

    The count combines before the shuffle, so a hot key stays cheap, and the
    target contributes its key columns only.
    """
    keys = _key_list(keys)
    repeated = (
        source.filter(~any_null(keys)).groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("source_rows"))
        .filter(F.col("source_rows") > 1)
    )
    return repeated.join(target.select(*keys), keys, "left_semi")


def require_no_conflicts(target: DataFrame, source: DataFrame, keys: str | Sequence[str]) -> None:
    sample = merge_conflicts(target, source, keys).limit(5).collect()
    if sample:
        raise MergeConflict(
            "several source rows match one target row, for example "
            + ", ".join(str(r.asDict()) for r in sample)
        )


def with_merge_key(df: DataFrame, *parts: str) -> DataFrame:
    return df.withColumn("merge_key", merge_key(*parts))


def merge_into(source: DataFrame, table: str, keys, update_cols: Sequence[str] | None = None) -> None:
    """The same merge on a catalog with row-level writes (Iceberg and others)."""
    keys = _key_list(keys)
    target = table.rsplit(".", 1)[-1]
    columns = source.sparkSession.table(table).columns
    update = [c for c in columns if c not in keys] if update_cols is None else update_cols
    null_safe = len(keys) > 1
    on = [(F.col(f"{target}.{k}"), F.col(f"source.{k}")) for k in keys]
    (
        source.alias("source")
        .mergeInto(table, reduce(and_, [t.eqNullSafe(s) if null_safe else t == s for t, s in on]))
        .whenMatched().update({c: F.col(f"source.{c}") for c in update})
        .whenNotMatched().insertAll()
        .merge()
    )

"""Read queries and checks over the history tables and marts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.functions.columns import or_zero, post_type_label, ts_lit
from assaylake.plans import marts
from assaylake.plans.marts import Silver
from assaylake.session import settled


def top_k(df: DataFrame, measure: str, keys: str | Sequence[str], k: int) -> DataFrame:
    """First ``k`` rows by a measure; the key columns break ties.

    Each task keeps its best ``k`` rows; the whole frame is never sorted.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.orderBy(
        F.col(measure).desc(), *[F.col(c).asc_nulls_last() for c in keys]
    ).limit(k)


#: More rows than this are no report, and too many to broadcast.
MOST_TOP = 100_000


def _names_for(top: DataFrame, users: DataFrame, k: int) -> DataFrame:
    """Left join of a top-k with the users it mentions.

    ``top`` is computed once, into a folder that goes with the session. It and the
    users found for it are broadcast, so neither the activity nor the users table
    is shuffled for the sake of k names.
    """
    if k > MOST_TOP:
        raise ValueError(f"a report has at most {MOST_TOP} rows")
    top = settled(top, "top")
    wanted = F.broadcast(top.select("user_id").distinct())
    found = users.select(F.col("id").alias("user_id"), "display_name").join(
        wanted, "user_id", "left_semi"
    )
    return top.join(F.broadcast(found), "user_id", "left")


def top_posters(silver: Silver, load_ts, k: int = 100) -> DataFrame:
    """Most posts per user, year and type. Names are looked up for the k rows only."""
    top = top_k(
        marts.owner_activity(silver.posts, "PostTypeId"),
        "cant_posts", ("user_id", "anio", "PostTypeId"), k,
    )
    named = _names_for(top, silver.users, k).select(
        "user_id",
        F.coalesce("display_name", F.lit("Unknown")).alias("display_name"),
        "anio",
        F.col("PostTypeId").alias("post_type_id"),
        post_type_label(F.col("PostTypeId")).alias("post_type"),
        "cant_posts", "total_score", "avg_score", "total_views",
        ts_lit(load_ts).alias("fecha_cargue"),
    )
    return top_k(named, "cant_posts", ("user_id", "anio", "post_type_id"), k)


def yearly_posters(silver: Silver, k: int = 20) -> DataFrame:
    """Most posts per user and year, with the stored (possibly null) name."""
    per_year = (
        silver.posts.filter(F.col("OwnerUserId").isNotNull())
        .groupBy(F.col("OwnerUserId").alias("user_id"), "anio")
        .agg(F.count("Id").alias("cant_posts"))
    )
    top = top_k(per_year, "cant_posts", ("user_id", "anio"), k)
    named = _names_for(top, silver.users, k).select("user_id", "display_name", "anio", "cant_posts")
    return top_k(named, "cant_posts", ("user_id", "anio"), k)


def validation_rollup(posts: DataFrame) -> DataFrame:
    """Totals of the posts mart at its finest grain, recomputed from posts."""
    grain = (
        posts.filter(F.col("OwnerUserId").isNotNull())
        .groupBy("OwnerUserId", "anio", "PostTypeId")
        .agg(F.count("Id").alias("cant_posts"))
    )
    return grain.agg(
        F.count(F.lit(1)).alias("total_registros"),
        F.sum("cant_posts").alias("total_posts"),
        F.max("anio").alias("ultimo_anio"),
        F.min("anio").alias("primer_anio"),
    )


def name_totals(silver: Silver) -> DataFrame:
    """Posts, score and badges per display name; users of one name merge.

    The published score counts each post once per badge of its owner; that
    factor is applied per user, before names are combined.
    """
    posts = (
        silver.posts.filter(F.col("OwnerUserId").isNotNull())
        .groupBy("OwnerUserId")
        .agg(F.count("Id").alias("posts"), F.sum("Score").alias("score"))
    )
    badges = (
        silver.badges.filter(F.col("UserId").isNotNull())
        .groupBy("UserId")
        .agg(F.count(F.lit(1)).alias("badge_rows"), F.count("Id").alias("badges"))
    )
    u = silver.users.select("id", "display_name")
    factor = F.greatest(or_zero("badge_rows"), F.lit(1).cast("long"))
    return (
        u.join(posts, u["id"] == posts["OwnerUserId"], "left")
        .join(badges, u["id"] == badges["UserId"], "left")
        .groupBy("display_name")
        .agg(
            F.sum(or_zero("posts")).alias("total_posts"),
            F.sum(F.col("score") * factor).alias("total_score"),
            F.sum(or_zero(F.col("badges"))).alias("total_badges"),
        )
    )


def top_users(silver: Silver, k: int = 10) -> DataFrame:
    return top_k(name_totals(silver), "total_posts", "display_name", k)


def posts_by_year_type(posts: DataFrame) -> DataFrame:
    """Posts per year and type id, shown with the type's label.

    Several ids may share the label 'Other'; each stays a row of its own. The
    sort key is not among the columns shown.
    """
    return (
        posts.groupBy("anio", "PostTypeId")
        .agg(F.count(F.lit(1)).alias("cantidad"))
        .withColumn("tipo", post_type_label(F.col("PostTypeId")))
        .orderBy("anio", "PostTypeId")
        .select("anio", "tipo", "cantidad")
    )


def rows_per_year(df: DataFrame) -> DataFrame:
    return df.groupBy("anio").agg(F.count(F.lit(1)).alias("total")).orderBy("anio")


def reconcile(
    stored: DataFrame, recomputed: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Keys whose stored and recomputed measures differ, or that one side lacks."""
    s = stored.select(*keys, *[F.col(m).alias(f"stored_{m}") for m in measures])
    r = recomputed.select(*keys, *[F.col(m).alias(f"recomputed_{m}") for m in measures])
    s, r = s.withColumn("_s", F.lit(True)), r.withColumn("_r", F.lit(True))
    # null parts of a key are equal, as in the grouping that made them
    same_key = reduce(and_, [F.col(f"s.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    lacking = F.col("_s").isNull() | F.col("_r").isNull()
    differs = reduce(
        or_, [~F.col(f"stored_{m}").eqNullSafe(F.col(f"recomputed_{m}")) for m in measures]
    )
    return s.alias("s").join(r.alias("r"), same_key, "full_outer").filter(lacking | differs).select(
        *[F.coalesce(f"s.{k}", f"r.{k}").alias(k) for k in keys],
        *[f"{side}_{m}" for m in measures for side in ("stored", "recomputed")],
    )


def reconcile_posts_mart(mart: DataFrame, posts: DataFrame) -> DataFrame:
    """Differences between the stored posts mart and the posts themselves."""
    return reconcile(
        mart, marts.owner_activity(posts), ("user_id", "anio"),
        ("cant_posts", "total_score", "total_views"),
    )

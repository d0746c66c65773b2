"""Gold marts.

The many-sided tables (posts, votes, badges) are always aggregated to the join
key before they are joined. Partial aggregation runs before the shuffle, so a
user or post that holds a large share of the rows sends one row per task, and no
join multiplies rows. The joins rely on the history tables' own contract: one
row per non-null key.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake import specs
from assaylake.functions.columns import (
    count_if,
    or_zero,
    post_type_label,
    sum_or_zero,
    ts_lit,
)
from assaylake.operators.upsert import with_merge_key


class Silver(NamedTuple):
    users: DataFrame
    posts: DataFrame
    votes: DataFrame
    badges: DataFrame
    # votes_by_post(votes) and owner_totals(posts), where a run has stored them
    # because several marts need them
    vote_counts: DataFrame | None = None
    totals: DataFrame | None = None

    def counted_votes(self) -> DataFrame:
        return votes_by_post(self.votes) if self.vote_counts is None else self.vote_counts

    def activity(self, *extra_keys: str) -> DataFrame:
        if self.totals is None:
            return owner_activity(self.posts, *extra_keys)
        return activity_from_totals(self.totals, *extra_keys)


class MartSpec(NamedTuple):
    build: object
    # real columns the mart is merged on
    keys: tuple[str, ...]


def _or_unknown(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("Unknown"))


def owner_activity(posts: DataFrame, *extra_keys: str) -> DataFrame:
    """Posts per owner, year and further keys; posts without owner are left out."""
    return (
        posts.filter(F.col("OwnerUserId").isNotNull())
        .groupBy(F.col("OwnerUserId").alias("user_id"), "anio", *extra_keys)
        .agg(
            F.count("Id").alias("cant_posts"),
            sum_or_zero("Score").alias("total_score"),
            F.round(F.avg("Score"), 2).alias("avg_score"),
            sum_or_zero("ViewCount").alias("total_views"),
        )
    )


def owner_totals(posts: DataFrame) -> DataFrame:
    """Sums per owner, year and type, from which coarser activity adds up."""
    return (
        posts.filter(F.col("OwnerUserId").isNotNull())
        .groupBy(F.col("OwnerUserId").alias("user_id"), "anio", "PostTypeId")
        .agg(
            F.count("Id").alias("posts"),
            F.count("Score").alias("scored"),
            F.sum("Score").alias("score"),
            F.sum("ViewCount").alias("views"),
        )
    )


def activity_from_totals(totals: DataFrame, *extra_keys: str) -> DataFrame:
    """The same as ``owner_activity``, from stored sums.

    Bucketed by user, the sums are grouped and joined with users in place.
    """
    return totals.groupBy("user_id", "anio", *extra_keys).agg(
        F.sum("posts").alias("cant_posts"),
        sum_or_zero("score").alias("total_score"),
        F.round(F.try_divide(F.sum("score"), F.sum("scored")), 2).alias("avg_score"),
        sum_or_zero("views").alias("total_views"),
    )


def _with_display_name(df: DataFrame, users: DataFrame) -> DataFrame:
    names = users.select(F.col("id").alias("user_id"), "display_name")
    return df.join(names, "user_id", "left")


def posts_per_user_year(silver: Silver, load_ts) -> DataFrame:
    mart = _with_display_name(silver.activity(), silver.users).select(
        "user_id",
        _or_unknown("display_name").alias("display_name"),
        "anio", "cant_posts", "total_score", "avg_score", "total_views",
        ts_lit(load_ts).alias("fecha_cargue"),
    )
    return with_merge_key(mart, "user_id", "anio")


def posts_per_user_year_type(silver: Silver, load_ts) -> DataFrame:
    mart = _with_display_name(silver.activity("PostTypeId"), silver.users).select(
        "user_id",
        _or_unknown("display_name").alias("display_name"),
        "anio",
        F.col("PostTypeId").alias("post_type_id"),
        post_type_label(F.col("PostTypeId")).alias("post_type"),
        "cant_posts", "total_score", "avg_score", "total_views",
        ts_lit(load_ts).alias("fecha_cargue"),
    )
    return with_merge_key(mart, "user_id", "anio", "post_type_id")


def votes_by_post(votes: DataFrame) -> DataFrame:
    """Counts per post. ``vote_rows`` includes votes without an id."""
    return (
        votes.filter(F.col("PostId").isNotNull())
        .groupBy("PostId")
        .agg(
            F.count(F.lit(1)).alias("vote_rows"),
            F.count("Id").alias("total_votes"),
            count_if(F.col("VoteTypeId") == specs.UP_VOTE).alias("upvotes"),
            count_if(F.col("VoteTypeId") == specs.DOWN_VOTE).alias("downvotes"),
        )
    )


def _null_keys_once(rows: DataFrame, key: str) -> DataFrame:
    """Rows without a key match nothing and group by their other columns.

    A history table can hold the same such row several times. They are a branch
    of their own so that the keyed rows keep their partitioning.
    """
    return rows.filter(F.col(key).isNull()).distinct()


def vote_stats_per_post(silver: Silver, load_ts) -> DataFrame:
    per_post = silver.counted_votes()
    p = silver.posts.select("Id", "Title", "PostTypeId", "OwnerUserId", "anio", "Score", "ViewCount")
    counted = p.filter(F.col("Id").isNotNull()).join(
        per_post, p["Id"] == per_post["PostId"], "left"
    ).drop("PostId")
    rows = counted.unionByName(_null_keys_once(p, "Id"), allowMissingColumns=True)
    return rows.select(
        F.col("Id").alias("post_id"),
        F.coalesce("Title", F.lit("")).alias("title"),
        F.col("PostTypeId").alias("post_type_id"),
        F.col("OwnerUserId").alias("owner_user_id"),
        "anio",
        or_zero("total_votes").alias("total_votes"),
        or_zero("upvotes").alias("upvotes"),
        or_zero("downvotes").alias("downvotes"),
        (or_zero("upvotes") - or_zero("downvotes")).alias("net_votes"),
        or_zero("Score").alias("score"),
        or_zero("ViewCount").alias("view_count"),
        ts_lit(load_ts).alias("fecha_cargue"),
    )


def question_tags(posts: DataFrame) -> DataFrame:
    """One row per question and tag."""
    # fixed value: the pattern by which the published query splits tags
    tags = F.split(F.regexp_replace("Tags", "[<>]", " "), r"\s+")
    return (
        posts.filter(
            (F.col("PostTypeId") == specs.QUESTION)
            & F.col("Tags").isNotNull()
            & (F.col("Tags") != "")
        )
        .select("anio", "Score", "ViewCount", "AnswerCount", F.explode(tags).alias("raw_tag"))
        .withColumn("tag", F.trim("raw_tag"))
        .filter(F.col("tag") != "")
    )


def top_tags(silver: Silver, load_ts) -> DataFrame:
    mart = (
        question_tags(silver.posts)
        .groupBy("tag", "anio")
        .agg(
            F.count(F.lit(1)).alias("cant_preguntas"),
            sum_or_zero("Score").alias("total_score"),
            F.round(F.avg("Score"), 2).alias("avg_score"),
            sum_or_zero("ViewCount").alias("total_views"),
            sum_or_zero("AnswerCount").alias("total_answers"),
        )
        .withColumn("fecha_cargue", ts_lit(load_ts))
    )
    return with_merge_key(mart, "tag", "anio")


def user_engagement(silver: Silver, load_ts, fanout: bool = True) -> DataFrame:
    """Activity per user.

    The published totals come from joining posts, votes and badges at once, so
    each post is counted once per vote and once per badge. ``fanout=True`` gives
    those totals by multiplying counts, without building the product;
    ``fanout=False`` gives the plain totals.
    """
    votes = silver.counted_votes().select("PostId", "vote_rows", "total_votes")
    badges = (
        silver.badges.filter(F.col("UserId").isNotNull())
        .groupBy("UserId")
        .agg(F.count(F.lit(1)).alias("badge_rows"), F.count("Id").alias("badges"))
    )
    return engagement_of(silver.users, owner_engagement(silver.posts, votes, fanout), badges, load_ts, fanout)


def owner_engagement(posts: DataFrame, votes: DataFrame, fanout: bool = True) -> DataFrame:
    """Sums per owner; with ``fanout`` a post counts once for each of its votes."""
    one = F.lit(1).cast("long")
    per_post = F.greatest(or_zero("vote_rows"), one) if fanout else one
    owned = posts.filter(F.col("OwnerUserId").isNotNull())
    weight = F.col("weight")
    return (
        owned.join(votes, owned["Id"] == votes["PostId"], "left")
        .withColumn("weight", per_post)
        .groupBy("OwnerUserId")
        .agg(
            F.count("Id").alias("posts"),
            F.sum(F.when(F.col("PostTypeId") == specs.QUESTION, weight)).alias("questions"),
            F.sum(F.when(F.col("PostTypeId") == specs.ANSWER, weight)).alias("answers"),
            F.sum(F.col("Score") * weight).alias("score"),
            F.sum(F.col("ViewCount") * weight).alias("views"),
            F.sum(F.col("CommentCount") * weight).alias("comments"),
            F.sum("total_votes").alias("votes"),
        )
    )


def engagement_of(
    users: DataFrame, posts: DataFrame, badges: DataFrame, load_ts, fanout: bool = True
) -> DataFrame:
    """The engagement mart of these users, from sums per owner and badges per user."""
    one = F.lit(1).cast("long")
    per_user = F.greatest(or_zero("badge_rows"), one) if fanout else one
    u = users.select("id", "display_name", "reputation", "location")
    active = (
        u.filter(F.col("id").isNotNull())
        .join(posts, u["id"] == posts["OwnerUserId"], "left")
        .join(badges, u["id"] == badges["UserId"], "left")
        .drop("OwnerUserId", "UserId")
    )
    return (
        active.unionByName(_null_keys_once(u, "id"), allowMissingColumns=True)
        .select(
            F.col("id").alias("user_id"),
            _or_unknown("display_name").alias("display_name"),
            or_zero("reputation").alias("reputation"),
            F.coalesce("location", F.lit("")).alias("location"),
            or_zero("posts").alias("total_posts"),
            (or_zero("questions") * per_user).alias("total_questions"),
            (or_zero("answers") * per_user).alias("total_answers"),
            (or_zero("score") * per_user).alias("total_score"),
            (or_zero("views") * per_user).alias("total_views"),
            (or_zero("comments") * per_user).alias("total_comments"),
            or_zero("votes").alias("total_votes_received"),
            or_zero(F.col("badges")).alias("total_badges"),
            ts_lit(load_ts).alias("fecha_cargue"),
        )
    )


def user_engagement_exact(silver: Silver, load_ts) -> DataFrame:
    return user_engagement(silver, load_ts, fanout=False)


def badges_summary(silver: Silver, load_ts) -> DataFrame:
    per_user = silver.badges.groupBy(F.col("UserId").alias("user_id")).agg(
        F.count("Id").alias("total_badges"),
        count_if(F.col("Class") == specs.GOLD_CLASS).alias("gold_badges"),
        count_if(F.col("Class") == specs.SILVER_CLASS).alias("silver_badges"),
        count_if(F.col("Class") == specs.BRONZE_CLASS).alias("bronze_badges"),
        count_if(F.col("TagBased")).alias("tag_based_badges"),
        F.count_distinct("Name").alias("unique_badge_types"),
    )
    return badges_of(silver.users, per_user, load_ts)


def badges_of(users: DataFrame, per_user: DataFrame, load_ts) -> DataFrame:
    """The badge mart, from counts per ``user_id``."""
    u = users.select(F.col("id").alias("user_id"), "display_name", "reputation")
    return per_user.join(u, "user_id", "left").select(
        "user_id",
        _or_unknown("display_name").alias("display_name"),
        or_zero("reputation").alias("reputation"),
        "total_badges", "gold_badges", "silver_badges", "bronze_badges",
        "tag_based_badges", "unique_badge_types",
        ts_lit(load_ts).alias("fecha_cargue"),
    )


# Gold tables. Two grains of the posts mart exist; each has its own table.
MARTS: dict[str, MartSpec] = {
    "cant_post_x_user_hist": MartSpec(posts_per_user_year, ("user_id", "anio")),
    "cant_post_x_user_type_hist": MartSpec(
        posts_per_user_year_type, ("user_id", "anio", "post_type_id")
    ),
    "vote_stats_per_post": MartSpec(vote_stats_per_post, ("post_id",)),
    "top_tags": MartSpec(top_tags, ("tag", "anio")),
    "user_engagement": MartSpec(user_engagement, ("user_id",)),
    "badges_summary": MartSpec(badges_summary, ("user_id",)),
}

"""Synthetic inputs.

Each generator turns a frame of ids into rows, so its size and distribution over
tasks follow that frame: ``spark.range`` for a fixture, or the ids of any table.
Values are integer arithmetic on the id, which any engine reproduces and no
partitioning changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values: they must equal the published fixture shapes -------------

BADGE_NAMES = (
    "Enthusiast", "Supporter", "Commentator", "Critic", "Citizen Patrol",
    "Reviewer", "Custodian", "Organizer", "Enlightened", "Nice Question",
)
EVEN_TAGS, ODD_TAGS = "<python><sql>", "<javascript><react>"
LICENSE = "CC BY-SA 3.0"

# ---- end of fixed values ----------------------------------------------------

# a linear congruence: consecutive ids give unrelated values, also modulo 2, and
# nothing overflows a long, however large the id
_PRIME, _ID_STEP, _SEED_STEP = 2147483647, 1103515245, 104729


def ids(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(1, n + 1)


def draw(modulus: int, seed: int, low: int = 0) -> Column:
    """Pseudo-random whole number in [low, low + modulus) from the id."""
    spread = (F.col("id") % _PRIME * _ID_STEP + seed * _SEED_STEP) % _PRIME
    return F.lit(low) + spread % modulus


def _day(year: int, seed: int, days: int = 365) -> Column:
    return F.date_add(F.make_date(F.lit(year), F.lit(1), F.lit(1)), draw(days, seed).cast("int"))


def _later(day: Column, seed: int) -> Column:
    return F.date_add(day, draw(30, seed).cast("int")).cast("timestamp")


def _name(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


# Fixed values, from here on: the column names, ranges and text patterns of the rows
# must equal the published fixture shapes. The draws themselves are this module's own.


def generate_users(ids: DataFrame, year: int) -> DataFrame:
    created = _day(year, year)
    return ids.select(
        F.col("id").alias("Id"),
        draw(49999, year + 1, 1).alias("Reputation"),
        created.cast("timestamp").alias("CreationDate"),
        _name("User_", F.col("id")).alias("DisplayName"),
        _later(created, year + 2).alias("LastAccessDate"),
        draw(10000, year + 3).alias("Views"),
        draw(1000, year + 4).alias("UpVotes"),
        draw(100, year + 5).alias("DownVotes"),
        _name("City_", F.col("id") % 50).alias("Location"),
        F.col("id").alias("AccountId"),
    )


def generate_posts(ids: DataFrame, year: int, n_users: int = 499) -> DataFrame:
    created = _day(year, year + 1000)
    return ids.select(
        F.col("id").alias("Id"),
        draw(2, year + 1001, 1).alias("PostTypeId"),
        F.when(draw(10, year + 1002) >= 7, draw(1999, year + 1003, 1)).alias("AcceptedAnswerId"),
        created.cast("timestamp").alias("CreationDate"),
        draw(105, year + 1004, -5).alias("Score"),
        draw(5000, year + 1005).alias("ViewCount"),
        draw(n_users, year + 1006, 1).alias("OwnerUserId"),
        _name("User_", F.col("id") % 500).alias("OwnerDisplayName"),
        _later(created, year + 1007).alias("LastActivityDate"),
        _name("Post_", F.col("id")).alias("Title"),
        F.when(F.col("id") % 2 == 0, F.lit(EVEN_TAGS)).otherwise(F.lit(ODD_TAGS)).alias("Tags"),
        draw(10, year + 1008).alias("AnswerCount"),
        draw(20, year + 1009).alias("CommentCount"),
        draw(50, year + 1010).alias("FavoriteCount"),
        F.lit(LICENSE).alias("ContentLicense"),
        F.lit(None).cast("long").alias("ParentId"),
        F.lit(None).cast("timestamp").alias("ClosedDate"),
    )


def generate_votes(ids: DataFrame, year: int, n_posts: int = 2000, n_users: int = 499) -> DataFrame:
    return ids.select(
        F.col("id").alias("Id"),
        draw(n_posts - 1, year + 2000, 1).alias("PostId"),
        draw(2, year + 2001, 2).alias("VoteTypeId"),
        _day(year, year + 2002).cast("timestamp").alias("CreationDate"),
        draw(n_users, year + 2003, 1).alias("UserId"),
        F.when(draw(20, year + 2004) == 0, draw(450, year + 2005, 50)).alias("BountyAmount"),
    )


def generate_badges(ids: DataFrame, n_users: int = 499, year: int = 2021) -> DataFrame:
    names = F.array(*[F.lit(n) for n in BADGE_NAMES])
    position = (F.pmod(F.col("id") - 1, F.lit(len(BADGE_NAMES))) + 1).cast("int")
    return ids.select(
        F.col("id").alias("Id"),
        draw(n_users, 42, 1).alias("UserId"),
        F.element_at(names, position).alias("Name"),
        _day(year, 43).cast("timestamp").alias("Date"),
        draw(3, 44, 1).alias("Class"),
        (draw(2, 45) == 1).alias("TagBased"),
    )


def _text(day: Column) -> Column:
    return F.date_format(day.cast("timestamp"), "yyyy-MM-dd HH:mm:ss")


def generate_posts_text_dates(ids: DataFrame, year: int) -> DataFrame:
    """Posts in snake case, with dates as text."""
    return ids.select(
        F.col("id").alias("post_id"),
        draw(99, year + 3000, 1).alias("owner_user_id"),
        _name("Post ", F.col("id")).alias("title"),
        _name("Content ", F.col("id")).alias("body"),
        _text(_day(year, year + 3001)).alias("creation_date"),
        draw(100, year + 3002).alias("score"),
        draw(5000, year + 3003).alias("view_count"),
        draw(100, year + 3004).alias("favorite_count"),
        _text(_day(year, year + 3005)).alias("last_activity_date"),
    )


def generate_votes_text_dates(ids: DataFrame, year: int) -> DataFrame:
    return ids.select(
        F.col("id").alias("vote_id"),
        draw(1999, year + 4000, 1).alias("post_id"),
        draw(99, year + 4001, 1).alias("user_id"),
        draw(5, year + 4002, 1).alias("vote_type_id"),
        _text(_day(year, year + 4003)).alias("creation_date"),
    )


def generate_badges_text_dates(ids: DataFrame, year: int = 2019) -> DataFrame:
    return ids.select(
        F.col("id").alias("badge_id"),
        draw(99, 5000, 1).alias("user_id"),
        _name("Badge_", F.col("id") % 20).alias("badge_name"),
        _text(_day(year, 5001, 1095)).alias("date"),
    )


def write_raw_fixture(spark: SparkSession, raw: str, years, n_users=1000, n_posts=2000,
                      n_votes=5000, n_badges=1500) -> None:
    """Raw files of all entities. Ids restart each year, as in real exports."""
    raw = raw.rstrip("/")
    users = None
    for year in years:
        one = generate_users(ids(spark, n_users), year)
        users = one if users is None else users.unionByName(one)
        generate_posts(ids(spark, n_posts), year).write.mode("overwrite").parquet(
            f"{raw}/posts/{year}.parquet")
        generate_votes(ids(spark, n_votes), year, n_posts).write.mode("overwrite").parquet(
            f"{raw}/votes/{year}.parquet")
    users.write.mode("overwrite").parquet(f"{raw}/users.parquet")
    generate_badges(ids(spark, n_badges)).write.mode("overwrite").parquet(f"{raw}/badges.parquet")

"""The community's tables, as expressions over the driver's tables.

Both engines read these lists unchanged. Every row of the base table is kept;
edge cases (no owner, deleted owner, missing title, blank tags, shared or missing
names) are put in by rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from assaylake.operators.dedupe import latest_rows
from assaylake.plans.marts import Silver
from assaylake.specs import VOTES

# accounts that left: their posts and badges stay, without a users row
GONE = 1000000000

SOURCES = {"users": "customer", "posts": "orders", "votes": "lineitem", "badges": "events"}

USERS_COLS = {
    "id": "c_custkey",
    "reputation": "case when c_custkey % 31 = 0 then null else cast(floor(c_acctbal) as bigint) end",
    "creation_date": "cast(concat('2019-01-', cast(c_nationkey % 20 + 10 as string), ' 08:00:00') as timestamp)",
    "display_name": "case when c_custkey % 29 = 0 then null when c_custkey % 10 = 0 then c_mktsegment else c_name end",
    "last_access_date": "cast(concat('2020-02-', cast(c_nationkey % 18 + 10 as string), ' 09:30:00') as timestamp)",
    "views": "cast(c_nationkey * 10 as bigint)",
    "up_votes": "c_custkey % 1000",
    "down_votes": "c_custkey % 100",
    "location": "case when c_custkey % 23 = 0 then null else c_mktsegment end",
    "account_id": "c_custkey + 7",
}
POSTS_COLS = {
    "Id": "o_orderkey",
    "PostTypeId": "case o_orderstatus when 'P' then 1 when 'F' then 2 else 3 end",
    "OwnerUserId": f"case when o_orderkey % 13 = 0 then null when o_orderkey % 7 = 0 then o_custkey + {GONE} else o_custkey end",
    "Title": "case when o_orderkey % 11 = 0 then null else o_orderpriority end",
    "Score": "cast(floor(o_totalprice / 1000) as bigint) - 100",
    "ViewCount": "o_orderkey % 5000",
    "AnswerCount": "o_orderkey % 10",
    "CommentCount": "o_orderkey % 20",
    "FavoriteCount": "case when o_orderkey % 3 = 0 then null else o_orderkey % 50 end",
    "Tags": "case when o_orderkey % 17 = 0 then '' when o_orderkey % 19 = 0 then null else concat('<', lower(substr(o_orderpriority, 3)), '><', lower(o_orderstatus), '>') end",
    "CreationDate": "cast(o_orderdate as timestamp)",
    "LastActivityDate": "case when o_orderkey % 5 = 0 then null else cast(o_orderdate as timestamp) end",
    "anio": "cast(year(o_orderdate) as int)",
}
# Id is not unique here
VOTES_COLS = {
    "Id": "l_orderkey * 10 + l_linenumber",
    "PostId": "l_orderkey",
    "VoteTypeId": "case l_returnflag when 'A' then 2 when 'R' then 3 else 1 end",
    "UserId": "case when l_suppkey % 5 = 0 then null else l_suppkey end",
    "BountyAmount": "case when l_linenumber = 1 then cast(floor(l_quantity) as bigint) end",
    "CreationDate": "cast(l_shipdate as timestamp)",
    "anio": "cast(year(l_shipdate) as int)",
}
BADGES_COLS = {
    "Id": "event_id",
    "UserId": f"case when event_id % 37 = 0 then null when event_id % 11 = 0 then user_id + {GONE} else user_id end",
    "Name": "case when event_id % 41 = 0 then null else event_type end",
    "Class": "case event_type when 'purchase' then 1 when 'signup' then 2 else 3 end",
    "TagBased": "value > 20",
    "Date": "cast(ts as timestamp)",
}
COLUMNS = {"users": USERS_COLS, "posts": POSTS_COLS, "votes": VOTES_COLS, "badges": BADGES_COLS}


def select_list(columns: dict[str, str]) -> str:
    return ", ".join(f"{expr} as {name}" for name, expr in columns.items())


def base(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def mapped(spark: SparkSession, sf_dir: str, table: str, columns: dict[str, str]) -> DataFrame:
    return base(spark, sf_dir, table).selectExpr(*[f"{e} as {n}" for n, e in columns.items()])


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return mapped(spark, sf_dir, SOURCES[name], COLUMNS[name])


def silver(spark: SparkSession, sf_dir: str) -> Silver:
    votes = latest_rows(view(spark, sf_dir, "votes"), VOTES.key, VOTES.latest_by)
    return Silver(
        view(spark, sf_dir, "users"),
        view(spark, sf_dir, "posts"),
        votes,
        view(spark, sf_dir, "badges"),
    )


def newest(table: str, key: str, order: list[str]) -> str:
    sort = ", ".join(f"{c} desc nulls last" for c in order)
    return (
        f"select * exclude (_rn) from (select *, row_number() over "
        f"(partition by {key} order by {sort}) as _rn from {table}) where _rn = 1"
    )


# the same views for the SQL side; unused ones cost nothing
VOTE_ORDER = ["anio", "CreationDate", "PostId", "VoteTypeId", "UserId", "BountyAmount"]
CTES = ", ".join(
    [
        f"{'votes_raw' if n == 'votes' else n} as (select {select_list(COLUMNS[n])} from {SOURCES[n]})"
        for n in COLUMNS
    ]
    + [f"votes as ({newest('votes_raw', 'Id', VOTE_ORDER)})"]
)


def sql(body: str, *ctes: str) -> str:
    return f"with {', '.join([CTES, *ctes])} {body}"

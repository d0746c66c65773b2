"""Properties of the physical plans that matter on large inputs."""

import re

import pytest
from conftest import TS1, plan

from assaylake.operators.dedupe import latest_rows
from assaylake.plans import marts, reports
from assaylake.sources import extract
from verification import mapping as m
from verification.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def no_automatic_broadcast(spark):
    """As with tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def tree(df) -> str:
    return plan(df).split("\n\n")[0]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_products_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas",
                 "FlatMapGroups", "Scan ExistingRDD"):
        assert node not in text
    # broadcasts only where the side was counted or cut to k rows, or is ranges of a fixed number
    bounded = {"topk_posts_user", "readme_top_posters", "upsert_small_source", "reconcile_by_digests"}
    assert ("BroadcastExchange" in text) == (name in bounded)


def test_dedupe_limits_each_key_before_the_exchange(spark):
    t = tree(latest_rows(m.view(spark, SF, "votes"), "Id", ("anio",)))
    assert re.search(r"WindowGroupLimit.*Exchange.*WindowGroupLimit.*Scan", t, re.S)
    assert t.count("Exchange") == 1


def test_marts_aggregate_before_they_shuffle(spark):
    s = m.silver(spark, SF)._replace(votes=m.view(spark, SF, "votes"))
    for build in (marts.posts_per_user_year, marts.vote_stats_per_post, marts.top_tags,
                  marts.user_engagement, marts.badges_summary):
        t = tree(build(s, TS1))
        # every many-sided table reaches its first exchange through a partial aggregate
        assert re.search(r"HashAggregate.*\n.*Exchange.*\n.*HashAggregate", t)
    # no row multiplication: three joins, each of one row to one row
    assert tree(marts.user_engagement(s, TS1)).count("SortMergeJoin LeftOuter") == 3


def test_scans_read_the_needed_columns_only(spark):
    text = plan(reports.validation_rollup(m.view(spark, SF, "posts")))
    schema = re.search(r"ReadSchema: (.*)", text).group(1)
    assert "o_totalprice" not in schema and "o_orderpriority" not in schema
    text = plan(extract.source_year_count(m.base(spark, SF, "orders"), 1997, "o_orderdate"))
    assert re.search(r"ReadSchema: struct<o_orderdate:timestamp_ntz>", text)


def test_year_predicates_reach_the_scan(spark):
    orders = m.base(spark, SF, "orders")
    for df in (extract.extract_year(orders, 1997, "o_orderdate"),
               extract.extract_years(orders, (1997, 1999), "o_orderdate")):
        pushed = re.search(r"PushedFilters: \[(.*)\]", plan(df)).group(1)
        assert "GreaterThanOrEqual(o_orderdate,1997-01-01T00:00)" in pushed
        assert "Exchange" not in tree(df)


def test_top_k_never_sorts_the_whole(spark):
    s = m.silver(spark, SF)
    for df in (reports.top_posters(s, TS1, 10), reports.top_users(s, 10)):
        t = tree(df)
        assert "TakeOrderedAndProject" in t and "rangepartitioning" not in plan(df)

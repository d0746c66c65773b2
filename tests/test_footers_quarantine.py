"""Ranges from footers, and values that casts cannot read."""

import datetime

import pytest
from conftest import plan, rows

from assaylake.operators.quarantine import LOST, quarantine
from assaylake.sources.footers import footer_plan, footer_profile, pushed_aggregates


def test_footers_equal_a_scan(spark, tmp_path):
    df = spark.range(1000).selectExpr(
        "if(id % 10 = 0, null, id) as id", "cast(id % 7 - 3 as int) as n", "date_add(date'2020-01-01', int(id % 50)) as day",
        "cast(2019 + id % 3 as int) as year", "'x' as text",
    )
    df.repartition(3).write.partitionBy("year").parquet(f"{tmp_path}/t")
    got = footer_profile(spark, f"{tmp_path}/t", ["id", "n", "day"], ["year"])
    spark.read.parquet(f"{tmp_path}/t").createOrReplaceTempView("t")
    want = spark.sql("select year, count(*), min(id), max(id), min(n), max(n), min(day), max(day) from t group by year")
    assert rows(got) == rows(want)
    assert rows(footer_profile(spark, f"{tmp_path}/t")) == [(1000,)]
    with pushed_aggregates(spark):
        text = plan(footer_plan(spark, f"{tmp_path}/t", ["id", "n"]))
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id), MIN(n), MAX(n)]" in text
    # outside, plans are as ever
    assert "PushedAggregation" not in plan(footer_plan(spark, f"{tmp_path}/t", ["id"]))


def test_footers_of_odd_tables(spark, tmp_path):
    spark.range(0).selectExpr("id", "cast(null as int) as n").write.parquet(f"{tmp_path}/empty")
    assert rows(footer_profile(spark, f"{tmp_path}/empty", ["id", "n"])) == [(0, None, None, None, None)]
    spark.range(3).selectExpr("cast(null as int) as n", "double(id) as d", "'a' as s").write.parquet(f"{tmp_path}/nulls")
    assert rows(footer_profile(spark, f"{tmp_path}/nulls", ["n"])) == [(3, None, None)]
    for c in ("d", "s", "absent"):
        with pytest.raises(ValueError):
            footer_profile(spark, f"{tmp_path}/nulls", [c])


def test_rows_are_accepted_or_rejected(spark, tmp_path):
    data = [
        (1, "5", "2020-01-02 03:04:05", bytearray(b"7")), (2, "five", "2020-01-02 00:00:00", None),
        (3, "x", "y", bytearray(b"\xff")), (4, None, "", None), (5, " ", None, bytearray(b"8")), (None, "1e99", None, None),
        (1, "5", "2020-01-02 03:04:05", bytearray(b"7")),
    ]
    df = spark.createDataFrame(data, "id long, n string, day string, raw binary")
    split = quarantine(df, {"n": "long", "day": "timestamp", "raw": "int", "absent": "int"}, f"{tmp_path}/q")
    assert split.accepted.columns == df.columns and split.rejected.columns == [*df.columns, LOST]
    day = datetime.datetime(2020, 1, 2, 3, 4, 5)
    assert rows(split.accepted) == sorted([(1, 5, day, 7), (1, 5, day, 7), (4, None, None, None), (5, None, None, 8)], key=repr)
    assert split.accepted.count() + split.rejected.count() == len(data)
    assert rows(split.values("id")) == sorted([
        (2, "n", "five"), (3, "n", "x"), (3, "day", "y"), (3, "raw", "\ufffd"), (None, "n", "1e99")], key=repr)
    assert dict(rows(split.summary())) == {"n": 3, "day": 1, "raw": 1}
    # what can be read of a rejected row is read
    assert split.rejected.filter("id = 2").first()["day"] == datetime.datetime(2020, 1, 2)
    # the accepted rows do not read the rejected ones' files
    assert "PartitionFilters: [isnotnull(_rejected" in plan(split.accepted)


def test_quarantine_of_empty_and_clean_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, "2")], "id long, n string")
    split = quarantine(df.limit(0), {"n": "long"}, f"{tmp_path}/a")
    assert split.accepted.collect() == split.rejected.collect() == []
    split = quarantine(df, {}, f"{tmp_path}/b")
    assert rows(split.accepted) == [(1, "2")] and split.rejected.isEmpty()

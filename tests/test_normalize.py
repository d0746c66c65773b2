from datetime import datetime

import pytest
from conftest import TS1, rows
from pyspark.sql import functions as F

from assaylake import specs
from assaylake.operators.normalize import (
    add_load_metadata,
    coerce_columns,
    fill_defaults,
    normalize,
    to_silver,
    union_by_name,
    union_positional,
)

USER_COLUMNS = list(specs.USERS.columns)


def test_spellings_lead_to_one_schema(spark):
    a = spark.createDataFrame([(1, "A", 5)], "Id long, DisplayName string, UpVotes int")
    b = spark.createDataFrame([("2", "B", "6")], "id string, display_name string, up_votes string")
    c = spark.createDataFrame([(3, "C", 7)], "id long, displayname string, upvotes long")
    frames = [normalize(f, specs.USERS) for f in (a, b, c)]
    assert all(f.columns == USER_COLUMNS for f in frames)
    assert all(f.schema == frames[0].schema for f in frames)
    got = rows(union_by_name(frames), "id", "display_name", "up_votes", "location")
    assert got == [(1, "A", 5, None), (2, "B", 6, None), (3, "C", 7, None)]


def test_unknown_columns_drop_for_users_and_pass_for_posts(spark):
    df = spark.createDataFrame([(1, "x", "y")], "Id long, AboutMe string, other string")
    assert normalize(df, specs.USERS).columns == USER_COLUMNS
    assert normalize(df, specs.POSTS).columns == [*specs.POSTS.columns, "AboutMe", "other"]


def test_two_columns_of_one_meaning_are_an_error(spark):
    df = spark.createDataFrame([(1, 2)], "creation_date long, CreationDate long")
    with pytest.raises(ValueError, match="both mean 'creation_date'"):
        normalize(df, specs.USERS)


def test_binary_is_decoded_before_the_cast(spark):
    df = spark.createDataFrame(
        [(b"123", b"text", b"2020-01-02 03:04:05"), (b"12x", b"a\xffb", b"bad")],
        "Id binary, DisplayName binary, CreationDate binary",
    )
    for spec, name, date in ((specs.USERS, "display_name", "creation_date"),
                             (specs.POSTS, None, "CreationDate")):
        out = normalize(df, spec).select(spec.key, *([name] if name else []), date)
        first, second = sorted(out.collect(), key=lambda r: r[0] is None)
        assert first[0] == 123 and first[-1] == datetime(2020, 1, 2, 3, 4, 5)
        assert second[0] is None and second[-1] is None
        if name:
            assert (first[1], second[1]) == ("text", "a�b")


def test_unreadable_values_become_null(spark):
    df = spark.createDataFrame(
        [("1", "2020-01-01"), (" 2 ", "nope"), ("3.9", None), ("x", "2020-13-01"),
         ("99999999999999999999", "2020-02-30 00:00:00"), (None, "")],
        "n string, d string",
    )
    out = coerce_columns(df, {"n": "long", "d": "timestamp", "absent": "long"})
    assert [r.n for r in out.collect()] == [1, 2, 3, None, None, None]
    assert [r.d for r in out.collect()] == [datetime(2020, 1, 1)] + [None] * 5


def test_column_without_type_survives_a_parquet_write(spark, tmp_path):
    df = spark.sql("select 1L as Id, null as ParentId")
    normalize(df, specs.POSTS).write.parquet(f"{tmp_path}/p")
    assert spark.read.parquet(f"{tmp_path}/p").schema["ParentId"].dataType.simpleString() == "string"


def test_fills_apply_to_columns_the_input_lacks(spark):
    votes = to_silver(spark.createDataFrame([(1,)], "vote_id long"), specs.VOTES, TS1)
    assert votes.select("Id", "UserId", "BountyAmount", "fuente").collect()[0][:] == (
        1, -1, 0, "clickhouse_stackoverflow")
    badges = to_silver(spark.createDataFrame([(1, None)], "Id long, TagBased string"),
                       specs.BADGES, TS1)
    assert badges.select("Name", "TagBased").collect()[0][:] == ("Unknown", False)
    posts = fill_defaults(normalize(spark.range(1), specs.POSTS), specs.POSTS)
    assert posts.select("Title", "Tags", "OwnerDisplayName").collect()[0][:] == ("", "", "Unknown")


def test_load_time_is_one_literal(spark):
    df = add_load_metadata(spark.range(3), datetime(2026, 1, 1, 2, 3, 4))
    assert {r.fecha_cargue for r in df.collect()} == {datetime(2026, 1, 1, 2, 3, 4)}
    other = add_load_metadata(spark.range(1), TS1, "s", "load_date", "source_system")
    assert other.columns == ["id", "load_date", "source_system"]


def test_unions(spark):
    a = spark.createDataFrame([(1, "x")], "a long, b string")
    b = spark.createDataFrame([("y", 2)], "b string, c long")
    assert rows(union_by_name([a, b]), "a", "b", "c") == [(1, "x", None), (None, "y", 2)]
    assert rows(union_positional([a, a.select(F.col("a").alias("z"), "b")])) == [(1, "x"), (1, "x")]

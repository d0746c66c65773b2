import random

from conftest import rows

from assaylake.operators.dedupe import duplicates_removed, latest_rows
from assaylake.operators.profile import null_profile, row_counts, table_counts


def test_latest_year_then_latest_access_then_nulls_last(spark):
    df = spark.createDataFrame(
        [
            (1, 2019, "2021-01-01", "old year, later access"),
            (1, 2020, "2020-01-01", "kept"),
            (2, 2020, None, "no access"),
            (2, 2020, "2020-05-05", "kept"),
            (3, 2020, None, "kept"),
            (None, 2019, "2019-01-01", "null key, older"),
            (None, 2020, "2019-01-01", "kept"),
        ],
        "id long, anio int, last_access_date string, note string",
    )
    out = latest_rows(df, "id", ("anio", "last_access_date"))
    assert out.columns == df.columns
    assert rows(out, "id", "note") == [(1, "kept"), (2, "kept"), (3, "kept"), (None, "kept")]


def test_survivor_does_not_depend_on_partitioning(spark):
    data = [(i % 5, 2020, None, random.Random(i).randint(0, 9), f"n{i % 7}") for i in range(200)]
    schema = "id int, anio int, last_access_date string, v int, note string"
    results = []
    for seed in range(3):
        shuffled = data[:]
        random.Random(seed).shuffle(shuffled)
        df = spark.createDataFrame(shuffled, schema).repartition(seed + 2)
        results.append(rows(latest_rows(df, "id", ("anio", "last_access_date"))))
    assert results[0] == results[1] == results[2] and len(results[0]) == 5


def test_columns_that_cannot_be_sorted_are_carried_along(spark):
    df = spark.sql("select 1 as id, 2020 as anio, map('a', 1) as m union all select 1, 2021, map('b', 2)")
    assert latest_rows(df, "id", ("anio",)).collect()[0].m == {"b": 2}


def test_duplicates_removed_counts_null_as_one_key(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "id long")
    assert duplicates_removed(df, "id").collect()[0][:] == (5, 3, 2)
    assert df.count() - df.dropDuplicates(["id"]).count() == 2
    assert duplicates_removed(df.filter("id > 9"), "id").collect()[0][:] == (0, 0, 0)


def test_profiles(spark, namespaces):
    df = spark.createDataFrame([(1, None), (None, None)], "a long, b string")
    assert null_profile(df).collect()[0][:] == (1, 2)
    assert null_profile(df, ["b"]).collect()[0][:] == (2,)
    assert rows(row_counts({"x": df, "y": df.limit(1)})) == [("x", 2), ("y", 1)]
    df.createOrReplaceTempView("there")
    assert rows(table_counts(spark, ["there", "silver.not_there"])) == [
        ("silver.not_there", None, "table not found"), ("there", 2, None)]

import logging
from datetime import datetime

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from assaylake import specs
from assaylake.operators.normalize import normalize
from assaylake.session import scratch_path
from assaylake.sources import bronze, extract


def put(spark, base, entity, year, data, schema):
    spark.createDataFrame(data, schema).write.parquet(bronze.bronze_path(base, entity, year))


def test_paths():
    assert bronze.bronze_path("/b/", "users", 2020) == "/b/users/2020/users_2020.parquet"
    assert bronze.bronze_path("/b", "badges") == "/b/badges/all/badges.parquet"


def test_strict_and_lenient_years(spark, tmp_path, caplog):
    base = str(tmp_path)
    put(spark, base, "posts", 2019, [(1, "a")], "Id long, Title string")
    put(spark, base, "posts", 2021, [(1, 5)], "Id long, Score long")
    with pytest.raises(FileNotFoundError, match="posts 2020"):
        bronze.read_years(spark, base, "posts")
    with caplog.at_level(logging.WARNING):
        df = bronze.read_years(spark, base, "posts", on_missing="skip")
    assert "2020 skipped" in caplog.text
    assert rows(df, "Id", "Title", "Score", "anio") == [(1, "a", None, 2019), (1, None, 5, 2021)]
    with pytest.raises(RuntimeError, match="no bronze data"):
        bronze.read_years(spark, base, "votes", on_missing="skip")
    with pytest.raises(ValueError):
        bronze.read_years(spark, base, "posts", on_missing="ignore")


def test_years_of_different_types_fit_after_prepare(spark, tmp_path):
    base = str(tmp_path)
    put(spark, base, "users", 2019, [(bytearray(b"7"), bytearray(b"9"))], "Id binary, Reputation binary")
    put(spark, base, "users", 2020, [(8, 10)], "id long, reputation long")
    df = bronze.read_years(spark, base, "users", [2019, 2020],
                           prepare=lambda f: normalize(f, specs.USERS))
    assert rows(df, "id", "reputation", "anio") == [(7, 9, 2019), (8, 10, 2020)]


def test_unfinished_dataset_counts_as_absent(spark, tmp_path):
    (tmp_path / "half" / "_temporary").mkdir(parents=True)
    assert bronze.read_if_present(spark, f"{tmp_path}/half") is None
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_bytes(b"not parquet at all")
    with pytest.raises(Exception) as e:
        bronze.read_if_present(spark, f"{tmp_path}/bad")
    assert not (isinstance(e.value, AnalysisException) and e.value.getCondition() == "PATH_NOT_FOUND")


def test_write_modes(spark, tmp_path, caplog):
    path = f"{tmp_path}/d"
    one, two = spark.range(1), spark.range(2)
    with caplog.at_level(logging.WARNING):
        assert not bronze.write_bronze(one.filter("id < 0"), path)
    assert "empty" in caplog.text and bronze.read_if_present(spark, path) is None
    assert bronze.write_bronze(one, path, overwrite=False)
    assert not bronze.write_bronze(two, path, overwrite=False)
    assert spark.read.parquet(path).count() == 1
    assert bronze.write_bronze(two, path)
    count, columns, head = bronze.read_back(spark, path, 1)
    assert (count, columns, head.count()) == (2, ["id"], 1)


def test_read_all_must_exist(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        bronze.read_all(spark, str(tmp_path), "badges")


def test_inventory_and_expected_files(spark, tmp_path):
    base = str(tmp_path)
    assert [r.present for r in bronze.expected_files(spark, base, "users").collect()] == [False] * 3
    put(spark, base, "users", 2019, [(1,)], "Id long")
    put(spark, base, "users", 2021, [(1,), (2,)], "Id long")
    files = bronze.file_inventory(spark, base)
    assert files.count() >= 2 and files.filter("length <= 0").count() == 0
    got = {r.anio: r for r in bronze.expected_files(spark, base, "users").collect()}
    assert [got[y].present for y in (2019, 2020, 2021)] == [True, False, True]
    total = files.agg(F.sum("length")).collect()[0][0]
    assert got[2019].bytes + got[2021].bytes == total and got[2020].files == 0


def test_expected_file_may_be_a_single_file(spark, tmp_path):
    folder = tmp_path / "users" / "2020"
    folder.mkdir(parents=True)
    (folder / "users_2020.parquet").write_bytes(b"12345")
    got = bronze.expected_files(spark, str(tmp_path), "users", [2020]).collect()[0]
    assert (got.present, got.files, got.bytes) == (True, 1, 5)


def test_nanos(spark):
    df = spark.createDataFrame([(1_600_000_000_123_456_789,)], "t long")
    got = bronze.nanos_to_timestamp(df, "t").collect()[0].t
    assert got == datetime(2020, 9, 13, 12, 26, 40, 123456)


def test_year_of_text_and_times(spark):
    text = spark.createDataFrame(
        [(3, "2020-01-01"), (1, "2020-12-31 23:59:59"), (2, "2021-01-01"), (4, "junk"), (5, None)],
        "Id long, CreationDate string",
    )
    typed = text.withColumn("CreationDate", F.col("CreationDate").try_cast("timestamp"))
    ntz = text.withColumn("CreationDate", F.col("CreationDate").try_cast("timestamp_ntz"))
    for df in (text, typed, ntz):
        assert rows(extract.extract_year(df, 2020), "Id") == [(1,), (3,)]
        assert rows(extract.extract_year(df, 2020, columns=["Id"], n=1)) == [(1,)]
        assert extract.source_year_count(df, 2020).collect()[0].cnt == 2
        assert rows(extract.extract_years(df, [2020, 2021]), "Id", "anio") == [
            (1, 2020), (2, 2021), (3, 2020)]


def test_sql_sent_to_a_source_selects_the_same_rows(spark):
    df = spark.createDataFrame(
        [(3, "2020-01-01"), (1, "2020-12-31 23:59:59"), (2, "2021-01-01"), (5, None)],
        "Id long, CreationDate string",
    ).withColumn("CreationDate", F.col("CreationDate").cast("timestamp"))
    df.createOrReplaceTempView("users_source")
    for columns, n in ((["Id", "CreationDate"], None), (["Id"], 1)):
        text = extract.year_query("users_source", columns, 2020, n=n)
        assert rows(spark.sql(text)) == rows(extract.extract_year(df, 2020, columns=columns, n=n))


def test_head_is_in_key_order(spark):
    df = spark.createDataFrame([(3, "c"), (1, "z"), (1, "b"), (None, "n")], "Id long, v string")
    assert rows(extract.extract_head(df, 2, "Id")) == [(1, "b"), (1, "z")]
    assert extract.extract_head(df, None, "Id").count() == 4


def test_scratch_lies_in_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


@pytest.mark.parametrize("ranges", [1, 2, 7, 1000])
def test_caps_are_exact(spark, monkeypatch, ranges):
    monkeypatch.setattr(extract, "_RANGES", ranges)
    # half of the rows share one key
    df = spark.range(2000).selectExpr("if(id % 2 = 0, 7, id) as Id", "id as v")
    df = df.unionByName(spark.createDataFrame([(None, 1), (None, 2)], "Id long, v long"))
    whole = [tuple(r) for r in df.orderBy(F.asc_nulls_last("Id"), F.desc("v")).collect()]
    kinds = [
        df, df.withColumn("Id", F.col("Id").cast("string")),
        df.withColumn("Id", F.timestamp_seconds("Id")), df.withColumn("Id", F.col("Id").cast("double")),
    ]
    for k, typed in enumerate(kinds):
        for n in (0, 1, 5, 900, 1500, 2000, 2001, 2002, 5000):
            got = extract.first_rows(typed, n, "Id", as_type="long" if k == 1 else None)
            assert sorted(r["v"] for r in got.collect()) == sorted(v for _, v in whole[:n])
    assert extract.extract_head(df.limit(0), 5, "Id").collect() == []


def test_a_row_is_held_against_two_percentiles_only(spark, monkeypatch):
    def searched(*_):
        raise AssertionError("a list is searched for each row")

    monkeypatch.setattr(F, "filter", searched)
    df = spark.range(0, 50000, 1, 8).selectExpr("cast(id * 7919 % 50000 as string) as Id")
    for n in (1, 300, 24999, 49990):
        got = extract.first_rows(df, n, "Id", as_type="long")
        assert got.count() == n and got.agg(F.max(F.col("Id").cast("long"))).first()[0] == n - 1


def test_a_large_cap_is_read_by_many_tasks(spark):
    got = extract.extract_head(spark.range(0, 100000, 1, 8).toDF("Id"), 60000, "Id")
    used = got.select(F.spark_partition_id().alias("p")).distinct().count()
    assert got.count() == 60000 and used > 3


def test_years_in_one_pass(spark, tmp_path):
    df = spark.range(100).selectExpr("id as Id", "cast(2019 + id % 3 as int) as y")
    for rebalance in (False, True):
        base = f"{tmp_path}/{rebalance}"
        bronze.write_year_partitions(df, base, "posts", "y", rebalance)
        back = bronze.read_years(spark, base, "posts", path_of=bronze.year_partition_path)
        assert sorted(rows(back)) == [(i, 2019 + i % 3) for i in range(100)]


def test_files_written_by_other_tools(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    path, nanos = f"{tmp_path}/a.parquet", f"{tmp_path}/n.parquet"
    pq.write_table(pa.table({
        "Id": pa.array([1, 2]), "ParentId": pa.nulls(2),
        "Title": pa.array([b"a", b"\xff"], pa.binary()),
        "CreationDate": pa.array([datetime(2020, 1, 1)] * 2, pa.timestamp("us")),
    }), path)
    out = normalize(bronze.read_if_present(spark, path), specs.POSTS)
    assert rows(out, "Id", "Title", "CreationDate", "ParentId") == [
        (1, "a", datetime(2020, 1, 1), None), (2, "\ufffd", datetime(2020, 1, 1), None)]
    # nanoseconds: refused by default, read as long on request
    pq.write_table(pa.table({"t": pa.array([1_577_836_800_123_456_789], pa.timestamp("ns"))}), nanos)
    with pytest.raises(AnalysisException):
        bronze.read_if_present(spark, nanos)
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    try:
        got = bronze.nanos_to_timestamp(spark.read.parquet(nanos), "t").collect()[0].t
    finally:
        spark.conf.unset("spark.sql.legacy.parquet.nanosAsLong")
    assert got == datetime(2020, 1, 1, 0, 0, 0, 123456)


def test_job_settings_respect_the_cluster(spark):
    from assaylake.session import tuned

    key = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    before = spark.conf.get(key)
    try:
        assert tuned(spark).conf.get(key) == "64m"
        spark.conf.set(key, "5m")
        assert tuned(spark).conf.get(key) == "5m"
    finally:
        spark.conf.set(key, before)


def test_only_stale_years_are_written(spark, tmp_path):
    base, raw = str(tmp_path), {y: f"{tmp_path}/raw/{y}" for y in (2019, 2020, 2021)}
    one = lambda *ids: spark.createDataFrame([(i, f"v{i}") for i in ids], "id long, v string")
    for y in (2019, 2020):
        one(y, y + 100).write.parquet(raw[y])
    assert bronze.refresh_years(spark, raw, base, "posts") == [2019, 2020]  # 2021 is not there yet
    files = lambda: {f: f.stat().st_mtime_ns for f in (tmp_path / "posts").rglob("part-*")}
    before = files()
    assert bronze.refresh_years(spark, raw, base, "posts") == [] and files() == before
    one(5, 6, 7).write.mode("overwrite").parquet(raw[2020])
    one(8).write.parquet(raw[2021])
    assert bronze.refresh_years(spark, raw, base, "posts") == [2020, 2021]
    now = files()
    kept = {f for f in now if "anio=2019" in str(f)}
    assert kept and all(now[f] == before[f] for f in kept)
    got = bronze.read_year_partitions(spark, base, "posts")
    want = [(5, 2020), (6, 2020), (7, 2020), (8, 2021), (2019, 2019), (2119, 2019)]
    assert sorted(tuple(r) for r in got.select("id", "anio").collect()) == want
    # an input without rows, or one that has gone, leaves what is there
    one(1).limit(0).write.mode("overwrite").parquet(raw[2021])
    assert bronze.refresh_years(spark, {2021: raw[2021], 2030: f"{base}/none"}, base, "posts") == []
    assert bronze.refresh_years(spark, {}, base, "posts") == []
    assert bronze.read_year_partitions(spark, base, "posts", [2021]).count() == 1

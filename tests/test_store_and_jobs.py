import re

import pytest
from conftest import TS1, TS2, plan, rows
from pyspark.sql import functions as F

from assaylake import specs
from assaylake.operators.profile import table_counts
from assaylake.operators.upsert import MergeConflict
from assaylake.plans import jobs, marts
from assaylake.plans.store import TableStore
from assaylake.sources import bronze, generators

YEARS = (2019, 2020)


@pytest.fixture
def store(spark, tmp_path, namespaces):
    return TableStore(spark, f"{tmp_path}/tables", buckets=4)


def frame(spark, data):
    return spark.createDataFrame(data, "id long, v string")


def test_merge_creates_then_updates_and_logs(spark, store):
    name = "silver.t"
    assert not store.exists(name)
    assert store.merge(name, frame(spark, [(1, "a"), (2, "b")]), "id", TS1) == 2
    assert store.merge(name, frame(spark, [(2, "B"), (3, "c")]), "id", TS2) == 3
    assert rows(store.read(name)) == [(1, "a"), (2, "B"), (3, "c")]
    assert store.read(name).columns == ["id", "v"]
    log = [tuple(r) for r in store.history(name).select("version", "op", "rows").collect()]
    assert log == [(1, "create", 2), (2, "merge", 3)]
    assert store.tables("silver") == ["t"]
    assert store.sample(name, 2).count() == 2


def test_loads_are_profiled_while_they_are_written(spark, store):
    from assaylake.operators.profile import null_profile

    loads = [frame(spark, [(1, "a"), (2, None), (None, None)]), frame(spark, [(2, "b"), (3, None)])]
    for df, ts in zip(loads, (TS1, TS2), strict=True):
        store.merge("silver.t", df, "id", ts, profile=True)
    store.merge("silver.t", frame(spark, [(9, "z")]), "id", TS2)
    got = {(r["version"], r["column"]): (r["rows"], r["nulls"]) for r in store.profiles("silver.t").collect()}
    want = {(v, c): (df.count(), n) for v, df in enumerate(loads, 1) for c, n in null_profile(df).first().asDict().items()}
    assert got == want
    assert store.profiles("silver.none").collect() == []


def test_empty_table_from_a_schema(spark, store):
    df = frame(spark, [(1, "a")])
    assert store.create_if_absent("silver.t", df, TS1, "id")
    assert not store.create_if_absent("silver.t", df, TS1, "id")
    assert store.read("silver.t").schema.simpleString() == df.schema.simpleString()
    assert store.read("silver.t").count() == 0
    assert store.merge("silver.t", df, "id", TS1) == 1


def test_overwrite(spark, store):
    store.overwrite("silver.t", frame(spark, [(1, "a"), (1, "a")]), TS1)
    assert store.overwrite("silver.t", frame(spark, [(9, "z")]), TS2) == 1
    assert rows(store.read("silver.t")) == [(9, "z")]
    # a table may be rebuilt from itself
    store.overwrite("silver.t", store.read("silver.t").withColumn("v", F.lit("y")), TS2)
    assert rows(store.read("silver.t")) == [(9, "y")]


def test_null_keys(spark, store):
    store.merge("silver.t", frame(spark, [(None, "a"), (1, "b")]), "id", TS1)
    assert store.merge("silver.t", frame(spark, [(None, "a")]), "id", TS2) == 3
    assert store.merge("silver.t", frame(spark, [(None, "a")]), "id", TS2, drop_null_keys=True) == 3


def test_conflict_leaves_the_table_alone(spark, store):
    store.merge("silver.t", frame(spark, [(1, "a")]), "id", TS1)
    twice = frame(spark, [(1, "x"), (1, "y")])
    with pytest.raises(MergeConflict):
        store.merge("silver.t", twice, "id", TS2, source_unique=False)
    assert rows(store.read("silver.t")) == [(1, "a")] and store.history("silver.t").count() == 1


def test_failed_write_is_invisible(spark, store):
    store.merge("silver.t", frame(spark, [(1, "a")]), "id", TS1)
    bad = frame(spark, [(1, "b")]).withColumn("v", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        store.overwrite("silver.t", bad, TS2)
    assert rows(store.read("silver.t")) == [(1, "a")]
    assert store.merge("silver.t", frame(spark, [(1, "c")]), "id", TS2) == 1
    assert rows(store.read("silver.t")) == [(1, "c")]


def test_reopened_by_a_session_without_the_catalog_entries(spark, store):
    store.merge("silver.t", frame(spark, [(1, "a")]), "id", TS1)
    store.merge("silver.t", frame(spark, [(2, "b")]), "id", TS2)
    spark.sql("DROP SCHEMA silver CASCADE")
    again = TableStore(spark, store.base, buckets=4)
    assert rows(again.read("silver.t")) == [(1, "a"), (2, "b")]
    assert rows(again.columns("silver.t")) == [("id", "bigint"), ("v", "string")]
    assert again.merge("silver.t", frame(spark, [(2, "c")]), "id", TS2) == 2


def test_merge_does_not_shuffle_the_history(spark, store):
    from assaylake.operators.upsert import upsert

    store.merge("silver.t", frame(spark, [(i, "a") for i in range(100)]), "id", TS1)
    spark.range(5).selectExpr("id", "'x' as v").write.parquet(f"{store.base}/src")
    merged = upsert(store.read("silver.t"), spark.read.parquet(f"{store.base}/src"), "id")
    text = plan(merged)
    assert "Bucketed: true" in text
    # one exchange, for the incoming rows
    tree = text.split("\n\n")[0]
    assert tree.count("Exchange") == 1
    assert merged.count() == 100


def slices(path):
    """Parquet files by slice, with their times."""
    out = {}
    for f in path.rglob("part-*.parquet"):
        out.setdefault(int(re.search(r"_slice=(\d+)", f.parent.name)[1]), set()).add((f.name, f.stat().st_mtime_ns))
    return out


def test_only_the_last_versions_keep_files(spark, store, tmp_path):
    for i in range(5):
        store.merge("silver.t", frame(spark, [(i, "a")]), "id", TS1)
    assert rows(store.read("silver.t")) == [(i, "a") for i in range(5)]
    assert store.history("silver.t").count() == 5
    with pytest.raises(ValueError):
        TableStore(spark, store.base, keep=1)
    # a rewrite starts a folder of its own; the former stays while it may be read
    for _ in range(2):
        store.overwrite("silver.t", frame(spark, [(9, "z")]), TS2)
    assert sorted(p.name for p in (tmp_path / "tables" / "silver" / "t").iterdir()) == ["g6", "g7"]
    assert "silver" in store.namespaces()


def test_a_merge_writes_only_the_slices_it_touches(spark, tmp_path, namespaces):
    store = TableStore(spark, f"{tmp_path}/tables", buckets=16)
    store.merge("silver.t", frame(spark, [(i, "a") for i in range(400)]), "id", TS1)
    folder = tmp_path / "tables" / "silver" / "t"
    assert sorted(slices(folder)) == list(range(16))
    for keys, ts in (([3], TS2), ([3, 5000], TS2), ([7], TS2)):
        source = frame(spark, [(k, f"new {k}") for k in keys])
        hit = {r[0] for r in source.select(F.pmod(F.hash("id"), F.lit(16))).collect()}
        had = slices(folder)
        n = store.merge("silver.t", source, "id", ts)
        now = slices(folder)
        assert {k for k in now if now[k] != had[k]} == hit and all(len(f) == 1 for f in now.values())
        assert n == store.read("silver.t").count()
    got = dict(rows(store.read("silver.t")))
    assert len(got) == 401
    assert {k: v for k, v in got.items() if v != "a"} == {3: "new 3", 5000: "new 5000", 7: "new 7"}
    spark.sql("DROP SCHEMA silver CASCADE")
    again = TableStore(spark, store.base)
    assert dict(rows(again.read("silver.t"))) == got
    assert again.merge("silver.t", frame(spark, []), "id", TS2) == 401


def test_only_the_slices_of_the_keys_are_read(spark, tmp_path, namespaces):
    store = TableStore(spark, f"{tmp_path}/tables", buckets=16)
    store.merge("silver.t", frame(spark, [(i, "a") for i in range(400)]), "id", TS1)
    got = store.rows_of_keys("silver.t", spark.createDataFrame([(3,), (None,), (999,)], "id long"))
    assert rows(got) == [(3, "a")]
    text = plan(got)
    assert re.search(r"PartitionFilters: \[.*_slice#\d+ IN \(|PartitionFilters: \[.*_slice#\d+ = ", text), text
    store.overwrite("silver.u", spark.createDataFrame([(1, None, 5), (1, "x", 6), (None, None, 7)], "a int, b string, n int"),
                    TS1, ["a", "b"])
    keys = spark.createDataFrame([(1, None), (None, None), (2, "x")], "a int, b string")
    assert rows(store.rows_of_keys("silver.u", keys)) == [(1, None, 5), (None, None, 7)]
    with pytest.raises(ValueError):
        store.overwrite("silver.w", frame(spark, [(1, "a")]), TS1)
        store.rows_of_keys("silver.w", keys)


def test_sums_are_added_in_their_slices(spark, tmp_path, namespaces):
    store = TableStore(spark, f"{tmp_path}/tables", buckets=8)
    sums = "id long, year int, n long"
    store.overwrite("work.s", spark.createDataFrame([(i, 2000 + i % 2, i) for i in range(100)], sums), TS1, "id")
    folder = tmp_path / "tables" / "work" / "s"
    had = slices(folder)
    delta = spark.createDataFrame([(5, 2001, -5), (5, 2000, 1), (1000, None, 4)], sums)
    assert store.add_sums("work.s", delta, ["id", "year"], TS2) == 102
    now = slices(folder)
    assert sum(now[k] != had.get(k) for k in now) <= 2
    got = {tuple(r)[:2]: r["n"] for r in store.read("work.s").collect()}
    assert got[5, 2001] == 0 and got[5, 2000] == 1 and got[1000, None] == 4 and got[7, 2001] == 7
    assert store.add_sums("work.s", delta.limit(0), ["id", "year"], TS2) == 102


def test_the_written_merge_neither_sorts_nor_shuffles_the_history(spark, store, monkeypatch):
    store.merge("silver.t", frame(spark, [(i, "a") for i in range(1000)]), "id", TS1)
    plans = []
    replace = TableStore._replace_slices
    monkeypatch.setattr(TableStore, "_replace_slices",
                        lambda self, n, df, *a: (plans.append(plan(df)), replace(self, n, df, *a))[1])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store.merge("silver.t", frame(spark, [(1, "b"), (2, "c")]), "id", TS2)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tree = plans[0].split("\n\n")[0]
    assert "ShuffledHashJoin" in tree and "Sort" not in tree
    assert tree.count("Exchange") == 1 and tree.count("Scan parquet") == 2
    assert store.read("silver.t").count() == 1000


def test_rows_are_counted_from_footers(spark, store):
    store.merge("silver.t", frame(spark, [(i, "a") for i in range(10)]), "id", TS1)
    counted = spark.table("silver.t__g1").groupBy().count()
    assert "ReadSchema: struct<>" in plan(counted)


def test_another_number_of_buckets_places_the_rows_anew(spark, tmp_path, namespaces):
    base = f"{tmp_path}/tables"
    TableStore(spark, base, buckets=8).merge("silver.t", frame(spark, [(i, "a") for i in range(300)]), "id", TS1)
    seven = TableStore(spark, base, buckets=7)
    assert seven.merge("silver.t", frame(spark, [(1, "b")]), "id", TS2) == 300
    live = tmp_path / "tables" / "silver" / "t" / "g2"
    assert sorted(slices(live)) == list(range(7))
    # without a number, a table keeps the one it has
    assert TableStore(spark, base).merge("silver.t", frame(spark, [(400, "c")]), "id", TS2) == 301
    assert sorted(slices(live)) == list(range(7))


def test_keyed_tables_are_bucketed_by_default(spark, tmp_path, namespaces):
    store = TableStore(spark, f"{tmp_path}/tables")
    store.merge("silver.t", frame(spark, [(1, "a")]), "id", TS1)
    assert store.history("silver.t").first()["slices"] == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_first_load_has_one_exchange(spark, tmp_path, namespaces, monkeypatch):
    from assaylake.operators.dedupe import latest_rows

    store = TableStore(spark, f"{tmp_path}/tables", buckets=6)
    spark.range(500).selectExpr("id % 90 as id", "cast(id as string) as v").write.parquet(f"{tmp_path}/in")
    plans = []
    writer = type(spark.range(1).write)
    save = writer.saveAsTable
    monkeypatch.setattr(writer, "saveAsTable", lambda self, *a, **k: (plans.append(plan(self._df)), save(self, *a, **k))[1])
    df = latest_rows(spark.read.parquet(f"{tmp_path}/in"), "id", ["v"])
    assert store.merge("silver.t", df, "id", TS1, by_key=True) == 90
    assert plans[0].split("\n\n")[0].count("Exchange") == 1
    assert sorted(slices(tmp_path / "tables" / "silver")) == list(range(6))


def test_a_table_of_another_store_is_not_taken_over(spark, tmp_path, namespaces):
    TableStore(spark, f"{tmp_path}/a").merge("silver.t", frame(spark, [(1, "a")]), "id", TS1)
    other = TableStore(spark, f"{tmp_path}/b")
    assert not other.exists("silver.t")
    with pytest.raises(ValueError, match="another store"):
        other.merge("silver.t", frame(spark, [(2, "b")]), "id", TS1)


def test_marts_need_unique_keys(spark, raw, tmp_path, namespaces):
    store = TableStore(spark, f"{tmp_path}/tables")
    jobs.run_bronze(spark, raw, f"{tmp_path}/bronze", YEARS)
    jobs.run_silver(spark, f"{tmp_path}/bronze", store, TS1, YEARS, dedupe=False)
    with pytest.raises(ValueError, match="keys may repeat"):
        jobs.run_gold(store, TS1)


def test_counted_votes_join_posts_without_a_shuffle(spark, store):
    posts = generators.generate_posts(generators.ids(spark, 50), 2020).withColumn("anio", F.lit(2020))
    votes = generators.generate_votes(generators.ids(spark, 90), 2020, n_posts=50)
    users = generators.generate_users(generators.ids(spark, 5), 2020).withColumnRenamed("DisplayName", "display_name")
    store.merge("silver.post_hist", posts, "Id", TS1)
    store.overwrite("work.counts", marts.votes_by_post(votes), TS1, "PostId")
    silver = marts.Silver(users, store.read("silver.post_hist"), votes, votes, store.read("work.counts"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        mart = marts.vote_stats_per_post(silver, TS1)
        tree = plan(mart).split("\n\n")[0]
        joined = tree[tree.index("SortMergeJoin"):tree.index("HashAggregate")]
        assert "Exchange" not in joined
        assert rows(mart) == rows(marts.vote_stats_per_post(silver._replace(vote_counts=None), TS1))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_owner_totals_are_grouped_and_joined_in_place(spark, store):
    posts = generators.generate_posts(generators.ids(spark, 200), 2020, n_users=9).selectExpr(
        "* except (Score)", "if(OwnerUserId = 3 or Id % 4 = 0, null, Score) as Score",
        "cast(2019 + Id % 2 as int) as anio")
    users = generators.generate_users(generators.ids(spark, 5), 2020).selectExpr(
        "Id as id", "DisplayName as display_name")
    store.merge("silver.users_hist", users, "id", TS1)
    store.overwrite("work.totals", marts.owner_totals(posts), TS1, "user_id")
    stored = marts.Silver(store.read("silver.users_hist"), posts, posts, posts,
                          totals=store.read("work.totals"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for build in (marts.posts_per_user_year, marts.posts_per_user_year_type):
            mart = build(stored, TS1)
            assert "Exchange" not in plan(mart).split("\n\n")[0]
            assert rows(mart) == rows(build(stored._replace(totals=None), TS1))
            assert mart.schema.simpleString() == build(stored._replace(totals=None), TS1).schema.simpleString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_table_counts_are_tolerant(spark, store):
    store.merge("silver.t", frame(spark, [(1, "a")]), "id", TS1)
    got = rows(table_counts(spark, ["silver.t", "gold.none"]))
    assert got == [("gold.none", None, "table not found"), ("silver.t", 1, None)]


# ---- the chain --------------------------------------------------------------


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw"))
    generators.write_raw_fixture(spark, path, YEARS, n_users=60, n_posts=80, n_votes=200, n_badges=50)
    return path


def contents(store, drop=("fecha_cargue",)):
    names = [f"silver.{t}" for t in store.tables("silver")] + [f"gold.{t}" for t in store.tables("gold")]
    return {n: rows(store.read(n).drop(*drop)) for n in names}


@pytest.mark.parametrize("buckets,some", [(4, tuple(marts.MARTS)), (None, ("cant_post_x_user_hist", "top_tags"))])
def test_run_all_twice_changes_load_times_only(spark, raw, tmp_path, namespaces, buckets, some):
    base = str(tmp_path)
    first = jobs.run_all(spark, raw, base, TS1, YEARS, buckets=buckets, marts=some)
    store = TableStore(spark, f"{base}/tables", buckets)
    before = contents(store)
    second = jobs.run_all(spark, raw, base, TS2, YEARS, buckets=buckets, marts=some)
    assert first == second and contents(store) == before
    assert first["silver.users_hist"] == 60 and first["silver.badges_hist"] == 50
    assert len(before) == 4 + len(some)
    stamps = {r[0] for r in store.read("gold.top_tags").select("fecha_cargue").distinct().collect()}
    assert [str(s) for s in stamps] == [TS2]
    # the latest year of each repeated id won
    assert {r.anio for r in store.read("silver.users_hist").select("anio").distinct().collect()} == {2020}
    posts = store.read("silver.post_hist")
    assert posts.schema["ClosedDate"].dataType.simpleString() == "timestamp"
    mart = store.read("gold.cant_post_x_user_hist")
    # plain SQL over the catalog's names gives the same mart
    by_sql = spark.sql("""
        select p.OwnerUserId as user_id, coalesce(u.display_name, 'Unknown') as display_name, p.anio,
            count(p.Id) as cant_posts, coalesce(sum(p.Score), 0) as total_score,
            round(avg(p.Score), 2) as avg_score, coalesce(sum(p.ViewCount), 0) as total_views
        from silver.post_hist p left join silver.users_hist u on p.OwnerUserId = u.id
        where p.OwnerUserId is not null group by p.OwnerUserId, u.display_name, p.anio""")
    assert rows(by_sql) == rows(mart, *by_sql.columns)
    assert mart.agg(F.sum("cant_posts")).collect()[0][0] == posts.count()


def test_later_load_updates_some_columns_and_inserts(spark, tmp_path, namespaces):
    base, store = str(tmp_path), TableStore(spark, f"{tmp_path}/tables", 4)
    post = "Id long, Title string, Score long, OwnerUserId long"
    for year, data in ((2019, [(1, "first", 1, 7)]), (2020, [(1, "second", 5, 8), (2, "new", 2, 9)])):
        spark.createDataFrame(data, post).write.parquet(bronze.bronze_path(base, "posts", year))
    for years, ts in (([2019], TS1), ([2019, 2020], TS2)):
        frame = jobs.silver_frame(spark, base, specs.POSTS, ts, years)
        store.merge("silver.post_hist", frame, "Id", ts, specs.POSTS.update_cols)
    got = rows(store.read("silver.post_hist"), "Id", "Title", "Score", "OwnerUserId", "anio")
    # the title and owner of post 1 stay as first inserted
    assert got == [(1, "first", 5, 7, 2020), (2, "new", 2, 9, 2020)]


def test_without_dedupe_repeated_ids_are_refused_on_the_second_run(spark, raw, tmp_path, namespaces):
    store = TableStore(spark, f"{tmp_path}/tables", 4)
    jobs.run_bronze(spark, raw, f"{tmp_path}/bronze", YEARS)
    first = jobs.run_silver(spark, f"{tmp_path}/bronze", store, TS1, YEARS, dedupe=False)
    assert first["silver.post_hist"] == 160
    with pytest.raises(MergeConflict):
        jobs.run_silver(spark, f"{tmp_path}/bronze", store, TS2, YEARS, dedupe=False)


def test_bronze_loading(spark, raw, tmp_path):
    out = str(tmp_path)
    assert len(jobs.run_bronze(spark, raw, out, YEARS, cap=10)) == 7
    for spec in (specs.POSTS, specs.USERS, specs.VOTES):
        df = bronze.read_years(spark, out, spec.entity, YEARS)
        assert rows(df.groupBy("anio").count()) == [(2019, 10), (2020, 10)]
        assert df.agg(F.max("Id")).collect()[0][0] == 10
    assert bronze.read_all(spark, out, "badges").count() == 30
    # everything is there, so nothing is written but the year to refresh
    assert jobs.run_bronze(spark, raw, out, YEARS) == []
    again = jobs.run_bronze(spark, raw, out, YEARS, refresh_users_year=2020)
    assert again == [bronze.bronze_path(out, "users", 2020)]
    assert spark.read.parquet(again[0]).count() == 60
    assert len(jobs.run_bronze(spark, raw, out, YEARS, refresh=["posts", "badges"])) == 3
    assert bronze.read_all(spark, out, "badges").count() == 50
    with pytest.raises(ValueError):
        jobs.run_bronze(spark, raw, out, YEARS, refresh=["post"])
    # a dataset whose commit broke off is loaded again
    (tmp_path / "badges" / "all" / "badges.parquet" / "_SUCCESS").unlink()
    assert jobs.run_bronze(spark, raw, out, YEARS) == [bronze.bronze_path(out, "badges")]


def test_nanosecond_times_reach_silver(spark, tmp_path, namespaces):
    import pyarrow as pa
    import pyarrow.parquet as pq

    made = [pa.array([1_577_836_800_123_456_789 + k], pa.timestamp("ns")) for k in range(2)]
    (tmp_path / "raw").mkdir()
    pq.write_table(pa.table({"Id": [1], "UserId": [2], "Name": ["a"], "Date": made[0], "Class": [1]}),
                   tmp_path / "raw" / "badges.parquet")
    try:
        assert jobs.load_entity(spark, f"{tmp_path}/raw", f"{tmp_path}/bronze", specs.BADGES)
        got = jobs.silver_frame(spark, f"{tmp_path}/bronze", specs.BADGES, TS1).select("Date").first()["Date"]
    finally:
        spark.conf.unset("spark.sql.legacy.parquet.nanosAsLong")
    assert str(got) == "2020-01-01 00:00:00.123456"


def test_capped_load_orders_text_ids_as_numbers(spark, tmp_path):
    ids = [("2",), ("9",), ("10",), ("100",), ("x",), (None,)]
    spark.createDataFrame(ids, "Id string").write.parquet(f"{tmp_path}/raw/posts/2019.parquet")
    for cap, want in ((2, ["2", "9"]), (5, ["10", "100", "2", "9", "x"])):
        jobs.load_entity(spark, f"{tmp_path}/raw", f"{tmp_path}/b{cap}", specs.POSTS, 2019, cap)
        got = spark.read.parquet(bronze.bronze_path(f"{tmp_path}/b{cap}", "posts", 2019))
        assert sorted(r["Id"] for r in got.collect()) == want


def test_simple_posts(spark, raw, tmp_path, namespaces):
    store = TableStore(spark, f"{tmp_path}/tables")
    jobs.run_bronze(spark, raw, f"{tmp_path}/bronze", YEARS)
    for ts in (TS1, TS2):
        # a year without files is skipped
        assert jobs.load_posts_simple(spark, f"{tmp_path}/bronze", store, ts, [*YEARS, 2050]) == 160
    with pytest.raises(RuntimeError):
        jobs.load_posts_simple(spark, f"{tmp_path}/bronze", store, TS1, [2050])
    df = store.read("silver.post_hist_simple")
    assert df.select("year", "load_date", "source_system").distinct().count() == 2
    assert df.first().load_date == TS2


def test_text_date_fixtures_reach_silver(spark, tmp_path):
    base, n = str(tmp_path), generators.ids(spark, 30)
    made = [
        (specs.POSTS, generators.generate_posts_text_dates(n, 2019)),
        (specs.VOTES, generators.generate_votes_text_dates(n, 2019)),
        (specs.BADGES, generators.generate_badges_text_dates(n)),
    ]
    for spec, df in made:
        df.write.parquet(bronze.bronze_path(base, spec.entity, 2019 if spec.yearly else None))
        out = jobs.silver_frame(spark, base, spec, TS1, [2019])
        date = "Date" if spec is specs.BADGES else "CreationDate"
        assert out.filter(F.col(date).isNull() | F.col(spec.key).isNull()).count() == 0
        assert out.count() == 30 and {"fecha_cargue", "fuente"} <= set(out.columns)


def test_generators_do_not_depend_on_partitioning(spark):
    for make in (generators.generate_users, generators.generate_posts, generators.generate_votes):
        assert rows(make(generators.ids(spark, 50), 2020)) == rows(
            make(generators.ids(spark, 50).repartition(7), 2020))
    users = generators.generate_users(generators.ids(spark, 500), 2020)
    assert users.filter("Reputation < 1 or Reputation >= 50000 or year(CreationDate) <> 2020").count() == 0
    posts = generators.generate_posts(generators.ids(spark, 500), 2020)
    assert posts.filter("PostTypeId not in (1, 2) or Score < -5 or Score >= 100").count() == 0
    # questions and answers carry both pairs of tags
    assert posts.select("PostTypeId", "Tags").distinct().count() == 4
    assert generators.generate_users(spark.range(10**15, 10**15 + 9), 2020).count() == 9
    assert posts.filter("OwnerUserId < 1 or OwnerUserId >= 500").count() == 0
    assert {r[0] for r in generators.generate_votes(generators.ids(spark, 99), 2020)
            .select("VoteTypeId").distinct().collect()} == {2, 3}
    assert generators.generate_badges(generators.ids(spark, 30)).select("Name").distinct().count() == 10


def test_command_line(spark, tmp_path, namespaces, capsys):
    from assaylake.__main__ import parse, run

    common = ["--base", f"{tmp_path}/lake", "--raw", f"{tmp_path}/raw", "--years", "2019",
              "--load-ts", TS1, "--marts", "cant_post_x_user_hist", "--buckets", "2", "--cap", "40"]
    for step in ("fixture", "bronze", "silver", "gold", "verify"):
        run(spark, parse([step, *common]))
    out = capsys.readouterr().out
    assert "silver.badges_hist 120" in out and "silver.votes_hist 40" in out
    assert "gold.cant_post_x_user_hist" in out and "badges.parquet" in out
    with pytest.raises(SystemExit):
        parse(["all", "--base", "x"])

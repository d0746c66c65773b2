"""Marts brought up to date from changes, against full runs."""

import random

import pytest
from conftest import TS1, TS2, plan, rows
from pyspark.sql import functions as F

from assaylake.operators.normalize import add_load_metadata
from assaylake.plans import jobs, marts, refresh
from assaylake.plans import store as store_module
from assaylake.plans.store import TableStore
from assaylake.specs import BADGES, POSTS, USERS, VOTES

SPECS = (USERS, POSTS, VOTES, BADGES)
SCHEMAS = {
    USERS.entity: "id long, display_name string, reputation long, location string, creation_date timestamp,"
    " last_access_date timestamp, views long, up_votes long, down_votes long, account_id long, anio int",
    POSTS.entity: "Id long, PostTypeId int, OwnerUserId long, Title string, Tags string, Score long, ViewCount long,"
    " AnswerCount long, CommentCount long, FavoriteCount long, LastActivityDate timestamp, anio int",
    VOTES.entity: "Id long, PostId long, VoteTypeId int, UserId long, BountyAmount long, CreationDate timestamp, anio int",
    BADGES.entity: "Id long, UserId long, Name string, Class int, TagBased boolean, Date timestamp",
}


def load(spark, seed, ids):
    """Rows of the four tables for these ids; values depend on the seed, a third belongs to one user."""
    rng = random.Random(seed)
    some = lambda *xs: rng.choice(xs)
    user = lambda: some(1, rng.randrange(2, 12), rng.randrange(2, 12))
    data = {
        USERS.entity: [(i % 15, some("ann", "bob", None), some(None, 5, 6), some(None, "x"), *[None] * 6, 2020) for i in ids],
        POSTS.entity: [(i, some(1, 2, 5), some(user(), user(), None, 99), some(None, "t"), some(None, "", "<a><b>", "<a> <c>"),
                 some(None, rng.randrange(-5, 9)), some(None, 7), some(None, 2), some(None, 3), None, None,
                 some(2019, 2020, None)) for i in ids],
        VOTES.entity: [(i, some(rng.randrange(30), 7, None), some(2, 3, 1), *[None] * 3, 2020) for i in ids],
        BADGES.entity: [(i, some(user(), None), some("x", "y", None), some(1, 2, 3), some(True, False, None), None) for i in ids],
    }
    data[USERS.entity] = list({r[0]: r for r in data[USERS.entity]}.values())
    return {s.entity: add_load_metadata(spark.createDataFrame(data[s.entity], SCHEMAS[s.entity]), TS1) for s in SPECS}


def keyed(store, namespace, mart):
    df = store.read(f"{namespace}.{mart}").drop("fecha_cargue")
    return rows(df.filter(F.col(marts.MARTS[mart].keys[0]).isNotNull()))


def merged(store, tables, ts=TS1):
    return {
        s.entity: refresh.merge_changes(store, f"silver.{s.table}", tables[s.entity], s, ts) for s in SPECS
    }


@pytest.fixture
def store(spark, tmp_path, namespaces):
    return TableStore(spark, f"{tmp_path}/tables", buckets=2)


def test_refreshed_marts_equal_full_runs(spark, tmp_path, store):
    merged(store, load(spark, 1, range(60)))
    refresh.build_sums(store, TS1)
    jobs.run_gold(store, TS1, work="work")
    jobs.run_gold(store, TS1, namespace="full", work="work_full")
    # some rows change, some stay, some are new
    later = load(spark, 2, [*range(40, 50), *range(100, 110)])
    changes = merged(store, later, TS2)
    assert refresh.refresh_gold(store, changes, TS2).keys() == {f"gold.{m}" for m in marts.MARTS}
    jobs.run_gold(store, TS2, namespace="full", work="work_full")
    for mart in marts.MARTS:
        assert keyed(store, "gold", mart) == keyed(store, "full", mart), mart
    # what was not hit keeps its load time
    stamps = {str(r[0]) for r in store.read("gold.vote_stats_per_post").select("fecha_cargue").distinct().collect()}
    assert stamps == {TS1, TS2}
    # the sums are those of the whole tables
    for name, sums in refresh.SUMS.items():
        whole = sums.group(store.read(f"silver.{sums.of.table}"))
        assert rows(store.read(f"work.{name}").filter("rows > 0"), *whole.columns) == rows(whole)
    # the same load again changes nothing
    again = merged(store, later, TS2)
    assert all(c.before.isEmpty() for c in again.values())
    assert all(c.after.isEmpty() for c in again.values())
    before = {m: keyed(store, "gold", m) for m in marts.MARTS}
    refresh.refresh_gold(store, again, TS2)
    assert {m: keyed(store, "gold", m) for m in marts.MARTS} == before
    for s in ("full", "work_full"):
        spark.sql(f"DROP SCHEMA {s} CASCADE")


@pytest.mark.parametrize("mart", ["badges_summary", "cant_post_x_user_hist", "user_engagement"])
def test_only_the_sums_of_the_marts_at_hand_are_kept(spark, store, mart):
    merged(store, load(spark, 1, range(30)))
    refresh.build_sums(store, TS1, names=[mart])
    jobs.run_gold(store, TS1, [mart])
    assert {t for t in store.tables("work") if t.endswith("_sums")} == set(refresh.SUMS_OF[mart])
    jobs.run_gold(store, TS1, [mart], namespace="full", work="work_full")
    changes = merged(store, load(spark, 2, [*range(20, 30), *range(50, 60)]), TS2)
    refresh.refresh_gold(store, changes, TS2, [mart])
    jobs.run_gold(store, TS2, [mart], namespace="full", work="work_full")
    assert keyed(store, "gold", mart) == keyed(store, "full", mart)
    with pytest.raises(ValueError, match="tag_sums"):
        refresh.refresh_gold(store, changes, TS2, ["top_tags"])
    for name in ("full", "work_full"):
        spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")


def test_rows_without_ids_are_inserted_and_counted(spark, store):
    first = load(spark, 3, range(20))
    merged(store, first)
    refresh.build_sums(store, TS1)
    jobs.run_gold(store, TS1, ["cant_post_x_user_hist"], work="work")
    post = [(None, 1, 3, "t", "<a>", 4, 1, 1, 1, None, None, 2020)]
    empty = {s: t.limit(0) for s, t in first.items()}
    empty[POSTS.entity] = add_load_metadata(spark.createDataFrame(post, SCHEMAS[POSTS.entity]), TS2)
    changes = merged(store, empty, TS2)
    assert changes["posts"].after.count() == 1 and changes["votes"].after.isEmpty()
    refresh.refresh_gold(store, changes, TS2, ["cant_post_x_user_hist"])
    silver = jobs.open_silver(store)
    want = marts.posts_per_user_year(silver, TS2).drop("fecha_cargue")
    assert keyed(store, "gold", "cant_post_x_user_hist") == rows(want)


def test_a_refresh_reads_and_writes_the_slices_it_hits(spark, tmp_path, namespaces, monkeypatch):
    store = TableStore(spark, f"{tmp_path}/tables", buckets=16)
    tables = load(spark, 4, range(100))
    merged(store, tables)
    refresh.build_sums(store, TS1)
    jobs.run_gold(store, TS1, ["vote_stats_per_post"], work="work")
    votes = add_load_metadata(spark.createDataFrame([(1000, 7, 2, None, None, None, 2020)], SCHEMAS[VOTES.entity]), TS2)
    changes = merged(store, {**{s: t.limit(0) for s, t in tables.items()}, VOTES.entity: votes}, TS2)
    read, of = [], TableStore.slices
    monkeypatch.setattr(TableStore, "slices", lambda self, n, numbers: (read.append((n, len(numbers))), of(self, n, numbers))[1])
    times = {f: f.stat().st_mtime_ns for f in (tmp_path / "tables" / "gold").rglob("part-*")}
    refresh.refresh_gold(store, changes, TS2, ["vote_stats_per_post"])
    assert all(n <= 2 for _, n in read) and {"silver.post_hist", "work.vote_sums"} <= {t for t, _ in read}
    now = {f: f.stat().st_mtime_ns for f in (tmp_path / "tables" / "gold").rglob("part-*")}
    assert len(now.keys() - times.keys()) == 1 and len(now) == len(times)
    ids = spark.createDataFrame([(7,)], "Id long")
    assert "_slice" in plan(store.rows_of_keys("silver.post_hist", ids))


def test_changes_are_found_by_one_join_with_the_history(spark, store, monkeypatch):
    def badges(*data):
        return add_load_metadata(spark.createDataFrame(list(data), SCHEMAS[BADGES.entity]), TS1)

    def merge(df, ts):
        return refresh.merge_changes(store, f"silver.{BADGES.table}", df, BADGES, ts)

    merge(badges((1, 5, "x", 1, True, None), (2, None, "x", 1, None, None), (3, 5, None, 2, False, None)), TS1)
    of, read = TableStore.slices, []
    monkeypatch.setattr(TableStore, "slices", lambda self, n, numbers: (read.append(n), of(self, n, numbers))[1])
    changes = merge(badges(
        (1, 5, "x", 1, True, None), (2, None, "x", 1, False, None), (3, 6, None, 2, False, None),
        (4, 7, "y", 3, None, None), (None, 8, "z", 1, None, None), (None, 8, "z", 1, None, None)), TS2)
    assert len(read) == 2  # for the changes, and for the merge
    columns = ("Id", "UserId", "Name", "Class", "TagBased")
    assert rows(changes.before, *columns) == [(2, None, "x", 1, None), (3, 5, None, 2, False)]
    now = rows(store.read(f"silver.{BADGES.table}"), *columns)
    assert rows(changes.after, *columns) == sorted((r for r in now if r[0] != 1), key=repr) and len(now) == 6


def test_sums_are_placed_by_slice_before_they_are_written(spark, tmp_path, namespaces):
    store = TableStore(spark, f"{tmp_path}/tables", buckets=3)
    sums = spark.range(300).selectExpr("id as k", "id % 7 as j", "1L as n")
    store.overwrite("work.some", sums, TS1, "k")
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        store.add_sums("work.some", sums, ["k", "j"], TS1)
    finally:
        spark.conf.unset(setting)
    files = [f.parent.name for f in (tmp_path / "tables" / "work").rglob("part-*.parquet")]
    assert len(files) == len(set(files)) == 3
    assert store.read("work.some").agg(F.count("k"), F.sum("n")).first()[:] == (300, 600)


def test_slices_follow_from_the_size_of_the_files(spark, tmp_path, monkeypatch):
    spark.range(100_000).coalesce(1).write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    assert store_module.slices_for([table], 8) == 8
    monkeypatch.setattr(store_module, "SLICE_BYTES", 1 << 14)
    few = store_module.slices_for([table], 8)
    monkeypatch.setattr(store_module, "SLICE_BYTES", 1 << 12)
    assert few > 8 and 3.9 * few < store_module.slices_for([table.limit(0), table], 8) <= 4 * few

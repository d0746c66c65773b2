"""Marts on the edge rows, and against the joins they replace."""

import pytest
from conftest import TS1, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from assaylake.plans import marts, reports
from assaylake.plans.marts import Silver

USERS = "id long, display_name string, reputation long, location string"
POSTS = ("Id long, OwnerUserId long, PostTypeId int, Title string, Score long, ViewCount long, "
         "AnswerCount long, CommentCount long, Tags string, anio int")
VOTES = "Id long, PostId long, VoteTypeId int"
BADGES = "Id long, UserId long, Name string, Class int, TagBased boolean"


@pytest.fixture(scope="module")
def silver(spark):
    return Silver(
        spark.createDataFrame(
            [(1, "Ann", 10, "X"), (2, None, None, None), (3, "Ann", 5, "Y"), (4, "Idle", 1, "Z")], USERS),
        spark.createDataFrame(
            [
                (10, 1, 1, "t", 1, 100, 2, 3, "<a><b>", 2019),
                (11, 1, 2, None, 2, None, None, 1, None, 2019),
                (12, 1, 1, "u", None, 7, 1, None, "", 2020),
                (13, 2, 5, "v", 4, 1, 0, 0, "<a>", 2019),
                (14, None, 1, "w", 5, 1, 1, 1, "<two words><a>", 2019),
                (15, 99, 1, "gone", 6, 1, 1, 1, " <>", 2020),
                (16, 3, 2, "x", -1, 2, 0, 4, "<a>", 2020),
                (17, 3, None, "y", None, None, None, None, "<a>", None),
            ], POSTS),
        spark.createDataFrame(
            [(100, 10, 2), (101, 10, 3), (102, 10, 1), (103, 11, 2), (104, 999, 2),
             (105, None, 2), (106, 16, 2), (None, 16, 3)], VOTES),
        spark.createDataFrame(
            [(200, 1, "n1", 1, True), (201, 1, "n1", 3, False), (202, 1, None, 2, None),
             (203, 3, "n2", 9, True), (204, None, "n3", 1, True), (205, 99, "n4", 2, False)], BADGES),
    )


@pytest.fixture
def views(spark, silver):
    for name, df in zip(silver._fields, silver[:4]):
        df.createOrReplaceTempView(f"t_{name}")
    return spark.sql


def test_posts_per_user_year(silver):
    got = rows(marts.posts_per_user_year(silver, TS1), "merge_key", "display_name", "cant_posts",
               "total_score", "avg_score", "total_views")
    assert got == [
        ("1_2019", "Ann", 2, 3, 1.5, 100), ("1_2020", "Ann", 1, 0, None, 7),
        ("2_2019", "Unknown", 1, 4, 4.0, 1), ("3", "Ann", 1, 0, None, 0),
        ("3_2020", "Ann", 1, -1, -1.0, 2), ("99_2020", "Unknown", 1, 6, 6.0, 1),
    ]


def test_posts_per_user_year_type(silver):
    got = rows(marts.posts_per_user_year_type(silver, TS1), "merge_key", "post_type", "cant_posts")
    assert got == [
        ("1_2019_1", "Question", 1), ("1_2019_2", "Answer", 1), ("1_2020_1", "Question", 1),
        ("2_2019_5", "Other", 1), ("3", "Other", 1), ("3_2020_2", "Answer", 1),
        ("99_2020_1", "Question", 1),
    ]


@pytest.mark.parametrize("scores,mean", [([1, 0, 0, 0, 0, 0, 0, 0], 0.13), ([-1] + [0] * 7, -0.13),
                                         ([1, 0, 0], 0.33), ([2, 0, 0], 0.67),
                                         ([3] * 27 + [2] * 13, 2.68), ([2] + [1] * 199, 1.01)])
def test_average_rounds_half_away_from_zero(spark, silver, scores, mean):
    posts = spark.createDataFrame(
        [(i, 1, 1, "t", s, 0, 0, 0, "", 2020) for i, s in enumerate(scores)], POSTS)
    got = marts.posts_per_user_year(silver._replace(posts=posts), TS1).collect()[0]
    assert got.avg_score == mean


def test_vote_stats(silver):
    got = rows(marts.vote_stats_per_post(silver, TS1), "post_id", "title", "total_votes", "upvotes",
               "downvotes", "net_votes", "score", "view_count")
    assert got[0] == (10, "t", 3, 1, 1, 0, 1, 100)
    assert got[1] == (11, "", 1, 1, 0, 1, 2, 0)
    assert got[2] == (12, "u", 0, 0, 0, 0, 0, 7)
    assert got[6] == (16, "x", 1, 1, 1, 0, -1, 2)
    assert len(got) == 8


def test_top_tags(silver):
    got = rows(marts.top_tags(silver, TS1), "tag", "anio", "cant_preguntas", "total_score", "merge_key")
    assert got == [("a", 2019, 2, 6, "a_2019"), ("b", 2019, 1, 1, "b_2019"),
                   ("two", 2019, 1, 5, "two_2019"), ("words", 2019, 1, 5, "words_2019")]


NAIVE_ENGAGEMENT = """
    select u.id as user_id, coalesce(u.display_name, 'Unknown') as display_name,
        coalesce(u.reputation, 0L) as reputation, coalesce(u.location, '') as location,
        count(distinct p.Id) as total_posts,
        count_if(p.PostTypeId = 1) as total_questions,
        count_if(p.PostTypeId = 2) as total_answers,
        coalesce(sum(p.Score), 0L) as total_score, coalesce(sum(p.ViewCount), 0L) as total_views,
        coalesce(sum(p.CommentCount), 0L) as total_comments,
        count(distinct v.Id) as total_votes_received, count(distinct b.Id) as total_badges
    from t_users u left join t_posts p on u.id = p.OwnerUserId
        left join t_votes v on p.Id = v.PostId left join t_badges b on u.id = b.UserId
    group by u.id, u.display_name, u.reputation, u.location"""


def test_engagement_equals_the_four_way_join(silver, views):
    assert rows(marts.user_engagement(silver, TS1).drop("fecha_cargue")) == rows(views(NAIVE_ENGAGEMENT))


ids = st.one_of(st.none(), st.integers(1, 3))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    posts=st.lists(st.tuples(ids, st.integers(1, 3), st.one_of(st.none(), st.integers(-2, 2))), max_size=6),
    votes=st.lists(ids, max_size=8),
    badges=st.lists(ids, max_size=5),
)
def test_engagement_equals_the_join_on_any_fan_out(spark, posts, votes, badges):
    s = Silver(
        spark.createDataFrame([(i, f"u{i}", i, "x") for i in (1, 2, 3)], USERS),
        spark.createDataFrame(
            [(i + 1, o, k, "t", v, v, 0, v, "", 2020) for i, (o, k, v) in enumerate(posts)], POSTS),
        spark.createDataFrame([(i, p, 2) for i, p in enumerate(votes)], VOTES),
        spark.createDataFrame([(i, u, "n", 1, True) for i, u in enumerate(badges)], BADGES),
    )
    for name, df in zip(s._fields, s[:4]):
        df.createOrReplaceTempView(f"t_{name}")
    got = rows(marts.user_engagement(s, TS1).drop("fecha_cargue"))
    assert got == rows(spark.sql(NAIVE_ENGAGEMENT))


def test_exact_engagement_counts_each_post_once(silver):
    got = {r.user_id: r for r in marts.user_engagement_exact(silver, TS1).collect()}
    ann = got[1]
    assert (ann.total_posts, ann.total_questions, ann.total_answers) == (3, 2, 1)
    assert (ann.total_score, ann.total_views, ann.total_comments) == (3, 107, 4)
    assert (ann.total_votes_received, ann.total_badges) == (4, 3)
    assert tuple(got[4])[4:12] == (0,) * 8


def test_badges_summary(silver):
    got = rows(marts.badges_summary(silver, TS1).drop("fecha_cargue"))
    assert got == [
        (1, "Ann", 10, 3, 1, 1, 1, 1, 1), (3, "Ann", 5, 1, 0, 0, 0, 1, 1),
        (99, "Unknown", 0, 1, 0, 1, 0, 0, 1), (None, "Unknown", 0, 1, 1, 0, 0, 1, 1),
    ]


def test_top_users_merges_homonyms(silver, views):
    naive = views("""
        select u.display_name, count(distinct p.Id) as total_posts, sum(p.Score) as total_score,
            count(distinct b.Id) as total_badges
        from t_users u left join t_posts p on u.id = p.OwnerUserId
            left join t_badges b on u.id = b.UserId
        group by u.display_name""")
    got = reports.top_users(silver, 10)
    assert rows(got) == rows(naive)
    assert got.collect()[0].display_name == "Ann"
    assert {r.display_name: r.total_score for r in got.collect()}["Idle"] is None


def test_top_posters_look_names_up_for_the_top_only(silver):
    whole = marts.posts_per_user_year_type(silver, TS1)
    for k in (1, 3, 100):
        got = [r.asDict() for r in reports.top_posters(silver, TS1, k).collect()]
        want = reports.top_k(whole, "cant_posts", ("user_id", "anio", "post_type_id"), k)
        assert got == [r.asDict() for r in want.drop("merge_key").collect()]
    names = {r.user_id: r.display_name for r in reports.yearly_posters(silver, 20).collect()}
    assert names == {1: "Ann", 2: None, 3: "Ann", 99: None}


def test_ties_are_cut_by_key(spark, silver):
    posts = spark.createDataFrame(
        [(i, i, 1, "t", 1, 0, 0, 0, "", 2020) for i in range(30)], POSTS).repartition(5)
    got = reports.yearly_posters(silver._replace(posts=posts), 5).collect()
    assert [r.user_id for r in got] == [0, 1, 2, 3, 4]


def test_checks(silver):
    assert reports.validation_rollup(silver.posts).collect()[0][:] == (7, 7, 2020, 2019)
    by_type = [tuple(r) for r in reports.posts_by_year_type(silver.posts).collect()]
    assert by_type == [(None, "Other", 1), (2019, "Question", 2), (2019, "Answer", 1),
                       (2019, "Other", 1), (2020, "Question", 2), (2020, "Answer", 1)]
    assert [tuple(r) for r in reports.rows_per_year(silver.posts).collect()] == [
        (None, 1), (2019, 4), (2020, 3)]


def test_rows_without_a_key_are_grouped(spark, silver):
    lost = spark.createDataFrame([(None, "Lost", 1, "L")] * 2 + [(None, "Other", 1, "L")], USERS)
    posts = spark.createDataFrame([(None, 1, 1, "t", 2, 3, 0, 0, "", 2020)] * 2, POSTS)
    s = silver._replace(users=silver.users.unionByName(lost), posts=silver.posts.unionByName(posts))
    for name, df in zip(s._fields, s[:4]):
        df.createOrReplaceTempView(f"t_{name}")
    got = rows(marts.user_engagement(s, TS1).drop("fecha_cargue"))
    assert got == rows(spark.sql(NAIVE_ENGAGEMENT))
    assert sum(r[0] is None for r in got) == 2
    stats = marts.vote_stats_per_post(s, TS1).filter("post_id is null")
    assert rows(stats, "title", "total_votes", "net_votes", "score") == [("t", 0, 0, 2)]


def test_reconcile(silver):
    mart = marts.posts_per_user_year(silver, TS1)
    known = silver.posts
    assert reports.reconcile_posts_mart(mart, known).count() == 0
    changed = known.filter("Id <> 13").withColumn("Score", known["Score"] + 1)
    got = {(r.user_id, r.anio): r for r in reports.reconcile_posts_mart(mart, changed).collect()}
    assert got[(2, 2019)].recomputed_cant_posts is None
    assert (got[(1, 2019)].stored_total_score, got[(1, 2019)].recomputed_total_score) == (3, 5)


def test_totals_equal_the_source(silver):
    mart = marts.posts_per_user_year(silver, TS1)
    owned = silver.posts.filter("OwnerUserId is not null")
    assert mart.agg({"cant_posts": "sum"}).collect()[0][0] == owned.count()
    assert mart.select("user_id", "anio").distinct().count() == mart.count()

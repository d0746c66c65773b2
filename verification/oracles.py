"""The same queries in SQL, written the direct way."""

from __future__ import annotations

from assaylake import specs
from assaylake.sources import generators as g
from verification.mapping import POSTS_COLS, USERS_COLS, VOTE_ORDER, VOTES_COLS, newest, select_list, sql
from verification.queries import (
    EXTRACT_YEAR,
    GEN_YEAR,
    HEAD_CAP,
    LARGE_CAP,
    LAST_OLD_YEAR,
    LATER_TS,
    LOAD_TS,
    PASCAL,
    YEAR_CAP,
    YEARS,
)

TS = f"timestamp '{LOAD_TS}'"
TS2 = f"timestamp '{LATER_TS}'"
TYPE_LABEL = "case {0} when 1 then 'Question' when 2 then 'Answer' else 'Other' end"


def avg2(c: str) -> str:
    """Average rounded half up on its decimal text."""
    return f"cast(round(cast(cast(avg({c}) as varchar) as decimal(38,18)), 2) as double)"


def big(expr: str) -> str:
    return f"cast({expr} as bigint)"


ACTIVITY = f"""count(p.Id) as cant_posts, {big('coalesce(sum(p.Score), 0)')} as total_score,
    {avg2('p.Score')} as avg_score, {big('coalesce(sum(p.ViewCount), 0)')} as total_views"""


def posts_user_year(posts: str = "posts", ts: str = TS) -> str:
    return f"""select p.OwnerUserId as user_id, coalesce(u.display_name, 'Unknown') as display_name,
        p.anio, {ACTIVITY}, {ts} as fecha_cargue,
        concat_ws('_', cast(p.OwnerUserId as varchar), cast(p.anio as varchar)) as merge_key
    from {posts} p left join users u on p.OwnerUserId = u.id
    where p.OwnerUserId is not null group by p.OwnerUserId, u.display_name, p.anio"""


def posts_user_year_type(with_key: bool = True) -> str:
    key = """, concat_ws('_', cast(p.OwnerUserId as varchar), cast(p.anio as varchar),
        cast(p.PostTypeId as varchar)) as merge_key""" if with_key else ""
    return f"""select p.OwnerUserId as user_id, coalesce(u.display_name, 'Unknown') as display_name,
        p.anio, p.PostTypeId as post_type_id, {TYPE_LABEL.format('p.PostTypeId')} as post_type,
        {ACTIVITY}, {TS} as fecha_cargue{key}
    from posts p left join users u on p.OwnerUserId = u.id
    where p.OwnerUserId is not null
    group by p.OwnerUserId, u.display_name, p.anio, p.PostTypeId"""


VOTE_STATS = f"""select p.Id as post_id, coalesce(p.Title, '') as title, p.PostTypeId as post_type_id,
        p.OwnerUserId as owner_user_id, p.anio, count(v.Id) as total_votes,
        count(*) filter (where v.VoteTypeId = 2) as upvotes,
        count(*) filter (where v.VoteTypeId = 3) as downvotes,
        count(*) filter (where v.VoteTypeId = 2) - count(*) filter (where v.VoteTypeId = 3) as net_votes,
        coalesce(p.Score, 0) as score, coalesce(p.ViewCount, 0) as view_count, {TS} as fecha_cargue
    from posts p left join votes v on p.Id = v.PostId
    group by p.Id, p.Title, p.PostTypeId, p.OwnerUserId, p.anio, p.Score, p.ViewCount"""

TOP_TAGS = f"""select trim(tag) as tag, anio, count(*) as cant_preguntas,
        {big('coalesce(sum(Score), 0)')} as total_score, {avg2('Score')} as avg_score,
        {big('coalesce(sum(ViewCount), 0)')} as total_views,
        {big('coalesce(sum(AnswerCount), 0)')} as total_answers, {TS} as fecha_cargue,
        concat_ws('_', trim(tag), cast(anio as varchar)) as merge_key
    from (select anio, Score, ViewCount, AnswerCount,
            unnest(regexp_split_to_array(regexp_replace(Tags, '[<>]', ' ', 'g'), '\\s+')) as tag
          from posts where PostTypeId = 1 and Tags is not null and Tags <> '')
    where trim(tag) <> '' group by trim(tag), anio"""

# the four-way join itself
ENGAGEMENT = f"""select u.id as user_id, coalesce(u.display_name, 'Unknown') as display_name,
        coalesce(u.reputation, 0) as reputation, coalesce(u.location, '') as location,
        count(distinct p.Id) as total_posts,
        count(*) filter (where p.PostTypeId = 1) as total_questions,
        count(*) filter (where p.PostTypeId = 2) as total_answers,
        {big('coalesce(sum(p.Score), 0)')} as total_score,
        {big('coalesce(sum(p.ViewCount), 0)')} as total_views,
        {big('coalesce(sum(p.CommentCount), 0)')} as total_comments,
        count(distinct v.Id) as total_votes_received, count(distinct b.Id) as total_badges,
        {TS} as fecha_cargue
    from users u left join posts p on u.id = p.OwnerUserId
        left join votes v on p.Id = v.PostId left join badges b on u.id = b.UserId
    group by u.id, u.display_name, u.reputation, u.location"""

ENGAGEMENT_EXACT = f"""select u.id as user_id, coalesce(u.display_name, 'Unknown') as display_name,
        coalesce(u.reputation, 0) as reputation, coalesce(u.location, '') as location,
        (select count(*) from posts p where p.OwnerUserId = u.id) as total_posts,
        (select count(*) from posts p where p.OwnerUserId = u.id and PostTypeId = 1) as total_questions,
        (select count(*) from posts p where p.OwnerUserId = u.id and PostTypeId = 2) as total_answers,
        {big('coalesce((select sum(Score) from posts p where p.OwnerUserId = u.id), 0)')} as total_score,
        {big('coalesce((select sum(ViewCount) from posts p where p.OwnerUserId = u.id), 0)')} as total_views,
        {big('coalesce((select sum(CommentCount) from posts p where p.OwnerUserId = u.id), 0)')} as total_comments,
        (select count(*) from votes v join posts p on v.PostId = p.Id where p.OwnerUserId = u.id) as total_votes_received,
        (select count(*) from badges b where b.UserId = u.id) as total_badges, {TS} as fecha_cargue
    from users u"""


def badges_summary(badges: str = "badges", ts: str = TS) -> str:
    return f"""select b.UserId as user_id, coalesce(u.display_name, 'Unknown') as display_name,
        coalesce(u.reputation, 0) as reputation, count(b.Id) as total_badges,
        count(*) filter (where b.Class = 1) as gold_badges,
        count(*) filter (where b.Class = 2) as silver_badges,
        count(*) filter (where b.Class = 3) as bronze_badges,
        count(*) filter (where b.TagBased) as tag_based_badges,
        count(distinct b.Name) as unique_badge_types, {ts} as fecha_cargue
    from {badges} b left join users u on b.UserId = u.id
    group by b.UserId, u.display_name, u.reputation"""


NAME_TOTALS = f"""select u.display_name, count(distinct p.Id) as total_posts,
        {big('sum(p.Score)')} as total_score, count(distinct b.Id) as total_badges
    from users u left join posts p on u.id = p.OwnerUserId left join badges b on u.id = b.UserId
    group by u.display_name"""


def merge(columns: list[str], key: list[str], update: list[str]) -> str:
    """MERGE as a left join plus the source rows that match nothing."""
    on = " and ".join(f"t.{k} = s.{k}" for k in key)
    kept = ", ".join(
        f"case when s.{key[0]} is not null then s.{c} else t.{c} end as {c}"
        if c in update else f"t.{c} as {c}"
        for c in columns
    )
    plain = ", ".join(f"s.{c}" for c in columns)
    return (
        f"select {kept} from t left join s on {on} union all "
        f"select {plain} from s where not exists (select 1 from t where {on})"
    )


def loads(table: str, columns: list[str], changes: dict[str, str], year: str, last: int):
    """CTEs t and s: earlier rows, and the later load with changed values."""
    old = ", ".join(columns)
    new = ", ".join(f"{changes[c]} as {c}" if c in changes else c for c in columns)
    return (
        f"t as (select {old}, {TS} as fecha_cargue, 'first' as fuente from {table} where {year} <= {last})",
        f"s as (select {new}, {TS2} as fecha_cargue, 'second' as fuente from {table} where {year} >= {last})",
    )


def upsert_users(update, rename: dict[str, str] | None = None) -> str:
    rename = rename or {}
    columns = [*USERS_COLS, "anio"]
    dated = f"dated as (select {select_list(USERS_COLS)}, cast(1990 + c_nationkey as int) as anio from customer)"
    t, s = loads(
        "dated", columns,
        {"reputation": "reputation + 5", "location": "cast(null as varchar)",
         "account_id": "account_id + 1", "views": "views * 2"},
        "anio", 2002,
    )
    names = [*columns, "fecha_cargue", "fuente"]
    body = merge(names, ["id"], [c for c in names if rename.get(c, c) in update])
    renamed = ", ".join(f"{c} as {rename.get(c, c)}" for c in names)
    return sql(f"select {renamed} from merged", dated, t, s, f"merged as ({body})")


def _upsert(table: str, columns: list[str], key: str, update, changes, year="anio", last=LAST_OLD_YEAR):
    names = [*columns, "fecha_cargue", "fuente"]
    return sql(merge(names, [key], list(update)), *loads(table, columns, changes, year, last))


def upsert_mart(build, table: str, columns: list[str], key: list[str], old: str, new: str) -> str:
    return sql(
        merge(columns, key, [c for c in columns if c not in key]),
        f"old_rows as (select * from {table} where {old})",
        f"new_rows as (select * from {table} where {new})",
        f"t as ({build('old_rows', TS)})",
        f"s as ({build('new_rows', TS2)})",
    )


POST_COLUMNS = ["Id", "PostTypeId", "OwnerUserId", "Title", "Score", "ViewCount", "AnswerCount",
                "CommentCount", "FavoriteCount", "Tags", "LastActivityDate", "anio"]
VOTE_COLUMNS = ["Id", "PostId", "VoteTypeId", "UserId", "BountyAmount", "CreationDate", "anio"]
BADGE_COLUMNS = ["Id", "UserId", "Name", "Class", "TagBased", "Date"]


def _bags(table: str) -> str:
    """Rows and values of each Id; the values as sorted lists in which null is a value."""
    lists = ", ".join(
        f"list_sort(list(coalesce(cast({c} as varchar), chr(1)))) as {n}"
        for c, n in (("Score", "scores"), ("Title", "titles"), ("Tags", "tags"))
    )
    return f"select Id, count(*) as n, {lists} from {table} group by Id"


# ---- generators -------------------------------------------------------------


def draw(modulus: int, seed: int, low: int = 0) -> str:
    return f"({low} + ((id % 2147483647) * 1103515245 + {seed} * 104729) % 2147483647 % {modulus})"


def day(year: int, seed: int, days: int = 365) -> str:
    return f"(timestamp '{year}-01-01 00:00:00' + to_days(cast({draw(days, seed)} as integer)))"


def later(date: str, seed: int) -> str:
    return f"({date} + to_days(cast({draw(30, seed)} as integer)))"


def text(date: str) -> str:
    return f"strftime({date}, '%Y-%m-%d %H:%M:%S')"


def generated(table: str, id_expr: str, columns: dict[str, str]) -> str:
    return f"select {select_list(columns)} from (select {id_expr} as id from {table})"


Y = GEN_YEAR
GEN_USERS = {
    "Id": "id", "Reputation": draw(49999, Y + 1, 1), "CreationDate": day(Y, Y),
    "DisplayName": "'User_' || id", "LastAccessDate": later(day(Y, Y), Y + 2),
    "Views": draw(10000, Y + 3), "UpVotes": draw(1000, Y + 4), "DownVotes": draw(100, Y + 5),
    "Location": "'City_' || (id % 50)", "AccountId": "id",
}
GEN_POSTS = {
    "Id": "id", "PostTypeId": draw(2, Y + 1001, 1),
    "AcceptedAnswerId": f"case when {draw(10, Y + 1002)} >= 7 then {draw(1999, Y + 1003, 1)} end",
    "CreationDate": day(Y, Y + 1000), "Score": draw(105, Y + 1004, -5),
    "ViewCount": draw(5000, Y + 1005), "OwnerUserId": draw(499, Y + 1006, 1),
    "OwnerDisplayName": "'User_' || (id % 500)",
    "LastActivityDate": later(day(Y, Y + 1000), Y + 1007), "Title": "'Post_' || id",
    "Tags": f"case when id % 2 = 0 then '{g.EVEN_TAGS}' else '{g.ODD_TAGS}' end",
    "AnswerCount": draw(10, Y + 1008), "CommentCount": draw(20, Y + 1009),
    "FavoriteCount": draw(50, Y + 1010), "ContentLicense": f"'{g.LICENSE}'",
    "ParentId": "cast(null as bigint)", "ClosedDate": "cast(null as timestamp)",
}
GEN_VOTES = {
    "Id": "id", "PostId": draw(1999, Y + 2000, 1), "VoteTypeId": draw(2, Y + 2001, 2),
    "CreationDate": day(Y, Y + 2002), "UserId": draw(499, Y + 2003, 1),
    "BountyAmount": f"case when {draw(20, Y + 2004)} = 0 then {draw(450, Y + 2005, 50)} end",
}
GEN_BADGES = {
    "Id": "id", "UserId": draw(499, 42, 1),
    "Name": "(array[" + ", ".join(f"'{n}'" for n in g.BADGE_NAMES) + "])[(id - 1) % 10 + 1]",
    "Date": day(2021, 43), "Class": draw(3, 44, 1), "TagBased": f"{draw(2, 45)} = 1",
}
GEN_POSTS_TEXT = {
    "post_id": "id", "owner_user_id": draw(99, Y + 3000, 1), "title": "'Post ' || id",
    "body": "'Content ' || id", "creation_date": text(day(Y, Y + 3001)),
    "score": draw(100, Y + 3002), "view_count": draw(5000, Y + 3003),
    "favorite_count": draw(100, Y + 3004), "last_activity_date": text(day(Y, Y + 3005)),
}

GEN_VOTES_TEXT = {
    "vote_id": "id", "post_id": draw(1999, Y + 4000, 1), "user_id": draw(99, Y + 4001, 1),
    "vote_type_id": draw(5, Y + 4002, 1), "creation_date": text(day(Y, Y + 4003)),
}
GEN_BADGES_TEXT = {
    "badge_id": "id", "user_id": draw(99, 5000, 1), "badge_name": "'Badge_' || (id % 20)",
    "date": text(day(2019, 5001, 1095)),
}


def chain(raw: str, fills: dict[str, str], columns: list[str], update, changes: dict[str, str], order=None) -> str:
    """Two loads into a history table, nulls filled and, if an order is given, the newest row per key."""
    filled = ", ".join(f"coalesce({c}, {v}) as {c}" for c, v in fills.items())
    changed = ", ".join(f"{e} as {c}" for c, e in changes.items())
    names = [*columns, "fecha_cargue"]

    def load(cte: str, source: str, ts: str) -> str:
        rows = f"select * replace ({filled}) from {source}"
        if order:
            rows = newest(f"({rows})", "Id", order)
        return f"{cte} as (select {', '.join(columns)}, {ts} as fecha_cargue from ({rows}))"

    return sql(
        merge(names, ["Id"], list(update)),
        f"older as (select * from {raw} where anio <= {LAST_OLD_YEAR})",
        f"newer as (select * replace ({changed}) from {raw} where anio >= {LAST_OLD_YEAR})",
        load("t", "older", TS),
        load("s", "newer", TS2),
    )


IN_YEAR = f"year(o_orderdate) = {EXTRACT_YEAR}"
FUENTE = f"'{specs.SOURCE_NAME}'"

ORACLES: dict[str, str] = {
    # marts
    "mart_posts_user_year": sql(posts_user_year()),
    "mart_posts_user_year_type": sql(posts_user_year_type()),
    "mart_vote_stats": sql(VOTE_STATS),
    "mart_top_tags": sql(TOP_TAGS),
    "mart_user_engagement": sql(ENGAGEMENT),
    "mart_user_engagement_exact": sql(ENGAGEMENT_EXACT),
    "mart_badges_summary": sql(badges_summary()),
    # reports
    "topk_posts_user": sql(
        posts_user_year_type(with_key=False)
        + " order by cant_posts desc, user_id, p.anio, post_type_id limit 100"),
    "topk_votes": sql(VOTE_STATS + " order by total_votes desc, post_id limit 100"),
    "topk_tags": sql(f"select * from ({TOP_TAGS}) order by cant_preguntas desc, tag, anio limit 50"),
    "topk_engagement": sql(ENGAGEMENT + " order by total_posts desc, user_id limit 100"),
    "topk_badges": sql(
        badges_summary() + " order by total_badges desc, user_id nulls last limit 100"),
    "readme_top_posters": sql("""select p.OwnerUserId as user_id, u.display_name, p.anio,
            count(p.Id) as cant_posts
        from posts p left join users u on p.OwnerUserId = u.id where p.OwnerUserId is not null
        group by p.OwnerUserId, u.display_name, p.anio
        order by cant_posts desc, user_id, p.anio limit 20"""),
    "top_users": sql(NAME_TOTALS + " order by total_posts desc, u.display_name nulls last limit 10"),
    "name_totals": sql(NAME_TOTALS),
    "validation_rollup": sql(f"""select count(*) as total_registros, {big('sum(cant_posts)')} as total_posts,
            max(anio) as ultimo_anio, min(anio) as primer_anio
        from (select OwnerUserId, anio, PostTypeId, count(Id) as cant_posts from posts
              where OwnerUserId is not null group by OwnerUserId, anio, PostTypeId)"""),
    "posts_by_year_type": sql(f"""select anio, {TYPE_LABEL.format('PostTypeId')} as tipo,
            count(*) as cantidad from posts group by anio, PostTypeId order by anio, PostTypeId"""),
    "rows_per_year": sql("select anio, count(*) as total from posts group by anio order by anio"),
    "table_row_counts": sql(" union all ".join(
        f"select '{label}' as tabla, count(*) as filas from {t}"
        for label, t in (("post_hist", "posts"), ("users_hist", "users"),
                         ("votes_hist", "votes"), ("badges_hist", "badges")))),
    "null_profile": sql("select " + ", ".join(
        f"count(*) - count({c}) as {c}" for c in [*POST_COLUMNS, "CreationDate"]) + " from posts"),
    "null_profile_filled": sql("""select count(*) - count(id) as id,
            cast(0 as bigint) as display_name, count(*) - count(reputation) as reputation,
            count(*) - count(coalesce(account_id, -1)) as account_id,
            count(*) - count(coalesce(location, '')) as location from users"""),
    "reconcile_posts_mart": sql(f"""select OwnerUserId as user_id, anio,
            cast(null as bigint) as stored_cant_posts, count(Id) as recomputed_cant_posts,
            cast(null as bigint) as stored_total_score, {big('sum(Score)')} as recomputed_total_score,
            cast(null as bigint) as stored_total_views, {big('sum(ViewCount)')} as recomputed_total_views
        from posts where OwnerUserId is not null and anio >= {max(YEARS)} group by OwnerUserId, anio"""),
    # dedupe
    "collapse_latest": sql("select * from votes"),
    "dedup_by_key": sql("select distinct Id from votes_raw"),
    "duplicates_removed": sql("""select count(*) as total_rows, count(distinct Id) as distinct_keys,
            count(*) - count(distinct Id) as duplicates_removed from votes_raw"""),
    # normalisation
    "normalize_users": f"""select {select_list({**USERS_COLS, 'location':
        "case when c_nationkey between 9 and 16 then null else " + USERS_COLS['location'] + " end"})}
        from customer""",
    "decode_binary_cast": """select c_custkey as id, cast(floor(c_acctbal) as bigint) as reputation,
        case when c_custkey % 10 = 0 then 'A' || chr(65533) || 'B' else c_name end as display_name,
        timestamp '2020-05-01 10:00:00' as creation_date from customer""",
    "coerce_lenient": """select event_id as Id, case when event_id % 5 = 0 then null else user_id end as UserId,
        case when event_id % 7 = 0 then null else ts end as Date from events""",
    "quarantine_rejects": """with raw as (select event_id as Id, user_id, event_id % 5 = 0 as bad_user,
            event_id % 11 = 0 as blank, event_id % 7 = 0 as bad_date from events)
        select Id, 'UserId' as "column", concat('x', Id) as raw from raw where bad_user
        union all select Id, 'Date', 'not a date' from raw where bad_date
        union all select Id, null, case when blank then null else cast(user_id as varchar) end from raw
            where not bad_user and not bad_date""",
    "refresh_stale_years": sql(
        f"""select * replace (case when anio = {LAST_OLD_YEAR} then 5 else VoteTypeId end as VoteTypeId),
            anio = {LAST_OLD_YEAR} as written from votes_raw"""),
    "load_profile": sql(" union all ".join(
        f"""select cast({version} as int) as version, '{c}' as "column", count(*) as rows, count(*) filter ({c} is null) as nulls
            from votes where anio {sign} {LAST_OLD_YEAR}"""
        for version, sign in ((1, "<="), (2, ">=")) for c in VOTE_COLUMNS)),
    "footer_ranges": sql(
        """select cast(anio as int) as anio, count(*) as rows, min(Id) as min_Id, max(Id) as max_Id,
            min(PostId) as min_PostId, max(PostId) as max_PostId, min(VoteTypeId) as min_VoteTypeId,
            max(VoteTypeId) as max_VoteTypeId from votes_raw group by anio"""),
    "silver_posts_typed": f"""select o_orderkey as Id,
        case when o_orderkey % 97 = 0 then null else cast(o_orderkey % 4 as int) end as PostTypeId,
        case when o_orderkey % 101 = 0 then null else o_orderdate end as CreationDate,
        case when o_orderkey % 89 = 0 then null else cast(trunc(o_totalprice) as bigint) end as Score,
        o_orderkey % 5000 as ViewCount, o_custkey as OwnerUserId, 'Unknown' as OwnerDisplayName,
        cast(null as timestamp) as LastActivityDate,
        case when o_orderkey % 11 = 0 then '' else o_orderpriority end as Title,
        case when o_orderkey % 19 = 0 then '' else o_orderstatus end as Tags,
        o_orderkey % 10 as AnswerCount, cast(null as bigint) as CommentCount,
        o_orderkey % 50 as FavoriteCount, o_orderstatus as body,
        {TS} as fecha_cargue, {FUENTE} as fuente from orders""",
    "silver_votes_typed": f"""select l_orderkey * 10 + l_linenumber as Id, l_orderkey as PostId,
        case l_returnflag when 'A' then 2 when 'R' then 3 end as VoteTypeId, l_shipdate as CreationDate,
        case when l_suppkey % 5 = 0 then -1 else l_suppkey end as UserId,
        case when l_linenumber = 1 then cast(trunc(l_quantity) as bigint) else 0 end as BountyAmount,
        {TS} as fecha_cargue, {FUENTE} as fuente from lineitem""",
    "silver_badges_typed": f"""select event_id as Id, user_id as UserId,
        case when event_id % 41 = 0 then 'Unknown' else event_type end as Name, ts as Date,
        case event_type when 'purchase' then 1 when 'signup' then 2 else 3 end as Class,
        case when event_id % 6 = 0 then false else coalesce(value > 20, false) end as TagBased,
        {TS} as fecha_cargue, {FUENTE} as fuente from events""",
    "fillna_defaults": sql("""select id, coalesce(display_name, 'Unknown') as display_name,
        coalesce(location, '') as location, coalesce(account_id, -1) as account_id from users"""),
    "add_load_metadata": sql(f"""select Id, anio, {TS} as fecha_cargue, {FUENTE} as fuente,
        {TS2} as load_date, '{specs.SIMPLE_SOURCE_NAME}' as source_system from posts"""),
    "union_years_by_name": sql(f"""select Id, anio, case when anio <= {LAST_OLD_YEAR} then ViewCount end as ViewCount,
        case when anio > {LAST_OLD_YEAR} then Tags end as Tags from posts"""),
    "union_positional": sql(f"""select Id,
        case when anio <= {LAST_OLD_YEAR} then Score else ViewCount end as measure from posts"""),
    # upserts
    "upsert_users_full": upsert_users(specs.USERS.update_cols),
    "upsert_users_partial": upsert_users(specs.USERS_PASCAL_UPDATE_COLS, PASCAL),
    "upsert_small_source": upsert_users(specs.USERS.update_cols),
    "upsert_posts_partial": _upsert(
        "posts", POST_COLUMNS, "Id", specs.POSTS.update_cols,
        {"Score": "Score + 7", "Title": "'edited'", "FavoriteCount": "cast(null as bigint)",
         "OwnerUserId": "cast(-1 as bigint)"}),
    "upsert_votes_partial": _upsert(
        "votes", VOTE_COLUMNS, "Id", specs.VOTES.update_cols,
        {"VoteTypeId": "5", "BountyAmount": "cast(null as bigint)"}),
    "upsert_badges_partial": _upsert(
        "badges", BADGE_COLUMNS, "Id", specs.BADGES.update_cols,
        {"Name": "upper(Name)", "Class": "4"}, year="day(Date)", last=15),
    "upsert_gold_mart": upsert_mart(
        posts_user_year, "posts",
        ["user_id", "display_name", "anio", "cant_posts", "total_score", "avg_score",
         "total_views", "fecha_cargue", "merge_key"],
        ["user_id", "anio"], f"anio <= {LAST_OLD_YEAR}", f"anio >= {LAST_OLD_YEAR}"),
    "upsert_gold_null_keys": upsert_mart(
        badges_summary, "badges",
        ["user_id", "display_name", "reputation", "total_badges", "gold_badges", "silver_badges",
         "bronze_badges", "tag_based_badges", "unique_badge_types", "fecha_cargue"],
        ["user_id"], "day(Date) <= 15", "day(Date) >= 15"),
    "merge_conflicts": sql(f"""select Id, count(*) as source_rows from votes_raw
        where Id in (select Id from votes where anio <= {LAST_OLD_YEAR})
        group by Id having count(*) > 1"""),
    "merge_key_build": sql("""select Id,
        concat_ws('_', cast(OwnerUserId as varchar), cast(anio as varchar)) as key_2,
        concat_ws('_', cast(OwnerUserId as varchar), cast(anio as varchar), cast(PostTypeId as varchar)) as key_3
        from posts"""),
    # bronze
    "src_years_strict": sql("select * from posts"),
    "src_years_lenient": sql("select * from posts"),
    "src_years_pruned": sql(f"select * from posts where anio >= {LAST_OLD_YEAR}"),
    "src_all": sql("select * from badges"),
    "bronze_overwrite_roundtrip": sql(f"select *, cast({GEN_YEAR} as int) as anio from users"),
    "extract_year_capped": f"select * from orders where {IN_YEAR} order by o_orderkey limit {YEAR_CAP}",
    "extract_years_whole": f"""select *, cast(year(o_orderdate) as int) as anio from orders
        where year(o_orderdate) between {min(YEARS)} and {max(YEARS)}""",
    "extract_projected_year": f"select o_orderkey, o_custkey, o_orderdate from orders where {IN_YEAR}",
    "source_year_count": f"select count(*) as cnt from orders where {IN_YEAR}",
    "extract_head": sql(f"select * from badges order by Id limit {HEAD_CAP}"),
    "extract_head_text_key": sql(
        f"select * replace (cast(Id as varchar) as Id) from (select * from badges order by Id limit {HEAD_CAP})"),
    "extract_year_large_cap": f"select * from orders where {IN_YEAR} order by o_orderkey limit {LARGE_CAP}",
    "bronze_skip_present": sql("select * from badges"),
    "bronze_skip_empty": sql("select * from badges"),
    "expected_files": sql(f"""select cast(y as int) as anio, y <= {YEARS[1]} as present
        from range({min(YEARS)}, {max(YEARS) + 1}) r(y)"""),
    # the store and the chain
    "chain_silver_posts": chain(
        "posts", {"Title": "''", "Tags": "''"}, [*POSTS_COLS], specs.POSTS.update_cols,
        {"Score": "Score + 7", "Title": "'edited'", "OwnerUserId": "cast(-1 as bigint)",
         "FavoriteCount": "cast(null as bigint)"}),
    "chain_silver_votes": chain(
        "votes_raw", {"UserId": "-1", "BountyAmount": "0"}, [*VOTES_COLS], specs.VOTES.update_cols,
        {"VoteTypeId": "5", "BountyAmount": "cast(null as bigint)"}, VOTE_ORDER),
    "chain_gold_posts_user_year": sql(posts_user_year(ts=TS2)),
    "chain_gold_engagement": sql(ENGAGEMENT),
    "refresh_posts_user_year": sql(posts_user_year()),
    "refresh_posts_user_year_type": sql(posts_user_year_type()),
    "refresh_vote_stats": sql(VOTE_STATS),
    "refresh_top_tags": sql(TOP_TAGS),
    "refresh_user_engagement": sql(ENGAGEMENT),
    "refresh_badges_summary": sql(f"select * from ({badges_summary()}) where user_id is not null"),
    "reconcile_by_digests": sql(
        """select coalesce(l.Id, r.Id) as Id, coalesce(l.n, 0) as left_rows, coalesce(r.n, 0) as right_rows,
            case when l.n is null or r.n is null then '' else concat_ws(',',
                case when l.scores <> r.scores then 'Score' end, case when l.titles <> r.titles then 'Title' end,
                case when l.tags <> r.tags then 'Tags' end) end as changed
        from lefts l full join rights r on l.Id = r.Id
        where l.n is distinct from r.n or l.scores <> r.scores or l.titles <> r.titles or l.tags <> r.tags""",
        "copies as (select Id, if(Id % 101 = 0, Score + 1, Score) as Score, if(Id % 89 = 0, null, Title) as Title, Tags "
        "from posts where Id % 97 <> 0 union all select Id, Score, Title, Tags from posts where Id % 103 = 0)",
        f"lefts as ({_bags('posts')})", f"rights as ({_bags('copies')})",
    ),
    "load_log": sql(f"""select 'votes' as "table", 1 as version, 'create' as op, count(*) as rows
            from votes where anio <= {LAST_OLD_YEAR}
        union all select 'votes', 2, 'merge', count(*) from votes
        union all select 'posts', 1, 'overwrite', count(*) from posts"""),
    "tolerant_counts": sql("""select 'posts' as tabla, count(*) as filas, cast(null as varchar) as error from posts
        union all select 'none', null, 'table not found'"""),
    "table_overwrite_twice": sql("select * from badges"),
    "create_empty_then_merge": sql("select * from badges"),
    # generators
    "gen_users": generated("customer", "c_custkey + 1", GEN_USERS),
    "gen_posts": generated("orders", "o_orderkey + 1", GEN_POSTS),
    "gen_votes": generated("lineitem", "l_orderkey * 10 + l_linenumber", GEN_VOTES),
    "gen_badges": generated("events", "event_id + 1", GEN_BADGES),
    "gen_posts_text_dates": generated("orders", "o_orderkey + 1", GEN_POSTS_TEXT),
    "gen_votes_text_dates": generated("lineitem", "l_orderkey * 10 + l_linenumber", GEN_VOTES_TEXT),
    "gen_badges_text_dates": generated("events", "event_id + 1", GEN_BADGES_TEXT),
}

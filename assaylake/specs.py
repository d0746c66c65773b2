"""Canonical schema, defaults and merge rules of the four history tables."""

from __future__ import annotations

from dataclasses import dataclass, field


def fold(name: str) -> str:
    """Spelling-independent form of a column name."""
    return name.replace("_", "").lower()


@dataclass(frozen=True)
class EntitySpec:
    entity: str
    table: str
    key: str
    # canonical column -> Spark type, in table order
    columns: dict[str, str]
    fills: dict[str, object]
    # columns overwritten when a key is matched by an upsert
    update_cols: tuple[str, ...]
    # columns that decide which of several rows of one key is the latest
    latest_by: tuple[str, ...]
    # keep input columns the spec does not know
    passthrough: bool = True
    # bronze is split by year
    yearly: bool = True
    # foreign spellings that folding alone does not reach
    aliases: dict[str, str] = field(default_factory=dict)

    def canonical(self, name: str) -> str | None:
        """Canonical name of an input column, or None when it is unknown."""
        lookup = {fold(c): c for c in self.columns}
        lookup.update({fold(a): c for a, c in self.aliases.items()})
        return lookup.get(fold(name))


# ---- fixed values: they must equal the published schemas and defaults -------

SOURCE_NAME = "clickhouse_stackoverflow"
SIMPLE_SOURCE_NAME = "stackoverflow_bronze"
DEFAULT_YEARS = (2019, 2020, 2021)

POST_TYPES = {1: "Question", 2: "Answer"}
OTHER_POST_TYPE = "Other"
QUESTION, ANSWER = 1, 2
UP_VOTE, DOWN_VOTE = 2, 3
GOLD_CLASS, SILVER_CLASS, BRONZE_CLASS = 1, 2, 3

USERS = EntitySpec(
    entity="users",
    table="users_hist",
    key="id",
    columns={
        "id": "long",
        "reputation": "long",
        "creation_date": "timestamp",
        "display_name": "string",
        "last_access_date": "timestamp",
        "views": "long",
        "up_votes": "long",
        "down_votes": "long",
        "location": "string",
        "account_id": "long",
    },
    fills={"display_name": "Unknown", "location": "", "account_id": -1},
    update_cols=(
        "reputation", "creation_date", "last_access_date", "display_name",
        "views", "up_votes", "down_votes", "location", "account_id",
        "anio", "fecha_cargue", "fuente",
    ),
    latest_by=("anio", "last_access_date"),
    passthrough=False,
)

POSTS = EntitySpec(
    entity="posts",
    table="post_hist",
    key="Id",
    columns={
        "Id": "long",
        "PostTypeId": "int",
        "CreationDate": "timestamp",
        "Score": "long",
        "ViewCount": "long",
        "OwnerUserId": "long",
        "OwnerDisplayName": "string",
        "LastActivityDate": "timestamp",
        "Title": "string",
        "Tags": "string",
        "AnswerCount": "long",
        "CommentCount": "long",
        "FavoriteCount": "long",
    },
    fills={"Title": "", "Tags": "", "OwnerDisplayName": "Unknown"},
    update_cols=(
        "Score", "ViewCount", "AnswerCount", "CommentCount", "FavoriteCount",
        "LastActivityDate", "anio", "fecha_cargue", "fuente",
    ),
    latest_by=("anio", "LastActivityDate"),
    aliases={"post_id": "Id"},
)

VOTES = EntitySpec(
    entity="votes",
    table="votes_hist",
    key="Id",
    columns={
        "Id": "long",
        "PostId": "long",
        "VoteTypeId": "int",
        "CreationDate": "timestamp",
        "UserId": "long",
        "BountyAmount": "long",
    },
    fills={"UserId": -1, "BountyAmount": 0},
    update_cols=(
        "PostId", "VoteTypeId", "UserId", "BountyAmount", "CreationDate",
        "anio", "fecha_cargue",
    ),
    latest_by=("anio", "CreationDate"),
    aliases={"vote_id": "Id"},
)

BADGES = EntitySpec(
    entity="badges",
    table="badges_hist",
    key="Id",
    columns={
        "Id": "long",
        "UserId": "long",
        "Name": "string",
        "Date": "timestamp",
        "Class": "int",
        "TagBased": "boolean",
    },
    fills={"Name": "Unknown", "TagBased": False},
    update_cols=("UserId", "Name", "Date", "Class", "TagBased", "fecha_cargue"),
    latest_by=("Date",),
    yearly=False,
    aliases={"badge_id": "Id", "badge_name": "Name"},
)

# users as the notebooks spell and merge them: key Id, and neither the creation
# date nor the account is ever updated
USERS_PASCAL_UPDATE_COLS = (
    "Reputation", "LastAccessDate", "DisplayName", "Views", "UpVotes",
    "DownVotes", "Location", "anio", "fecha_cargue", "fuente",
)

# ---- end of fixed values ----------------------------------------------------

ENTITIES = {s.entity: s for s in (USERS, POSTS, VOTES, BADGES)}

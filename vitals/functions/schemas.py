"""Schemas, enumerations and weights of the event data model.

Everything in the block marked FIXED VALUES must stay equal to the behaviour this
project reproduces: event types kept in silver, allowed actions, score weights and
the text patterns used to parse raw events and to check contracts.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the reproduced behaviour exactly)
# ---------------------------------------------------------------------------

# Event types kept in silver, in their natural order.
KNOWN_EVENT_TYPES: tuple[str, ...] = (
    "PushEvent",
    "PullRequestEvent",
    "IssuesEvent",
    "WatchEvent",
    "IssueCommentEvent",
    "PullRequestReviewEvent",
    "PullRequestReviewCommentEvent",
    "CreateEvent",
    "DeleteEvent",
    "ForkEvent",
    "ReleaseEvent",
    "CommitCommentEvent",
)

# Allowed silver actions; pushed, created and deleted are synthesised.
KNOWN_ACTIONS: tuple[str, ...] = (
    "assigned",
    "closed",
    "dismissed",
    "labeled",
    "opened",
    "published",
    "reopened",
    "started",
    "unassigned",
    "unlabeled",
    "updated",
    "forked",
    "merged",
    "pushed",
    "created",
    "deleted",
)

# Actions synthesised from the event type when the payload has none.
SYNTHETIC_ACTIONS: tuple[tuple[str, str], ...] = (
    ("PushEvent", "pushed"),
    ("CreateEvent", "created"),
    ("DeleteEvent", "deleted"),
)

# Activity score weights and cap.
SCORE_WEIGHTS: tuple[tuple[str, int], ...] = (
    ("PushEvent", 1),
    ("PullRequestEvent", 5),
    ("IssuesEvent", 3),
    ("WatchEvent", 2),
)
SCORE_CAP: float = 100.0

# Text patterns.
CREATED_AT_FORMAT: str = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ACTION_REGEX: str = r'"action"\s*:\s*"([a-z_]+)"'
BOT_REGEX: str = r"\[bot\]|bot$"
YEAR_REGEX: str = r"^\d{4}$"
MONTH_REGEX: str = r"^(0[1-9]|1[0-2])$"
DAY_REGEX: str = r"^(0[1-9]|[12]\d|3[01])$"
HOUR_REGEX: str = r"^(0\d|1\d|2[0-3])$"

# Watermark used when the gold table does not exist yet (full backfill).
GOLD_SENTINEL_DAY: str = "2014-12-31"

# ---------------------------------------------------------------------------
# Spark schemas
# ---------------------------------------------------------------------------

# Raw events: every field is text, nested objects stay raw JSON.
BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("actor", T.StringType()),
        T.StructField("repo", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("public", T.BooleanType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("org", T.StringType()),
    ]
)
BRONZE_PARTITIONS: tuple[str, ...] = ("year", "month", "day", "hour")

ACTOR_STRUCT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("login", T.StringType()),
        T.StructField("display_login", T.StringType()),
        T.StructField("gravatar_id", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("avatar_url", T.StringType()),
    ]
)
REPO_STRUCT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("url", T.StringType()),
    ]
)
ORG_STRUCT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("login", T.StringType()),
        T.StructField("gravatar_id", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("avatar_url", T.StringType()),
    ]
)

SILVER_EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("actor_id", T.LongType()),
        T.StructField("repo_id", T.LongType()),
        T.StructField("org_id", T.LongType()),
        T.StructField("public", T.BooleanType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("year", T.StringType()),
        T.StructField("month", T.StringType()),
        T.StructField("day", T.StringType()),
        T.StructField("hour", T.StringType()),
    ]
)
EVENT_PARTITIONS: tuple[str, ...] = ("year", "month", "day", "hour")

ACTORS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("login", T.StringType()),
        T.StructField("display_login", T.StringType()),
        T.StructField("gravatar_id", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("avatar_url", T.StringType()),
        T.StructField("is_bot", T.BooleanType()),
        T.StructField("first_seen_at", T.TimestampNTZType()),
        T.StructField("inserted_at", T.TimestampNTZType()),
    ]
)
REPOS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("first_seen_at", T.TimestampNTZType()),
        T.StructField("inserted_at", T.TimestampNTZType()),
    ]
)
ORGS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("login", T.StringType()),
        T.StructField("gravatar_id", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("avatar_url", T.StringType()),
        T.StructField("first_seen_at", T.TimestampNTZType()),
        T.StructField("inserted_at", T.TimestampNTZType()),
    ]
)

# Columns kept per dimension in the static extract.
EXTRACT_DIM_COLUMNS: dict[str, tuple[str, ...]] = {
    "orgs": ("id", "login"),
    "repos": ("id", "name"),
    "actors": ("id", "login", "is_bot"),
}

GOLD_COUNT_COLUMNS: tuple[str, ...] = (
    "total_events",
    "unique_actors",
    "push_events",
    "pr_events",
    "issue_events",
    "watch_events",
    "fork_events",
    "release_events",
    "comment_events",
    "review_events",
    "prs_opened",
    "prs_merged",
    "prs_closed",
    "prs_closed_unmerged",
    "issues_opened",
    "issues_closed",
)
GOLD_PARTITIONS: tuple[str, ...] = ("year", "month", "day")

# Bitmaps of the ids of each day, partitioned like gold.
DAY_SETS_SCHEMA = T.StructType(
    [
        T.StructField("at_midnight", T.BooleanType()),
        T.StructField("kind", T.StringType()),
        T.StructField("page", T.LongType()),
        T.StructField("bits", T.BinaryType()),
        T.StructField("year", T.StringType()),
        T.StructField("month", T.StringType()),
        T.StructField("day", T.DateType()),
    ]
)

# Raw rows that a silver batch sets aside: what was delivered, the archive hour, and why.
REJECTS_SCHEMA = T.StructType(
    [
        *(f for f in BRONZE_SCHEMA.fields),
        T.StructField("source", T.StringType()),
        T.StructField("reasons", T.ArrayType(T.StringType())),
        T.StructField("batch", T.StringType()),
    ]
)

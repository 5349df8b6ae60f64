"""Driver tables → raw event rows of the lakehouse data model.

The driver's ``events`` table (event_id, ts, user_id, event_type, value, props) has
no code-hosting semantics, so this module maps every row to one raw event with JSON
text for actor, repo, org and payload, exactly as an hourly archive file would hold
it. The mapping is a deterministic function of the row, runs as one projection over
the whole table and so grows with it. The independent SQL version of the same rules
lives in :mod:`vitals.oracle`.

Let k = props.k, b = event_id mod 20, j = event_id div 20.

* type: b<6 Push; <9 PullRequest; <11 Issues; <13 Watch; 13 IssueComment;
  14 PullRequestReview; 15 PullRequestReviewComment; 16 Create; 17 Fork; 18 Release;
  19 by k mod 4: Delete, CommitComment, Gollum, Member (the last two are not kept).
* payload: PR action by j mod 4 (opened, closed, merged, reopened); Issues by j mod 3
  (opened, closed, labeled); Watch started; 13-15 created; Fork forked; Release
  published; CommitComment has the action only nested (regex fallback); Push, Create,
  Delete, Gollum, Member carry none (synthesised later).
* id: event_id as text; every row with event_id mod 50 = 0 is delivered twice.
* actor: user_id, missing when event_id mod 97 = 0; login ``user<id>`` with suffix
  ``[bot]`` (user_id mod 10 = 0) or ``bot`` (mod 10 = 1); from 2024-01-16 users with
  user_id mod 7 = 0 are renamed with prefix ``r-``.
* repo: 0 when k < 30 (a hot repository), else k mod 40; repo 5 is renamed from
  2024-01-20.
* org: 0 when k < 30; missing when k mod 4 = 3; else k mod 7.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitals.functions.columns import format_created_at, zero_pad

ACTOR_RENAME_FROM = "2024-01-16 00:00:00"
REPO_RENAME_FROM = "2024-01-20 00:00:00"
RENAMED_REPO_ID = 5


#: Types by b, below 19.
_TYPES = (
    *["PushEvent"] * 6,
    *["PullRequestEvent"] * 3,
    *["IssuesEvent"] * 2,
    *["WatchEvent"] * 2,
    "IssueCommentEvent",
    "PullRequestReviewEvent",
    "PullRequestReviewCommentEvent",
    "CreateEvent",
    "ForkEvent",
    "ReleaseEvent",
)


def _one_of(values: tuple[str, ...], at: Column) -> Column:
    """The ``at``-th value, counted from 0; a null or negative ``at`` gives the first."""
    return F.element_at(F.array(*(F.lit(v) for v in values)), F.greatest(at, F.lit(0)).cast("int") + 1)


def _text(c: Column) -> Column:
    """A number as text, ``null`` for null."""
    return F.coalesce(c.cast("string"), F.lit("null"))


def _event_type(b: Column, k: Column) -> Column:
    return (
        F.when(b < 19, _one_of(_TYPES, b))
        .when(k % 4 == 0, "DeleteEvent")
        .when(k % 4 == 1, "CommitCommentEvent")
        .when(k % 4 == 2, "GollumEvent")
        .otherwise("MemberEvent")
    )


def _payload(etype: Column, j: Column, k: Column) -> Column:
    def with_action(actions: tuple[str, ...], at: Column) -> Column:
        # without a number there is no action either
        action = F.when(j.isNull(), "null").otherwise(F.element_at(F.array(*(F.lit(a) for a in actions)), (at + 1).cast("int")))
        return F.concat(F.lit('{"action": "'), action, F.lit('", "number": '), _text(j), F.lit("}"))

    return (
        F.when(etype == "PullRequestEvent", with_action(("opened", "closed", "merged", "reopened"), j % 4))
        .when(etype == "IssuesEvent", with_action(("opened", "closed", "labeled"), j % 3))
        .when(etype == "WatchEvent", F.lit('{"action":"started"}'))
        .when(
            etype.isin("IssueCommentEvent", "PullRequestReviewEvent", "PullRequestReviewCommentEvent"),
            F.concat(F.lit('{"action":"created","comment":{"id":'), _text(j), F.lit("}}")),
        )
        .when(etype == "ForkEvent", F.lit('{"action":"forked"}'))
        .when(etype == "ReleaseEvent", F.lit('{"action":"published"}'))
        .when(etype == "CommitCommentEvent", F.concat(F.lit('{"comment": {"id": '), _text(j), F.lit(', "action" : "created"}}')))
        .otherwise(F.concat(F.lit('{"size":'), _text(k), F.lit("}")))
    )


def _object(id_: Column, *fields: tuple[str, Column]) -> Column:
    """JSON text of an id, left out if null, and of text fields that need no escapes and aren't null."""
    head = F.coalesce(F.concat(F.lit('{"id":'), id_.cast("string"), F.lit(",")), F.lit("{"))
    parts = [head]
    for i, (name, value) in enumerate(fields):
        parts += [F.lit(f'{"," if i else ""}"{name}":"'), value, F.lit('"')]
    return F.concat(*parts, F.lit("}"))


def raw_events(events: DataFrame) -> DataFrame:
    """Raw event rows (all text, JSON objects as text) plus the archive hour they
    belong to (``file_hour``, the hour of created_at).

    In steps of few columns each, which keeps the generated methods short."""
    k = F.get_json_object("props", "$.k").cast("long")
    base = events.select(
        "event_id",
        "ts",
        "user_id",
        k.alias("k"),
        (F.col("event_id") % 20).alias("b"),
        F.expr("event_id div 20").alias("j"),
    )
    uid, k = F.col("user_id"), F.col("k")
    name = _text(uid)
    login = (
        F.when(uid % 10 == 0, F.concat(F.lit("user"), name, F.lit("[bot]")))
        .when(uid % 10 == 1, F.concat(F.lit("user"), name, F.lit("bot")))
        .otherwise(F.concat(F.lit("user"), name))
    )
    renamed = (uid % 7 == 0) & (F.col("ts") >= F.lit(ACTOR_RENAME_FROM).cast("timestamp_ntz"))
    hot = k < 30
    named = base.select(
        "*",
        _event_type(F.col("b"), k).alias("type"),
        F.concat(F.when(renamed, F.lit("r-")).otherwise(F.lit("")), login).alias("login"),
        F.when(hot, F.lit(0).cast("long")).otherwise(k % 40).alias("repo_id"),
        F.when(hot, F.lit(0).cast("long")).when(k % 4 == 3, F.lit(None).cast("long")).otherwise(k % 7).alias("org_id"),
    )
    repo_id, org_id = F.col("repo_id"), F.col("org_id")
    moved = (repo_id == RENAMED_REPO_ID) & (F.col("ts") >= F.lit(REPO_RENAME_FROM).cast("timestamp_ntz"))
    named = named.select(
        "*",
        F.concat(F.when(moved, F.lit("org/renamed")).otherwise(F.lit("org/repo")), _text(repo_id)).alias("repo_name"),
        F.concat(F.lit("org"), _text(org_id)).alias("org_login"),
        _payload(F.col("type"), F.col("j"), k).alias("payload"),
    )
    login, repo_name, org_login = F.col("login"), F.col("repo_name"), F.col("org_login")
    actor = F.when(
        F.col("event_id") % 97 != 0,
        _object(
            uid,
            ("login", login),
            ("display_login", login),
            ("gravatar_id", F.lit("")),
            ("url", F.concat(F.lit("https://api.github.com/users/"), login)),
            ("avatar_url", F.concat(F.lit("https://avatars.githubusercontent.com/u/"), name, F.lit("?"))),
        ),
    )
    repo = _object(repo_id, ("name", repo_name), ("url", F.concat(F.lit("https://api.github.com/repos/"), repo_name)))
    org = F.when(
        org_id.isNotNull(),
        _object(
            org_id,
            ("login", org_login),
            ("gravatar_id", F.lit("")),
            ("url", F.concat(F.lit("https://api.github.com/orgs/"), org_login)),
            ("avatar_url", F.concat(F.lit("https://avatars.githubusercontent.com/u/"), _text(org_id), F.lit("?"))),
        ),
    )
    copies = F.when(F.col("event_id") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return named.select(
        F.col("event_id").cast("string").alias("id"),
        "type",
        actor.alias("actor"),
        repo.alias("repo"),
        "payload",
        F.lit(True).alias("public"),
        format_created_at("ts").alias("created_at"),
        org.alias("org"),
        F.date_trunc("hour", F.col("ts")).alias("file_hour"),
        F.explode(copies).alias("_copy"),
    ).drop("_copy")


def bronze_frame(events: DataFrame, ingested_at: str = "2024-02-01 00:00:00") -> DataFrame:
    """Raw rows in landed-bronze shape: + source_file, ingestion_timestamp and the
    year/month/day/hour partition columns of the archive file."""
    return bronze_of(raw_events(events), ingested_at)


def bronze_of(raw: DataFrame, ingested_at: str = "2024-02-01 00:00:00") -> DataFrame:
    """Any raw rows with ``file_hour`` in landed-bronze shape."""
    fh = F.col("file_hour")
    return raw.select(
        "id",
        "type",
        "actor",
        "repo",
        "payload",
        "public",
        "created_at",
        "org",
        archive_file_name(fh).alias("source_file"),
        F.lit(ingested_at).cast("timestamp").alias("ingestion_timestamp"),
        F.year(fh).cast("string").alias("year"),
        zero_pad(F.month(fh)).alias("month"),
        zero_pad(F.dayofmonth(fh)).alias("day"),
        zero_pad(F.hour(fh)).alias("hour"),
    )


#: Added to an event_id it gives a new event of the same kind: a multiple of all the numbers above.
NEW_IDS = 29_100_000_000


def new_like(events: DataFrame) -> DataFrame:
    """Further events that look like the given ones, under new ids."""
    return events.withColumn("event_id", F.col("event_id") + F.lit(NEW_IDS))


def damaged(raw: DataFrame) -> DataFrame:
    """Raw rows of which some are broken, by their id: 211 the actor is cut, 223 the id is no number, 227 the time is no
    time, 229 the repository and 233 the organisation are no JSON."""
    n = F.col("id").cast("long")
    return raw.withColumns(
        {
            "actor": F.when(n % 211 == 0, F.substring("actor", 1, 10)).otherwise(F.col("actor")),
            "created_at": F.when(n % 227 == 0, F.lit("not a time")).otherwise(F.col("created_at")),
            "repo": F.when(n % 229 == 0, F.lit('{"id":')).otherwise(F.col("repo")),
            "org": F.when((n % 233 == 0) & F.col("org").isNotNull(), F.lit("[")).otherwise(F.col("org")),
            "id": F.when(n % 223 == 0, F.concat(F.lit("evt_"), F.col("id"))).otherwise(F.col("id")),
        }
    )


def archive_file_name(hour_ts: Column) -> Column:
    """``2024-01-05-7.json.gz``: archive naming, hour not padded."""
    day = F.coalesce(F.date_format(hour_ts, "yyyy-MM-dd"), F.lit("null"))
    return F.concat(day, F.lit("-"), _text(F.hour(hour_ts)), F.lit(".json.gz"))

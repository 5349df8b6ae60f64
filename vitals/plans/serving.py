"""Metric queries over gold and silver (overview, community, development, ecosystem).

Every query is a lazy function ``(lake, start, end, ...) -> DataFrame``; the caller
decides on the action. Date semantics follow the reproduced behaviour:

* gold queries keep ``day BETWEEN start AND end`` (both days included);
* silver queries keep ``created_at BETWEEN start 00:00 AND end 00:00``, so the end
  day only contributes its exact midnight instant (``include_end_day=True`` widens
  the window to the whole end day).

Joins always go to the newest version of a dimension (one row per id), so a renamed
actor or repository is never counted twice. Where the output is a top-k, the limit
is taken on the aggregated rows before the dimension join, so the join sees k rows;
every limit has a full order (the id breaks ties).

Shapes that matter at scale:

* big-side aggregation happens before any dimension join (events are first reduced
  to (day, actor) or (actor, repo) rows), so a hot actor or repository is combined
  map-side instead of being shuffled row by row into one join task;
* one-row aggregates are combined by a union and one more aggregate (no join at all);
* cumulative sums run over per-day rows only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitals.functions.columns import one_row, round_even, stable
from vitals.operators import distincts as DS
from vitals.operators import silver as SV
from vitals.sources.lake import Lake


def _day(d: str | dt.date) -> Column:
    return F.lit(str(d)).cast("date")


def gold_window(lake: Lake, start: str, end: str) -> DataFrame:
    """Gold rows with day in [start, end] (prunes day partitions of the table)."""
    return lake.gold().where(F.col("day").between(_day(start), _day(end)))


def silver_window(lake: Lake, start: str, end: str, include_end_day: bool = False) -> DataFrame:
    """Silver events with created_at in [start 00:00, end 00:00] (or the whole end day).

    The same bounds are also stated on the table's partition columns (``lake.on_days``) so
    a partitioned table is pruned to the days in range."""
    lo = F.lit(f"{start} 00:00:00").cast("timestamp_ntz")
    end_excl = dt.date.fromisoformat(str(end)) + dt.timedelta(days=1)
    if include_end_day:
        ts_ok = (F.col("created_at") >= lo) & (F.col("created_at") < F.lit(f"{end_excl} 00:00:00").cast("timestamp_ntz"))
    else:
        ts_ok = F.col("created_at").between(lo, F.lit(f"{end} 00:00:00").cast("timestamp_ntz"))
    return lake.events().where(ts_ok & lake.on_days(start, end))


def _sum(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).cast("long")


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan (file sizes through projections / filters)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))  # noqa: SLF001
    except Exception:  # noqa: BLE001 - unknown size: treat as large (never broadcast)
        return 1 << 62


def broadcast_limit(spark) -> int:
    """The session's broadcast threshold in bytes (accepts "10485760" or "10MB")."""
    v = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for suffix in sorted(units, key=len, reverse=True):
        if v.endswith(suffix) and v[: -len(suffix)].strip().lstrip("-").isdigit():
            return int(v[: -len(suffix)]) * units[suffix]
    return int(v)


def _latest_for(dim: DataFrame, track: str, ids: DataFrame, id_col: str) -> DataFrame:
    """Latest (id, track) rows needed to name the ≤ k ``ids``.

    Checked size: when the dimension's estimated size is within the broadcast limit its
    whole latest version is built once and broadcast; beyond that the dimension is
    first cut by a semi join with the k ids (broadcast, ≤ k rows), so the per-id
    aggregation only sees the versions of those ids and never the whole dimension."""
    if estimated_bytes(dim) <= broadcast_limit(dim.sparkSession):
        return SV.latest_dim(dim, track, ["id", track])
    wanted = F.broadcast(ids.select(F.col(id_col).alias("id")).where(F.col("id").isNotNull()))
    return SV.latest_dim(dim.join(wanted, "id", "left_semi"), track, ["id", track])


def _topk_join_name(ranked: DataFrame, lake: Lake, order: list[Column], limit: int, select: list[Column]) -> DataFrame:
    """Top ``limit`` aggregated repo rows, then the latest repo name (left join)."""
    top = ranked.orderBy(*order, F.col("repo_id").asc()).limit(limit)
    names = _latest_for(lake.repos(), "name", top, "repo_id").withColumnRenamed("id", "repo_id")
    return top.join(F.broadcast(names), "repo_id", "left").select(*select)


# ---------------------------------------------------------------------------
# Overview
# ---------------------------------------------------------------------------


def overview_kpis(lake: Lake, start: str, end: str) -> DataFrame:
    """Q01: six KPIs in one row: five from gold, distinct contributors from the days' bitmaps, or from silver in a lake
    without them. With bitmaps all six are as of the last gold batch."""
    g = gold_window(lake, start, end).agg(
        _sum("total_events").alias("total_events"),
        F.count_distinct("repo_id").alias("active_repos"),
        stable(F.avg("pr_merge_rate")).alias("avg_pr_merge_rate"),
        stable(F.avg("issue_close_rate")).alias("avg_issue_close_rate"),
        stable(F.avg("activity_score")).alias("avg_activity_score"),
    )
    sets = lake.day_sets()
    if sets is None:
        s = silver_window(lake, start, end).agg(F.count_distinct("actor_id").alias("unique_contributors"))
    else:
        s = DS.count_ids(sets.where(DS.in_window(start, end)), "actor", "unique_contributors")
    return one_row(g, s)


def daily_timeline(lake: Lake, start: str, end: str) -> DataFrame:
    """Q02: events per day."""
    return gold_window(lake, start, end).groupBy("day").agg(_sum("total_events").alias("total_events")).orderBy("day")


# FIXED VALUES: chart labels of the eight counted event families, in order.
EVENT_TYPE_LABELS: tuple[tuple[str, str], ...] = (
    ("Push", "push_events"),
    ("Pull Request", "pr_events"),
    ("Issue", "issue_events"),
    ("Watch/Star", "watch_events"),
    ("Fork", "fork_events"),
    ("Release", "release_events"),
    ("Comment", "comment_events"),
    ("Review", "review_events"),
)


def event_type_distribution(lake: Lake, start: str, end: str) -> DataFrame:
    """Q03: (label, count) for the eight event families: one aggregate, then unpivot."""
    totals = gold_window(lake, start, end).agg(*(_sum(c).alias(label) for label, c in EVENT_TYPE_LABELS))
    return totals.unpivot([], [label for label, _ in EVENT_TYPE_LABELS], "label", "count")


def daily_event_breakdown(lake: Lake, start: str, end: str) -> DataFrame:
    """Q04: per day, five event-family sums and the mean score."""
    return (
        gold_window(lake, start, end)
        .groupBy("day")
        .agg(
            _sum("push_events").alias("push_events"),
            _sum("pr_events").alias("pr_events"),
            _sum("issue_events").alias("issue_events"),
            _sum("watch_events").alias("watch_events"),
            _sum("fork_events").alias("fork_events"),
            stable(F.avg("activity_score")).alias("avg_activity_score"),
        )
        .orderBy("day")
    )


def top_repos(lake: Lake, start: str, end: str, limit: int = 10) -> DataFrame:
    """Q05: top repositories by events, with mean score (1 dp)."""
    per_repo = gold_window(lake, start, end).groupBy("repo_id").agg(
        _sum("total_events").alias("total_events"), F.avg("activity_score").alias("avg_score")
    )
    return _topk_join_name(
        per_repo,
        lake,
        [F.col("total_events").desc()],
        limit,
        [F.col("name").alias("repo_name"), "total_events", round_even("avg_score", 1).alias("avg_score")],
    )


def trending_repos(lake: Lake, start: str, end: str, limit: int = 10) -> DataFrame:
    """Q06: top repositories by stars gained (stars > 0), with active days."""
    per_repo = (
        gold_window(lake, start, end)
        .groupBy("repo_id")
        .agg(_sum("watch_events").alias("stars_gained"), F.count_distinct("day").cast("long").alias("active_days"))
        .where(F.col("stars_gained") > 0)
    )
    return _topk_join_name(
        per_repo, lake, [F.col("stars_gained").desc()], limit, [F.col("name").alias("repo_name"), "stars_gained", "active_days"]
    )


# ---------------------------------------------------------------------------
# Community
# ---------------------------------------------------------------------------


def activity_heatmap(lake: Lake, end: str, event_type: str | None = None) -> DataFrame:
    """Q07: events by day of week (0 = Sunday) and hour over [end - 7 days, end 00:00]."""
    start = dt.date.fromisoformat(str(end)) - dt.timedelta(days=7)
    ev = silver_window(lake, str(start), str(end))
    if event_type:
        ev = ev.where(F.col("type") == event_type)
    return (
        ev.groupBy(
            (F.dayofweek("created_at") - 1).cast("short").alias("dow"),
            F.hour("created_at").cast("short").alias("hour"),
        )
        .agg(F.count(F.lit(1)).alias("events"))
        .orderBy("dow", "hour")
    )


def _actor_activity(lake: Lake, start: str, end: str, keys: list[str], extra: list[Column] | None = None, where: Column | None = None) -> DataFrame:
    """Silver events in range reduced to one row per (actor_id, *keys) before any join."""
    ev = silver_window(lake, start, end)
    if where is not None:
        ev = ev.where(where)
    cols = [F.count(F.lit(1)).alias("n")] + (extra or [])
    return ev.groupBy("actor_id", *keys).agg(*cols)


def _with_actor(pre: DataFrame, lake: Lake) -> DataFrame:
    actors = lake.latest_actors().withColumnRenamed("id", "actor_id")
    return pre.join(actors, "actor_id", "left")


def top_contributors(lake: Lake, start: str, end: str, limit: int = 50) -> DataFrame:
    """Q08: top actors by events, with distinct repositories and PR events.

    Events are first reduced to (actor, repo) rows, so the distinct repository count
    per login stays exact while the join input shrinks to distinct pairs."""
    pre = _actor_activity(
        lake, start, end, ["repo_id"], [F.count_if(F.col("type") == "PullRequestEvent").alias("prs")]
    )
    per_login = (
        _with_actor(pre, lake)
        .groupBy("login", "is_bot")
        .agg(
            F.sum("n").cast("long").alias("events"),
            F.count_distinct("repo_id").cast("long").alias("repos"),
            F.sum("prs").cast("long").alias("prs"),
        )
    )
    return per_login.orderBy(F.col("events").desc(), F.col("login").asc_nulls_first(), F.col("is_bot").asc_nulls_first()).limit(limit)


def contributors_over_time(lake: Lake, start: str, end: str) -> DataFrame:
    """Q09: distinct actors per day and bot flag."""
    pre = _actor_activity(lake, start, end, [F.to_date("created_at").alias("day")])
    return (
        _with_actor(pre, lake)
        .groupBy("day", "is_bot")
        # rows are unique per actor and day already
        .agg(F.count("actor_id").cast("long").alias("contributors"))
        .orderBy("day", "is_bot")
    )


def bot_vs_human(lake: Lake, start: str, end: str) -> DataFrame:
    """Q10: events per day and bot flag (null flag = actor missing from the dimension)."""
    pre = _actor_activity(lake, start, end, [F.to_date("created_at").alias("day")])
    return _with_actor(pre, lake).groupBy("day", "is_bot").agg(F.sum("n").cast("long").alias("events")).orderBy("day", "is_bot")


def pr_bot_breakdown(lake: Lake, start: str, end: str) -> DataFrame:
    """Q12: pull-request events per day and bot flag."""
    pre = _actor_activity(lake, start, end, [F.to_date("created_at").alias("day")], where=F.col("type") == "PullRequestEvent")
    return _with_actor(pre, lake).groupBy("day", "is_bot").agg(F.sum("n").cast("long").alias("prs")).orderBy("day", "is_bot")


# ---------------------------------------------------------------------------
# Development
# ---------------------------------------------------------------------------


def pr_metrics(lake: Lake, start: str, end: str) -> DataFrame:
    """Q11: per day PR opened / merged / closed unmerged and the mean merge rate."""
    return (
        gold_window(lake, start, end)
        .groupBy("day")
        .agg(
            _sum("prs_opened").alias("prs_opened"),
            _sum("prs_merged").alias("prs_merged"),
            _sum("prs_closed_unmerged").alias("prs_closed_unmerged"),
            stable(F.avg("pr_merge_rate")).alias("avg_merge_rate"),
        )
        .orderBy("day")
    )


def issue_metrics(lake: Lake, start: str, end: str) -> DataFrame:
    """Q13: per day issues opened / closed and the mean close rate."""
    return (
        gold_window(lake, start, end)
        .groupBy("day")
        .agg(
            _sum("issues_opened").alias("issues_opened"),
            _sum("issues_closed").alias("issues_closed"),
            stable(F.avg("issue_close_rate")).alias("avg_close_rate"),
        )
        .orderBy("day")
    )


def code_review_metrics(lake: Lake, start: str, end: str) -> DataFrame:
    """Q14: per day PR, review and comment events."""
    return (
        gold_window(lake, start, end)
        .groupBy("day")
        .agg(_sum("pr_events").alias("pr_events"), _sum("review_events").alias("review_events"), _sum("comment_events").alias("comment_events"))
        .orderBy("day")
    )


def repo_health(lake: Lake, start: str, end: str, limit: int = 10) -> DataFrame:
    """Q15: top repositories by events with score, rates and reviews per PR."""
    per_repo = gold_window(lake, start, end).groupBy("repo_id").agg(
        _sum("total_events").alias("total_events"),
        F.avg("activity_score").alias("avg_score"),
        F.avg("pr_merge_rate").alias("avg_merge_rate"),
        F.avg("issue_close_rate").alias("avg_close_rate"),
        _sum("review_events").alias("total_reviews"),
        _sum("pr_events").alias("total_prs"),
    )
    return _topk_join_name(
        per_repo,
        lake,
        [F.col("total_events").desc()],
        limit,
        [
            F.col("name").alias("repo_name"),
            "total_events",
            round_even("avg_score", 1).alias("avg_score"),
            round_even("avg_merge_rate", 3).alias("avg_merge_rate"),
            round_even("avg_close_rate", 3).alias("avg_close_rate"),
            F.when(F.col("total_prs") > 0, round_even(F.col("total_reviews") / F.col("total_prs"), 2)).alias("review_per_pr"),
        ],
    )


# ---------------------------------------------------------------------------
# Ecosystem
# ---------------------------------------------------------------------------


def ecosystem_kpis(lake: Lake, start: str, end: str) -> DataFrame:
    """Q16: ecosystem indicators in one row. Per-day figures are aggregated first
    (one row per day), then averaged; an empty range gives nulls, not an error."""
    g = gold_window(lake, start, end)
    totals = g.agg(
        F.count_distinct("repo_id").cast("long").alias("active_repos"),
        _sum("watch_events").alias("total_stars"),
        _sum("fork_events").alias("total_forks"),
        round_even(F.avg("activity_score"), 1).alias("avg_activity_score"),
        _sum("unique_actors").alias("unique_actors"),
    )
    daily = (
        g.groupBy("day")
        .agg(F.count_distinct("repo_id").alias("active_repos"), F.sum("watch_events").alias("stars"))
        .agg(
            round_even(F.coalesce(F.avg("stars"), F.lit(0.0)), 1).alias("avg_stars_per_day"),
            round_even(F.coalesce(F.avg("active_repos"), F.lit(0.0)), 1).alias("avg_active_repos_per_day"),
        )
    )
    return one_row(totals, daily).select(
        "active_repos",
        "total_stars",
        "total_forks",
        "avg_activity_score",
        "unique_actors",
        "avg_stars_per_day",
        "avg_active_repos_per_day",
        F.when(F.col("total_forks") > 0, round_even(F.col("total_stars") / F.col("total_forks"), 1)).alias("star_fork_ratio"),
    )


def org_summary(lake: Lake, start: str, end: str) -> DataFrame:
    """Q17: per organisation events, distinct repositories and mean score (1 dp)."""
    per_org = (
        gold_window(lake, start, end)
        .where(F.col("org_id").isNotNull())
        .groupBy("org_id")
        .agg(
            _sum("total_events").alias("total_events"),
            F.count_distinct("repo_id").cast("long").alias("active_repos"),
            F.avg("activity_score").alias("avg_score"),
        )
    )
    orgs = lake.latest_orgs().withColumnRenamed("id", "org_id")
    return (
        per_org.join(orgs, "org_id", "left")
        .orderBy(F.col("total_events").desc(), F.col("org_id"))
        .select(
            F.col("login").alias("org_name"),
            "total_events",
            "active_repos",
            round_even("avg_score", 1).alias("avg_activity_score"),
        )
    )


def active_repos_over_time(lake: Lake, start: str, end: str) -> DataFrame:
    """Q18: distinct active repositories per day."""
    return gold_window(lake, start, end).groupBy("day").agg(F.count_distinct("repo_id").cast("long").alias("active_repos")).orderBy("day")


def _growth(lake: Lake, start: str, end: str, src: str, name: str) -> DataFrame:
    per_day = gold_window(lake, start, end).groupBy("day").agg(_sum(src).alias(name))
    # Runs over one row per day: a single ordered partition is bounded by the number of days.
    running = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_day.withColumn(f"cumulative_{name}", F.sum(name).over(running).cast("long")).orderBy("day")


def star_growth(lake: Lake, start: str, end: str) -> DataFrame:
    """Q19: stars per day and running total."""
    return _growth(lake, start, end, "watch_events", "stars")


def fork_growth(lake: Lake, start: str, end: str) -> DataFrame:
    """Q20: forks per day and running total."""
    return _growth(lake, start, end, "fork_events", "forks")


def top_forked_repos(lake: Lake, start: str, end: str, limit: int = 10) -> DataFrame:
    """Q21: top repositories by forks (forks > 0)."""
    per_repo = gold_window(lake, start, end).groupBy("repo_id").agg(_sum("fork_events").alias("forks")).where(F.col("forks") > 0)
    return _topk_join_name(per_repo, lake, [F.col("forks").desc()], limit, [F.col("name").alias("repo_name"), "forks"])


def top_open_repos(lake: Lake, start: str, end: str, limit: int = 10, sort_by: str = "issues") -> DataFrame:
    """Q22: top repositories by issues opened (``sort_by='issues'``) or PRs opened."""
    sort_col = "prs_opened" if sort_by == "prs" else "issues_opened"
    per_repo = gold_window(lake, start, end).groupBy("repo_id").agg(
        _sum("issues_opened").alias("issues_opened"), _sum("prs_opened").alias("prs_opened")
    )
    return _topk_join_name(per_repo, lake, [F.col(sort_col).desc()], limit, [F.col("name").alias("repo_name"), "issues_opened", "prs_opened"])


def _first_org(g: DataFrame) -> Column:
    """The group's "first" org: the one of its earliest day, non-null before null,
    then the smallest id (a full order, so the answer is stable)."""
    return F.min_by("org_id", F.struct("day", F.col("org_id").isNull(), "org_id"))


def _with_repo_and_org(top: DataFrame, lake: Lake) -> DataFrame:
    """Names for ≤ k top rows: both dimensions are cut to the k ids first."""
    names = _latest_for(lake.repos(), "name", top, "repo_id").withColumnRenamed("id", "repo_id")
    orgs = _latest_for(lake.orgs(), "login", top, "org_id").select(F.col("id").alias("org_id"), F.col("login").alias("org_name"))
    return top.join(F.broadcast(names), "repo_id", "left").join(F.broadcast(orgs), "org_id", "left")


def stars_vs_forks(lake: Lake, start: str, end: str, limit: int = 60) -> DataFrame:
    """Q23: top repositories by stars (stars or forks > 0) with forks and org name."""
    per_repo = (
        gold_window(lake, start, end)
        .groupBy("repo_id")
        .agg(_sum("watch_events").alias("stars_gained"), _sum("fork_events").alias("forks"), _first_org(lake).alias("org_id"))
        .where((F.col("stars_gained") > 0) | (F.col("forks") > 0))
    )
    top = per_repo.orderBy(F.col("stars_gained").desc(), "repo_id").limit(limit)
    return _with_repo_and_org(top, lake).select(F.col("name").alias("repo_name"), "stars_gained", "forks", "org_name")


def star_engagement(lake: Lake, start: str, end: str, limit: int = 20) -> DataFrame:
    """Q24: top repositories by stars with PR + issue engagement and conversion rate."""
    per_repo = (
        gold_window(lake, start, end)
        .groupBy("repo_id")
        .agg(
            _sum("watch_events").alias("stars"),
            (_sum("pr_events") + _sum("issue_events")).alias("engagement"),
            _first_org(lake).alias("org_id"),
        )
        .where(F.col("stars") > 0)
    )
    top = per_repo.orderBy(F.col("stars").desc(), "repo_id").limit(limit)
    return _with_repo_and_org(top, lake).select(
        F.col("name").alias("repo_name"),
        "stars",
        "engagement",
        F.when(F.col("stars") > 0, round_even(F.col("engagement") / F.col("stars"), 3)).alias("conversion_rate"),
        "org_name",
    )


def date_range(lake: Lake) -> DataFrame:
    """Q25: first and last day present in gold."""
    return lake.gold().agg(F.min("day").alias("min_day"), F.max("day").alias("max_day"))

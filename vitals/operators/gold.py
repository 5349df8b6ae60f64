"""Silver → gold: one aggregate at grain (day, repo_id, org_id)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitals.functions.columns import activity_score, count_where, safe_ratio, zero_pad

GOLD_KEYS = ("day", "repo_id", "org_id")


def daily_activity(events: DataFrame, now: Column) -> DataFrame:
    """Daily activity per repository and organisation (null org is its own group).

    One scan, one aggregate. The exact distinct actor count makes Spark plan a
    two-level aggregate keyed first by (day, repo, org, actor), so a hot repository is
    spread over its actors before the final merge; all other counts are combined
    map-side.
    """
    t, a = F.col("type"), F.col("action")
    is_pr = t == "PullRequestEvent"
    is_issue = t == "IssuesEvent"
    agg = events.groupBy(F.to_date("created_at").alias("day"), "repo_id", "org_id").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct("actor_id").alias("unique_actors"),
        count_where(t == "PushEvent").alias("push_events"),
        count_where(is_pr).alias("pr_events"),
        count_where(is_issue).alias("issue_events"),
        count_where(t == "WatchEvent").alias("watch_events"),
        count_where(t == "ForkEvent").alias("fork_events"),
        count_where(t == "ReleaseEvent").alias("release_events"),
        count_where(t == "IssueCommentEvent").alias("comment_events"),
        count_where(t.isin("PullRequestReviewEvent", "PullRequestReviewCommentEvent")).alias("review_events"),
        count_where(is_pr & (a == "opened")).alias("prs_opened"),
        count_where(is_pr & (a == "merged")).alias("prs_merged"),
        count_where(is_pr & (a == "closed")).alias("prs_closed"),
        count_where(is_issue & (a == "opened")).alias("issues_opened"),
        count_where(is_issue & (a == "closed")).alias("issues_closed"),
    )
    unmerged = F.greatest(F.col("prs_closed") - F.col("prs_merged"), F.lit(0).cast("long"))
    return agg.select(
        *GOLD_KEYS,
        "total_events",
        F.col("unique_actors").cast("long").alias("unique_actors"),
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
        unmerged.alias("prs_closed_unmerged"),
        safe_ratio(F.col("prs_merged"), F.col("prs_merged") + unmerged).alias("pr_merge_rate"),
        "issues_opened",
        "issues_closed",
        safe_ratio(F.col("issues_closed"), F.col("issues_opened") + F.col("issues_closed")).alias("issue_close_rate"),
        activity_score(F.col("push_events"), F.col("pr_events"), F.col("issue_events"), F.col("watch_events")).alias("activity_score"),
        now.cast("timestamp_ntz").alias("updated_at"),
        F.year("day").cast("string").alias("year"),
        zero_pad(F.month("day")).alias("month"),
    )


def events_for_days(events: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Silver events whose created_at day is in [first_day, last_day] (both closed),
    projected to the six columns gold needs.

    The range is stated twice: on the zero-padded partition strings (so directory
    pruning applies on a partitioned table) and on created_at (exact)."""
    ymd = F.concat_ws("-", "year", "month", "day")
    return events.where(
        (ymd >= F.lit(first_day)) & (ymd <= F.lit(last_day))
        & (F.to_date("created_at") >= F.lit(first_day).cast("date"))
        & (F.to_date("created_at") <= F.lit(last_day).cast("date"))
    ).select("type", "action", "actor_id", "repo_id", "org_id", "created_at")

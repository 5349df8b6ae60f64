"""Derived metrics: the reshaping and ratios the dashboard computed in chart code,
as DataFrame operators over the serving queries' outputs (all small: one row per
day, per heatmap cell or per top-k entry)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitals.functions.columns import one_row, round_even, stable

# FIXED VALUES: labels of the PR funnel stages and the score bands, in order.
FUNNEL_STAGES: tuple[str, ...] = ("Opened", "Merged", "Closed w/o merge", "Still open")
SCORE_BANDS: tuple[tuple[str, float | None], ...] = (("low", 30.0), ("average", 60.0), ("good", None))
MISSING_ORG_LABEL = "n/a"


def pivot_bot_human(df: DataFrame, value: str) -> DataFrame:
    """(day, is_bot, value) → (day, human, bot) with 0 fill; rows of unknown actors
    (null is_bot) are left out. Pivot values are given, so no extra distinct job."""
    wide = df.where(F.col("is_bot").isNotNull()).groupBy("day").pivot("is_bot", [False, True]).agg(F.sum(value))
    return wide.select(
        "day",
        F.coalesce(F.col("false"), F.lit(0)).cast("long").alias("human"),
        F.coalesce(F.col("true"), F.lit(0)).cast("long").alias("bot"),
    ).orderBy("day")


def bot_human_totals(bot_vs_human: DataFrame) -> DataFrame:
    """Total human and bot events over the range (one row)."""
    return bot_vs_human.agg(
        F.coalesce(F.sum(F.when(F.col("is_bot") == F.lit(False), F.col("events"))), F.lit(0)).cast("long").alias("human_events"),
        F.coalesce(F.sum(F.when(F.col("is_bot"), F.col("events"))), F.lit(0)).cast("long").alias("bot_events"),
    )


def heatmap_grid(heatmap: DataFrame) -> DataFrame:
    """Densify (dow, hour, events) to all 7 × 24 cells with zeros, and attach the
    colour-scale statistics: max, upper median of non-zero cells, floor = 0.85 × median.

    The grid is generated from one row (no cross join); the statistics are windows
    over the 168 cells, a bound fixed by construction."""
    spark = heatmap.sparkSession
    cells = spark.range(1).select(F.explode(F.sequence(F.lit(0), F.lit(167))).alias("cell")).select(
        (F.col("cell") / 24).cast("short").alias("dow"), (F.col("cell") % 24).cast("short").alias("hour")
    )
    grid = cells.join(heatmap, ["dow", "hour"], "left").select("dow", "hour", F.coalesce("events", F.lit(0)).cast("long").alias("events"))
    w = Window.partitionBy(F.lit(0))
    nonzero = F.sort_array(F.collect_list(F.when(F.col("events") > 0, F.col("events"))).over(w))
    median = F.when(F.size(nonzero) > 0, F.element_at(nonzero, (F.size(nonzero) / 2).cast("int") + 1)).otherwise(F.lit(0)).cast("long")
    return grid.select(
        "dow",
        "hour",
        "events",
        F.max("events").over(w).alias("max_events"),
        median.alias("median_nonzero"),
        (median * F.lit(0.85)).alias("floor"),
    ).orderBy("dow", "hour")


def top_per_group(contributors: DataFrame, is_bot: bool, n: int = 10) -> DataFrame:
    """First ``n`` humans or bots of the top-contributor list (so fewer is possible)."""
    w = Window.partitionBy("is_bot").orderBy(F.col("events").desc(), F.col("login"))
    ranked = contributors.where(F.col("is_bot") == F.lit(is_bot)).withColumn("rank", F.row_number().over(w).cast("long"))
    return ranked.where(F.col("rank") <= n)


def pr_funnel(pr_metrics: DataFrame) -> DataFrame:
    """Opened, merged, closed unmerged and still open (clamped at 0), as (stage, count)."""
    t = pr_metrics.agg(
        F.coalesce(F.sum("prs_opened"), F.lit(0)).cast("long").alias("o"),
        F.coalesce(F.sum("prs_merged"), F.lit(0)).cast("long").alias("m"),
        F.coalesce(F.sum("prs_closed_unmerged"), F.lit(0)).cast("long").alias("c"),
    )
    still_open = F.greatest(F.col("o") - F.col("m") - F.col("c"), F.lit(0).cast("long"))
    stages = t.select(
        F.col("o").alias(FUNNEL_STAGES[0]),
        F.col("m").alias(FUNNEL_STAGES[1]),
        F.col("c").alias(FUNNEL_STAGES[2]),
        still_open.alias(FUNNEL_STAGES[3]),
    )
    return stages.unpivot([], list(FUNNEL_STAGES), "stage", "count")


def rate_pct(daily: DataFrame, rate: str, name: str) -> DataFrame:
    """Daily rate in percent, 1 dp, nulls kept."""
    return daily.select("day", round_even(F.col(rate) * F.lit(100.0), 1).alias(name)).orderBy("day")


def period_mean_rates(pr_daily: DataFrame, issue_daily: DataFrame) -> DataFrame:
    """Mean over days of the daily mean merge / close rate (one row each side)."""
    a = pr_daily.agg(stable(F.avg("avg_merge_rate")).alias("overall_merge_rate"))
    b = issue_daily.agg(stable(F.avg("avg_close_rate")).alias("overall_close_rate"))
    return one_row(a, b)


def review_totals(review_daily: DataFrame) -> DataFrame:
    """Reviews, comments and PRs over the range, per-PR ratios (2 dp, null if no PRs)."""
    t = review_daily.agg(
        F.coalesce(F.sum("review_events"), F.lit(0)).cast("long").alias("total_reviews"),
        F.coalesce(F.sum("comment_events"), F.lit(0)).cast("long").alias("total_comments"),
        F.coalesce(F.sum("pr_events"), F.lit(0)).cast("long").alias("total_prs"),
    )
    return t.select(
        "*",
        F.when(F.col("total_prs") > 0, round_even(F.col("total_reviews") / F.col("total_prs"), 2)).alias("reviews_per_pr"),
        F.when(F.col("total_prs") > 0, round_even(F.col("total_comments") / F.col("total_prs"), 2)).alias("comments_per_pr"),
    )


def review_ratios(review_daily: DataFrame) -> DataFrame:
    """Daily reviews per PR and comments per PR (2 dp, null if no PRs)."""
    p = F.col("pr_events")
    return review_daily.select(
        "day",
        F.when(p > 0, round_even(F.col("review_events") / p, 2)).alias("reviews_per_pr"),
        F.when(p > 0, round_even(F.col("comment_events") / p, 2)).alias("comments_per_pr"),
    ).orderBy("day")


def score_bands(breakdown: DataFrame, score_col: str = "avg_activity_score") -> DataFrame:
    """Daily mean score (2 dp) and its band: low ≤ 30, average ≤ 60, good > 60."""
    s = round_even(score_col, 2)
    band = F.when(s <= SCORE_BANDS[0][1], SCORE_BANDS[0][0]).when(s <= SCORE_BANDS[1][1], SCORE_BANDS[1][0]).otherwise(SCORE_BANDS[2][0])
    return breakdown.select("day", s.alias("score"), band.alias("band")).orderBy("day")


def distribution_share(distribution: DataFrame) -> DataFrame:
    """Non-zero event families with their share of the total in percent."""
    nz = distribution.where(F.col("count") > 0)
    total = F.sum("count").over(Window.partitionBy(F.lit(0)))
    return nz.select("label", "count", stable(F.col("count") * F.lit(100.0) / total).alias("share_pct"))


def head(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def org_label(df: DataFrame, col: str = "org_name") -> DataFrame:
    """Missing organisation names shown as "n/a"."""
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(MISSING_ORG_LABEL)))


def default_range(date_range: DataFrame, days: int = 30) -> DataFrame:
    """Dashboard default window: [max(min_day, max_day - days), max_day]."""
    return date_range.select(
        F.greatest(F.col("min_day"), F.date_sub(F.col("max_day"), days)).alias("start_day"),
        F.col("max_day").alias("end_day"),
    )

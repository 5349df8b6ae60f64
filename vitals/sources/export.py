"""Static extract for serving: a gold window, silver events by date, latest dims,
and the organisation CSV download."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitals.functions.schemas import EXTRACT_DIM_COLUMNS
from vitals.operators import silver as SV
from vitals.sources.lake import Lake

# FIXED VALUES: columns kept per dimension in the extract, and CSV headers.
DIM_COLUMNS: dict[str, tuple[str, ...]] = EXTRACT_DIM_COLUMNS
DIM_TRACK: dict[str, str] = {"orgs": "login", "repos": "name", "actors": "login"}
ORG_CSV_HEADERS: tuple[tuple[str, str], ...] = (
    ("org_name", "Organization"),
    ("total_events", "Total events"),
    ("active_repos", "Active repos"),
    ("avg_activity_score", "Avg activity score"),
)


def gold_max_day(lake: Lake) -> str | None:
    """Latest day in gold (one scalar)."""
    v = lake.gold().agg(F.max("day").alias("d")).first()["d"]
    return None if v is None else str(v)


def gold_window(lake: Lake, days: int, max_day: str) -> DataFrame:
    """Gold rows with day in [max_day - days, max_day] (both closed: days + 1 dates)."""
    lo = str(dt.date.fromisoformat(max_day) - dt.timedelta(days=days))
    return lake.gold().where(F.col("day").between(F.lit(lo).cast("date"), F.lit(max_day).cast("date")))


def events_window(lake: Lake, days: int, max_day: str) -> DataFrame:
    """Events with created_at in [min_day 00:00, max_day + 1 00:00] (both closed,
    so the next midnight instant is included), with a ``date`` column replacing the
    hour partition columns."""
    lo = dt.date.fromisoformat(max_day) - dt.timedelta(days=days)
    hi = dt.date.fromisoformat(max_day) + dt.timedelta(days=1)
    ev = lake.events().where(
        lake.on_days(str(lo), str(hi))
        & F.col("created_at").between(F.lit(f"{lo} 00:00:00").cast("timestamp_ntz"), F.lit(f"{hi} 00:00:00").cast("timestamp_ntz"))
    )
    return ev.withColumn("date", F.to_date("created_at")).drop("year", "month", "day", "hour")


def latest_dimension(lake: Lake, name: str) -> DataFrame:
    """Newest version per id, cut to the extract's columns."""
    dim = getattr(lake, name)()
    return SV.latest_dim(dim, DIM_TRACK[name], list(DIM_COLUMNS[name]))


def org_csv_frame(org_summary: DataFrame, n: int = 100) -> DataFrame:
    """First ``n`` organisations with display headers."""
    top = org_summary.limit(n)
    return top.select(*(F.col(src).alias(dst) for src, dst in ORG_CSV_HEADERS))


def write_extract(lake: Lake, out: str, days: int = 7) -> dict[str, str]:
    """Write the whole extract under ``out`` (Parquet zstd; events partitioned by date)."""
    max_day = gold_max_day(lake)
    paths = {}
    if max_day is None:
        return paths
    paths["gold"] = f"{out}/gold/daily_activity"
    gold_window(lake, days, max_day).write.mode("overwrite").option("compression", "zstd").parquet(paths["gold"])
    paths["events"] = f"{out}/silver/events"
    (
        events_window(lake, days, max_day)
        .hint("rebalance", "date")
        .write.mode("overwrite")
        .option("compression", "zstd")
        .partitionBy("date")
        .parquet(paths["events"])
    )
    for name in DIM_COLUMNS:
        paths[name] = f"{out}/silver/{name}"
        latest_dimension(lake, name).write.mode("overwrite").option("compression", "zstd").parquet(paths[name])
    return paths


def write_org_csv(org_summary: DataFrame, path: str, n: int = 100) -> None:
    """One CSV file with a header row (≤ n rows, so a single task is bounded)."""
    org_csv_frame(org_summary, n).coalesce(1).write.mode("overwrite").option("header", True).csv(path)

"""Benchmark: pipeline stages + serving queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Stages (timed): land_bronze (gzip NDJSON archive → hourly Parquet), silver batch
(parse, dedup, dimensions, contracts, publish), gold batch (daily aggregate,
contract, publish). The archive files themselves are generated from the driver's
``events`` table first and not timed (the equivalent of the download).

Queries (timed): every serving and derived metric query on the written tables, each
collected (results are small). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vitals.oracle import END, START  # noqa: E402
from vitals.operators import derived as D  # noqa: E402
from vitals.plans import jobs as J  # noqa: E402
from vitals.plans import pipeline as P  # noqa: E402
from vitals.plans import serving as Q  # noqa: E402
from vitals.session import local_session, scratch_path  # noqa: E402
from vitals.sources.lake import TableLake  # noqa: E402


def serving(lake):
    s, e = START, END
    return {
        "overview_kpis": lambda: Q.overview_kpis(lake, s, e),
        "daily_timeline": lambda: Q.daily_timeline(lake, s, e),
        "event_type_distribution": lambda: Q.event_type_distribution(lake, s, e),
        "daily_event_breakdown": lambda: Q.daily_event_breakdown(lake, s, e),
        "top_repos": lambda: Q.top_repos(lake, s, e),
        "trending_repos": lambda: Q.trending_repos(lake, s, e),
        "activity_heatmap": lambda: Q.activity_heatmap(lake, e),
        "top_contributors": lambda: Q.top_contributors(lake, s, e),
        "contributors_over_time": lambda: Q.contributors_over_time(lake, s, e),
        "bot_vs_human": lambda: Q.bot_vs_human(lake, s, e),
        "pr_metrics": lambda: Q.pr_metrics(lake, s, e),
        "pr_bot_breakdown": lambda: Q.pr_bot_breakdown(lake, s, e),
        "issue_metrics": lambda: Q.issue_metrics(lake, s, e),
        "code_review_metrics": lambda: Q.code_review_metrics(lake, s, e),
        "repo_health": lambda: Q.repo_health(lake, s, e),
        "ecosystem_kpis": lambda: Q.ecosystem_kpis(lake, s, e),
        "org_summary": lambda: Q.org_summary(lake, s, e),
        "active_repos_over_time": lambda: Q.active_repos_over_time(lake, s, e),
        "star_growth": lambda: Q.star_growth(lake, s, e),
        "fork_growth": lambda: Q.fork_growth(lake, s, e),
        "top_forked_repos": lambda: Q.top_forked_repos(lake, s, e),
        "top_open_repos_by_issues": lambda: Q.top_open_repos(lake, s, e, sort_by="issues"),
        "top_open_repos_by_prs": lambda: Q.top_open_repos(lake, s, e, sort_by="prs"),
        "stars_vs_forks": lambda: Q.stars_vs_forks(lake, s, e),
        "star_engagement": lambda: Q.star_engagement(lake, s, e),
        "date_range": lambda: Q.date_range(lake),
        "heatmap_grid": lambda: D.heatmap_grid(Q.activity_heatmap(lake, e)),
        "pr_funnel": lambda: D.pr_funnel(Q.pr_metrics(lake, s, e)),
        "events_bot_human": lambda: D.pivot_bot_human(Q.bot_vs_human(lake, s, e), "events"),
    }


def replicated_events(spark, sf_dir: str, factor: int) -> str:
    """``events`` repeated ``factor`` times with shifted ids (same hours, more events
    per hour), written once to scratch: the like-for-like throughput run."""
    from pyspark.sql import functions as F

    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    span = ev.agg(F.max("event_id")).first()[0] + 1
    out = scratch_path(spark, "replicated")
    rep = ev.select("*", F.explode(F.sequence(F.lit(0), F.lit(factor - 1))).alias("_r"))
    rep = rep.withColumn("event_id", F.col("event_id") + F.col("_r") * F.lit(span)).drop("_r")
    rep.write.mode("overwrite").parquet(f"{out}/events.parquet")
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    replicate = int(os.environ.get("BENCH_REPLICATE", "1"))
    spark = local_session(cpus, "vitals-bench")
    src_dir = sf_dir
    if replicate > 1:
        src_dir = replicated_events(spark, sf_dir, replicate)
    n_events = spark.read.parquet(f"{src_dir}/events.parquet").count()

    archive = P.write_archive(spark, src_dir)  # input synthesis, not timed
    lake = TableLake(spark, scratch_path(spark, "bench-lake"))
    times: dict[str, float] = {}

    t = time.perf_counter()
    P.land(spark, archive, lake.paths["bronze"])
    times["stage_land_bronze"] = time.perf_counter() - t

    t = time.perf_counter()
    rep = J.silver_batch(lake, P.now_col())
    times["stage_silver"] = time.perf_counter() - t
    assert rep.status == J.SUCCESS, rep

    t = time.perf_counter()
    rep = J.gold_batch(lake, P.now_col())
    times["stage_gold"] = time.perf_counter() - t
    assert rep.status == J.SUCCESS, rep

    for name, fn in serving(lake).items():
        t = time.perf_counter()
        fn().collect()
        times[name] = time.perf_counter() - t

    pipeline = times["stage_land_bronze"] + times["stage_silver"] + times["stage_gold"]
    total = sum(times.values())
    out = {
        "metric": "pipeline_plus_serving_total",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
        "replicate": replicate,
        "events": n_events,
        "pipeline_sec": round(pipeline, 3),
        "pipeline_events_per_sec": round(n_events / pipeline, 1) if pipeline else None,
        "serving_sec": round(total - pipeline, 3),
        "cpus": cpus,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()

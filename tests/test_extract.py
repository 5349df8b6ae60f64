"""The metrics over a written lake and over its static extract are the same."""

import datetime as dt

import pytest

from conftest import SMOKE
from vitals.functions.schemas import EVENT_PARTITIONS
from vitals.plans import serving as Q
from vitals.session import scratch_path
from vitals.sources import export as X
from vitals.sources.lake import DerivedLake, ExtractLake, TableLake


@pytest.fixture(scope="module")
def lakes(spark):
    source = DerivedLake(spark, SMOKE)
    lake = TableLake(spark, scratch_path(spark, "test-extract-lake"))
    last = X.gold_max_day(source)
    first = str(dt.date.fromisoformat(last) - dt.timedelta(days=3))
    days = source.events().where(f"created_at >= timestamp_ntz'{first} 00:00:00'").coalesce(1)
    days.write.partitionBy(*EVENT_PARTITIONS).parquet(lake.paths["events"])
    for name in ("actors", "repos", "orgs", "gold"):
        getattr(source, name)().coalesce(1).write.parquet(lake.paths[name])
    out = scratch_path(spark, "test-extract")
    X.write_extract(lake, out, days=2)
    return lake, ExtractLake(spark, out), str(dt.date.fromisoformat(last) - dt.timedelta(days=2)), last


@pytest.mark.parametrize(
    "metric",
    ["bot_vs_human", "top_contributors", "contributors_over_time", "pr_bot_breakdown", "overview_kpis", "trending_repos", "top_repos", "stars_vs_forks"],
)
def test_metric_on_lake_and_extract(lakes, metric):
    lake, extract, start, end = lakes
    want = getattr(Q, metric)(lake, start, end).collect()
    assert want and getattr(Q, metric)(extract, start, end).collect() == want


def test_windows_prune_by_date_and_keep_the_end(lakes):
    lake, extract, start, end = lakes
    for whole in (False, True):
        want = Q.silver_window(lake, start, end, include_end_day=whole)
        got = Q.silver_window(extract, start, end, include_end_day=whole)
        assert got.count() == want.count() > 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_wrong_layout_raises(spark, lakes):
    lake, extract, *_ = lakes
    with pytest.raises(ValueError, match="date"):
        TableLake(spark, extract.root).events()
    with pytest.raises(ValueError, match="year"):
        ExtractLake(spark, lake.root).events()
    flat = TableLake(spark, scratch_path(spark, "test-extract-flat"))
    extract.events().drop("date").coalesce(1).write.parquet(flat.paths["events"])
    with pytest.raises(ValueError, match="no folder"):
        flat.events()

"""Bitmaps of the ids of each day, against plain distinct counts."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from vitals.operators import distincts as DS
from vitals.plans import jobs as J
from vitals.plans import serving as Q
from vitals.sources import tables as TB
from vitals.sources.lake import TableLake

EVENTS = "created_at timestamp_ntz, actor_id long, repo_id long"


def some_events(n=400):
    rng = random.Random(8)
    times = [dt.datetime(2024, 3, 1) + dt.timedelta(days=rng.randrange(12), hours=rng.choice([0, 0, 5, 23])) for _ in range(n)]
    ids = [0, 1, 32767, 32768, 32769, 98304, 10**12, 2**62, None]
    return [(t, rng.choice([*ids, -5, rng.randrange(10**6)]), rng.choice([*ids, 7])) for t in times]


def test_windows_closed_at_midnight(spark):
    rows = some_events()
    sets = DS.day_sets(spark.createDataFrame(rows, EVENTS)).cache()
    for first, last in ((1, 12), (3, 4), (5, 5), (2, 9), (20, 25)):
        lo, hi = dt.datetime(2024, 3, first), dt.datetime(2024, 3, last)
        for kind, at in (("actor", 1), ("repo", 2)):
            want = len({r[at] for r in rows if lo <= r[0] <= hi and r[at] is not None})
            got = DS.count_ids(sets.where(DS.in_window(lo.date(), hi.date())), kind, "n").first()["n"]
            assert got == want, (first, last, kind)


def test_rolling_weeks(spark):
    rows = [r for r in some_events(60) if r[0].day not in (4, 5)]
    got = {r["day"]: (r["actors"], r["repos"]) for r in DS.rolling(DS.day_sets(spark.createDataFrame(rows, EVENTS)), 3).collect()}
    want = {}
    for d in {r[0].date() for r in rows}:
        near = [r for r in rows if 0 <= (d - r[0].date()).days < 3]
        want[d] = tuple(len({r[at] for r in near if r[at] is not None}) for at in (1, 2))
    assert got == want


def test_no_events(spark):
    sets = DS.day_sets(spark.createDataFrame([], EVENTS))
    assert DS.count_ids(sets, "actor", "n").first()["n"] == 0 and DS.rolling(sets, 7).count() == 0


def test_pages_are_built_without_a_shuffle_of_bitmaps(spark):
    plan = DS.day_sets(spark.createDataFrame(some_events(), EVENTS))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("bitmap_construct_agg") < plan.index("REPARTITION_BY_COL") and "ENSURE_REQUIREMENTS" not in plan[: plan.index("REPARTITION_BY_COL")]


def test_gold_batch_keeps_them_and_kpis_read_no_events(spark, tmp_path):
    lake = TableLake(spark, str(tmp_path))
    rows = [(i, "PushEvent", "pushed", a, r or 1, 1, True, t, f"{t:%Y}", f"{t:%m}", f"{t:%d}", f"{t:%H}") for i, (t, a, r) in enumerate(some_events()) if a is not None]
    schema = "id long, type string, action string, actor_id long, repo_id long, org_id long, public boolean, created_at timestamp_ntz, year string, month string, day string, hour string"
    silver = spark.createDataFrame(rows, schema)
    TB.replace_partitions(silver, lake.paths["events"], ("year", "month", "day", "hour"))
    days = ("2024-03-01", "2024-03-12")
    now = F.lit("2024-04-01 00:00:00").cast("timestamp_ntz")
    assert J.gold_batch(lake, now, days=days).status == J.SUCCESS
    kpis = Q.overview_kpis(lake, "2024-03-02", "2024-03-09")
    assert "silver/events" not in kpis._jdf.queryExecution().executedPlan().toString()
    lo, hi = dt.datetime(2024, 3, 2), dt.datetime(2024, 3, 9)
    assert kpis.first()["unique_contributors"] == len({r[3] for r in rows if lo <= r[7] <= hi})
    # a day that loses its events loses its bitmaps; a day of gold without bitmaps sends the query back to silver
    TB.drop_partitions(spark, lake.paths["events"], [("2024", "03", "05", f"{h:02d}") for h in range(24)], ("year", "month", "day", "hour"))
    assert J.gold_batch(lake, now, days=("2024-03-05", "2024-03-05")).status == J.SUCCESS
    assert lake.day_sets().where("day = date'2024-03-05'").count() == 0
    TB.drop_partitions(spark, lake.paths["day_sets"], [("2024", "03", "2024-03-06")], ("year", "month", "day"))
    assert lake.day_sets() is None

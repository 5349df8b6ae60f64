"""Write jobs: reruns are no-ops, late files merge exactly, violations block publish."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE, actor, org, repo
from vitals.functions.schemas import BRONZE_PARTITIONS
from vitals.plans import jobs as J
from vitals.plans import pipeline as P
from vitals.session import scratch_path
from vitals.sources import bronze as B
from vitals.sources.lake import DerivedLake, TableLake


def _now():
    return P.now_col()


@pytest.fixture(scope="module")
def lake(spark):
    root = scratch_path(spark, "test-lake")
    lk = TableLake(spark, root)
    P.land(spark, P.write_archive(spark, SMOKE), lk.paths["bronze"])
    assert J.silver_batch(lk, _now()).status == J.SUCCESS
    assert J.gold_batch(lk, _now()).status == J.SUCCESS
    return lk


def _land_rows(spark, lk, rows, file_name):
    df = spark.createDataFrame(rows, "id string, type string, actor string, repo string, payload string, public boolean, created_at string, org string")
    landed = B.with_bronze_partitions(df.withColumn("source_file", F.lit(f"/in/{file_name}")), F.current_timestamp())
    (landed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*BRONZE_PARTITIONS).parquet(lk.paths["bronze"]))


def _cmp(a, b, drop=("updated_at", "inserted_at")):
    cols = [c for c in b.columns if c not in drop]
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_tables_match_lazy_derivation(spark, lake):
    d = DerivedLake(spark, SMOKE)
    for name in ("events", "actors", "repos", "orgs", "gold"):
        assert _cmp(getattr(lake, name)(), getattr(d, name)()), name


def test_rerun_is_noop(spark, lake):
    before = lake.gold().drop("updated_at").collect()
    assert J.silver_batch(lake, _now()).status == J.EMPTY
    rep = J.gold_batch(lake, _now())  # watermark day is recomputed, not appended
    assert rep.status == J.SUCCESS
    after = lake.gold().drop("updated_at").collect()
    assert sorted(map(tuple, before), key=str) == sorted(map(tuple, after), key=str)


def test_late_file_merges_exactly(spark, lake):
    n_before = lake.events().count()
    existing = lake.events().orderBy("id").first()
    ts = existing["created_at"].strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = [
        # re-delivered copy of an event already in silver (same hour partition)
        (str(existing["id"]), existing["type"], actor(existing["actor_id"], "late"), repo(existing["repo_id"], "org/x"),
         json.dumps({"action": existing["action"]}), True, ts, None),
        # a genuinely new, late event for that old hour, delivered in a new file
        ("99999001", "WatchEvent", actor(5, "user5"), repo(1, "org/repo1"), json.dumps({"action": "started"}), True, ts, org(1, "org1")),
    ]
    _land_rows(spark, lake, rows, "2024-02-02-3.json.gz")
    rep = J.silver_batch(lake, _now())
    assert rep.status == J.SUCCESS and rep.partitions == 1
    assert lake.events().count() == n_before + 1
    assert lake.events().where("id = 99999001").count() == 1
    # the late day is recomputed on demand and replaced, never duplicated
    day = existing["created_at"].date().isoformat()
    assert J.gold_batch(lake, _now(), days=(day, day)).status == J.SUCCESS
    g = lake.gold()
    assert g.groupBy("day", "repo_id", "org_id").count().where("count > 1").count() == 0
    assert g.agg(F.sum("total_events")).first()[0] == n_before + 1


def test_contract_violation_blocks_publish(spark, lake):
    n_before = lake.events().count()
    bad = [("99999002", "IssuesEvent", actor(7, "user7"), repo(1, "org/repo1"), json.dumps({"action": "starred"}), True, "2024-01-03T04:05:06Z", None)]
    _land_rows(spark, lake, bad, "2024-02-03-1.json.gz")
    rep = J.silver_batch(lake, _now())
    assert rep.status == J.FAILED
    assert ("events", "action_isin", "action", 1) in rep.violations
    assert lake.events().count() == n_before
    # the failed hour stays pending; quarantine mode publishes the rest and keeps the rejects
    rep = J.silver_batch(lake, _now(), on_violation="quarantine")
    assert rep.status == J.SUCCESS
    assert lake.events().where("id = 99999002").count() == 0
    rejects = spark.read.parquet(f"{lake.root}/_rejects/events")
    assert rejects.where("id = 99999002").count() == 1


def test_streaming_equals_batch(spark):
    lk = P.stream_lake(spark, SMOKE, max_files=100)
    d = DerivedLake(spark, SMOKE)
    assert _cmp(lk.events(), d.events())
    assert _cmp(lk.gold(), d.gold())


def test_streaming_late_file_recomputes_its_day(spark):
    """A late file arriving after a first streaming run: the second availableNow run
    merges it into silver exactly and recomputes only the touched day in gold."""
    from vitals.streaming.stream import stream_gold, stream_silver

    root = scratch_path(spark, "test-stream-late")
    lk = TableLake(spark, root)
    P.land(spark, P.write_archive(spark, SMOKE), lk.paths["bronze"])
    ck_s, ck_g = f"{root}/_ckpt/silver", f"{root}/_ckpt/gold"
    stream_silver(lk, _now(), checkpoint=ck_s)
    stream_gold(lk, _now(), checkpoint=ck_g)
    n_events = lk.events().count()
    day_rows = lk.gold().where("day = DATE'2024-01-05'").drop("updated_at").collect()

    late = [
        ("99999101", "ForkEvent", actor(3, "user3"), repo(1, "org/repo1"), json.dumps({"action": "forked"}), True, "2024-01-05T07:30:00Z", org(1, "org1")),
    ]
    _land_rows(spark, lk, late, "2024-02-05-1.json.gz")
    stream_silver(lk, _now(), checkpoint=ck_s)
    stream_gold(lk, _now(), checkpoint=ck_g)

    assert lk.events().count() == n_events + 1
    g = lk.gold()
    assert g.groupBy("day", "repo_id", "org_id").count().where("count > 1").count() == 0
    after = g.where("day = DATE'2024-01-05'").agg(F.sum("total_events"), F.sum("fork_events")).first()
    before_total = sum(r["total_events"] for r in day_rows)
    before_forks = sum(r["fork_events"] for r in day_rows)
    assert (after[0], after[1]) == (before_total + 1, before_forks + 1)
    assert _cmp(g.where("day <> DATE'2024-01-05'"), DerivedLake(spark, SMOKE).gold().where("day <> DATE'2024-01-05'"))


def test_compaction_of_append_only_tables(spark):
    from vitals.sources import tables as TB

    path = scratch_path(spark, "compact-test")
    for i in range(3):
        TB.append(spark.range(i * 10, i * 10 + 10).repartition(2), path)
    assert len(spark.read.parquet(path).inputFiles()) == 6
    assert TB.compact_if_fragmented(spark, path, max_files=4)
    df = spark.read.parquet(path)
    assert len(df.inputFiles()) == 1 and df.count() == 30
    assert not TB.compact_if_fragmented(spark, path, max_files=4)


def _fork(event_id, at):
    return (str(event_id), "ForkEvent", actor(5, "ann"), repo(8, "tools/kit"), json.dumps({"action": "forked"}), True, at, org(2, "tools"))


def test_an_id_in_two_hours_stays_one_row(spark):
    lk = TableLake(spark, scratch_path(spark, "test-two-hours"))
    _land_rows(spark, lk, [_fork(71, "2024-03-01T02:00:00Z"), _fork(71, "2024-03-01T01:59:59Z"), _fork(72, "2024-03-01T02:10:00Z")], "2024-03-01-2.json.gz")
    assert J.silver_batch(lk, _now()).status == J.SUCCESS
    assert sorted((r["id"], r["hour"]) for r in lk.events().collect()) == [(71, "01"), (72, "02")]
    # a later batch brings the published id again, in another hour that it touches as well
    again = [_fork(72, "2024-03-01T01:00:00Z"), _fork(73, "2024-03-01T02:20:00Z"), _fork(74, "2024-03-01T01:30:00Z")]
    _land_rows(spark, lk, again, "2024-03-01-3.json.gz")
    assert J.silver_batch(lk, _now(), on_violation="quarantine").status == J.SUCCESS
    assert sorted((r["id"], r["hour"]) for r in lk.events().collect()) == [(71, "01"), (72, "02"), (73, "02"), (74, "01")]


def test_a_late_row_keeps_the_files_of_a_large_hour(spark, monkeypatch):
    monkeypatch.setattr(J, "ROWS_PER_FILE", 20)
    lk = TableLake(spark, scratch_path(spark, "test-late-layout"))
    _land_rows(spark, lk, [_fork(100 + i, "2024-03-02T04:00:00Z") for i in range(100)], "2024-03-02-4.json.gz")
    J.silver_batch(lk, _now())
    before = len(lk.events().inputFiles())
    _land_rows(spark, lk, [_fork(500, "2024-03-02T04:30:00Z")], "2024-03-02-5.json.gz")
    J.silver_batch(lk, _now())
    assert before > 1 and len(lk.events().inputFiles()) >= before and lk.events().count() == 101


def test_bad_times_are_set_aside(spark):
    lk = TableLake(spark, scratch_path(spark, "test-bad-times"))
    rows = [_fork(81, "2024-03-03T05:00:00Z"), _fork(82, "not a time"), _fork(83, "2024-13-40T05:00:00Z")]
    _land_rows(spark, lk, rows, "2024-03-03-5.json.gz")
    assert J.silver_batch(lk, _now(), on_violation="fail").status == J.FAILED
    assert J.silver_batch(lk, _now(), on_violation="quarantine").status == J.SUCCESS
    assert [r["id"] for r in lk.events().collect()] == [81]
    assert {r["id"] for r in spark.read.parquet(f"{lk.root}/_rejects/events").collect()} == {82, 83}


def test_redelivered_rows_stay_before_the_merge(spark, monkeypatch):
    """Copies in one archive hour go no further; another hour's copy, changed rows and old late rows do."""
    from vitals.plans import jobs
    from vitals.streaming.stream import stream_silver

    def event(id_, at, user=3):
        return (id_, "ForkEvent", actor(user, f"user{user}"), repo(1, "org/repo1"), json.dumps({"action": "forked"}), True, at, None)

    def arrive(rows, file_name):
        df = spark.createDataFrame(rows, "id string, type string, actor string, repo string, payload string, public boolean, created_at string, org string")
        landed = B.with_bronze_partitions(df.withColumn("source_file", F.lit(f"/in/{file_name}")), F.current_timestamp())
        landed.coalesce(1).write.mode("append").partitionBy(*BRONZE_PARTITIONS).parquet(lk.paths["bronze"])

    merged, plain = [], jobs.silver_from_bronze

    def spy(lake, rows, *args, **named):
        merged.extend((r["id"], r["hour"]) for r in rows.collect())
        return plain(lake, rows, *args, **named)

    monkeypatch.setattr(jobs, "silver_from_bronze", spy)
    lk = TableLake(spark, scratch_path(spark, "test-stream-redelivered"))
    a, b = event("1", "2024-02-05T07:30:00Z"), event("2", "2024-02-05T07:31:00Z")
    arrive([a, b, b], "2024-02-05-7.json.gz")
    stream_silver(lk, _now(), redelivered_within="1 hour")
    assert sorted(merged) == [("1", "07"), ("2", "07")]
    merged.clear()
    arrive([a, event("2", "2024-02-05T07:31:00Z", 4), event("3", "2020-01-01T00:00:00Z")], "2024-02-05-7.json.gz")
    arrive([a], "2024-02-05-9.json.gz")
    stream_silver(lk, _now(), redelivered_within="1 hour")
    assert sorted(merged) == [("1", "09"), ("2", "07"), ("3", "07")]
    assert sorted((r["id"], r["actor_id"]) for r in lk.events().collect()) == [(1, 3), (2, 3), (3, 3)]
    merged.clear()
    arrive([a], "2024-02-05-7.json.gz")
    stream_silver(lk, _now(), redelivered_within="1 hour")
    assert merged == []

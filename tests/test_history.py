"""Several landings and batches: ids across batches, hours landed again, late and emptied days, rejects, byte bounds, ingest."""

import gzip
import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import actor, org, repo
from vitals.plans import ingest as IN
from vitals.plans import jobs as J
from vitals.plans import pipeline as P
from vitals.session import scratch_path
from vitals.sources import bronze as B
from vitals.sources import ledger as LG
from vitals.sources.id_index import IdIndex
from vitals.sources.lake import TableLake

RAW = "id string, type string, actor string, repo string, payload string, public boolean, created_at string, org string"


@pytest.fixture
def lake(spark):
    return TableLake(spark, scratch_path(spark, "test-history"))


def star(event_id, at, who=5, **changes):
    row = {
        "id": None if event_id is None else str(event_id), "type": "WatchEvent", "actor": actor(who, f"user{who}"), "repo": repo(8, "tools/kit"),
        "payload": json.dumps({"action": "started"}), "public": True, "created_at": at, "org": org(2, "tools"),
    } | changes
    return tuple(row.values())


def land(lake, hour, *rows):
    """Land the rows as the archive hour ``2024-05-01-7``, in place of what it held."""
    df = lake.spark.createDataFrame(list(rows), RAW).coalesce(1).withColumn("source_file", F.lit(f"/in/{hour}.json.gz"))
    landed = B.with_bronze_partitions(df, F.current_timestamp())
    landed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month", "day", "hour").parquet(lake.paths["bronze"])


def silver(lake, **kwargs):
    rep = J.silver_batch(lake, P.now_col(), **kwargs)
    assert rep.status == J.SUCCESS, rep
    return rep


def held(lake):
    return sorted((r["id"], f"{r['day']}T{r['hour']}") for r in lake.events().collect())


# ids across batches
def test_an_id_in_a_later_batch_and_hour_stays_one_row(lake):
    land(lake, "2024-05-01-2", star(1, "2024-05-01T02:00:00Z"), star(2, "2024-05-01T02:00:00Z"))
    silver(lake)
    # hour 09 touches nothing of the first batch
    land(lake, "2024-05-01-9", star(1, "2024-05-01T09:00:00Z"), star(3, "2024-05-01T09:00:00Z"))
    silver(lake)
    assert held(lake) == [(1, "01T02"), (2, "01T02"), (3, "01T09")]


def test_only_blocks_that_may_hold_the_ids_are_read(spark):
    index = IdIndex(spark, scratch_path(spark, "test-index"), blocks=8)
    ids = spark.range(0, 64 * 40).select("id", F.lit("2024-05-01-02").alias("source"), F.lit("2024-05-01-02").alias("event_hour"), F.lit(True).alias("published"))
    index.write(ids, "a")
    index.write(ids.withColumn("id", F.col("id") + 10**9), "b")
    assert len(index.blocks_to_read(ids)) == 8
    # one id lies in one block of one generation, and unknown ids in none
    one = spark.createDataFrame([(77,)], "id long")
    assert [b for b, _ in index.blocks_to_read(one)] == ["a"]
    assert [r["id"] for r in index.lookup(one).collect()] == [77]
    assert {f.split("/batch=")[1].split("/")[0] for f in index.lookup(one).inputFiles()} == {"a"}
    unknown = spark.range(5 * 10**9, 5 * 10**9 + 100).select("id")
    assert len(index.blocks_to_read(unknown)) < 3 and index.lookup(unknown).count() == 0
    assert index.lookup(one, but="a").count() == 0
    index.write(ids.limit(0), "c")
    assert index.lookup(one).count() == 1


def test_a_row_that_failed_its_contract_can_come_again(lake):
    bad = json.dumps({"action": "unheard of"})
    land(lake, "2024-05-01-2", star(1, "2024-05-01T02:00:00Z", payload=bad), star(2, "2024-05-01T02:00:00Z"))
    silver(lake, on_violation="quarantine")
    assert held(lake) == [(2, "01T02")]
    land(lake, "2024-05-01-4", star(1, "2024-05-01T04:00:00Z"))
    silver(lake)
    assert held(lake) == [(1, "01T04"), (2, "01T02")]


# hours landed again
def test_an_hour_landed_again_replaces_what_it_brought(lake):
    land(lake, "2024-05-01-2", star(1, "2024-05-01T02:00:00Z"), star(2, "2024-05-01T02:30:00Z"), star(3, "2024-04-30T23:00:00Z"))
    land(lake, "2024-05-01-3", star(4, "2024-05-01T03:00:00Z"), star(2, "2024-05-01T03:30:00Z"))
    silver(lake)
    P.run_gold(lake)
    assert held(lake) == [(1, "01T02"), (2, "01T02"), (3, "30T23"), (4, "01T03")]
    assert silver_is_empty(lake)
    # 1 stays, 2 is left to the other hour, 3 and with it the 30th goes, 5 is new
    land(lake, "2024-05-01-2", star(1, "2024-05-01T02:00:00Z"), star(5, "2024-05-01T02:10:00Z"))
    assert silver(lake).partitions == 1
    assert held(lake) == [(1, "01T02"), (2, "01T03"), (4, "01T03"), (5, "01T02")]
    P.run_gold(lake)
    assert [(str(r["day"]), r["total_events"]) for r in lake.gold().collect()] == [("2024-05-01", 4)]
    # and the other hour again, without 2: it is gone now
    land(lake, "2024-05-01-3", star(4, "2024-05-01T03:00:00Z"))
    silver(lake)
    assert held(lake) == [(1, "01T02"), (4, "01T03"), (5, "01T02")]


def silver_is_empty(lake):
    return J.silver_batch(lake, P.now_col()).status == J.EMPTY


# late days
def test_a_late_event_reaches_gold_long_after_its_day(lake):
    land(lake, "2024-05-01-2", star(1, "2024-05-01T02:00:00Z"))
    land(lake, "2024-05-09-2", star(2, "2024-05-09T02:00:00Z"))
    silver(lake)
    P.run_gold(lake)
    land(lake, "2024-05-10-2", star(3, "2024-05-01T05:00:00Z", who=6))
    silver(lake)
    before = lake.gold().where("day = DATE'2024-05-09'").first()
    rep = P.run_gold(lake, days_per_batch=1)
    assert rep.batches == 2  # the late day and the watermark's
    assert {str(r["day"]): r["total_events"] for r in lake.gold().collect()} == {"2024-05-01": 2, "2024-05-09": 1}
    assert lake.gold().where("day = DATE'2024-05-09'").first() == before
    assert LG.changed_days(lake.spark, lake.paths["changed_days"], lake.paths["gold_consumed"]).count() == 0


# rejects
def test_every_row_is_published_or_set_aside_with_its_reasons(lake):
    at = "2024-05-01T02:00:00Z"
    rows = [
        star(1, at), star("x7", at), star(None, at), star(2, at, actor='{"id":'), star(3, at, actor=None), star(4, at, repo="[}"),
        star(5, at, repo=json.dumps({"name": "no id"})), star(6, at, org="{{"), star(7, "yesterday"), star(8, at, org=None), star("x9", None, actor="{"),
    ]
    land(lake, "2024-05-01-2", *rows)
    rep = J.silver_batch(lake, P.now_col())
    assert rep.status == J.FAILED and not lake.has("events")
    assert ("bronze", "id_malformed", "id", 2) in rep.violations and ("bronze", "actor_malformed", "actor", 2) in rep.violations
    assert rep.samples["bronze"]
    for _ in range(2):  # a second try replaces the first one's rejects
        rep = J.silver_batch(lake, P.now_col(), on_violation="quarantine")
    assert rep.status == J.EMPTY
    got = {(r["id"], tuple(r["reasons"])) for r in lake.rejects().collect()}
    assert got == {
        ("x7", ("id malformed",)), (None, ("id missing",)), ("2", ("actor malformed",)), ("3", ("actor missing",)), ("4", ("repo malformed",)),
        ("5", ("repo missing",)), ("6", ("org malformed",)), ("7", ("time malformed",)), ("x9", ("id malformed", "actor malformed", "time missing")),
    }
    assert lake.events().count() + lake.rejects().count() == len(rows)
    assert {r["source"] for r in lake.rejects().collect()} == {"2024-05-01-02"}


# batches bounded by bytes
@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 120), min_size=1, max_size=40), st.integers(2, 100))
def test_batches_keep_their_bound(spark, sizes, bound):
    hours = spark.createDataFrame([("2024", "05", f"{i // 24:02d}", f"{i % 24:02d}", n) for i, n in enumerate(sizes)], "year string, month string, day string, hour string, bytes long")
    rows = sorted(map(tuple, LG.pack(hours, bound).collect()))
    assert [r[4] for r in rows] == sizes
    by = {}
    for *_, n, pack in rows:
        by.setdefault(pack, []).append(n)
    assert list(by) == sorted(by)
    assert all(sum(g) <= bound or len(g) == 1 for g in by.values())


def test_a_run_that_stops_goes_on_after_the_last_batch(lake, monkeypatch):
    for h in range(4):
        land(lake, f"2024-05-01-{h}", star(10 + h, f"2024-05-01T0{h}:00:00Z"))
    original, seen = J.silver_from_bronze, []

    def crash(lake, rows, now, on_violation, batch, relanded):
        seen.append((batch, rows.count()))
        if len(seen) == 3:
            raise OSError("lost")
        return original(lake, rows, now, on_violation, batch, relanded)

    monkeypatch.setattr(J, "silver_from_bronze", crash)
    with pytest.raises(OSError):
        silver(lake, max_bytes=1)
    assert len(held(lake)) == 2
    rep = silver(lake, max_bytes=1)
    assert rep.batches == 2 and [n for _, n in seen] == [1] * 5 and [b for b, _ in seen][2] == [b for b, _ in seen][3]
    assert len(held(lake)) == 4


def test_a_batch_cut_off_after_publishing_is_run_again(lake, monkeypatch):
    land(lake, "2024-05-01-2", star(1, "2024-05-01T02:00:00Z"), star(2, "2024-05-01T02:00:00Z"))
    silver(lake)
    land(lake, "2024-05-01-2", star(1, "2024-05-01T02:00:00Z"), star(3, "2024-05-01T03:00:00Z"))
    original = IdIndex.write

    def crash(self, *_):
        raise OSError("lost")

    monkeypatch.setattr(IdIndex, "write", crash)
    with pytest.raises(OSError):
        silver(lake)
    monkeypatch.setattr(IdIndex, "write", original)
    silver(lake)
    assert held(lake) == [(1, "01T02"), (3, "01T03")]


# ingest
def archive(tmp_path, hour, data):
    path = tmp_path / "archive" / f"{hour}.json.gz"
    path.parent.mkdir(exist_ok=True)
    path.write_bytes(data)


def test_ingest_isolates_broken_files(spark, lake, tmp_path):
    r = random.Random(1)
    lines = [json.dumps({"id": str(i), "type": "WatchEvent", "actor": {"id": 1, "login": "".join(r.choices("abcdef", k=300))}, "created_at": "2024-05-01T00:00:00Z"}) for i in range(50)]
    whole = gzip.compress("\n".join(lines).encode())
    archive(tmp_path, "2024-05-01-0", whole)
    archive(tmp_path, "2024-05-01-1", whole[: len(whole) // 2])
    archive(tmp_path, "2024-05-01-2", b"plain text")
    archive(tmp_path, "2024-05-01-3", gzip.compress(b"no json\n" + lines[0].encode()) + gzip.compress(b"\n" + lines[1].encode() + b"\n"))
    archive(tmp_path, "2024-05-01-4", whole[:400] + b"\0" * 200 + whole[600:])
    archive(tmp_path, "2024-05-01-5", gzip.compress(b""))
    hours = spark.sql("SELECT explode(sequence(TIMESTAMP_NTZ'2024-05-01 00:00:00', TIMESTAMP_NTZ'2024-05-01 06:00:00', INTERVAL 1 HOUR)) AS hour_ts")
    got = {r["hour_ts"].hour: tuple(r)[1:] for r in IN.ingest(lake, f"{tmp_path}/archive/*.gz", hours).collect()}
    assert got[0] == ("success", "landed", 50, 0)
    assert got[1] == ("failed", "cut off", None, None)
    assert got[2] == ("failed", "not gzip", None, None)
    assert got[3] == ("success", "landed", 3, 1)
    assert got[4][:1] == ("failed",) and got[4][2:] == (None, None)
    assert got[5] == ("success", "landed", 0, 0)
    assert got[6] == ("skipped", "source missing", None, None)
    assert lake.bronze().count() == 53
    # the repaired file is landed by the next call, the others are skipped
    archive(tmp_path, "2024-05-01-1", whole)
    again = {r["hour_ts"].hour: tuple(r)[1:3] for r in IN.ingest(lake, f"{tmp_path}/archive/*.gz", hours).collect()}
    assert again[0] == ("skipped", "already landed") and again[1] == ("success", "landed") and again[2] == ("failed", "not gzip")
    assert spark.read.parquet(f"{lake.root}/_ledger/ingest").count() == 14


def test_gzip_lines_holds_any_piece_size():
    data = gzip.compress(b"a\nbb\nccc") + gzip.compress(b"") + gzip.compress(b"\nd\n")
    for piece in (1, 2, 7, 1 << 20):
        assert IN.gzip_lines(data, piece) == (4, None)
        assert IN.gzip_lines(data[:-3], piece)[1] == "cut off"


def test_ingest_without_files(spark, lake, tmp_path):
    archive(tmp_path, "2024-05-01-1", b"")
    hours = spark.sql("SELECT TIMESTAMP_NTZ'2024-05-01 00:00:00' AS hour_ts")
    assert [tuple(r)[1:3] for r in IN.ingest(lake, f"{tmp_path}/archive/*.gz", hours).collect()] == [("skipped", "source missing")]


def test_long_partition_lists_are_read_in_chunks(spark, monkeypatch):
    from vitals.sources import tables as TB

    monkeypatch.setattr(TB, "MAX_LITERAL_PARTITIONS", 2)
    table = spark.createDataFrame([(str(i), f"{i % 3}", i) for i in range(9)], "day string, hour string, v int")
    wanted = table.where("v <> 4").select("day", "hour")
    assert sorted(r["v"] for r in TB.in_partitions(table, wanted, ("day", "hour")).collect()) == [0, 1, 2, 3, 5, 6, 7, 8]
    assert TB.in_partitions(table, wanted.limit(0), ("day", "hour")).count() == 0


# what a batch keeps in memory, and what it reads again
def test_a_batch_stages_its_decoded_rows_and_keeps_narrow_ones(lake, monkeypatch):
    staged, kept = [], []
    frame = type(lake.spark.range(1))
    stage, persist = J.TB.stage, frame.persist
    monkeypatch.setattr(J.TB, "stage", lambda spark, df, name, *a: staged.append(name) or stage(spark, df, name, *a))
    monkeypatch.setattr(frame, "persist", lambda self, *a: kept.append(self.schema) or persist(self, *a))
    land(lake, "2024-05-01-2", star(1, "2024-05-01T02:00:00Z"), star(2, "2024-05-01T02:00:00Z"))
    silver(lake)
    assert staged.count("parsed") == 1
    assert not [f.name for schema in kept for f in schema if f.dataType.typeName() == "struct"]
    # the ids that another hour has published are looked up once
    assert ["id"] in [schema.fieldNames() for schema in kept]


def test_an_empty_index_takes_no_filters(spark, monkeypatch):
    index = IdIndex(spark, scratch_path(spark, "test-index"))
    monkeypatch.setattr("vitals.sources.id_index.filters_of", lambda *a: pytest.fail("filters of an empty index"))
    assert index.lookup(spark.range(5)).count() == 0


def test_partition_strings_of_the_surviving_delivery(spark):
    rows = [(1, "2024-05-01 09:00:00", "b"), (1, "2024-05-01 02:30:00", "a"), (2, None, "a")]
    facts = spark.createDataFrame(rows, "id long, at string, source string").select("id", F.col("at").cast("timestamp_ntz").alias("created_at"), "source")
    facts = facts.select("id", "created_at", *J.SV.partition_columns("created_at"), "source")
    one = J.SV.dedup_deliveries(facts)
    assert one.columns == [*facts.columns, "sources"]
    got = {r["id"]: (r["day"], r["hour"], r["source"], sorted(r["sources"])) for r in one.collect()}
    assert got == {1: ("01", "02", "a", ["a", "b"]), 2: (None, None, "a", ["a"])}

"""Source operators: hours to ingest, skip statuses, archive names, raw JSON read."""

import datetime as dt
import json

from pyspark.sql import functions as F

from vitals.session import scratch_path
from vitals.sources import bronze as B


def test_hours_to_ingest_stops_at_last_complete_hour(spark):
    now = F.lit("2024-03-05 14:23:00").cast("timestamp_ntz")
    hours = [r.hour_ts for r in B.hours_to_ingest(spark, now, 1).orderBy("hour_ts").collect()]
    assert hours[0] == dt.datetime(2024, 3, 4, 0) and hours[-1] == dt.datetime(2024, 3, 5, 13)
    assert len(hours) == 24 + 14


def test_hours_to_ingest_just_after_midnight(spark):
    now = F.lit("2024-03-05 00:10:00").cast("timestamp_ntz")  # last complete hour is 23:00 the day before
    hours = [r.hour_ts for r in B.hours_to_ingest(spark, now, 0).orderBy("hour_ts").collect()]
    assert hours[0] == dt.datetime(2024, 3, 4, 0) and hours[-1] == dt.datetime(2024, 3, 4, 23)


def _parts(spark, stamps):
    return spark.createDataFrame([(f"{t.year}", f"{t.month:02d}", f"{t.day:02d}", f"{t.hour:02d}") for t in stamps], "year string, month string, day string, hour string")


def test_skip_existing_hours_statuses(spark):
    now = F.lit("2024-03-05 03:30:00").cast("timestamp_ntz")
    hours = B.hours_to_ingest(spark, now, 0)  # 00:00, 01:00, 02:00
    landed = _parts(spark, [dt.datetime(2024, 3, 5, 0)])
    available = _parts(spark, [dt.datetime(2024, 3, 5, 0), dt.datetime(2024, 3, 5, 1)])
    got = {r.hour_ts.hour: r.status for r in B.skip_existing_hours(hours, landed, available).collect()}
    assert got == {0: "skipped", 1: "success", 2: "skipped"}
    again = {r.hour_ts.hour: r.status for r in B.skip_existing_hours(hours, landed, available, overwrite=True).collect()}
    assert again == {0: "success", 1: "success", 2: "skipped"}


def test_archive_file_hour(spark):
    df = spark.createDataFrame([("s3a://b/x/2024-01-05-7.json.gz",), ("/in/2024-12-31-23.json.gz",)], "p string")
    got = [r.h for r in df.select(B.file_hour(F.col("p")).alias("h")).collect()]
    assert got == [dt.datetime(2024, 1, 5, 7), dt.datetime(2024, 12, 31, 23)]


def test_raw_read_keeps_nested_objects_as_text(spark):
    path = scratch_path(spark, "raw-test")
    line = {"id": "1", "type": "PushEvent", "actor": {"id": 5, "login": "a"}, "repo": {"id": 2, "name": "o/r"},
            "payload": {"size": 1}, "public": True, "created_at": "2024-01-05T07:00:00Z", "org": None}
    spark.createDataFrame([(json.dumps(line),)], "value string").write.text(f"{path}/2024-01-05-7.json.gz")
    r = B.read_raw_events(spark, f"{path}/2024-01-05-7.json.gz").first()
    assert json.loads(r["actor"]) == {"id": 5, "login": "a"}
    assert r["org"] is None and r["public"] is True
    assert "2024-01-05-7.json.gz" in r["source_file"]


def test_listed_partitions_are_the_only_files_read(spark, tmp_path):
    from vitals.sources.tables import MAX_LITERAL_PARTITIONS, in_partitions

    path = str(tmp_path / "hours")
    hours = spark.range(48).selectExpr("id", "'2024' AS year", "'01' AS month", "lpad(1 + id div 24, 2, '0') AS day", "lpad(id % 24, 2, '0') AS hour")
    hours.write.partitionBy("year", "month", "day", "hour").parquet(path)
    keys = ("year", "month", "day", "hour")
    lake = spark.read.schema(hours.schema).parquet(path)
    wanted = hours.where("id IN (3, 30)")
    many = spark.range(MAX_LITERAL_PARTITIONS + 5).selectExpr("'2024' AS year", "'01' AS month", "'01' AS day", "lpad(id, 2, '0') AS hour")
    assert in_partitions(lake, many, keys).count() == 24
    assert in_partitions(lake, wanted.limit(0), keys).count() == 0
    # a read that opened any other hour would fail
    for f in (tmp_path / "hours").rglob("*.parquet"):
        if not ("day=01/hour=03" in str(f) or "day=02/hour=06" in str(f)):
            f.write_bytes(b"broken")
    assert sorted(r["id"] for r in in_partitions(lake, wanted, keys).collect()) == [3, 30]


def test_missing_and_unreadable_tables_raise(spark, tmp_path):
    import pytest

    from vitals.sources.lake import TableLake, exists

    lake = TableLake(spark, str(tmp_path / "nowhere"))
    assert not lake.has("gold")
    with pytest.raises(FileNotFoundError):
        lake.gold()
    with pytest.raises(Exception, match="(?i)scheme|filesystem"):
        exists(spark, "nosuchscheme://bucket/table")

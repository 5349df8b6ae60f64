"""Rows are decoded once: no filter is moved below the JSON decoding, and jobs that read several tables stage the decoded rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitals import registry as R
from vitals.operators import silver as SV
from vitals.sources import fixtures
from vitals.sources import lake as L


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def write_events(spark, path, n=400):
    ts = F.expr("timestamp_ntz'2024-01-14 00:00:00' + make_interval(0, 0, 0, 0, id % 96, 0, 0)")
    events = spark.range(n).select(
        F.col("id").alias("event_id"), ts.alias("ts"), (F.col("id") % 23).alias("user_id"), F.lit("x").alias("event_type"), F.lit(1.0).alias("value"),
        F.format_string('{"k": %d}', F.col("id") % 90).alias("props"),
    )
    events.repartition(5).write.parquet(f"{path}/events.parquet")


def test_no_row_is_decoded_for_a_filter(spark, sample_bronze):
    parsed = SV.parse_bronze(sample_bronze)
    for df in (SV.build_events(parsed), SV.build_actors(parsed, F.lit("2024-01-01")), SV.build_orgs(parsed, F.lit("2024-01-01"))):
        assert not [x for x in plan(df).split("\n") if "Filter" in x and "from_json" in x]


def test_rows_without_keys_are_left_out(spark, sample_bronze):
    """An id whose smallest row has no actor keeps its other row; rows without id or repository go."""
    broken = sample_bronze.where("id = '1'")
    rows = sample_bronze.unionByName(broken.withColumn("actor", F.lit(None).cast("string"))).unionByName(broken.withColumns({"id": F.lit("9"), "repo": F.lit(None).cast("string")}))
    rows = rows.unionByName(broken.withColumn("id", F.lit(None).cast("string")))
    got = {r["id"]: r for r in SV.build_events(SV.parse_bronze(rows)).collect()}
    assert sorted(got) == [1, 2, 3] and got[1]["actor_id"] == 100 and got[1]["hour"] == "10"
    orgs = SV.build_orgs(SV.parse_bronze(rows), F.lit("2024-01-01")).collect()
    assert [r["id"] for r in orgs] == [1]


def test_extract_decodes_once(spark, tmp_path, monkeypatch):
    write_events(spark, str(tmp_path))
    staged, stage = [], L.stage
    monkeypatch.setattr(L, "stage", lambda s, df, name, *more: (staged.append(name), stage(s, df, name, *more))[1])
    assert R.queries()["export_events_window"](spark, str(tmp_path)).count()
    assert sorted(staged) == ["events", "gold", "parsed"]


def test_an_hour_is_not_a_file_of_each_task(spark, tmp_path):
    write_events(spark, str(tmp_path))
    paths = [f.replace("file://", "").replace("file:", "") for f in R.queries()["append_fact"](spark, str(tmp_path)).inputFiles()]
    assert len(paths) < 2 * len({p.rsplit("/", 1)[0] for p in paths})


def test_raw_texts(spark):
    """Missing numbers are written as null, as the format strings of the SQL do, and a missing id is left out."""
    rows = spark.sql("select 100L event_id, timestamp_ntz'2024-01-20 03:04:05.6' ts, cast(null as long) user_id, cast(null as string) props")
    out = fixtures.raw_events(rows).collect()
    assert len(out) == 2  # ids divisible by 50 come twice
    assert out[0]["actor"].startswith('{"login":"usernull","display_login":"usernull","gravatar_id":""')
    assert out[0]["repo"] == '{"name":"org/reponull","url":"https://api.github.com/repos/org/reponull"}'
    assert (out[0]["org"], out[0]["payload"], out[0]["type"]) == (None, '{"size":null}', "PushEvent")

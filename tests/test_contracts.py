import datetime as dt

import pytest
from pyspark.sql import functions as F

from vitals.operators import contracts as C


def bad(report):
    return {r.rule: r.n_bad for r in C.failed(report).collect()}


EVENT_ROW = dict(
    id=1, type="PushEvent", action="pushed", actor_id=100, repo_id=10, org_id=1, public=True,
    created_at=dt.datetime(2026, 7, 19, 10), year="2026", month="07", day="19", hour="10",
)
EVENT_SCHEMA = (
    "id long, type string, action string, actor_id long, repo_id long, org_id long, public boolean, "
    "created_at timestamp_ntz, year string, month string, day string, hour string"
)


def events(spark, **over):
    row = {**EVENT_ROW, **over}
    return spark.createDataFrame([tuple(row.values())], EVENT_SCHEMA)


class TestBronze:
    def test_valid_passes(self, sample_bronze):
        assert bad(C.check(sample_bronze, C.BRONZE)) == {}

    @pytest.mark.parametrize("col", ["id", "type", "created_at"])
    def test_null_required_fails(self, sample_bronze, col):
        df = sample_bronze.withColumn(col, F.when(F.col("id") == "1", F.lit(None)).otherwise(F.col(col)))
        assert bad(C.check(df, C.BRONZE)) == {f"{col}_not_null": 1}

    def test_null_actor_and_unknown_type_pass(self, sample_bronze):
        df = sample_bronze.withColumn("actor", F.lit(None).cast("string")).withColumn("type", F.lit("NewEvent"))
        assert bad(C.check(df, C.BRONZE)) == {}

    def test_wrong_dtype_fails(self, sample_bronze):
        df = sample_bronze.withColumn("id", F.col("id").cast("long"))
        assert bad(C.check(df, C.BRONZE)) == {"id_dtype": 3}


class TestEvents:
    def test_valid_passes(self, spark):
        assert bad(C.check(events(spark), C.EVENTS)) == {}

    @pytest.mark.parametrize(
        "over,rule",
        [
            ({"type": "GollumEvent"}, "type_isin"),
            ({"action": "starred"}, "action_isin"),
            ({"actor_id": None}, "actor_id_not_null"),
            ({"id": -1}, "id_ge"),
            ({"month": "13"}, "month_regex"),
            ({"hour": "24"}, "hour_regex"),
        ],
    )
    def test_violations(self, spark, over, rule):
        assert bad(C.check(events(spark, **over), C.EVENTS)) == {rule: 1}

    def test_null_org_passes(self, spark):
        assert bad(C.check(events(spark, org_id=None), C.EVENTS)) == {}

    def test_duplicate_id_fails(self, spark):
        df = events(spark).unionByName(events(spark))
        assert bad(C.check(df, C.EVENTS)) == {"id_unique": 2}

    def test_quarantine_split_sets_aside_duplicates_and_bad_rows(self, spark):
        df = events(spark).unionByName(events(spark)).unionByName(events(spark, id=2)).unionByName(events(spark, id=3, type="GollumEvent"))
        good, bad = C.split_passing(df, C.EVENTS)
        assert sorted(r.id for r in good.collect()) == [2]
        assert sorted(r.id for r in bad.collect()) == [1, 1, 3]

    def test_violation_sample_is_bounded(self, spark):
        df = events(spark, type="GollumEvent", action=None)
        out = C.violations(df, C.EVENTS, "id", 5).collect()
        assert len(out) == 1 and out[0]["n_failed"] == 2


class TestDims:
    def test_null_repo_name_fails(self, spark):
        ts = dt.datetime(2026, 7, 19)
        df = spark.createDataFrame([(1, None, "u", ts, ts)], "id long, name string, url string, first_seen_at timestamp_ntz, inserted_at timestamp_ntz")
        assert bad(C.check(df, C.REPOS)) == {"name_not_null": 1}

    def test_is_bot_must_be_boolean(self, spark):
        ts = dt.datetime(2026, 7, 19)
        df = spark.createDataFrame(
            [(1, "a", None, None, "u", None, "yes", ts, ts)],
            "id long, login string, display_login string, gravatar_id string, url string, avatar_url string, is_bot string, first_seen_at timestamp_ntz, inserted_at timestamp_ntz",
        )
        assert "is_bot_dtype" in bad(C.check(df, C.ACTORS))


class TestGold:
    @pytest.fixture
    def gold(self, spark):
        from conftest import silver_rows
        from vitals.operators.gold import daily_activity

        return daily_activity(silver_rows(spark, ["PushEvent"], ["pushed"]), F.lit("2026-07-20").cast("timestamp_ntz"))

    def test_valid_passes(self, gold):
        assert bad(C.check(gold, C.GOLD)) == {}

    @pytest.mark.parametrize(
        "col,val,rule",
        [
            ("activity_score", 150.0, "activity_score_le"),
            ("activity_score", -5.0, "activity_score_ge"),
            ("push_events", -1, "push_events_ge"),
            ("pr_merge_rate", 1.5, "pr_merge_rate_le"),
            ("month", "13", "month_regex"),
        ],
    )
    def test_violations(self, gold, col, val, rule):
        df = gold.withColumn(col, F.lit(val).cast(gold.schema[col].dataType))
        assert bad(C.check(df, C.GOLD)) == {rule: 1}

    def test_null_org_passes(self, gold):
        assert bad(C.check(gold.withColumn("org_id", F.lit(None).cast("long")), C.GOLD)) == {}

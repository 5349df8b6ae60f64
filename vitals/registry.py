"""Registered queries: name → callable(spark, sf_dir) → DataFrame.

Each callable builds the lakehouse tables from the driver's tables in ``sf_dir``
(whole tables, no sampling) and runs one operator or metric query on them. Serving
queries use the data's default dashboard window, [2024-01-01, 2024-01-30], i.e. the
[max(min_day, max_day - 30), max_day] range of the data (see ``default_range``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.functions.columns import detect_bot
from vitals.operators import contracts as C
from vitals.operators import derived as D
from vitals.operators import distincts as DS
from vitals.operators import gold as G
from vitals.operators import silver as SV
from vitals.oracle import END, EXTRACT_FROM, START
from vitals.plans import incremental as I
from vitals.plans import jobs as J
from vitals.plans import pipeline as P
from vitals.plans import serving as Q
from vitals.plans.ingest import ingest
from vitals.session import scratch_path
from vitals.sources import bronze as B
from vitals.sources import export as X
from vitals.sources import fixtures
from vitals.sources import ledger as LG
from vitals.sources import tables as TB
from vitals.sources.lake import DerivedLake, ExtractLake, StagedLake, TableLake

QueryFn = Callable[[SparkSession, str], DataFrame]


def _lake(spark: SparkSession, sf_dir: str) -> DerivedLake:
    return DerivedLake(spark, sf_dir)


def _ranged(fn, **kw) -> QueryFn:
    return lambda spark, sf_dir: fn(_lake(spark, sf_dir), START, END, **kw)


def daily_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold table (minus the run clock ``updated_at``)."""
    return _lake(spark, sf_dir).gold().drop("updated_at")


def serving_queries() -> dict[str, QueryFn]:
    return {
        "daily_activity": daily_activity,
        "overview_kpis": _ranged(Q.overview_kpis),
        "daily_timeline": _ranged(Q.daily_timeline),
        "event_type_distribution": _ranged(Q.event_type_distribution),
        "daily_event_breakdown": _ranged(Q.daily_event_breakdown),
        "top_repos": _ranged(Q.top_repos),
        "trending_repos": _ranged(Q.trending_repos),
        "activity_heatmap": lambda spark, d: Q.activity_heatmap(_lake(spark, d), END),
        "activity_heatmap_push": lambda spark, d: Q.activity_heatmap(_lake(spark, d), END, "PushEvent"),
        "top_contributors": _ranged(Q.top_contributors),
        "contributors_over_time": _ranged(Q.contributors_over_time),
        "bot_vs_human": _ranged(Q.bot_vs_human),
        "pr_metrics": _ranged(Q.pr_metrics),
        "pr_bot_breakdown": _ranged(Q.pr_bot_breakdown),
        "issue_metrics": _ranged(Q.issue_metrics),
        "code_review_metrics": _ranged(Q.code_review_metrics),
        "repo_health": _ranged(Q.repo_health),
        "ecosystem_kpis": _ranged(Q.ecosystem_kpis),
        "org_summary": _ranged(Q.org_summary),
        "active_repos_over_time": _ranged(Q.active_repos_over_time),
        "star_growth": _ranged(Q.star_growth),
        "fork_growth": _ranged(Q.fork_growth),
        "top_forked_repos": _ranged(Q.top_forked_repos),
        "top_open_repos_by_issues": _ranged(Q.top_open_repos, sort_by="issues"),
        "top_open_repos_by_prs": _ranged(Q.top_open_repos, sort_by="prs"),
        "stars_vs_forks": lambda spark, d: Q.stars_vs_forks(StagedLake(spark, d), START, END),
        "star_engagement": _ranged(Q.star_engagement),
        "date_range": lambda spark, d: Q.date_range(_lake(spark, d)),
    }


def _on(fn, then) -> QueryFn:
    """A derived metric over a serving query's output."""
    return lambda spark, sf_dir: then(fn(spark, sf_dir))


def derived_queries() -> dict[str, QueryFn]:
    sq = serving_queries()

    def period_mean_rates(spark, d):
        return D.period_mean_rates(sq["pr_metrics"](spark, d), sq["issue_metrics"](spark, d))

    return {
        "contributors_bot_human": _on(sq["contributors_over_time"], lambda df: D.pivot_bot_human(df, "contributors")),
        "events_bot_human": _on(sq["bot_vs_human"], lambda df: D.pivot_bot_human(df, "events")),
        "prs_bot_human": _on(sq["pr_bot_breakdown"], lambda df: D.pivot_bot_human(df, "prs")),
        "bot_human_totals": _on(sq["bot_vs_human"], D.bot_human_totals),
        "heatmap_grid": _on(sq["activity_heatmap"], D.heatmap_grid),
        "top_humans": _on(sq["top_contributors"], lambda df: D.top_per_group(df, False)),
        "top_bots": _on(sq["top_contributors"], lambda df: D.top_per_group(df, True)),
        "pr_funnel": _on(sq["pr_metrics"], D.pr_funnel),
        "merge_rate_pct": _on(sq["pr_metrics"], lambda df: D.rate_pct(df, "avg_merge_rate", "merge_rate_pct")),
        "close_rate_pct": _on(sq["issue_metrics"], lambda df: D.rate_pct(df, "avg_close_rate", "close_rate_pct")),
        "period_mean_rates": period_mean_rates,
        "review_totals": _on(sq["code_review_metrics"], D.review_totals),
        "review_ratios": _on(sq["code_review_metrics"], D.review_ratios),
        "score_bands": _on(sq["daily_event_breakdown"], D.score_bands),
        "distribution_share": _on(sq["event_type_distribution"], D.distribution_share),
        "org_top10": _on(sq["org_summary"], lambda df: D.head(df, 10)),
        "org_top100": _on(sq["org_summary"], lambda df: D.head(df, 100)),
        "stars_vs_forks_labeled": _on(sq["stars_vs_forks"], D.org_label),
        "default_range": _on(sq["date_range"], D.default_range),
    }


# ---------------------------------------------------------------------------
# Silver operators, dimensions, contracts, incremental planning (lazy)
# ---------------------------------------------------------------------------


# Fixed split used by the incremental operators: the lake "holds" data up to here.
PROCESSED_UNTIL = "2024-01-20"
# First day of the second ingest batch for the version anti-join.
SECOND_BATCH_FROM = "2024-01-16"


def _parsed_all_types(lake: DerivedLake):
    """Parsed frame without the type filter (for the contract-violation operators)."""
    return SV.with_action(SV.parse_structs(lake.bronze().drop("source_file", "ingestion_timestamp")))


def _unfiltered_events(lake: DerivedLake):
    return SV.build_events(_parsed_all_types(lake))


def _bronze_before(lake: DerivedLake, ts: str, before: bool):
    fh = F.to_timestamp_ntz(F.concat_ws(" ", F.concat_ws("-", "year", "month", "day"), F.col("hour")), F.lit("yyyy-MM-dd HH"))
    cond = fh < F.lit(f"{ts} 00:00:00").cast("timestamp_ntz")
    return lake.bronze().where(cond if before else ~cond)


def silver_queries() -> dict[str, QueryFn]:
    def L(spark, d):
        return _lake(spark, d)

    def filter_known(spark, d):
        return SV.filter_known_events(L(spark, d).bronze()).select("id", "type", "created_at", "public")

    def parse_structs(spark, d):
        p = SV.parse_structs(SV.filter_known_events(L(spark, d).bronze()))
        return p.select(
            "id",
            F.col("actor_struct.id").alias("actor_id"),
            F.col("actor_struct.login").alias("actor_login"),
            F.col("repo_struct.id").alias("repo_id"),
            F.col("repo_struct.name").alias("repo_name"),
            F.col("org_struct.id").alias("org_id"),
            F.col("org_struct.login").alias("org_login"),
            "created_at",
        )

    def parse_created_at(spark, d):
        from vitals.functions.columns import parse_created_at as pc

        b = L(spark, d).bronze()
        return b.select("id", F.col("created_at").alias("created_at_text"), pc("created_at").alias("created_at"))

    def dedup_events(spark, d):
        p = SV.parse_structs(SV.filter_known_events(L(spark, d).bronze())).select("id", "type", "created_at")
        return SV.dedup_by_key(p, "id")

    def extract_action(spark, d):
        p = SV.with_action(SV.filter_known_events(L(spark, d).bronze())).select("id", "type", "action")
        return SV.dedup_by_key(p, "id")

    def dims(name, cols):
        def q(spark, d):
            return getattr(L(spark, d), name)().select(*cols)

        return q

    def detect_bots(spark, d):
        a = L(spark, d).actors().select("login").distinct()
        return a.select("login", F.coalesce(detect_bot("login"), F.lit(False)).alias("is_bot"))

    def filter_scd1(spark, d):
        lake = L(spark, d)
        old = SV.build_actors(SV.parse_bronze(_bronze_before(lake, SECOND_BATCH_FROM, True)), lake.now)
        new = SV.build_actors(SV.parse_bronze(_bronze_before(lake, SECOND_BATCH_FROM, False)), lake.now)
        return SV.filter_new_versions(new, old, "id", "login").select("id", "login", "is_bot")

    return {
        "filter_known_events": filter_known,
        "parse_structs": parse_structs,
        "parse_created_at": parse_created_at,
        "dedup_events": dedup_events,
        "extract_action": extract_action,
        "build_events": lambda spark, d: L(spark, d).events(),
        "detect_bot": detect_bots,
        "build_actors": dims("actors", ["id", "login", "display_login", "gravatar_id", "url", "avatar_url", "is_bot", "first_seen_at"]),
        "build_repos": dims("repos", ["id", "name", "url", "first_seen_at"]),
        "build_orgs": dims("orgs", ["id", "login", "gravatar_id", "url", "avatar_url", "first_seen_at"]),
        "filter_scd1": filter_scd1,
        "latest_actors": lambda spark, d: L(spark, d).latest_actors(),
        "latest_repos": lambda spark, d: L(spark, d).latest_repos(),
        "latest_orgs": lambda spark, d: L(spark, d).latest_orgs(),
    }


def contract_queries() -> dict[str, QueryFn]:
    def on(table, contract):
        return lambda spark, d: C.check(getattr(_lake(spark, d), table)(), contract)

    def unfiltered(spark, d):
        return C.check(_unfiltered_events(_lake(spark, d)), C.EVENTS)

    def sample(spark, d):
        return C.violations(_unfiltered_events(_lake(spark, d)), C.EVENTS, "id", 20).select("id", "type", "action", "n_failed")

    return {
        "contract_bronze": on("bronze", C.BRONZE),
        "contract_events": on("events", C.EVENTS),
        "contract_actors": on("actors", C.ACTORS),
        "contract_repos": on("repos", C.REPOS),
        "contract_orgs": on("orgs", C.ORGS),
        "contract_gold": on("gold", C.GOLD),
        "contract_events_unfiltered": unfiltered,
        "violation_sample": sample,
    }


def incremental_queries() -> dict[str, QueryFn]:
    def pending_partitions(spark, d):
        lake = _lake(spark, d)
        ledger = I.bronze_partitions(_bronze_before(lake, PROCESSED_UNTIL, True))
        return I.pending_partitions(lake.bronze(), ledger)

    def watermark(spark, d):
        lake = _lake(spark, d)
        return I.gold_watermark(spark, lake.gold().where(F.col("day") <= F.lit(PROCESSED_UNTIL).cast("date")))

    def pending_days(spark, d):
        return I.pending_days(_lake(spark, d).events(), PROCESSED_UNTIL)

    def batches(spark, d):
        return I.batches(pending_days(spark, d), 2)

    def read_days(spark, d):
        return G.events_for_days(_lake(spark, d).events(), PROCESSED_UNTIL, "2024-01-21")

    return {
        "pending_partitions": pending_partitions,
        "gold_watermark": watermark,
        "pending_days": pending_days,
        "batches": batches,
        "read_events_for_days": read_days,
    }


# ---------------------------------------------------------------------------
# Sources, sinks and write jobs (each call writes under a fresh folder of the shared
# checkpoint directory and returns the re-read result)
# ---------------------------------------------------------------------------


EXPORT_DAYS = 7
LANDED_BEFORE = "2024-01-16"


def _landed(spark: SparkSession, sf_dir: str) -> TableLake:
    return TableLake(spark, scratch_path(spark, "ro"), bronze_path=P.landed_bronze(spark, sf_dir))


def _max_ts_plus_hour(spark: SparkSession, sf_dir: str):
    """Injected "now": one hour after the newest event (one scalar)."""
    mx = spark.read.parquet(f"{sf_dir}/events.parquet").agg(F.max("ts").alias("m")).first()["m"]
    return F.lit(mx).cast("timestamp_ntz") + F.expr("INTERVAL 1 HOUR")


def write_queries() -> dict[str, QueryFn]:
    def read_raw(spark, d):
        raw = B.read_raw_events(spark, P.write_archive(spark, d))
        return raw.select(
            "id",
            "type",
            "created_at",
            "public",
            F.get_json_object("actor", "$.login").alias("actor_login"),
            F.get_json_object("payload", "$.action").alias("payload_action"),
            F.regexp_extract("source_file", B.FILE_HOUR_REGEX, 0).alias("archive_file"),
        )

    def land(spark, d):
        lake = _landed(spark, d)
        return lake.bronze().select("id", "type", "year", "month", "day", "hour", F.regexp_extract("source_file", B.FILE_HOUR_REGEX, 0).alias("archive_file"))

    def hours(spark, d):
        return B.hours_to_ingest(spark, _max_ts_plus_hour(spark, d), 30)

    def skip_existing(spark, d):
        lake = _landed(spark, d)
        parts = I.bronze_partitions(lake.bronze())
        fh = F.to_timestamp_ntz(F.concat_ws(" ", F.concat_ws("-", "year", "month", "day"), "hour"), F.lit("yyyy-MM-dd HH"))
        landed = parts.where(fh < F.lit(f"{LANDED_BEFORE} 00:00:00").cast("timestamp_ntz"))
        return B.skip_existing_hours(B.hours_to_ingest(spark, _max_ts_plus_hour(spark, d), 30), landed, parts)

    def read_partitions(spark, d):
        lake = _landed(spark, d)
        ledger = I.bronze_partitions(_bronze_before(_lake(spark, d), PROCESSED_UNTIL, True))
        pending = I.pending_partitions(lake.bronze(), ledger)
        return B.read_bronze_partitions(lake.bronze(), pending).select("id", "type", "year", "month", "day", "hour")

    def append_fact(spark, d):
        events = StagedLake(spark, d).events()
        path = scratch_path(spark, "append")
        first = F.col("created_at") < F.lit(f"{LANDED_BEFORE} 00:00:00").cast("timestamp_ntz")
        hours = ["year", "month", "day", "hour"]
        # rows of an hour come together first, or each task writes a file for each hour
        TB.append(events.where(first).hint("rebalance", *hours), path, hours)
        TB.append(events.where(~first).hint("rebalance", *hours), path, hours)
        from vitals.functions.schemas import SILVER_EVENTS_SCHEMA

        return spark.read.schema(SILVER_EVENTS_SCHEMA).option("basePath", path).parquet(path)

    def transform_batch(spark, d):
        lake = P.fresh_lake(spark, d)
        rep = J.silver_batch(lake, P.now_col())
        if rep.status != J.SUCCESS:
            raise RuntimeError(str(rep))
        return lake.events()

    def silver_to_gold(spark, d):
        return P.build_lake(spark, d).gold().drop("updated_at")

    def replace_days(spark, d):
        lake = P.build_lake(spark, d)
        rep = J.gold_batch(lake, P.now_col(), days=(PROCESSED_UNTIL, "2024-01-21"))
        if rep.status != J.SUCCESS:
            raise RuntimeError(str(rep))
        return lake.gold().drop("updated_at")

    def export_gold(spark, d):
        out = scratch_path(spark, "extract")
        paths = X.write_extract(StagedLake(spark, d), out, EXPORT_DAYS)
        from vitals.sources.lake import GOLD_SCHEMA

        return spark.read.schema(GOLD_SCHEMA).parquet(paths["gold"]).drop("updated_at")

    def export_events(spark, d):
        out = scratch_path(spark, "extract")
        paths = X.write_extract(StagedLake(spark, d), out, EXPORT_DAYS)
        return spark.read.parquet(paths["events"]).withColumn("date", F.col("date").cast("date"))

    def csv_download(spark, d):
        path = scratch_path(spark, "orgs-csv")
        X.write_org_csv(Q.org_summary(_lake(spark, d), START, END), path, 100)
        schema = "`Organization` STRING, `Total events` BIGINT, `Active repos` BIGINT, `Avg activity score` DOUBLE"
        return spark.read.schema(schema).option("header", True).csv(path)

    def stream_silver(spark, d):
        return P.stream_lake(spark, d, max_files=400).events()

    def stream_redelivered(spark, d):
        return P.redelivered_lake(spark, d).events()

    def stream_gold(spark, d):
        return P.stream_lake(spark, d, max_files=400).gold().drop("updated_at")

    return {
        "read_raw_events": read_raw,
        "land_bronze": land,
        "hours_to_ingest": hours,
        "skip_existing_hours": skip_existing,
        "read_bronze_partitions": read_partitions,
        "append_fact": append_fact,
        "transform_batch": transform_batch,
        "silver_to_gold": silver_to_gold,
        "replace_days": replace_days,
        "export_gold_window": export_gold,
        "export_events_window": export_events,
        "csv_download": csv_download,
        "stream_silver": stream_silver,
        "stream_silver_redelivered": stream_redelivered,
        "stream_gold": stream_gold,
    }


# ---------------------------------------------------------------------------
# Histories: several landings and batches over the whole events table
# ---------------------------------------------------------------------------

# Archive hours after all others.
LATER, LATEST = "2024-02-04 03:00:00", "2024-02-05 05:00:00"
# The day whose hours are landed again with other rows, and the one that loses all of them.
RELANDED_DAY, EMPTIED_DAY = "2024-01-10", "2024-01-12"
# Archive hours whose files are cut off, and one with a line that is no JSON.
CUT_HOURS, CORRUPT_HOUR = ("2024-01-20-5", "2024-01-20-6", "2024-01-20-7"), "2024-01-21-3"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _raw(events: DataFrame) -> DataFrame:
    return fixtures.raw_events(events)


def relanded_lake(spark: SparkSession, sf_dir: str) -> TableLake:
    """A lake whose hours of one day were landed again: half of the rows, some of the others held by a later hour as well,
    and new ones; another day was landed again without a known event."""
    events = _events(spark, sf_dir)
    lake = P.own_lake(spark, _raw(events))
    P.run_silver(lake)
    P.run_gold(lake)
    day = F.to_date("ts")
    P.land_rows(lake, P.in_hour(_raw(events.where((day == RELANDED_DAY) & (F.col("event_id") % 10 == 1))), LATER))
    P.run_silver(lake)
    kept = events.where((day == RELANDED_DAY) & (F.col("event_id") % 2 == 0))
    new = fixtures.new_like(events.where((day == RELANDED_DAY) & (F.col("event_id") % 25 == 0)))
    # an hour of which nothing is left is landed with rows of an unknown type, as the emptied day's are
    unknown = _raw(events.where(day.isin(RELANDED_DAY, EMPTIED_DAY))).withColumn("type", F.lit("GollumEvent"))
    P.land_rows(lake, _raw(kept.unionByName(new)).unionByName(unknown))
    P.run_silver(lake)
    P.run_gold(lake)
    return lake


def history_queries() -> dict[str, QueryFn]:
    def dedup_across_batches(spark, d):
        """A tenth of all ids comes again 7 hours later in later batches, with some new events."""
        events = _events(spark, d)
        lake = P.own_lake(spark, _raw(events))
        P.run_silver(lake)
        again = events.where("event_id % 10 = 0").withColumn("ts", F.col("ts") + F.expr("INTERVAL 7 HOURS"))
        P.land_rows(lake, P.in_hour(_raw(again), LATER))
        P.run_silver(lake)
        P.land_rows(lake, P.in_hour(_raw(again.unionByName(fixtures.new_like(events.where("event_id % 25 = 0")))), LATEST))
        P.run_silver(lake)
        return lake.events()

    def late_days(spark, d):
        """Gold after events of every day came late, long behind the watermark."""
        events = _events(spark, d)
        lake = P.own_lake(spark, _raw(events))
        P.run_silver(lake)
        P.run_gold(lake)
        P.land_rows(lake, P.in_hour(_raw(fixtures.new_like(events.where("event_id % 25 = 0"))), LATEST))
        P.run_silver(lake)
        P.run_gold(lake, days_per_batch=8)
        return lake.gold().drop("updated_at")

    def rolling_distincts(spark, d):
        """Distinct actors and repositories of each week that ends with a day, from the bitmaps beside gold."""
        return DS.rolling(P.build_lake(spark, d).day_sets(), 7)

    def silver_rejects(spark, d):
        lake = P.own_lake(spark, fixtures.damaged(_raw(_events(spark, d))))
        P.run_silver(lake, on_violation="quarantine")
        return lake.rejects().select("id", "source", F.array_join("reasons", "; ").alias("reasons"))

    def in_batches(spark, d):
        lake = P.fresh_lake(spark, d)
        size = LG.file_versions(spark, lake.paths["bronze"]).agg(F.sum("bytes")).first()[0]
        P.run_silver(lake, max_bytes=size // 2)
        return lake.events()

    def ingest_status(spark, d):
        """The second ingest of an archive: three files are cut off, one has a line that is no JSON."""
        glob = P.write_archive(spark, d)
        root = glob.split("/archive=")[0]
        for name in CUT_HOURS:
            B.cut_archive_files(spark, f"{root}/archive={name}.json.gz")
        spark.createDataFrame([("no json",)], "value string").coalesce(1).write.mode("append").option("compression", "gzip").text(f"{root}/archive={CORRUPT_HOUR}.json.gz")
        lake = TableLake(spark, scratch_path(spark, "lake"))
        hours = B.hours_to_ingest(spark, _max_ts_plus_hour(spark, d), 30)
        at = F.lit(P.INGESTED_AT).cast("timestamp")
        ingest(lake, glob, hours.where(F.col("hour_ts") < F.lit(f"{LANDED_BEFORE} 00:00:00").cast("timestamp_ntz")), at)
        return ingest(lake, glob, hours, at)

    def read_table_extract(spark, d):
        """A metric that reads events and a dimension, over the written extract."""
        out = scratch_path(spark, "extract")
        X.write_extract(StagedLake(spark, d), out, EXPORT_DAYS)
        return Q.bot_vs_human(ExtractLake(spark, out), EXTRACT_FROM, END)

    return {
        "dedup_across_batches": dedup_across_batches,
        "late_days": late_days,
        "relanded_hour": lambda spark, d: relanded_lake(spark, d).events(),
        "relanded_gold": lambda spark, d: relanded_lake(spark, d).gold().drop("updated_at"),
        "silver_rejects": silver_rejects,
        "transform_in_batches": in_batches,
        "ingest_status": ingest_status,
        "read_table_extract": read_table_extract,
        "overview_kpis_from_bitmaps": lambda spark, d: Q.overview_kpis(P.build_lake(spark, d), START, END),
        "rolling_distincts": rolling_distincts,
    }


def queries() -> dict[str, QueryFn]:
    out: dict[str, QueryFn] = {}
    for section in (serving_queries, derived_queries, silver_queries, contract_queries, incremental_queries, write_queries, history_queries):
        out.update(section())
    return out

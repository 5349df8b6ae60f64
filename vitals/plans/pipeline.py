"""End-to-end runs over the driver's tables: archive files → bronze → silver → gold,
written under the shared checkpoint folder. Used by the registered write operators,
the streaming variants, the tests and the bench."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.functions.schemas import BRONZE_PARTITIONS
from vitals.plans import jobs as J
from vitals.session import configure, scratch_path
from vitals.sources import bronze as B
from vitals.sources import fixtures
from vitals.sources import tables as TB
from vitals.sources.lake import DEFAULT_NOW, TableLake

INGESTED_AT = "2024-02-01 00:00:00"


def now_col(now: str = DEFAULT_NOW) -> Column:
    return F.lit(now).cast("timestamp_ntz")


def raw_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.raw_events(spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet"))


def write_archive(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> str:
    """Driver events → hourly gzip NDJSON archive files; returns the glob to read."""
    root = scratch_path(spark, "archive")
    B.write_archive_files(raw if raw is not None else raw_from_tables(spark, sf_dir), root)
    return B.archive_paths(root)


def land(spark: SparkSession, archive_glob: str, bronze_path: str) -> None:
    B.land_bronze(spark, archive_glob, bronze_path, F.lit(INGESTED_AT).cast("timestamp"))


_BRONZE_CACHE: dict[tuple[str, str], str] = {}


def landed_bronze(spark: SparkSession, sf_dir: str) -> str:
    """Bronze table for ``sf_dir`` (landed once per session and input folder)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BRONZE_CACHE:
        configure(spark)
        path = scratch_path(spark, "bronze")
        land(spark, write_archive(spark, sf_dir), path)
        _BRONZE_CACHE[key] = path
    return _BRONZE_CACHE[key]


def land_rows(lake: TableLake, raw: DataFrame) -> None:
    """Raw rows with ``file_hour`` as landed bronze hours; an hour that is there is replaced."""
    # rows of an hour come together first, or each task writes a file for each hour
    rows = fixtures.bronze_of(raw, INGESTED_AT).hint("rebalance", *BRONZE_PARTITIONS)
    TB.replace_partitions(rows, lake.paths["bronze"], BRONZE_PARTITIONS)


def in_hour(raw: DataFrame, hour: str) -> DataFrame:
    """The rows as a delivery of another archive hour."""
    return raw.withColumn("file_hour", F.lit(hour).cast("timestamp_ntz"))


def run_silver(lake: TableLake, **kwargs) -> J.BatchReport:
    rep = J.silver_batch(lake, now_col(), **kwargs)
    if rep.status != J.SUCCESS:
        raise RuntimeError(f"silver batch {rep.status}: {rep.violations}")
    return rep


def run_gold(lake: TableLake, **kwargs) -> J.BatchReport:
    rep = J.gold_batch(lake, now_col(), **kwargs)
    if rep.status != J.SUCCESS:
        raise RuntimeError(f"gold batch {rep.status}: {rep.violations}")
    return rep


def own_lake(spark: SparkSession, raw: DataFrame) -> TableLake:
    """A new lake with a bronze table of its own, which may be landed into again."""
    lake = TableLake(configure(spark), scratch_path(spark, "lake"))
    land_rows(lake, raw)
    return lake


def fresh_lake(spark: SparkSession, sf_dir: str) -> TableLake:
    """A new, empty lake whose bronze is the landed archive of ``sf_dir``."""
    return TableLake(spark, scratch_path(spark, "lake"), bronze_path=landed_bronze(spark, sf_dir))


def build_lake(spark: SparkSession, sf_dir: str) -> TableLake:
    """Full run: silver batch then gold batch on a fresh lake."""
    lake = fresh_lake(spark, sf_dir)
    run_silver(lake)
    run_gold(lake)
    return lake


def stream_lake(spark: SparkSession, sf_dir: str, now: str = DEFAULT_NOW, max_files: int | None = None) -> TableLake:
    """Same result as :func:`build_lake`, driven by Structured Streaming."""
    from vitals.streaming.stream import stream_gold, stream_silver

    lake = fresh_lake(spark, sf_dir)
    stream_silver(lake, now_col(now), max_files=max_files)
    stream_gold(lake, now_col(now))
    return lake


def redelivered_lake(spark: SparkSession, sf_dir: str, now: str = DEFAULT_NOW, within: str = "12 hours") -> TableLake:
    """Silver of a stream whose archive hours arrive twice: the second delivery of each is kept from the merge."""
    from vitals.streaming.stream import stream_silver

    lake = fresh_lake(spark, sf_dir)
    stream_silver(lake, now_col(now), redelivered_within=within)
    # the plan reads the folder it adds to: the copy is staged
    again = TB.stage(spark, lake.bronze(), "bronze-again", BRONZE_PARTITIONS)
    again.write.mode("append").partitionBy(*BRONZE_PARTITIONS).parquet(lake.paths["bronze"])
    stream_silver(lake, now_col(now), redelivered_within=within)
    return lake

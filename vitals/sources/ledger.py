"""What was processed: versions of bronze hours, days that silver changed, and what gold has consumed.

An hour's version is a fingerprint of its files (name, length, modification time), taken from the file listing alone.
An hour is pending when its version isn't the one the ledger has last: new hours, and hours that were landed again.
The log of changed days has one folder a silver batch, so that a batch that is run again replaces its entry; gold notes
the batches whose days it has recomputed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from vitals.functions.schemas import BRONZE_PARTITIONS
from vitals.sources import tables as TB

KEYS = list(BRONZE_PARTITIONS)
LEDGER = "year string, month string, day string, hour string, version string, bytes long, batch string, processed_at timestamp_ntz"
CHANGED = "day date, batch string"
CONSUMED = "batch string"


def hour_key(keys: list[str] | None = None):
    """``2024-01-05-07`` of the partition columns."""
    return F.concat_ws("-", *(keys or KEYS))


def file_versions(spark: SparkSession, path: str, keys: list[str] | None = None, pattern: str = "*.parquet") -> DataFrame:
    """Partition columns, version, bytes and n_files of each folder of files under ``path``. No file is opened."""
    keys = keys or KEYS
    files = TB.list_files(spark, path, pattern)
    named = F.struct(F.regexp_extract("path", "[^/]+$", 0).alias("name"), "length", "modificationTime")
    return files.groupBy(*keys).agg(
        F.sha2(F.to_json(F.sort_array(F.collect_list(named))), 256).alias("version"),
        F.sum("length").alias("bytes"),
        F.count("*").alias("n_files"),
    )


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The newest entry of each hour."""
    if not TB.exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    entries = spark.read.schema(LEDGER).parquet(path)
    newest = F.max_by(F.struct("version", "batch"), F.col("batch")).alias("e")
    return entries.groupBy(*KEYS).agg(newest).select(*KEYS, "e.version", "e.batch")


def pending_versions(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Hours whose version isn't the processed one, oldest first; ``relanded``: an older version was processed."""
    done = ledger.select(*KEYS, F.col("version").alias("done"))
    joined = files.join(done, KEYS, "left").where("done IS NULL OR done <> version")
    return joined.select(*KEYS, "version", "bytes", "n_files", F.col("done").isNotNull().alias("relanded")).orderBy(*KEYS)


def pack(hours: DataFrame, max_bytes: int) -> DataFrame:
    """Number (``pack``) the hours' batches in order, so that no batch exceeds ``max_bytes``, but for one hour that alone does.

    By prefix sums: hours of at most half the bound share a batch when their sums before them fall into the same half
    bound, so a batch has less than a half before its last hour and at most a half in it; a larger hour is a batch of its
    own and parts its neighbours. One row an hour comes in, so one ordered window is enough."""
    half = max(1, max_bytes // 2)
    by = W.orderBy(*KEYS)
    large = F.col("bytes") > half
    before = F.sum(F.when(large, 0).otherwise(F.col("bytes"))).over(by.rowsBetween(W.unboundedPreceding, -1))
    parts = hours.withColumn("_part", F.floor(F.coalesce(before, F.lit(0)) / half)).withColumn("_large", large)
    moved = (F.col("_part") != F.lag("_part").over(by)) | F.col("_large") | F.lag("_large").over(by)
    return parts.withColumn("pack", F.sum(F.coalesce(moved.cast("int"), F.lit(0))).over(by)).drop("_part", "_large")


def log_changed_days(days: DataFrame, path: str, batch: str) -> None:
    TB.write_parquet(days.select("day").distinct().coalesce(1), f"{path}/batch={batch}", static=True)


def changed_days(spark: SparkSession, log: str, consumed: str) -> DataFrame:
    """(day, batch) entries of silver batches that gold hasn't consumed."""
    if not TB.exists(spark, log):
        return spark.createDataFrame([], CHANGED)
    entries = spark.read.schema(CHANGED).option("basePath", log).parquet(log)
    if not TB.exists(spark, consumed):
        return entries
    return entries.join(spark.read.schema(CONSUMED).parquet(consumed), "batch", "left_anti").select("day", "batch")


def consume(entries: list[str], spark: SparkSession, consumed: str) -> None:
    """Note the batches whose days gold has recomputed."""
    if entries:
        TB.append(spark.createDataFrame([(b,) for b in sorted(set(entries))], CONSUMED).coalesce(1), consumed)

"""What is left to process: pending bronze partitions, the gold watermark, pending
days and their batches. Every answer is a small DataFrame (one row per hour or day);
the only value brought to the driver is the watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitals.functions.schemas import BRONZE_PARTITIONS, GOLD_SENTINEL_DAY

PARTITION_KEYS = list(BRONZE_PARTITIONS)


def bronze_partitions(bronze: DataFrame) -> DataFrame:
    """Distinct hour partitions of bronze."""
    return bronze.select(*PARTITION_KEYS).distinct()


def pending_partitions(bronze: DataFrame, processed: DataFrame | None) -> DataFrame:
    """Bronze hour partitions not in the processed ledger, oldest first.

    The ledger is keyed by bronze partition (not by the event hours found in silver),
    so a stray late event cannot mark an hour as done."""
    parts = bronze_partitions(bronze)
    if processed is not None:
        parts = parts.join(processed.select(*PARTITION_KEYS).distinct(), PARTITION_KEYS, "left_anti")
    return parts.orderBy(*PARTITION_KEYS)


def gold_watermark(spark: SparkSession, gold: DataFrame | None) -> DataFrame:
    """Greatest day in gold, or the sentinel when the table is missing / empty."""
    sentinel = F.lit(GOLD_SENTINEL_DAY).cast("date")
    if gold is None:
        return spark.range(1).select(sentinel.alias("watermark"))
    return gold.agg(F.coalesce(F.max("day"), sentinel).alias("watermark"))


def watermark_value(watermark: DataFrame) -> str:
    """The one watermark date as ISO text (a single scalar to the driver)."""
    return str(watermark.first()["watermark"])


def pending_days(events: DataFrame, watermark: str) -> DataFrame:
    """Distinct created_at days strictly after the watermark's midnight, oldest
    first. The watermark day itself is pending again (its later events are > 00:00),
    which completes a partially processed day. The bound is a literal, so the
    partition strings prune every earlier day at planning time."""
    wm = F.lit(f"{watermark} 00:00:00").cast("timestamp_ntz")
    ymd = F.concat_ws("-", "year", "month", "day")
    cand = events.where((ymd >= F.lit(watermark)) & (F.col("created_at") > wm))
    return cand.select(F.to_date("created_at").alias("day")).distinct().orderBy("day")


def batches(days: DataFrame, size: int) -> DataFrame:
    """I4: consecutive chunks of ``size`` pending days: (batch, first_day, last_day,
    n_days). One row per day in, so a single ordered window is bounded by the number
    of days."""
    rn = F.row_number().over(Window.orderBy("day")) - 1
    chunked = days.select("day", (rn / size).cast("long").alias("batch"))
    return (
        chunked.groupBy("batch")
        .agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count(F.lit(1)).alias("n_days"))
        .orderBy("batch")
    )

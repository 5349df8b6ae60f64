"""Structured Streaming drivers for the same transforms (re-aim of the batch loops).

* ``stream_silver``: new bronze files → each micro-batch goes through
  :func:`vitals.plans.jobs.silver_from_bronze` (parse, dedup against the touched
  silver partitions, contracts, publish). Exactly-once per file comes from the
  stream checkpoint; cross-batch duplicates are removed by the merge with existing
  partitions, so no unbounded dedup state is kept. ``redelivered_within`` puts a stage with bounded state in front:
  a delivery seen less than that ago (same archive hour, same content) goes no further, see :func:`new_deliveries`.
* ``stream_gold``: new silver files → the distinct days they touch (a handful of rows
  per micro-batch) → gold recomputed for exactly those days from the silver table and
  published by partition replacement. Late events for an old day simply recompute
  that day, so no watermark-based drop of late data is needed.

Both run with ``trigger(availableNow=True)`` for scheduled catch-up, or with a
processing-time trigger as a long-running job; checkpoints live under the lake's root, so
a later call goes on where the last one ended.
"""

from __future__ import annotations

import zlib

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitals.functions import schemas as S
from vitals.operators import contracts as C
from vitals.operators import distincts as DS
from vitals.operators import gold as G
from vitals.plans import jobs as J
from vitals.sources import tables as TB
from vitals.sources.lake import TableLake


def _bronze_stream_schema() -> T.StructType:
    return T.StructType(
        list(S.BRONZE_SCHEMA.fields)
        + [T.StructField("source_file", T.StringType()), T.StructField("ingestion_timestamp", T.TimestampType())]
        + [T.StructField(p, T.StringType()) for p in S.BRONZE_PARTITIONS]
    )


def new_deliveries(rows: DataFrame, within: str) -> DataFrame:
    """Streaming bronze rows without those that arrived before, less than ``within`` ago.

    Two rows are one delivery if their archive hour and all raw fields are equal (SHA-256 of both), so rows of one id that
    differ, and copies from another archive hour, still reach the exact merge, which picks the survivor and notes every hour.
    The watermark runs on the time of arrival: a row is never late for it, however old its event or file, and
    none is dropped but copies. The state holds one digest for each delivery of the last ``within``.
    """
    raw = [f.name for f in S.BRONZE_SCHEMA.fields]
    # to_json writes nulls as such, so a missing field and an empty one differ
    digest = F.sha2(F.to_json(F.struct(*S.BRONZE_PARTITIONS, *raw), {"ignoreNullFields": "false"}), 256)
    keyed = rows.withColumns({"_arrived": F.current_timestamp(), "_delivery": digest})
    return keyed.withWatermark("_arrived", within).dropDuplicatesWithinWatermark(["_delivery"]).drop("_arrived", "_delivery")


def stream_silver(
    lake: TableLake, now: Column, checkpoint: str | None = None, available_now: bool = True, max_files: int | None = None, redelivered_within: str | None = None
):
    """New bronze files into silver. ``redelivered_within`` ('2 hours') belongs to the checkpoint: a stream is started
    with it or without it, and goes on so."""
    spark = lake.spark
    reader = spark.readStream.schema(_bronze_stream_schema()).option("basePath", lake.paths["bronze"])
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    src = reader.parquet(lake.paths["bronze"])
    reports: list[J.BatchReport] = []
    checkpoint = checkpoint or f"{lake.root}/_checkpoints/silver{'-once' if redelivered_within else ''}"
    if redelivered_within:
        src = new_deliveries(src, redelivered_within)
    # epochs count by checkpoint, so the checkpoint is part of a batch's name
    stream = f"stream-{zlib.crc32(checkpoint.encode()):08x}"

    def process(batch: DataFrame, epoch_id: int) -> None:
        if redelivered_within:
            # the state of every partition is written by one whole pass; what follows reads the kept rows
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                if batch.count():
                    publish(batch, epoch_id)
            finally:
                batch.unpersist()
        else:
            publish(batch, epoch_id)

    def publish(batch: DataFrame, epoch_id: int) -> None:
        rep = J.silver_from_bronze(lake, batch, now, batch=f"{stream}-{epoch_id:08d}")
        if rep.status == J.FAILED:
            raise RuntimeError(f"silver micro-batch {epoch_id} failed contracts: {rep.violations}")
        reports.append(rep)

    w = src.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    handle = w.start()
    if available_now:
        handle.awaitTermination()
    return handle, reports


def stream_gold(lake: TableLake, now: Column, checkpoint: str | None = None, available_now: bool = True):
    spark = lake.spark
    src = spark.readStream.schema(S.SILVER_EVENTS_SCHEMA).option("basePath", lake.paths["events"]).parquet(lake.paths["events"])

    def process(batch: DataFrame, epoch_id: int) -> None:
        # Only the partitions of the days that this micro-batch touched are read, however far apart they are.
        events = TB.in_partitions(lake.events(), batch, S.GOLD_PARTITIONS).select("type", "action", "actor_id", "repo_id", "org_id", "created_at")
        daily = G.daily_activity(events, now)
        staged = TB.stage(spark, daily.hint("rebalance", "day"), "gold", S.GOLD_PARTITIONS)
        bad, _ = C.evaluate(staged, C.GOLD)
        if bad:
            raise RuntimeError(f"gold micro-batch {epoch_id} failed contracts: {bad}")
        TB.replace_partitions(DS.day_sets(events).hint("rebalance", "day"), lake.paths["day_sets"], S.GOLD_PARTITIONS)
        TB.replace_partitions(staged, lake.paths["gold"], S.GOLD_PARTITIONS)

    w = src.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint or f"{lake.root}/_checkpoints/gold")
    if available_now:
        w = w.trigger(availableNow=True)
    handle = w.start()
    if available_now:
        handle.awaitTermination()
    return handle

"""Ingest of archive files with faults isolated per file.

One job decompresses the candidate files, a file at a time and in pieces, and reports for each its lines or what is wrong with
it (cut off, not gzip, damaged). Hours all of whose files are whole are then landed by one Spark job (JSON read
on the JVM); an hour with a broken file is ``failed`` and keeps what it had. Lines that are no JSON are landed in
``_corrupt_record`` (other columns null), which readers of bronze don't see, and counted.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitals.functions.schemas import BRONZE_PARTITIONS, BRONZE_SCHEMA
from vitals.sources import bronze as B
from vitals.sources import tables as TB
from vitals.sources.lake import TableLake

CORRUPT = "_corrupt_record"
PIECE = 1 << 20
STATUS = "hour_ts timestamp_ntz, status string, reason string, n_rows long, n_corrupt long"


def gzip_lines(data: bytes | memoryview, piece: int = PIECE) -> tuple[int, str | None]:
    """(lines, error) of gzip data of one or more members; holds one piece of the text at a time."""
    lines, open_line, at, member = 0, False, 0, zlib.decompressobj(31)
    if not len(data):
        return 0, "empty file"
    try:
        while True:
            held = member.unconsumed_tail or bytes(data[at : at + piece])
            if not member.unconsumed_tail:
                at += len(held)
            text = member.decompress(held, piece)
            if text:
                lines += text.count(b"\n")
                open_line = not text.endswith(b"\n")
            if member.eof:
                at -= len(member.unused_data)
                if at >= len(data):
                    return lines + open_line, None
                member = zlib.decompressobj(31)
            elif not held and not text:
                return lines, "cut off"
    except zlib.error as e:
        return lines, "not gzip" if not lines and at <= piece and "header" in str(e) else "damaged"


def probe(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, n_lines, error of each file; error is null for a whole one."""

    def run(batches):
        for batch in batches:
            found = [gzip_lines(c.as_buffer() if c.is_valid else b"") for c in batch.column("content")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), pa.array([n for n, _ in found], pa.int64()), pa.array([e for _, e in found], pa.string())], names=["path", "n_lines", "error"]
            )

    if not paths:
        return spark.createDataFrame([], "path string, n_lines long, error string")
    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return files.mapInArrow(run, "path string, n_lines long, error string")


def _landed(spark: SparkSession, path: str) -> DataFrame:
    fields = [*BRONZE_SCHEMA.fields, T.StructField(CORRUPT, T.StringType()), *(T.StructField(p, T.StringType()) for p in BRONZE_PARTITIONS)]
    return spark.read.schema(T.StructType(fields)).option("basePath", path).parquet(path)


def ingest(lake: TableLake, archive: str, hours: DataFrame, ingested_at: Column | None = None, overwrite: bool = False) -> DataFrame:
    """Land the wanted ``hours`` (``hour_ts``) that have files under the glob ``archive``.

    hour_ts, status, reason, n_rows, n_corrupt: ``success`` (landed), ``skipped`` (landed before, or no source), ``failed``
    (a file of the hour is unreadable). Also kept, in ``_ledger/ingest``. A failed hour is tried again by the next call."""
    spark, keys, bronze = lake.spark, list(BRONZE_PARTITIONS), lake.paths["bronze"]
    files = TB.list_files(spark, archive, "*.gz").select("path").withColumn("hour_ts", B.file_hour(F.col("path")))
    files = files.select("path", "hour_ts", *B.hour_partition_columns(F.col("hour_ts")))
    landed = TB.list_partitions(spark, bronze, keys) if TB.exists(spark, bronze) else files.select(*keys).limit(0)
    plan = B.skip_existing_hours(hours, landed, files.select(*keys), overwrite)
    wanted = files.join(plan.where("status = 'success'").select("hour_ts"), "hour_ts", "left_semi")
    # a path and an error for each file: short rows, an hour's file each
    paths = [r["path"] for r in wanted.select("path").collect()]
    errors = probe(spark, paths).where("error IS NOT NULL").select("path", "error").toArrow()
    broken = spark.createDataFrame(errors) if errors.num_rows else spark.createDataFrame([], "path string, error string")
    bad = broken.select(B.file_hour(F.col("path")).alias("hour_ts"), "error").groupBy("hour_ts").agg(F.min("error").alias("error"))
    whole = [r["path"] for r in wanted.join(bad, "hour_ts", "left_anti").select("path").collect()]
    if whole:
        schema = T.StructType([*BRONZE_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
        raw = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(whole)
        rows = B.with_bronze_partitions(raw.withColumn("source_file", F.col("_metadata.file_path")), ingested_at)
        TB.replace_partitions(rows, bronze, BRONZE_PARTITIONS)
        here = files.where(F.col("path").isin(whole)) if len(whole) <= 100 else files.join(spark.createDataFrame([(p,) for p in whole], "path string"), "path", "left_semi")
        counts = TB.in_partitions(_landed(spark, bronze), here, BRONZE_PARTITIONS).groupBy(*keys).agg(F.count("*").alias("n_rows"), F.count(CORRUPT).alias("n_corrupt"))
    else:
        counts = spark.createDataFrame([], ", ".join(f"{k} string" for k in keys) + ", n_rows long, n_corrupt long")
    out = plan.select("hour_ts", "status", "reason", *B.hour_partition_columns(F.col("hour_ts"))).join(bad, "hour_ts", "left").join(counts, keys, "left")
    success = (F.col("status") == "success") & F.col("error").isNull()
    out = out.select(
        "hour_ts",
        F.when((F.col("status") == "success") & F.col("error").isNotNull(), "failed").otherwise(F.col("status")).alias("status"),
        F.when((F.col("status") == "success") & F.col("error").isNotNull(), F.col("error")).otherwise(F.col("reason")).alias("reason"),
        F.when(success, F.coalesce("n_rows", F.lit(0))).alias("n_rows"),
        F.when(success, F.coalesce("n_corrupt", F.lit(0))).alias("n_corrupt"),
    )
    report = TB.stage(spark, out.coalesce(1), "ingest-status")
    TB.append(report.withColumn("ingested_at", (ingested_at if ingested_at is not None else F.current_timestamp()).cast("timestamp")), f"{lake.root}/_ledger/ingest")
    return report

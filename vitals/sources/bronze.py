"""Raw hourly event files → bronze Parquet.

Archive files are gzip NDJSON, one per hour, named ``YYYY-MM-DD-H.json.gz``. gzip is
not splittable, so one file is one task: the hourly file is the natural unit of
parallelism, and a backfill of N hours is one Spark job of N tasks (no driver
thread pool).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.functions.columns import zero_pad
from vitals.functions.schemas import BRONZE_PARTITIONS, BRONZE_SCHEMA
from vitals.sources.tables import in_partitions

FILE_HOUR_REGEX = r"(\d{4}-\d{2}-\d{2})-(\d{1,2})\.json\.gz"


def read_raw_events(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Scan NDJSON(.gz) with the fixed all-text schema (nested objects stay raw
    JSON text) and record each row's source file."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.schema(BRONZE_SCHEMA).option("mode", "PERMISSIVE").json(paths)
    return df.withColumn("source_file", F.col("_metadata.file_path"))


def file_hour(source_file: Column) -> Column:
    """Archive hour of a file from its name (timestamp, naive UTC)."""
    m = F.regexp_extract(source_file, FILE_HOUR_REGEX, 1)
    h = F.regexp_extract(source_file, FILE_HOUR_REGEX, 2)
    return F.to_timestamp_ntz(F.concat_ws(" ", m, F.lpad(h, 2, "0")), F.lit("yyyy-MM-dd HH"))


def with_bronze_partitions(raw: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Stamp ingestion time and add year / month / day / hour of the archive file."""
    fh = file_hour(F.col("source_file"))
    return raw.select(
        *(c for c in raw.columns),
        (ingested_at if ingested_at is not None else F.current_timestamp()).alias("ingestion_timestamp"),
        F.year(fh).cast("string").alias("year"),
        zero_pad(F.month(fh)).alias("month"),
        zero_pad(F.dayofmonth(fh)).alias("day"),
        zero_pad(F.hour(fh)).alias("hour"),
    )


def land_bronze(spark: SparkSession, raw_paths: str | list[str], bronze_path: str, ingested_at: Column | None = None) -> None:
    """All pending hourly files → zstd Parquet under year=/month=/day=/hour=.

    Dynamic partition overwrite makes a re-landed hour replace itself; other hours
    are untouched."""
    landed = with_bronze_partitions(read_raw_events(spark, raw_paths), ingested_at)
    (
        landed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*BRONZE_PARTITIONS)
        .parquet(bronze_path)
    )


def write_archive_files(raw: DataFrame, root: str) -> None:
    """Write raw rows as archive-style gzip NDJSON (one folder per hour; JSON objects
    nested, not quoted). ``raw`` needs the raw text columns and ``file_hour``."""

    def obj(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit("null"))

    # Build the object field by field; to_json of a one-field struct gives proper escaping.
    parts = [
        F.lit('{"id":'), _json_value("id"),
        F.lit(',"type":'), _json_value("type"),
        F.lit(',"actor":'), obj("actor"),
        F.lit(',"repo":'), obj("repo"),
        F.lit(',"payload":'), obj("payload"),
        F.lit(',"public":'), F.when(F.col("public"), F.lit("true")).otherwise(F.lit("false")),
        F.lit(',"created_at":'), _json_value("created_at"),
        F.lit(',"org":'), obj("org"),
        F.lit("}"),
    ]
    out = raw.select(
        F.concat(*parts).alias("value"),
        F.concat(F.coalesce(F.date_format("file_hour", "yyyy-MM-dd"), F.lit("null")), F.lit("-"), F.coalesce(F.hour("file_hour").cast("string"), F.lit("null")), F.lit(".json.gz")).alias("archive"),
    )
    # One file per archive hour, like the real archive.
    out.repartition(64, "archive").write.mode("overwrite").option("compression", "gzip").partitionBy("archive").text(root)


def _json_value(c: str) -> Column:
    """JSON literal of a string column (quoted and escaped), ``null`` for null."""
    wrapped = F.to_json(F.struct(F.col(c).alias("v")))  # {"v":"..."}, or {} for null
    return F.when(F.col(c).isNull(), "null").otherwise(F.substring(wrapped, F.lit(6), F.length(wrapped) - 6))


def cut_archive_files(spark: SparkSession, folder: str) -> None:
    """Cut the gzip files of an archive folder to their first half, as a broken transfer leaves them."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(conf)
    for f in fs.listStatus(root) if fs.exists(root) else []:
        path = f.getPath()
        if path.getName().endswith(".gz"):
            half = jvm.org.apache.hadoop.fs.Path(folder, f"{path.getName()}.half")
            source, target = fs.open(path), fs.create(half)
            target.write(bytes(source.readNBytes(f.getLen() // 2)))
            source.close()
            target.close()
            fs.delete(path, False)
            fs.rename(half, path)


def archive_paths(root: str) -> str:
    """Glob over archive folders written by :func:`write_archive_files`."""
    return f"{root}/archive=*/*.gz"


def hours_to_ingest(spark: SparkSession, now: Column, days: int) -> DataFrame:
    """S3: every hour from 00:00 ``days`` days before the last complete hour
    (now - 1h) up to that hour, inclusive, as naive timestamps."""
    last = F.date_trunc("hour", now - F.expr("INTERVAL 1 HOUR")).cast("timestamp_ntz")
    start = (F.date_trunc("day", now - F.expr("INTERVAL 1 HOUR")) - F.expr(f"INTERVAL {int(days)} DAYS")).cast("timestamp_ntz")
    return spark.range(1).select(F.explode(F.sequence(start, last, F.expr("INTERVAL 1 HOUR"))).alias("hour_ts"))


def hour_partition_columns(ts: Column) -> list[Column]:
    return [
        F.year(ts).cast("string").alias("year"),
        zero_pad(F.month(ts)).alias("month"),
        zero_pad(F.dayofmonth(ts)).alias("day"),
        zero_pad(F.hour(ts)).alias("hour"),
    ]


def skip_existing_hours(hours: DataFrame, landed: DataFrame, available: DataFrame, overwrite: bool = False) -> DataFrame:
    """Status per wanted hour: ``skipped`` (already landed, unless ``overwrite``),
    ``skipped`` (no source file published), else ``success`` (to land).

    ``landed`` / ``available`` are distinct (year, month, day, hour) frames; both are
    bounded by the number of hours, so they are broadcast."""
    keys = ["year", "month", "day", "hour"]
    h = hours.select("hour_ts", *hour_partition_columns(F.col("hour_ts")))
    h = h.join(F.broadcast(landed.select(*keys).distinct().withColumn("_landed", F.lit(True))), keys, "left")
    h = h.join(F.broadcast(available.select(*keys).distinct().withColumn("_available", F.lit(True))), keys, "left")
    is_landed = F.coalesce(F.col("_landed"), F.lit(False)) & F.lit(not overwrite)
    has_file = F.coalesce(F.col("_available"), F.lit(False))
    return h.select(
        "hour_ts",
        F.when(is_landed, "skipped").when(~has_file, "skipped").otherwise("success").alias("status"),
        F.when(is_landed, "already landed").when(~has_file, "source missing").otherwise("landed").alias("reason"),
    )


def read_bronze_partitions(bronze: DataFrame, partitions: DataFrame) -> DataFrame:
    """The rows of the listed hour partitions, and only their files."""
    return in_partitions(bronze, partitions, BRONZE_PARTITIONS)

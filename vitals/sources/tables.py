"""Writes: partition replacement, appends, staged publish and the processed ledger.

Plain Parquet directories stand in for a table format (no Delta / Iceberg jars in the
image). Safety comes from three rules:

* never write to a path the same plan reads: results are first written to a staging
  folder under the shared checkpoint directory, checked, then published;
* facts are published with dynamic partition overwrite, so only the partitions a
  batch touches are replaced and a rerun of the same batch gives the same table;
* dimensions receive only versions they do not hold yet (anti-join), and the ledger
  of processed bronze partitions is appended last, so a failed batch is retried whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.session import scratch_path


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite", static: bool = False) -> None:
    """``static``: an overwrite replaces the whole folder, also where the session replaces partitions only."""
    w = df.write.mode(mode).option("compression", "zstd")
    if static:
        w = w.option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace exactly the partitions present in ``df`` (dynamic overwrite)."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Create-or-append (the fact write of the original design; kept for callers that
    want it, the jobs use :func:`replace_partitions`)."""
    write_parquet(df, path, partition_by, mode="append")


def stage(spark: SparkSession, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to a fresh staging folder in the shared checkpoint directory and
    return the re-read frame. Cuts lineage (a lost executor re-reads files instead of
    recomputing the whole batch) and lets checks and publish read the same bytes."""
    path = scratch_path(spark, f"stage-{name}")
    write_parquet(df, path, partition_by)
    return spark.read.schema(df.schema).option("basePath", path).parquet(path)


#: Partitions named in one predicate (about 12 weeks of hours); a longer list is read by several.
MAX_LITERAL_PARTITIONS = 2000


def in_partitions(table: DataFrame, partitions: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of ``table`` in the listed partitions.

    The list comes to the driver (one short row a partition) and goes back as literals on the partition
    columns, which prunes files at planning time; a join does not prune unless its side is filtered.
    """
    keys = list(partition_by)
    rows = sorted(tuple(r) for r in partitions.select(*keys).distinct().collect())
    chunks = [rows[i : i + MAX_LITERAL_PARTITIONS] for i in range(0, len(rows), MAX_LITERAL_PARTITIONS)] or [[]]
    out = table.where(_one_of(chunks[0], keys))
    for chunk in chunks[1:]:
        out = out.unionAll(table.where(_one_of(chunk, keys)))
    return out


def _one_of(rows: list[tuple], keys: list[str]):
    """Whether the partition columns are one of ``rows``."""
    by: dict[tuple, list] = {}
    for r in rows:
        by.setdefault(r[:-1], []).append(r[-1])
    wanted = F.lit(False)
    for head, last in by.items():
        one = F.col(keys[-1]).isin(*last)
        for key, value in zip(keys, head, strict=False):
            one = one & (F.col(key) == F.lit(value))
        wanted = wanted | one
    return wanted


def list_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """path, length, modificationTime and partition columns of the files under ``path``: a listing, no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "false").load(path)
    return files.drop("content")


def list_partitions(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Distinct partition values that have files under ``path``."""
    return list_files(spark, path).select(*keys).distinct()


def drop_partitions(spark: SparkSession, path: str, partitions: Sequence[tuple], partition_by: Sequence[str]) -> None:
    """Remove the folders of partitions that no row is left in."""
    for values in partitions:
        folder = spark._jvm.org.apache.hadoop.fs.Path("/".join([path, *(f"{k}={v}" for k, v in zip(partition_by, values, strict=True))]))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table folder exists (through the Hadoop file system, so the same
    call works for object stores)."""
    # An unreadable store raises: only a path that the store says is absent is missing.
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(hpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hpath))


def existing_in(table: DataFrame, touched: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of ``table`` in the touched partitions; no other file is read."""
    return in_partitions(table, touched, partition_by)


TARGET_FILE_BYTES = 256 << 20


def compact_if_fragmented(spark: SparkSession, path: str, max_files: int = 64) -> bool:
    """Unite the small files of an append-only table (ledger, dimensions) once it holds more than ``max_files`` of
    them, into files of about 256 MB. The united copy is added first and the small files are removed after it is
    complete: a crash between leaves rows twice, which these tables' readers don't mind, and never loses one.
    Files of half that size or more stay as they are. Returns whether it compacted."""
    small = list_files(spark, path).where(F.col("length") < TARGET_FILE_BYTES // 2).select("path", "length").collect()
    if len(small) <= max_files:
        return False
    paths = [r["path"] for r in small]
    rows = spark.read.schema(spark.read.parquet(path).schema).parquet(*paths)
    n_files = max(1, -(-sum(r["length"] for r in small) // TARGET_FILE_BYTES))
    append(rows.repartition(n_files), path)
    for p in paths:
        hpath = spark._jvm.org.apache.hadoop.fs.Path(p)
        hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, False)
    return True

"""Helpers shared by the training-data operators: staging, batching, bounded filters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.session import configure, scratch_path

#: Rows and bytes of one Arrow batch handed to Python: bounds a worker's memory.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Run-time settings of the library plus bounded Arrow batches."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: the result is cut
    from its lineage and survives lost executors."""
    path = path or scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete the files of staged frames that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        for root in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(root)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null reads as the empty text."""
    return ["" if t is None else t for t in batch.column(column).to_pylist()]


def rows_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    """Pack tuples into record batches of at most ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _pack(held, schema)
            held = []
    if held:
        yield _pack(held, schema)


def _pack(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


#: A membership filter has 2**FILTER_BITS bits (4 MB) whatever the number of keys; more
#: keys let more strangers pass, and an exact join follows every use.
FILTER_BITS = 25


def key_filter(keys: DataFrame, column: str, mixed: bool = False) -> np.ndarray:
    """One-hash Bloom filter over a long column as a packed bit array of fixed size.

    Built on the executors with bitmap aggregates; the driver receives the fixed-size
    bitmap alone, never the keys. ``mixed``: the keys are hashes already, their low bits serve.
    """
    slot = (F.col(column).bitwiseAND(F.lit((1 << FILTER_BITS) - 1)) if mixed else slot_of(column)) + 1
    parts = (
        keys.select(slot.alias("s"))
        .groupBy(F.expr("bitmap_bucket_number(s)").alias("b"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(s))").alias("bits"))
        .collect()
    )
    out = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for p in parts:
        part = np.frombuffer(p["bits"], np.uint8)
        at = (p["b"] - 1) * 4096
        out[at : at + len(part)] = part
    return out


def slot_of(column: str):
    """The filter's slot of a key, computed natively beside the key."""
    return F.pmod(F.xxhash64(column), F.lit(1 << FILTER_BITS))


def in_filter(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of (a, b) edges: rows (node, component = smallest node).

    Large-star / small-star contraction: every round links each node's larger
    neighbours to its smallest one, then each node to its smallest smaller neighbour,
    until nothing changes. Hot nodes are combined map-side (min) and their
    join partitions are split by AQE.
    """
    cur = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), f"{name}-e")
    before = None
    while not cur.isEmpty():
        # large star: each node's larger neighbours go to its smallest one
        both = cur.unionAll(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = stage(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct(), f"{name}-l")
        # small star: its smaller neighbours too
        small = large.join(large.groupBy("a").agg(F.min("b").alias("m")), "a")
        nxt = small.select("a", F.col("m").alias("b")).unionAll(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        nxt = stage(nxt.where("a <> b").distinct(), f"{name}-s")
        after = nxt.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        discard(cur, large)
        cur, before, same = nxt, after, before == after
        if same:
            break
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component"))

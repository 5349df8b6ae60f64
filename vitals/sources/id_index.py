"""Index of event ids, so that an id is published once however far apart its deliveries come.

Each silver batch adds one generation: the ids it delivered, the archive hour (``source``) that brought them, the event
hour (``event_hour``) they lie in, and whether the row was published. A generation is hashed into blocks by pages of
neighbouring ids, one folder a block, and each block has a membership filter: a bitmap of fixed size (``SLOTS`` bits) over its
pages. A batch builds the same bitmaps over its own ids and reads only the blocks whose bitmap shares a bit with its own;
an exact join follows. Archive ids grow with time, so a batch shares pages with few older blocks; ids in no order make
the filters fuller and more blocks be read, never a wrong answer.

Layout under the index's root: ``ids/batch=/block=``, ``filters/batch=``, ``sources/batch=``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.sources import tables as TB

BLOCKS = 16
#: Bits of a block's filter (one bitmap), and ids of a page.
SLOTS, PAGE = 32768, 64

IDS = "id long, source string, event_hour string, published boolean, batch string, block int"
FILTERS = "block int, bits binary, batch string"
SOURCES = "source string, batch string"


def block_of(id_: str | Column, blocks: int = BLOCKS) -> Column:
    return F.pmod(F.xxhash64(_page(id_)), F.lit(blocks)).cast("int")


def slot_of(id_: str | Column) -> Column:
    """The page's bit in its block's filter; another hash than the block's."""
    return F.pmod(F.xxhash64(_page(id_), F.lit(7)), F.lit(SLOTS)) + 1


def _page(id_: str | Column) -> Column:
    c = F.col(id_) if isinstance(id_, str) else id_
    return F.floor(c / PAGE)


def filters_of(ids: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """block, bits of a frame with ``id``."""
    slots = ids.select(block_of("id", blocks).alias("block"), slot_of("id").alias("slot"))
    return slots.groupBy("block").agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))


@dataclass
class IdIndex:
    spark: SparkSession
    root: str
    blocks: int = BLOCKS

    def _path(self, part: str) -> str:
        return f"{self.root}/{part}"

    def _read(self, part: str, schema: str) -> DataFrame:
        path = self._path(part)
        if not TB.exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", path).parquet(path)

    def write(self, deliveries: DataFrame, batch: str) -> None:
        """Store ``deliveries`` (id, source, event_hour, published) as generation ``batch``, in place of an earlier try."""
        rows = deliveries.select("id", "source", "event_hour", "published", block_of("id", self.blocks).alias("block"))
        path = f"{self._path('ids')}/batch={batch}"
        TB.write_parquet(rows.repartition("block"), path, ["block"], static=True)
        stored = self.spark.read.schema(IDS).option("basePath", self._path("ids")).parquet(path)
        TB.write_parquet(filters_of(stored, self.blocks).coalesce(1), f"{self._path('filters')}/batch={batch}", static=True)
        TB.write_parquet(stored.select("source").distinct().coalesce(1), f"{self._path('sources')}/batch={batch}", static=True)

    def blocks_to_read(self, ids: DataFrame, but: str | None = None) -> list[tuple[str, int]]:
        """(batch, block) whose filter shares a bit with the filter of ``ids``. One short row a block comes back."""
        if not TB.exists(self.spark, self._path("filters")):
            return []
        stored = self._read("filters", FILTERS)
        if but is not None:
            stored = stored.where(F.col("batch") != but)
        own = filters_of(ids, self.blocks).select("block", F.col("bits").alias("own"))  # a bitmap a block
        both = stored.join(F.broadcast(own), "block").select("batch", "block", F.explode(F.array("bits", "own")).alias("bits"))
        shared = both.groupBy("batch", "block").agg(F.bitmap_count(F.bitmap_and_agg("bits")).alias("n")).where("n > 0")
        return sorted((r["batch"], r["block"]) for r in shared.collect())

    def lookup(self, ids: DataFrame, but: str | None = None) -> DataFrame:
        """The stored deliveries of ``ids``, without those of generation ``but``; reads only the blocks that may hold them."""
        found = self.blocks_to_read(ids, but)
        if not found:
            return self._blocks(found)
        return self._blocks(found).join(ids.select("id").distinct(), "id", "left_semi")

    def _blocks(self, blocks: list[tuple[str, int]]) -> DataFrame:
        if not blocks:
            return self.spark.createDataFrame([], IDS)
        base = self._path("ids")
        return self.spark.read.schema(IDS).option("basePath", base).parquet(*(f"{base}/batch={batch}/block={block}" for batch, block in blocks))

    def batches_of(self, sources: list[str], but: str | None = None) -> list[str]:
        """Generations that hold deliveries of archive hours."""
        held = self._read("sources", SOURCES).where(F.col("source").isin(sources))
        return sorted(r["batch"] for r in held.select("batch").distinct().collect() if r["batch"] != but)

    def of_sources(self, sources: list[str], but: str | None = None) -> DataFrame:
        """Deliveries of archive hours; reads their generations alone."""
        base, batches = self._path("ids"), self.batches_of(sources, but)
        if not batches:
            return self.spark.createDataFrame([], IDS)
        held = self.spark.read.schema(IDS).option("basePath", base).parquet(*(f"{base}/batch={b}" for b in batches))
        return held.where(F.col("source").isin(sources))

    def forget(self, sources: list[str], but: str | None = None) -> None:
        """Rewrite the generations that hold deliveries of ``sources`` without them."""
        base = self._path("ids")
        for batch in self.batches_of(sources, but):
            held = self.spark.read.schema(IDS).option("basePath", base).parquet(f"{base}/batch={batch}")
            kept = TB.stage(self.spark, held.where(~F.col("source").isin(sources)).drop("batch", "block"), "id-index")
            self.write(kept, batch)

"""Exact distinct ids over any range of days, from bitmaps that are kept per day beside gold.

A bitmap holds the ids of one page of 32,768 neighbouring ids (4 KB before compression), for one day and kind of
id. Ids of events at exactly midnight have a bitmap of their own, since serving windows are closed at the midnight their last
day begins with. A range is counted by uniting the bitmaps of its days page by page; no event is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitals.functions.columns import zero_pad

#: Kinds of ids and the event columns they come from.
KINDS: tuple[tuple[str, str], ...] = (("actor", "actor_id"), ("repo", "repo_id"))
KEYS = ("day", "at_midnight", "kind", "page")


def day_sets(events: DataFrame) -> DataFrame:
    """day, at_midnight, kind, page, bits, year, month of events (created_at, actor_id, repo_id); null ids are left out.

    Ids are made distinct first (combined map-side), so a hot actor or repository is one row a task, and a page gets
    32,768 rows at most; the pages are built where their ids already are.
    """
    day = F.to_date("created_at")
    ids = F.explode(F.array(*(F.struct(F.lit(kind).alias("kind"), F.col(c).cast("long").alias("id")) for kind, c in KINDS))).alias("i")
    rows = events.select(day.alias("day"), (F.col("created_at") == day.cast("timestamp_ntz")).alias("at_midnight"), ids)
    rows = rows.where("i.id is not null").select("day", "at_midnight", "i.kind", "i.id").distinct()
    placed = rows.select("day", "at_midnight", "kind", F.bitmap_bucket_number("id").alias("page"), F.bitmap_bit_position("id").alias("bit"))
    pages = placed.repartition(*KEYS).groupBy(*KEYS).agg(F.bitmap_construct_agg("bit").alias("bits"))
    return pages.select(*KEYS, "bits", F.year("day").cast("string").alias("year"), zero_pad(F.month("day")).alias("month"))


def in_window(start: str, end: str) -> Column:
    """Bitmaps of [start 00:00, end 00:00], closed at both ends."""
    first, last = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
    return F.col("day").between(first, last) & ((F.col("day") < last) | F.col("at_midnight"))


def count_ids(sets: DataFrame, kind: str, name: str) -> DataFrame:
    """One row: the number of distinct ids of a kind in all given bitmaps."""
    united = sets.where(F.col("kind") == kind).groupBy("page").agg(F.bitmap_or_agg("bits").alias("bits"))
    return united.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("long").alias(name))


def rolling(sets: DataFrame, days: int) -> DataFrame:
    """day, actors, repos: distinct ids in the ``days`` days that end with each day that has events."""
    ends = F.explode(F.sequence("day", F.date_add("day", days - 1))).alias("end")
    held = sets.select(F.col("day").alias("end")).distinct()
    united = sets.select(ends, "kind", "page", "bits").groupBy("end", "kind", "page").agg(F.bitmap_or_agg("bits").alias("bits"))
    counts = [F.sum(F.when(F.col("kind") == kind, F.bitmap_count("bits")).otherwise(0)).cast("long").alias(f"{kind}s") for kind, _ in KINDS]
    return united.join(held, "end", "left_semi").groupBy(F.col("end").alias("day")).agg(*counts)

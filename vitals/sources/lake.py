"""Table access: one object hands out the five lakehouse tables as DataFrames.

Four backings share one interface, so every metric query runs unchanged on each:

* :class:`TableLake` reads the written Parquet tables under a root folder with
  explicit schemas (no inference, partition values stay typed as declared).
* :class:`ExtractLake` reads the static extract of ``export.write_extract`` (events by
  ``date``, dimensions cut to their newest version).
* :class:`DerivedLake` derives the same tables lazily from the driver's ``events``
  table through the full raw-JSON → silver → gold path (used by the registered
  queries and the tests, so each answer exercises the whole pipeline).
* :class:`StagedLake` derives them likewise, a step at a time, for jobs that read several.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitals.functions import schemas as S
from vitals.operators import gold as G
from vitals.operators import silver as SV
from vitals.session import configure
from vitals.sources import fixtures
from vitals.sources.id_index import IdIndex
from vitals.sources.tables import exists, list_partitions, stage

DEFAULT_NOW = "2024-02-01 00:00:00"

GOLD_SCHEMA = T.StructType(
    [
        T.StructField("day", T.DateType()),
        T.StructField("repo_id", T.LongType()),
        T.StructField("org_id", T.LongType()),
        *(T.StructField(c, T.LongType()) for c in S.GOLD_COUNT_COLUMNS if c not in ("prs_closed_unmerged",)),
        T.StructField("prs_closed_unmerged", T.LongType()),
        T.StructField("pr_merge_rate", T.DoubleType()),
        T.StructField("issue_close_rate", T.DoubleType()),
        T.StructField("activity_score", T.DoubleType()),
        T.StructField("updated_at", T.TimestampNTZType()),
        T.StructField("year", T.StringType()),
        T.StructField("month", T.StringType()),
    ]
)


class Lake:
    """Interface: silver events, versioned dimensions, gold, and latest dims."""

    spark: SparkSession

    def events(self) -> DataFrame:
        raise NotImplementedError

    def actors(self) -> DataFrame:
        raise NotImplementedError

    def repos(self) -> DataFrame:
        raise NotImplementedError

    def orgs(self) -> DataFrame:
        raise NotImplementedError

    def gold(self) -> DataFrame:
        raise NotImplementedError

    def day_sets(self) -> DataFrame | None:
        """Bitmaps of the ids of each day, where they are kept for all days of gold."""
        return None

    def on_days(self, first: str, last: str) -> Column:
        """Events of the days [first, last], stated on the partition columns (prunes)."""
        ymd = F.concat_ws("-", "year", "month", "day")
        return (ymd >= F.lit(str(first))) & (ymd <= F.lit(str(last)))

    # Latest version per id, cut to the columns the queries join on.
    def latest_actors(self) -> DataFrame:
        return SV.latest_dim(self.actors(), "login", ["id", "login", "is_bot"])

    def latest_repos(self) -> DataFrame:
        return SV.latest_dim(self.repos(), "name", ["id", "name"])

    def latest_orgs(self) -> DataFrame:
        return SV.latest_dim(self.orgs(), "login", ["id", "login"])


class DerivedLake(Lake):
    """Tables derived lazily from the driver's tables in ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str, now: str = DEFAULT_NOW):
        self.spark = configure(spark)
        self.sf_dir = sf_dir.rstrip("/")
        self.now: Column = F.lit(now).cast("timestamp_ntz")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def bronze(self) -> DataFrame:
        """Landed-bronze shape (raw text + file partition columns)."""
        return fixtures.bronze_frame(self.table("events"))

    def parsed(self) -> DataFrame:
        return SV.parse_bronze(self.bronze())

    def events(self) -> DataFrame:
        return SV.build_events(self.parsed())

    def actors(self) -> DataFrame:
        return SV.build_actors(self.parsed(), self.now)

    def repos(self) -> DataFrame:
        return SV.build_repos(self.parsed(), self.now)

    def orgs(self) -> DataFrame:
        return SV.build_orgs(self.parsed(), self.now)

    def gold(self) -> DataFrame:
        return G.daily_activity(self.events(), self.now)


class StagedLake(DerivedLake):
    """As :class:`DerivedLake`, for jobs that read several tables or one table more than once: rows are decoded once, and the
    decoded rows, the fact and gold are staged when they are first asked for."""

    @cached_property
    def _parsed(self) -> DataFrame:
        return stage(self.spark, super().parsed(), "parsed")

    @cached_property
    def _events(self) -> DataFrame:
        return stage(self.spark, super().events(), "events")

    @cached_property
    def _gold(self) -> DataFrame:
        return stage(self.spark, super().gold(), "gold")

    def parsed(self) -> DataFrame:
        return self._parsed

    def events(self) -> DataFrame:
        return self._events

    def gold(self) -> DataFrame:
        return self._gold


class TableLake(Lake):
    """The written tables under ``root``: bronze/github_events, silver/{events,actors,
    repos,orgs}, gold/daily_activity (all Parquet, zstd)."""

    def __init__(self, spark: SparkSession, root: str, bronze_path: str | None = None):
        self.spark = configure(spark)
        self.root = root.rstrip("/")
        self.bronze_path = bronze_path

    @cached_property
    def paths(self) -> dict[str, str]:
        r = self.root
        return {
            "bronze": self.bronze_path or f"{r}/bronze/github_events",
            "events": f"{r}/silver/events",
            "actors": f"{r}/silver/actors",
            "repos": f"{r}/silver/repos",
            "orgs": f"{r}/silver/orgs",
            "gold": f"{r}/gold/daily_activity",
            "day_sets": f"{r}/gold/day_sets",
            "ledger": f"{r}/_ledger/bronze_processed",
            "changed_days": f"{r}/_ledger/changed_days",
            "gold_consumed": f"{r}/_ledger/gold_consumed",
            "ids": f"{r}/_index/event_ids",
            "rejects": f"{r}/_rejects",
        }

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        path = self.paths[name]
        if not exists(self.spark, path):
            raise FileNotFoundError(f"no table {name!r} at {path}")
        return self.spark.read.schema(schema).option("basePath", path).parquet(path)

    def _read_partitioned(self, name: str, schema: T.StructType, partitions: tuple[str, ...]) -> DataFrame:
        """As ``_read``, but raises where the partition columns are absent: the explicit
        schema would fill them with nulls, and every filter on them would drop all rows."""
        df, path = self._read(name, schema), self.paths[name]
        folders, files = children(self.spark, path)
        held = {f.split("=", 1)[0] for f in folders if "=" in f}
        if files:  # not in folders: the columns must be in the files
            held |= {c for c in self.spark.read.parquet(path).columns if c == partitions[0]} or {"no folder"}
        if held - {partitions[0]}:
            raise ValueError(f"table {name!r} at {path} is laid out by {sorted(held)}, not by {list(partitions)}")
        return df

    def bronze(self) -> DataFrame:
        schema = T.StructType(
            list(S.BRONZE_SCHEMA.fields)
            + [T.StructField("source_file", T.StringType()), T.StructField("ingestion_timestamp", T.TimestampType())]
            + [T.StructField(p, T.StringType()) for p in S.BRONZE_PARTITIONS]
        )
        return self._read_partitioned("bronze", schema, S.BRONZE_PARTITIONS)

    def events(self) -> DataFrame:
        return self._read_partitioned("events", S.SILVER_EVENTS_SCHEMA, S.EVENT_PARTITIONS)

    def actors(self) -> DataFrame:
        return self._read("actors", S.ACTORS_SCHEMA)

    def repos(self) -> DataFrame:
        return self._read("repos", S.REPOS_SCHEMA)

    def orgs(self) -> DataFrame:
        return self._read("orgs", S.ORGS_SCHEMA)

    def gold(self) -> DataFrame:
        return self._read("gold", GOLD_SCHEMA)

    def day_sets(self) -> DataFrame | None:
        if not (self.has("day_sets") and self.has("gold")):
            return None
        days, kept = (list_partitions(self.spark, self.paths[t], S.GOLD_PARTITIONS) for t in ("gold", "day_sets"))
        if not days.join(kept, list(S.GOLD_PARTITIONS), "left_anti").isEmpty():
            return None  # days of a lake that was written without them
        return self._read("day_sets", S.DAY_SETS_SCHEMA)

    def has(self, name: str) -> bool:
        return exists(self.spark, self.paths[name])

    def id_index(self) -> IdIndex:
        return IdIndex(self.spark, self.paths["ids"])

    def rejects(self) -> DataFrame:
        """Raw rows that silver batches set aside, with their reasons."""
        path = f"{self.paths['rejects']}/bronze"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], S.REJECTS_SCHEMA)
        return self.spark.read.schema(S.REJECTS_SCHEMA).option("basePath", path).parquet(path)


class ExtractLake(TableLake):
    """The static extract under ``root`` (``export.write_extract``), for serving only: events
    partitioned by ``date``, dimensions with one row per id and the extract's columns."""

    def on_days(self, first: str, last: str) -> Column:
        return F.col("date").between(F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date"))

    def events(self) -> DataFrame:
        kept = [f for f in S.SILVER_EVENTS_SCHEMA.fields if f.name not in S.EVENT_PARTITIONS]
        return self._read_partitioned("events", T.StructType([*kept, T.StructField("date", T.DateType())]), ("date",))

    def _dimension(self, name: str, schema: T.StructType) -> DataFrame:
        cut = T.StructType([schema[c] for c in S.EXTRACT_DIM_COLUMNS[name]])
        # one version per id is left, so the missing time of first sight decides nothing
        return self._read(name, cut).withColumn("first_seen_at", F.lit(None).cast("timestamp_ntz"))

    def actors(self) -> DataFrame:
        return self._dimension("actors", S.ACTORS_SCHEMA)

    def repos(self) -> DataFrame:
        return self._dimension("repos", S.REPOS_SCHEMA)

    def orgs(self) -> DataFrame:
        return self._dimension("orgs", S.ORGS_SCHEMA)


def children(spark: SparkSession, path: str) -> tuple[list[str], bool]:
    """Names of the folders directly under ``path``, and whether Parquet files lie there."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hpath.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hpath)
    names = [(f.getPath().getName(), f.isDirectory()) for f in found]
    return [n for n, folder in names if folder], any(n.endswith(".parquet") for n, folder in names if not folder)

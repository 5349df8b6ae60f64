"""Bronze → silver transforms: type filter, JSON decoding, action extraction,
the event fact and the three versioned dimensions (actors, repos, orgs).

All functions are lazy DataFrame → DataFrame steps built from built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from vitals.functions.columns import detect_bot, extract_action, parse_created_at, partition_columns
from vitals.functions.schemas import ACTOR_STRUCT, EVENT_PARTITIONS, KNOWN_EVENT_TYPES, ORG_STRUCT, REPO_STRUCT

INGESTION_COLUMNS = ("source_file", "ingestion_timestamp")


def filter_known_events(bronze: DataFrame) -> DataFrame:
    """Keep the tracked event types, drop ingestion metadata (pushes down to the scan)."""
    drop = [c for c in INGESTION_COLUMNS if c in bronze.columns]
    return bronze.where(F.col("type").isin(*KNOWN_EVENT_TYPES)).drop(*drop)


def parse_structs(df: DataFrame) -> DataFrame:
    """Decode actor / repo / org JSON text into structs and created_at into a naive
    timestamp. Null text gives a null struct; malformed text gives a struct of nulls
    (PERMISSIVE), for which :func:`parse_checked` gives the row a reason."""
    return (
        df.withColumn("actor_struct", F.from_json("actor", ACTOR_STRUCT))
        .withColumn("repo_struct", F.from_json("repo", REPO_STRUCT))
        .withColumn("org_struct", F.from_json("org", ORG_STRUCT))
        .withColumn("created_at", parse_created_at("created_at"))
        .drop("actor", "repo", "org")
    )


def with_action(df: DataFrame) -> DataFrame:
    """Add ``action`` (payload path, regex fallback, synthesised) and drop the payload."""
    return df.withColumn("action", extract_action("payload", "type")).drop("payload")


def parse_bronze(bronze: DataFrame) -> DataFrame:
    """Filter → parse → action: the shared frame every silver output derives from.

    Not deduplicated: the fact deduplicates its own narrow projection, and the
    dimension aggregates (min / max / any per key) are unaffected by repeated rows,
    so one shuffle of wide rows is saved."""
    return with_action(parse_structs(filter_known_events(bronze)))


#: Reasons for which a row is no event as it stands: a batch fails on them, or sets them aside.
FATAL = ("id malformed", "actor malformed", "repo malformed", "org malformed")
#: Rows without an id, actor or repository are left out of the fact, and set aside.
MISSING = ("id missing", "actor missing", "repo missing")
#: Rows that reach the fact and fail its contract there.
BAD_TIME = ("time missing", "time malformed")

_CORRUPT = "_corrupt"
_RAW = ("id", "type", "actor", "repo", "payload", "public", "created_at", "org")


def parse_checked(bronze: DataFrame) -> DataFrame:
    """As :func:`parse_bronze`, with two more columns from the same pass: ``reasons`` (everything that is wrong with the
    row, empty for a good one) and ``raw`` (the row's texts, for rows with reasons alone, so good rows stay narrow)."""
    rows = filter_known_events(bronze)
    decoded = {
        name: F.from_json(name, StructType([*schema.fields, StructField(_CORRUPT, StringType())]), {"columnNameOfCorruptRecord": _CORRUPT})
        for name, schema in (("actor", ACTOR_STRUCT), ("repo", REPO_STRUCT), ("org", ORG_STRUCT))
    }
    rows = rows.withColumns({f"{name}_struct": struct for name, struct in decoded.items()} | {"_at": parse_created_at("created_at"), "action": extract_action("payload", "type")})
    broken = {name: F.col(f"{name}_struct.{_CORRUPT}").isNotNull() for name in decoded}
    found = [
        F.when(F.col("id").isNull(), "id missing").when(F.col("id").try_cast("long").isNull(), "id malformed"),
        *(F.when(broken[n], f"{n} malformed").when(F.col(f"{n}_struct.id").isNull(), f"{n} missing") for n in ("actor", "repo")),
        F.when(broken["org"], "org malformed"),
        F.when(F.col("created_at").isNull(), "time missing").when(F.col("_at").isNull(), "time malformed"),
    ]
    reasons = F.filter(F.array(*found), lambda x: x.isNotNull())
    raw = F.when(F.size("reasons") > 0, F.struct(*_RAW))
    checked = rows.withColumn("reasons", reasons).withColumn("raw", raw).drop("actor", "repo", "org", "payload", "created_at")
    return checked.withColumnRenamed("_at", "created_at")


def has_reason(*reasons: str) -> Column:
    return F.arrays_overlap("reasons", F.array(*(F.lit(x) for x in reasons)))


def dedup_by_key(df: DataFrame, key: str = "id") -> DataFrame:
    """One row per key. The survivor is the smallest row, so the choice is stable under
    task retries and reruns (identical duplicates make it irrelevant)."""
    others = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min(F.struct(*others)).alias("_row")).select(key, *(F.col(f"_row.{c}").alias(c) for c in others))


#: 0 for rows that are published already, 1 for new ones.
PUBLISHED_FIRST = "_new"


def dedup_clustered(df: DataFrame, cluster: list[str], buckets: DataFrame, n_partitions: int, key: str = "id") -> DataFrame:
    """One row per ``key``, laid out so that a partitioned write makes few files per ``cluster`` value (hour).

    1. Dedup on the key alone, so copies of one event in two hours become one too. Of the copies a
       published one survives (see ``PUBLISHED_FIRST``), then the earliest, then the smallest row: the choice is
       stable under retries, and no published hour is emptied. The minimum is a map-side partial
       aggregate, so even if one event is delivered so often that its copies are a third of all
       rows, each map task forwards a single copy.
    2. Shuffle the deduplicated rows on (cluster, salt) into ``n_partitions``, where
       ``buckets`` gives each hour a salt count sized from its row count: a hot hour
       is spread over many tasks and files, a quiet hour stays one file. ``buckets``
       has one row per hour of the batch, so it is broadcast."""
    columns = [c for c in df.columns if c != PUBLISHED_FIRST]
    order = [c for c in (PUBLISHED_FIRST, "created_at") if c in df.columns]
    order += [c for c in columns if c not in (key, *order)]
    unique = df.groupBy(key).agg(F.min(F.struct(*order)).alias("_row")).select(*(key if c == key else F.col(f"_row.{c}").alias(c) for c in columns))
    return layout(unique, cluster, buckets, n_partitions, key)


def layout(df: DataFrame, cluster: list[str], buckets: DataFrame, n_partitions: int, key: str = "id") -> DataFrame:
    """Step 2 of :func:`dedup_clustered`: the shuffle on (cluster, salt)."""
    n_salt = F.coalesce(F.col("_buckets"), F.lit(1))
    salted = df.join(F.broadcast(buckets.withColumnRenamed("buckets", "_buckets")), cluster, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(F.col(key)), n_salt)
    )
    return salted.repartition(max(1, int(n_partitions)), *cluster, "_salt").select(*df.columns)


def dedup_deliveries(facts: DataFrame, key: str = "id") -> DataFrame:
    """One row per ``key`` with ``source`` (the archive hour of the row that survives: the earliest, then the smallest) and
    ``sources`` (all hours that delivered it: at most the hours of a batch). Combined map-side; the partition strings of
    a fact follow from its time, so they needn't travel."""
    order = ["created_at", *(c for c in facts.columns if c not in (key, "created_at", "source", *EVENT_PARTITIONS)), "source"]
    one = facts.groupBy(key).agg(F.min(F.struct(*order)).alias("_row"), F.collect_set("source").alias("sources"))
    rows = one.select(key, *(F.col(f"_row.{c}").alias(c) for c in order), "sources")
    return rows.select("*", *partition_columns("created_at")).select(*facts.columns, "sources")


def salt_buckets(facts: DataFrame, cluster: list[str], rows_per_file: int) -> tuple[DataFrame, int]:
    """Buckets per cluster value = ceil(rows / rows_per_file), and their total.

    One map-side-combined count per hour; the result has one row per hour of the
    batch (a bounded, small frame), so it comes back to the driver."""
    counts = facts.groupBy(*cluster).agg(F.count(F.lit(1)).alias("n"))
    rows = counts.select(*cluster, F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(int(rows_per_file)))).cast("long").alias("buckets")).collect()
    spark = facts.sparkSession
    schema = ", ".join(f"`{c}` string" for c in cluster) + ", buckets long"
    table = spark.createDataFrame([tuple(r) for r in rows], schema)
    return table, int(sum(r["buckets"] for r in rows))


def events_projection(parsed: DataFrame, *more: str) -> DataFrame:
    """Typed fact columns of the parsed frame (and ``more`` of its columns), before null-drop and dedup."""
    return parsed.select(
        F.col("id").try_cast("long").alias("id"),
        "type",
        "action",
        F.col("actor_struct.id").alias("actor_id"),
        F.col("repo_struct.id").alias("repo_id"),
        F.col("org_struct.id").alias("org_id"),
        "public",
        "created_at",
        *partition_columns("created_at"),
        *more,
    )


def build_events(parsed: DataFrame) -> DataFrame:
    """Event fact: int64 id, flattened ids, partition strings; rows without id, actor
    or repo dropped; one row per id (one shuffle, on id, of narrow rows).

    The rows without actor or repo are left out in the aggregate: a filter would be moved below the JSON decoding and
    decode each row again. The partition strings follow from the time, so they needn't travel."""
    facts = events_projection(parsed).drop(*EVENT_PARTITIONS)
    others = [c for c in facts.columns if c != "id"]
    whole = F.col("actor_id").isNotNull() & F.col("repo_id").isNotNull()
    one = facts.groupBy("id").agg(F.min(F.when(whole, F.struct(*others))).alias("_row")).where("id is not null and _row is not null")
    return one.select("id", *(F.col(f"_row.{c}").alias(c) for c in others)).select("*", *partition_columns("created_at"))


def _dimension(
    parsed: DataFrame,
    struct_col: str,
    track_col: str,
    latest_fields: list[str],
    now: Column,
    bot_flag: bool = False,
) -> DataFrame:
    rows = parsed.select(F.col(f"{struct_col}.*"), "created_at")
    # Latest values of the version: taken from its newest event, ties broken by value.
    newest = F.max(F.struct(F.col("created_at").alias("_ts"), *(F.col(c) for c in latest_fields))).alias("_newest")
    agg = rows.groupBy("id", track_col).agg(newest, F.min("created_at").alias("first_seen_at"), F.count("id").alias("_ids"))
    # rows without an id go after the aggregate (one group a task for each tracked value): a filter on the id
    # would be moved below the JSON decoding and decode each row again
    agg = agg.where("_ids > 0")
    cols = [F.col("id"), F.col(track_col)] + [F.col(f"_newest.{c}").alias(c) for c in latest_fields]
    if bot_flag:
        cols.append(F.coalesce(detect_bot(track_col), F.lit(False)).alias("is_bot"))
    cols += [F.col("first_seen_at"), now.cast("timestamp_ntz").alias("inserted_at")]
    return agg.select(*cols)


def build_actors(parsed: DataFrame, now: Column) -> DataFrame:
    """One row per (id, login) version; is_bot from the login."""
    return _dimension(parsed, "actor_struct", "login", ["display_login", "gravatar_id", "url", "avatar_url"], now, bot_flag=True)


def build_repos(parsed: DataFrame, now: Column) -> DataFrame:
    """One row per (id, name) version."""
    return _dimension(parsed, "repo_struct", "name", ["url"], now)


def build_orgs(parsed: DataFrame, now: Column) -> DataFrame:
    """One row per (id, login) version; events without org are skipped."""
    return _dimension(parsed, "org_struct", "login", ["gravatar_id", "url", "avatar_url"], now)


def filter_new_versions(new: DataFrame, existing: DataFrame | None, id_col: str, track_col: str) -> DataFrame:
    """Rows whose (id, track) version is not in the existing dimension yet.

    Only the two key columns of the target are read. Null keys never match, so they
    pass through (and the contract rejects them)."""
    if existing is None:
        return new
    keys = existing.select(id_col, track_col)
    return new.join(keys, on=[id_col, track_col], how="left_anti")


def latest_dim(dim: DataFrame, track_col: str, columns: list[str] | None = None) -> DataFrame:
    """Newest version per id: greatest first_seen_at, ties by the tracked value.

    Partial aggregation on id keeps a hot id to one row per map task."""
    keep = columns or [c for c in dim.columns if c not in ("id",)]
    rest = [c for c in keep if c not in ("id", track_col, "first_seen_at")]
    newest = F.max(F.struct("first_seen_at", track_col, *rest)).alias("_v")
    out = dim.groupBy("id").agg(newest)
    return out.select("id", *(F.col(f"_v.{c}").alias(c) for c in keep if c != "id"))

"""Batch jobs: bronze → silver (T12) and silver → gold (G10), incremental and
idempotent (write, audit, publish).

Silver batches
    pending hours are those whose files aren't the version that the ledger has last; they are packed into batches by the
    sizes of their files (``max_bytes``). Each batch, under its own number:

    1. reads its hours alone and parses them once (staged: four outputs derive from it; at most a batch);
       rows with something wrong go to ``_rejects/bronze/batch=`` with their reasons;
    2. keeps one row per id, and leaves out ids that another hour has published (``IdIndex``);
    3. of hours that were landed again, takes back what the older version brought (an id that a third hour also
       delivered is read from there again);
    4. merges with the existing rows of the touched hours, staged; dimensions: versions not yet held, staged;
    5. contracts on the staged bytes; any violation → nothing is published (``on_violation="fail"``) or failing rows go
       to a rejects folder (``"quarantine"``);
    6. publishes: touched fact partitions, dimension appends, the log of changed days, the batch's ids, the ledger last.

    Every step replaces what an earlier try of the same batch wrote, so a batch that was cut off is run again, and the
    batches before it are not.

Gold batch
    days that silver changed since the last run (also long before the watermark), and from the watermark day on →
    aggregates over those days' partitions alone → contract → overwrite of the days; a day without
    events any more is removed. A day is replaced, so running it twice gives no duplicates.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from itertools import groupby

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.functions.schemas import EVENT_PARTITIONS, GOLD_PARTITIONS
from vitals.operators import contracts as C
from vitals.operators import distincts as DS
from vitals.operators import gold as G
from vitals.operators import silver as SV
from vitals.plans import incremental as I
from vitals.sources import ledger as LG
from vitals.sources import tables as TB
from vitals.sources.bronze import read_bronze_partitions
from vitals.sources.lake import TableLake

SUCCESS, FAILED, EMPTY = "success", "failed", "empty"

# Target rows per silver file (~100+ MB of narrow fact rows in zstd Parquet).
ROWS_PER_FILE = 2_000_000
# Append-only tables (ledger, dimensions) are rewritten once they exceed this many files.
COMPACT_AFTER_FILES = 64
# Failing rows of a table that a failed batch's report shows.
SAMPLE_ROWS = 5


#: Compressed bytes of bronze files that one silver batch takes at most, unless a single hour has more.
BATCH_BYTES = 32 << 30


@dataclass
class BatchReport:
    status: str
    partitions: int = 0
    rows: dict[str, int] = field(default_factory=dict)
    violations: list[tuple[str, str, str, int]] = field(default_factory=list)
    # The first failing rows of each table of a failed batch.
    samples: dict[str, list[dict]] = field(default_factory=dict)
    # Silver batches that were published.
    batches: int = 0


def _evaluate(name: str, df: DataFrame, contract: C.Contract) -> tuple[list[tuple[str, str, str, int]], int]:
    bad, rows = C.evaluate(df, contract)
    return [(name, rule, col, n) for rule, col, n in bad], rows


def _first_failing(df: DataFrame, contract: C.Contract, key: str = "id") -> list[dict]:
    """The first failing rows by ``key`` (row rules and unique keys), a bounded top-k."""
    bad = C.split_passing(df, contract)[1]
    return [r.asDict() for r in bad.orderBy(key).limit(SAMPLE_ROWS).collect()]


def silver_batch(
    lake: TableLake,
    now: Column | None = None,
    on_violation: str = "fail",
    max_partitions: int | None = None,
    max_bytes: int = BATCH_BYTES,
) -> BatchReport:
    """Process every pending bronze hour into silver (events + 3 dimensions), batch by batch.

    Stops at the first batch that fails; the ones before it are done."""
    spark = lake.spark
    now = now if now is not None else F.current_timestamp()
    if not lake.has("bronze"):
        return BatchReport(EMPTY)
    pending = LG.pending_versions(LG.file_versions(spark, lake.paths["bronze"]), LG.read_ledger(spark, lake.paths["ledger"]))
    if max_partitions is not None:
        pending = pending.limit(max_partitions)
    # One short row per pending hour: bounded by the hours in the backlog.
    hours = LG.pack(pending, max_bytes).orderBy(*LG.KEYS).collect()
    total = BatchReport(EMPTY)
    number = _next_batch(lake)
    for _, group in groupby(hours, key=lambda r: r["pack"]):
        rows, batch = list(group), f"{number + total.batches:08d}"
        chosen = spark.createDataFrame([tuple(r[c] for c in (*LG.KEYS, "version", "bytes")) for r in rows], "year string, month string, day string, hour string, version string, bytes long")
        relanded = ["-".join(r[k] for k in LG.KEYS) for r in rows if r["relanded"]]
        report = silver_from_bronze(lake, read_bronze_partitions(lake.bronze(), chosen), now, on_violation, batch, relanded)
        report.partitions = len(rows)
        if report.status != SUCCESS:
            report.batches = total.batches
            return report
        TB.append(chosen.withColumns({"batch": F.lit(batch), "processed_at": now.cast("timestamp_ntz")}).coalesce(1), lake.paths["ledger"])
        for name, n in report.rows.items():
            total.rows[name] = total.rows.get(name, 0) + n
        total.status, total.partitions, total.batches = SUCCESS, total.partitions + len(rows), total.batches + 1
        total.violations += report.violations
    if total.status == SUCCESS:
        # Append-only tables grow by one small file set per batch: keep them compact.
        for name in ("ledger", "actors", "repos", "orgs"):
            if lake.has(name):
                TB.compact_if_fragmented(spark, lake.paths[name], COMPACT_AFTER_FILES)
    return total


def _next_batch(lake: TableLake) -> int:
    """One more than the last batch in the ledger; a batch that was cut off keeps its number."""
    if not lake.has("ledger"):
        return 0
    last = lake.spark.read.schema(LG.LEDGER).parquet(lake.paths["ledger"]).agg(F.max("batch").alias("b")).first()["b"]
    return 0 if last is None else int(last) + 1


def silver_from_bronze(lake: TableLake, bronze_rows: DataFrame, now: Column, on_violation: str = "fail", batch: str = "one", relanded: list[str] | None = None) -> BatchReport:
    """Bronze rows (a batch or a stream micro-batch) → staged, checked, published silver.

    ``batch`` names what the batch writes beside the tables; ``relanded`` are the archive hours in it whose older
    version was processed before."""
    # staged, not cached: the decoded structs are wide, and each output reads few of their fields
    parsed = TB.stage(lake.spark, SV.parse_checked(bronze_rows).withColumn("source", LG.hour_key()), "parsed")
    cached: list[DataFrame] = []
    try:
        broken = _set_aside(lake, parsed, batch)
        if broken and on_violation == "fail":
            sample = [r.asDict(recursive=True) for r in lake.rejects().where((F.col("batch") == batch) & SV.has_reason(*SV.FATAL)).orderBy("id").limit(SAMPLE_ROWS).collect()]
            return BatchReport(FAILED, violations=broken, samples={"bronze": sample})
        index = lake.id_index()
        unique = SV.dedup_deliveries(_facts(parsed)).persist(StorageLevel.MEMORY_AND_DISK)
        cached.append(unique)
        known, new, retracted, revived = index.lookup(unique, but=batch).where("published"), None, None, None
        if relanded:
            known = known.where(~F.col("source").isin(relanded))
            retracted = index.of_sources(relanded, but=batch).where("published").select("id", "event_hour")
            revived = _revived(lake, retracted.join(unique, "id", "left_anti"), index, relanded, batch)
        # found once; its size is known to the joins that follow
        held = known.select("id").distinct().persist(StorageLevel.MEMORY_AND_DISK)
        cached.append(held)
        held.count()
        new = unique.drop("sources", "source").join(held, "id", "left_anti")
        if revived is not None:
            new = new.unionByName(revived.drop("source"))
        events, changed, merged = _merged(lake, new, retracted)
        if not merged:
            events = events.persist(StorageLevel.MEMORY_AND_DISK)
            cached.append(events)
        staged = {"events": events}
        usable = parsed.where(~SV.has_reason(*SV.FATAL))
        dims = {
            "actors": (SV.build_actors(usable, now), "login"),
            "repos": (SV.build_repos(usable, now), "name"),
            "orgs": (SV.build_orgs(usable, now), "login"),
        }
        for name, (frame, track) in dims.items():
            old = getattr(lake, name)() if lake.has(name) else None
            staged[name] = TB.stage(lake.spark, SV.filter_new_versions(frame, old, "id", track), name)
        report = _check_and_publish(lake, staged, on_violation, batch, changed if merged else None)
        if report.status == SUCCESS:
            report.violations += broken
            day = F.to_date(F.concat_ws("-", "year", "month", "day"))
            LG.log_changed_days(changed.dropna().select(day.alias("day")), lake.paths["changed_days"], batch)
            index.write(_deliveries(lake, unique, held, revived, batch), batch)
            if relanded:
                index.forget(relanded, but=batch)
        return report
    finally:
        for df in cached:
            df.unpersist()


def _deliveries(lake: TableLake, unique: DataFrame, held: DataFrame, revived: DataFrame | None, batch: str) -> DataFrame:
    """The batch's rows of the id index: each id and archive hour, and whether that hour's row is the published one."""
    each = unique.select("id", F.col("source").alias("_from"), F.explode("sources").alias("source"), LG.hour_key().alias("event_hour"))
    each = each.join(held.withColumn("_held", F.lit(True)), "id", "left")
    rows = each.select("id", "source", "event_hour", (F.col("_held").isNull() & (F.col("source") == F.col("_from"))).alias("published"))
    if revived is not None:
        rows = rows.unionByName(revived.select("id", "source", LG.hour_key().alias("event_hour"), F.lit(True).alias("published")))
    failed = f"{lake.paths['rejects']}/events/batch={batch}"
    if TB.exists(lake.spark, failed):  # rows that failed the contract weren't published
        rows = rows.join(lake.spark.read.parquet(failed).select("id"), "id", "left_anti")
    return rows.where("event_hour <> ''")


def _facts(parsed: DataFrame) -> DataFrame:
    """The fact columns and ``source`` of rows that can be events; a bad time is left for the contract."""
    return SV.events_projection(parsed.where(~SV.has_reason(*SV.FATAL, *SV.MISSING)), "source")


def _set_aside(lake: TableLake, parsed: DataFrame, batch: str) -> list[tuple[str, str, str, int]]:
    """Write the rows that have reasons, in place of an earlier try; the fatal ones as violations."""
    path = f"{lake.paths['rejects']}/bronze/batch={batch}"
    rows = parsed.where(F.size("reasons") > 0).select("raw.*", "source", "reasons")
    TB.write_parquet(rows.hint("rebalance"), path, static=True)
    counts = lake.rejects().where(F.col("batch") == batch).select(F.explode("reasons").alias("reason")).groupBy("reason").count()
    found = {r["reason"]: r["count"] for r in counts.collect()}
    return [("bronze", reason.replace(" ", "_"), reason.split()[0], found[reason]) for reason in SV.FATAL if reason in found]


def _hours_of(key: str) -> list[Column]:
    """Partition columns of an hour key."""
    return [F.split(key, "-")[i].alias(k) for i, k in enumerate(LG.KEYS)]


def _revived(lake: TableLake, lost: DataFrame, index, relanded: list[str], batch: str) -> DataFrame | None:
    """Rows of ids that the relanded hours no longer bring, but another hour also delivered: read from that hour again."""
    others = index.lookup(lost, but=batch).where(~F.col("source").isin(relanded))
    one = others.groupBy("id").agg(F.min("source").alias("source"))
    hours = one.select(*_hours_of("source")).distinct()
    if hours.isEmpty():
        return None
    again = SV.parse_checked(read_bronze_partitions(lake.bronze(), hours)).withColumn("source", LG.hour_key())
    return SV.dedup_deliveries(_facts(again).join(one, ["id", "source"], "left_semi")).drop("sources")


def _merged(lake: TableLake, new: DataFrame, retracted: DataFrame | None) -> tuple[DataFrame, DataFrame, bool]:
    """(the rows of all hours that change, these hours, whether published hours are among them)."""
    keys = list(EVENT_PARTITIONS)
    buckets, n_buckets = SV.salt_buckets(new, keys, ROWS_PER_FILE)
    changed = buckets.select(*keys)
    if retracted is not None:
        changed = changed.unionAll(retracted.select(*_hours_of("event_hour"))).distinct()
    width = _parallelism(lake.spark)
    if not (lake.has("events") and _touches_existing(lake, changed)):
        # Only new hours: the plan never reads the target, so check and publish the
        # same persisted frame (a lost block is recomputed, still one row per id).
        return SV.layout(new, keys, buckets, max(1, min(n_buckets, 4 * width))), changed, False
    # Rows for hours already in silver: merge with those partitions only, stage (the plan reads the table it will
    # overwrite), then publish.
    existing = TB.existing_in(lake.events(), changed.dropna(), EVENT_PARTITIONS)
    if retracted is not None:
        existing = existing.join(retracted.select("id").distinct(), "id", "left_anti")
    both = existing.withColumn(SV.PUBLISHED_FIRST, F.lit(0)).unionByName(new.withColumn(SV.PUBLISHED_FIRST, F.lit(1)))
    # the layout follows all rows of an hour, not the late ones alone
    buckets, n_buckets = SV.salt_buckets(both, keys, ROWS_PER_FILE)
    merged = SV.dedup_clustered(both, keys, buckets, max(1, min(n_buckets, 4 * width)))
    return TB.stage(lake.spark, merged, "events", EVENT_PARTITIONS), changed, True


def _parallelism(spark: SparkSession) -> int:
    """Shuffle width of the session (at least the cluster's default parallelism)."""
    width = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    try:
        return max(width, spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - sessions without a local SparkContext
        return width


def _touches_existing(lake: TableLake, hours: DataFrame) -> bool:
    """Whether any of the hours already has silver rows (from the folder listing)."""
    keys = list(EVENT_PARTITIONS)
    return not hours.join(TB.list_partitions(lake.spark, lake.paths["events"], keys), keys, "left_semi").isEmpty()


def _check_and_publish(lake: TableLake, staged: dict[str, DataFrame], on_violation: str, batch: str, changed: DataFrame | None) -> BatchReport:
    """``changed``: the hours that ``staged["events"]`` replaces, if published ones are among them."""
    contracts = {"events": C.EVENTS, "actors": C.ACTORS, "repos": C.REPOS, "orgs": C.ORGS}
    found, rows = [], {}
    for name, df in staged.items():
        bad, rows[name] = _evaluate(name, df, contracts[name])
        found += bad
    if found and on_violation == "fail":
        failing = {name for name, *_ in found}
        return BatchReport(FAILED, violations=found, samples={n: _first_failing(staged[n], contracts[n]) for n in staged if n in failing})
    if found:  # quarantine: failing rows aside, the rest goes on
        for name, df in staged.items():
            good, bad = C.split_passing(df, contracts[name])
            TB.write_parquet(bad, f"{lake.paths['rejects']}/{name}/batch={batch}", static=True)
            staged[name] = good
        rows = {name: df.count() for name, df in staged.items()}
    TB.replace_partitions(staged["events"], lake.paths["events"], EVENT_PARTITIONS)
    if changed is not None:
        left = {tuple(r) for r in staged["events"].select(*EVENT_PARTITIONS).distinct().collect()}
        TB.drop_partitions(lake.spark, lake.paths["events"], [tuple(r) for r in changed.dropna().collect() if tuple(r) not in left], EVENT_PARTITIONS)
    for name in ("actors", "repos", "orgs"):
        TB.append(staged[name], lake.paths[name])
    return BatchReport(SUCCESS, rows=rows, violations=found)


def gold_batch(lake: TableLake, now: Column | None = None, days: tuple[str, str] | None = None, days_per_batch: int | None = None) -> BatchReport:
    """Recompute gold for the days that silver changed and from the watermark day on (or for an explicit ``days``
    range), ``days_per_batch`` at a time."""
    spark = lake.spark
    now = now if now is not None else F.current_timestamp()
    if not lake.has("events"):
        return BatchReport(EMPTY)
    entries: list = []
    if days is not None:
        first, last = (dt.date.fromisoformat(d) for d in days)
        wanted = {first + dt.timedelta(i) for i in range((last - first).days + 1)}
    else:
        # one short row for each day that a batch changed
        entries = LG.changed_days(spark, lake.paths["changed_days"], lake.paths["gold_consumed"]).collect()
        wm = dt.date.fromisoformat(I.watermark_value(I.gold_watermark(spark, lake.gold() if lake.has("gold") else None)))
        held = {dt.date(*map(int, r)) for r in TB.list_partitions(spark, lake.paths["events"], ["year", "month", "day"]).collect()}
        wanted = {r["day"] for r in entries} | {d for d in held if d >= wm}
    order = sorted(wanted)
    if not order:
        return BatchReport(EMPTY)
    step, total = days_per_batch or len(order), BatchReport(SUCCESS, rows={"gold": 0})
    for i in range(0, len(order), step):
        report = _gold_days(lake, order[i : i + step], now)
        if report.status != SUCCESS:
            return report
        total.rows["gold"] += report.rows["gold"]
        total.batches += 1
    LG.consume([r["batch"] for r in entries], spark, lake.paths["gold_consumed"])
    return total


def _gold_days(lake: TableLake, days: list, now: Column) -> BatchReport:
    """Replace the gold rows of ``days``; days without events lose theirs."""
    spark = lake.spark
    parts = spark.createDataFrame([(f"{d:%Y}", f"{d:%m}", f"{d:%d}") for d in days], "year string, month string, day string")
    events = TB.in_partitions(lake.events(), parts, ("year", "month", "day"))
    daily = G.daily_activity(events.select("type", "action", "actor_id", "repo_id", "org_id", "created_at"), now)
    # The plan reads silver only, so no staging copy is needed. Gold is small next to
    # events: one rebalancing shuffle by day gives about one file per day, and AQE
    # splits a day that is far larger than the others instead of giving it one task.
    daily = daily.hint("rebalance", "day").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found, n = _evaluate("gold", daily, C.GOLD)
        if found:
            return BatchReport(FAILED, violations=found, samples={"gold": _first_failing(daily, C.GOLD, "repo_id")})
        # the bitmaps go first: a run that stops in between does both again
        TB.replace_partitions(DS.day_sets(events).hint("rebalance", "day"), lake.paths["day_sets"], GOLD_PARTITIONS)
        TB.replace_partitions(daily, lake.paths["gold"], GOLD_PARTITIONS)
        left = {r["day"] for r in daily.select("day").distinct().collect()}
        emptied = [(f"{d:%Y}", f"{d:%m}", d.isoformat()) for d in days if d not in left]
        for table in ("gold", "day_sets"):
            TB.drop_partitions(spark, lake.paths[table], emptied, GOLD_PARTITIONS)
        return BatchReport(SUCCESS, rows={"gold": n})
    finally:
        daily.unpersist()


def run_all(spark: SparkSession, root: str, now: Column | None = None) -> dict[str, BatchReport]:
    lake = TableLake(spark, root)
    return {"silver": silver_batch(lake, now), "gold": gold_batch(lake, now)}

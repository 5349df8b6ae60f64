"""Data contracts: declarative rules checked in one pass before every write.

``check(df, contract)`` evaluates all row rules of a contract in a single aggregate
(one ``count_if`` per rule, combined map-side) and uniqueness with one group-by on the
key, and returns ``(rule, column, n_bad)`` for every rule. A write goes ahead only
when every ``n_bad`` is 0; ``violations(...)`` returns a bounded sample of failing
rows for the log / rejects table.

Rules follow the usual dataframe-contract semantics: value checks ignore nulls and
nullability is its own rule; a column of the wrong type (or a missing column) fails
its dtype rule for every row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitals.functions import schemas as S


@dataclass(frozen=True)
class Col:
    name: str
    dtype: type[T.DataType]
    nullable: bool = False
    ge: float | None = None
    le: float | None = None
    isin: tuple[str, ...] | None = None
    regex: str | None = None
    unique: bool = False


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[Col, ...] = field(default_factory=tuple)


def _rules(c: Col) -> list[tuple[str, str, object]]:
    """(rule, kind, arg) for one column, in a fixed order."""
    out: list[tuple[str, str, object]] = [(f"{c.name}_dtype", "dtype", c.dtype)]
    if not c.nullable:
        out.append((f"{c.name}_not_null", "not_null", None))
    if c.ge is not None:
        out.append((f"{c.name}_ge", "ge", c.ge))
    if c.le is not None:
        out.append((f"{c.name}_le", "le", c.le))
    if c.isin is not None:
        out.append((f"{c.name}_isin", "isin", c.isin))
    if c.regex is not None:
        out.append((f"{c.name}_regex", "regex", c.regex))
    return out


def _ok(df: DataFrame, c: Col, kind: str, arg) -> Column:
    """Expression that is true when the row passes (never null)."""
    if c.name not in df.columns:
        return F.lit(False)
    dtype_ok = isinstance(df.schema[c.name].dataType, c.dtype)
    if kind == "dtype":
        return F.lit(dtype_ok)
    v = F.col(c.name)
    if kind == "not_null":
        return v.isNotNull()
    if not dtype_ok:
        return F.lit(False)
    if kind == "ge":
        return v.isNull() | (v >= F.lit(arg))
    if kind == "le":
        return v.isNull() | (v <= F.lit(arg))
    if kind == "isin":
        return v.isNull() | v.isin(*arg)
    if kind == "regex":
        return v.isNull() | v.rlike(arg)
    raise ValueError(kind)


def rule_table(df: DataFrame, contract: Contract) -> list[tuple[str, str, Column]]:
    return [(rule, c.name, _ok(df, c, kind, arg)) for c in contract.columns for rule, kind, arg in _rules(c)]


def check(df: DataFrame, contract: Contract) -> DataFrame:
    """(rule, column, n_bad) for every rule of ``contract`` over ``df``."""
    rules = rule_table(df, contract)
    counts = df.agg(*(F.count_if(~ok).cast("long").alias(rule) for rule, _, ok in rules))
    stack = ", ".join(f"'{rule}', '{col}', `{rule}`" for rule, col, _ in rules)
    out = counts.selectExpr(f"stack({len(rules)}, {stack}) AS (rule, column, n_bad)")
    for c in contract.columns:
        if c.unique and c.name in df.columns:
            # Rows whose key value occurs more than once (nulls are not keys).
            dup = (
                df.where(F.col(c.name).isNotNull())
                .groupBy(c.name)
                .agg(F.count(F.lit(1)).alias("n"))
                .agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("long").alias("n_bad"))
                .select(F.lit(f"{c.name}_unique").alias("rule"), F.lit(c.name).alias("column"), "n_bad")
            )
            out = out.unionByName(dup)
    return out


def evaluate(df: DataFrame, contract: Contract) -> tuple[list[tuple[str, str, int]], int]:
    """Failing rules as (rule, column, n_bad) plus the row count, from one aggregate
    pass (and one group-by per unique key). The one-row result is all that reaches
    the driver."""
    rules = rule_table(df, contract)
    aggs = [F.count_if(~ok).cast("long").alias(f"r{i}") for i, (_, _, ok) in enumerate(rules)]
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *aggs).first()
    bad = [(rule, col, int(row[f"r{i}"])) for i, (rule, col, _) in enumerate(rules) if row[f"r{i}"]]
    for c in contract.columns:
        if c.unique and c.name in df.columns:
            dup = (
                df.where(F.col(c.name).isNotNull())
                .groupBy(c.name)
                .agg(F.count(F.lit(1)).alias("n"))
                .agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("d"))
                .first()["d"]
            )
            if dup:
                bad.append((f"{c.name}_unique", c.name, int(dup)))
    return bad, int(row["_rows"])


def split_passing(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(passing rows, failing rows) for quarantine: a row fails when any row rule fails
    or its unique key occurs more than once (all copies are set aside). The duplicate
    keys are found with one group-by and removed with an anti join."""
    ok = F.lit(True)
    for _, _, expr in rule_table(df, contract):
        ok = ok & expr
    good, bad = df.where(ok), df.where(~ok)
    for c in contract.columns:
        if c.unique and c.name in df.columns:
            dup_keys = df.groupBy(c.name).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(c.name)
            bad = bad.unionByName(good.join(dup_keys, c.name, "left_semi"))
            good = good.join(dup_keys, c.name, "left_anti")
    return good, bad


def failed(report: DataFrame) -> DataFrame:
    return report.where(F.col("n_bad") > 0)


def violations(df: DataFrame, contract: Contract, key: str, n: int = 20) -> DataFrame:
    """The first ``n`` failing rows by ``key`` with the number of row rules each fails
    (a bounded sample: top-k on the key, never a full collect)."""
    rules = rule_table(df, contract)
    n_failed = sum((F.when(~ok, 1).otherwise(0) for _, _, ok in rules), F.lit(0))
    return df.withColumn("n_failed", n_failed.cast("long")).where(F.col("n_failed") > 0).orderBy(key).limit(n)


# ---------------------------------------------------------------------------
# Contracts of the five tables (FIXED VALUES: the rules themselves)
# ---------------------------------------------------------------------------

_STR, _LONG, _BOOL = T.StringType, T.LongType, T.BooleanType
_TS = (T.TimestampType, T.TimestampNTZType)

BRONZE = Contract(
    "bronze",
    (
        Col("id", _STR),
        Col("type", _STR),
        Col("created_at", _STR),
    ),
)

EVENTS = Contract(
    "events",
    (
        Col("id", _LONG, ge=0, unique=True),
        Col("type", _STR, isin=S.KNOWN_EVENT_TYPES),
        Col("action", _STR, isin=S.KNOWN_ACTIONS),
        Col("actor_id", _LONG, ge=0),
        Col("repo_id", _LONG, ge=0),
        Col("org_id", _LONG, nullable=True, ge=0),
        Col("public", _BOOL),
        Col("created_at", _TS),
        Col("year", _STR, regex=S.YEAR_REGEX),
        Col("month", _STR, regex=S.MONTH_REGEX),
        Col("day", _STR, regex=S.DAY_REGEX),
        Col("hour", _STR, regex=S.HOUR_REGEX),
    ),
)

ACTORS = Contract(
    "actors",
    (
        Col("id", _LONG, ge=0),
        Col("login", _STR),
        Col("display_login", _STR, nullable=True),
        Col("gravatar_id", _STR, nullable=True),
        Col("url", _STR),
        Col("avatar_url", _STR, nullable=True),
        Col("is_bot", _BOOL),
        Col("first_seen_at", _TS),
        Col("inserted_at", _TS),
    ),
)

REPOS = Contract(
    "repos",
    (
        Col("id", _LONG, ge=0),
        Col("name", _STR),
        Col("url", _STR),
        Col("first_seen_at", _TS),
        Col("inserted_at", _TS),
    ),
)

ORGS = Contract(
    "orgs",
    (
        Col("id", _LONG, ge=0),
        Col("login", _STR),
        Col("gravatar_id", _STR, nullable=True),
        Col("url", _STR),
        Col("avatar_url", _STR, nullable=True),
        Col("first_seen_at", _TS),
        Col("inserted_at", _TS),
    ),
)

_GOLD_COUNTS = (
    "total_events",
    "unique_actors",
    "push_events",
    "pr_events",
    "issue_events",
    "watch_events",
    "fork_events",
    "release_events",
    "comment_events",
    "review_events",
    "prs_opened",
    "prs_merged",
    "prs_closed_unmerged",
    "issues_opened",
    "issues_closed",
)

GOLD = Contract(
    "gold",
    (
        Col("day", T.DateType),
        Col("repo_id", _LONG, ge=0),
        Col("org_id", _LONG, nullable=True, ge=0),
        *(Col(c, _LONG, ge=0) for c in _GOLD_COUNTS),
        Col("pr_merge_rate", T.DoubleType, nullable=True, ge=0.0, le=1.0),
        Col("issue_close_rate", T.DoubleType, nullable=True, ge=0.0, le=1.0),
        Col("activity_score", T.DoubleType, ge=0.0, le=100.0),
        Col("updated_at", _TS),
        Col("year", _STR, regex=S.YEAR_REGEX),
        Col("month", _STR, regex=S.MONTH_REGEX),
    ),
)

ALL = {c.name: c for c in (BRONZE, EVENTS, ACTORS, REPOS, ORGS, GOLD)}


def sql_ok(c: Col, kind: str, arg) -> str:
    """The same rule as SQL text (used by the oracle)."""
    q = f'"{c.name}"'
    if kind == "dtype":
        return "TRUE"
    if kind == "not_null":
        return f"{q} IS NOT NULL"
    if kind == "ge":
        return f"({q} IS NULL OR {q} >= {arg})"
    if kind == "le":
        return f"({q} IS NULL OR {q} <= {arg})"
    if kind == "isin":
        vals = ", ".join(f"'{v}'" for v in arg)
        return f"({q} IS NULL OR {q} IN ({vals}))"
    if kind == "regex":
        return f"({q} IS NULL OR regexp_matches({q}, '{arg}'))"
    raise ValueError(kind)


def sql_check(table: str, contract: Contract) -> str:
    parts = []
    for c in contract.columns:
        for rule, kind, arg in _rules(c):
            parts.append(
                f"SELECT '{rule}' AS rule, '{c.name}' AS \"column\", "
                f"CAST(COUNT(*) FILTER (WHERE NOT ({sql_ok(c, kind, arg)})) AS BIGINT) AS n_bad FROM {table}"
            )
        if c.unique:
            parts.append(
                f"SELECT '{c.name}_unique' AS rule, '{c.name}' AS \"column\", CAST(COALESCE(SUM(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS n_bad "
                f"FROM (SELECT COUNT(*) AS n FROM {table} WHERE \"{c.name}\" IS NOT NULL GROUP BY \"{c.name}\")"
            )
    return "\nUNION ALL ".join(parts)

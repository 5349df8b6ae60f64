"""Column expressions shared by the transforms (all built-in, JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitals.functions.schemas import (
    ACTION_REGEX,
    BOT_REGEX,
    CREATED_AT_FORMAT,
    SCORE_CAP,
    SCORE_WEIGHTS,
    SYNTHETIC_ACTIONS,
)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_created_at(c: str | Column) -> Column:
    """Raw ``2024-01-05T10:11:12Z`` text to a naive (UTC by convention) timestamp.

    Text of another form, or no such time, gives null, which the contracts then reject."""
    return F.when(col(c).rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"), col(c).try_cast("timestamp_ntz"))


def format_created_at(c: str | Column) -> Column:
    """Inverse of :func:`parse_created_at` (drops sub-second precision)."""
    return F.date_format(col(c), CREATED_AT_FORMAT)


def extract_action(payload: str | Column, event_type: str | Column) -> Column:
    """Action of an event: ``$.action`` of the payload, else the first ``"action": "x"``
    anywhere in the text (nested keys and broken JSON included), else synthesised from
    the type, else null."""
    from_path = F.get_json_object(col(payload), "$.action")
    # regexp_extract gives '' when there is no match; map that to null.
    from_text = F.nullif(F.regexp_extract(col(payload), ACTION_REGEX, 1), F.lit(""))
    synthesised = None
    for etype, action in SYNTHETIC_ACTIONS:
        cond = col(event_type) == F.lit(etype)
        synthesised = F.when(cond, F.lit(action)) if synthesised is None else synthesised.when(cond, F.lit(action))
    return F.coalesce(from_path, from_text, synthesised)


def detect_bot(login: str | Column) -> Column:
    """Case-sensitive bot flag: login contains ``[bot]`` or ends in ``bot``."""
    return col(login).rlike(BOT_REGEX)


def zero_pad(c: Column, width: int = 2) -> Column:
    return F.lpad(c.cast("string"), width, "0")


def partition_columns(ts: str | Column) -> list[Column]:
    """year / zero-padded month / day / hour strings of a timestamp."""
    t = col(ts)
    return [
        F.year(t).cast("string").alias("year"),
        zero_pad(F.month(t)).alias("month"),
        zero_pad(F.dayofmonth(t)).alias("day"),
        zero_pad(F.hour(t)).alias("hour"),
    ]


def count_where(cond: Column) -> Column:
    """Number of rows where ``cond`` is true (null counts as false); never null."""
    return F.count_if(F.coalesce(cond, F.lit(False))).cast("long")


def activity_score(push: Column, pr: Column, issue: Column, watch: Column) -> Column:
    weights = dict(SCORE_WEIGHTS)
    raw = (
        push * weights["PushEvent"]
        + pr * weights["PullRequestEvent"]
        + issue * weights["IssuesEvent"]
        + watch * weights["WatchEvent"]
    )
    return F.least(raw.cast("double"), F.lit(SCORE_CAP))


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den as double, null when den is not positive (no ANSI divide-by-zero)."""
    return F.when(den > 0, num.cast("double") / den.cast("double"))


def round_even(c: str | Column, digits: int) -> Column:
    """Round half to even on the binary double (same IEEE steps as the SQL oracle:
    scale, round to nearest-even integer, rescale)."""
    scale = float(10**digits)
    return F.rint(col(c).cast("double") * F.lit(scale)) / F.lit(scale)


def stable(c: str | Column) -> Column:
    """6-place rounding for unrounded float outputs (means of rates), so that
    summation order cannot change the compared value."""
    return round_even(c, 6)


def one_row(*frames):
    """Side-by-side combination of one-row aggregates without a join: the frames are
    unioned (missing columns null) and collapsed by one global aggregate. Each column
    is non-null in at most one input row, so ``first(ignorenulls)`` picks it."""
    from functools import reduce

    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    cols = [c for f in frames for c in f.columns]
    return merged.agg(*(F.first(c, ignorenulls=True).alias(c) for c in cols))

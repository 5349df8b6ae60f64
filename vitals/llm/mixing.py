"""Operator 2: mixing sources to target weights by entropy balancing.

Every document starts at rate 1. The rates that meet the sources' token targets and stay closest to 1
(in relative entropy, with a ceiling of ``MAX_COPIES``) have the form min(ceiling, exp(lambda * size / mean size)).
The lambdas solve the convex dual of the token constraints, found by safeguarded Newton steps whose
gradients and curvatures Spark sums over the (source, size) histogram of all documents. Rates are then rounded
into whole copies so that each source's words track its target.

Cases: null text has size 0 and is taken 0 times; null source is a source of its own, last in order;
rows with the same doc_id count as rows of their own; an empty table gives no rows; other columns
are ignored. Ties (same source and size) are ordered by a hash of the doc_id, so reruns agree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vitals.llm.common import discard, prepare, stage

#: Weights by position of the source, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
MAX_COPIES = 3
#: Newton stops when every source is this near its target (relative), or after STEPS steps.
TOLERANCE, STEPS = 1e-6, 60
#: Rows of one (source, size) cell that one task ranks; larger cells are split.
CELL_ROWS = 20_000

WORD = r"[^\x20\x09-\x0D]+"


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source and number of words of every document."""
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def targets(hist: DataFrame, weights=WEIGHTS, ceiling: int = MAX_COPIES) -> DataFrame:
    """source, source_size, target: weights share all sizes, no target above ``ceiling`` times its size.

    The shares are multiplier * weight below the ceiling. Sources in order of ceiling / weight fill up
    first; the multiplier is read off the prefix sums. One row per source goes through one window.
    """
    by = hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    cap = (F.col("source_size") * ceiling).cast("double")
    fill = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    out = by.withColumn("weight", weight).withColumn("cap", cap)
    out = out.withColumn("rest", F.sum("source_size").over(W.partitionBy()).cast("double") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    out = out.withColumn("free", F.sum("weight").over(W.partitionBy()) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    # the multiplier if exactly the sources before this one are full; it rises up to the first
    # source that is not full and falls after it, so the largest one is right
    m = F.max(F.col("rest") / F.col("free")).over(W.partitionBy())
    target = F.least("cap", F.greatest(m, F.lit(0.0)) * F.col("weight"))
    return out.select("source", "source_size", target.alias("target"))


def tilt(hist: DataFrame, goal: DataFrame, ceiling: int = MAX_COPIES) -> DataFrame:
    """source, lam, mean: Newton's solution of the dual, one small job a step.

    The histogram has a row per (source, size), which is bounded by the sizes that exist, and is
    combined map-side, so a hot source costs no more than another.
    """
    mean = hist.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.greatest(F.sum("n"), F.lit(1))).alias("mean"))
    full = F.col("target") >= F.col("source_size") * ceiling * (1 - 1e-12)
    state = goal.join(mean, goal["source"].eqNullSafe(mean["source"])).select(
        goal["source"], "source_size", "target", "mean", F.lit(0.0).alias("lam"), F.lit(-1e6).alias("lo"), F.lit(1e6).alias("hi"), (full | (F.col("target") <= 0)).alias("done")
    )
    state = stage(state, "mix-state")
    for _ in range(STEPS):
        s = state.withColumnRenamed("source", "src")
        x = F.col("size") / F.col("mean")
        raw = F.exp(F.least(F.col("lam") * x, F.lit(50.0)))
        tokens = F.col("size") * F.col("n")
        sums = (
            hist.join(s.where("not done"), hist["source"].eqNullSafe(F.col("src")))
            .groupBy(hist["source"])
            .agg(F.sum(tokens * F.least(raw, F.lit(float(ceiling)))).alias("got"), F.sum(F.when(raw < ceiling, tokens * x * raw).otherwise(0.0)).alias("slope"))
            .withColumnRenamed("source", "g")
        )
        gap = F.col("got") - F.col("target")
        hit = F.abs(gap) <= F.lit(TOLERANCE) * F.col("target")
        lo = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))
        step = F.col("lam") - gap / F.col("slope")
        middle = F.when((lo > -1e6) & (hi < 1e6), (lo + hi) / 2).when(gap < 0, F.greatest(F.col("lam") * 2, F.lit(1.0))).otherwise(F.least(F.col("lam") * 2, F.lit(-1.0)))
        new = F.when((F.col("slope") > 0) & (step > lo) & (step < hi) & (F.abs(step - F.col("lam")) < 20), step).otherwise(middle)
        active = F.col("got").isNotNull() & ~F.col("done")
        nxt = state.join(sums, state["source"].eqNullSafe(sums["g"]), "left").select(
            state["source"], "source_size", "target", "mean",
            F.when(active & ~hit, new).otherwise(F.col("lam")).alias("lam"),
            F.when(active, lo).otherwise(F.col("lo")).alias("lo"),
            F.when(active, hi).otherwise(F.col("hi")).alias("hi"),
            (F.col("done") | hit | F.col("got").isNull() | ((hi - lo) <= 1e-13)).alias("done"),
        )
        nxt = stage(nxt, "mix-state")
        discard(state)
        state = nxt
        if not state.where("not done").limit(1).count():
            break
    return state.select("source", "source_size", "target", "mean", "lam")


def _round(ceiling: int):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        """Copies of each size of one source, largest first, so that the words taken track the
        words expected; what is over is carried to the next smaller size. The group has one row
        per distinct size."""
        pdf = pdf.sort_values("size", ascending=False)
        size, n, rate = pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64), pdf["rate"].to_numpy(float)
        copies, carry = np.zeros(len(pdf), np.int64), 0.0
        for i in range(len(pdf)):
            if not size[i]:
                continue
            carry += n[i] * rate[i] * size[i]
            copies[i] = min(max(round(carry / size[i]), 0), ceiling * n[i])
            carry -= float(copies[i] * size[i])
        return pd.DataFrame({"source": pdf["source"], "size": size, "n": n, "copies": copies})

    return run


def mix(docs: DataFrame, weights=WEIGHTS, ceiling: int = MAX_COPIES) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies for every document."""
    prepare(docs.sparkSession)
    base = stage(sizes(docs), "mix-sizes")
    hist = stage(base.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-hist")
    solved = tilt(hist, targets(hist, weights, ceiling), ceiling)
    s = solved.withColumnRenamed("source", "src")
    rate = F.when(F.col("target") <= 0, 0.0).when(
        F.col("target") >= F.col("source_size") * ceiling * (1 - 1e-12), float(ceiling)
    ).otherwise(F.least(F.lit(float(ceiling)), F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(50.0)))))
    rated = hist.join(s, hist["source"].eqNullSafe(s["src"])).select(hist["source"], "size", "n", rate.alias("rate"), "source_size", "target")
    counted = rated.groupBy("source").applyInPandas(_round(ceiling), "source string, size long, n long, copies long")
    cells = stage(
        rated.join(counted.withColumnsRenamed({"source": "s2", "size": "z2", "n": "n2"}), F.col("source").eqNullSafe(F.col("s2")) & (F.col("size") == F.col("z2"))).select(
            "source", "size", "n", "rate", "source_size", "target", "copies", F.ceil(F.col("n") / CELL_ROWS).cast("int").alias("parts")
        ),
        "mix-cells",
    )
    c = cells.withColumnsRenamed({"source": "c_source", "size": "c_size"})
    part = F.pmod(F.xxhash64("doc_id"), F.col("parts"))
    joined = base.join(c, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("size") == F.col("c_size"))).withColumn("part", part)
    # rank within a cell = rows of its earlier parts + rank within the part
    sub = joined.groupBy("c_source", "c_size", "part").agg(F.count("*").alias("m"))
    sub = sub.withColumn("before", F.sum("m").over(W.partitionBy("c_source", "c_size").orderBy("part")) - F.col("m"))
    sub = sub.where("before > 0").select(F.col("c_source").alias("p_source"), F.col("c_size").alias("p_size"), F.col("part").alias("p_part"), "before")
    rank = F.row_number().over(W.partitionBy("source", "size", "part").orderBy(F.xxhash64("doc_id"), "doc_id")) - 1
    ranked = joined.withColumn("rank", rank).join(
        sub, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size")) & (F.col("part") == F.col("p_part")), "left"
    )
    k = F.col("rank") + F.coalesce("before", F.lit(0))
    copies = F.floor((k + 1) * F.col("copies") / F.col("n")) - F.floor(k * F.col("copies") / F.col("n"))
    return ranked.select("doc_id", "source", "size", "source_size", "target", "rate", copies.cast("long").alias("copies"))

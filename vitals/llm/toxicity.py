"""Operator 4: toxicity by non-negative positive-unlabelled (nnPU) learning.

A linear numpy classifier over word features is trained from confirmed toxic texts (P) and
unlabelled texts (U) with the class-prior-corrected risk

    prior * E_P[l(+f)] + max(0, E_U[l(-f)] - prior * E_P[l(-f)])

where l is the logistic loss. When the second term turns negative, its gradient is followed the other
way round, as the non-negative estimator asks. The prior is the share of toxic rows among the labelled
rows that may be learnt from. Training takes a bounded sample (``MAX_POSITIVE``, ``MAX_UNLABELLED``
rows in expectation, by a hash of doc_id and text; equal rows count once); scoring reads every whole text.

Features of a text: its distinct words (runs of letters, lower case) and their prefixes of 4 to 6
letters. Only features whose shares of P and of U differ by at least ``MIN_Z`` standard errors, found in at least
``MIN_DOCS`` sampled texts, are trained. The score is the logistic of the linear form.

Cases: a null or empty text scores by the bias alone; without toxic rows to learn from every score is 0;
repeated doc_ids score alike; null doc_ids are neither learnt from nor held out; label rows
with null toxic are ignored; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitals.llm.common import discard, prepare, stage, texts

MAX_POSITIVE, MAX_UNLABELLED = 4000, 10000
MIN_DOCS, MIN_Z, EPOCHS, RATE, L2 = 5, 5.0, 800, 0.1, 2e-5
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7

LETTERS = re.compile(r"[^\W\d_]+")


def fold(column: str = "doc_id", folds: int = FOLDS):
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def word_features(word: str) -> list[str]:
    """The word and its prefixes; a prefix is marked so that it differs from a whole word."""
    return [word, *(word[:n] + "-" for n in (4, 5, 6) if len(word) > n)]


def features(text: str) -> set[str]:
    out: set[str] = set()
    for word in set(LETTERS.findall(text.lower())):
        out.update(word_features(word))
    return out


def _featurise(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array([sorted(features(t)) for t in texts(batch)], pa.list_(pa.string()))], names=["label", "features"])


def _loss_slope(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logistic loss of +z and its slope."""
    return np.logaddexp(0, -z), -1 / (1 + np.exp(np.clip(z, -50, 50)))


def train(rows: np.ndarray, cols: np.ndarray, n_features: int, n_p: int, n_u: int, prior: float, epochs: int = EPOCHS, rate: float = RATE, l2: float = L2) -> tuple[np.ndarray, float]:
    """(weights, bias) of the nnPU classifier by full-batch Adam. Documents 0 to n_p - 1 are positive,
    the next n_u unlabelled; (rows, cols) are their features."""
    n = n_p + n_u
    w, bias = np.zeros(n_features), float(np.log(prior / (1 - min(prior, 0.99))))
    m, s, mb, sb = np.zeros(n_features), np.zeros(n_features), 0.0, 0.0
    for t in range(1, epochs + 1):
        z = np.bincount(rows, w[cols], n) + bias
        zp, zu = z[:n_p], z[n_p:]
        _, up = _loss_slope(zp)  # slope of l(+f) on P
        dp_loss, dp = _loss_slope(-zp)  # l(-f) on P
        du_loss, du = _loss_slope(-zu)
        negative = (du_loss.mean() if n_u else 0.0) - prior * dp_loss.mean()
        g = np.zeros(n)
        if negative >= 0:
            g[:n_p] = prior * up / n_p + prior * dp / n_p
            g[n_p:] = -du / max(n_u, 1)
        else:  # step back from the overfitted part
            g[:n_p] = -prior * dp / n_p
            g[n_p:] = du / max(n_u, 1)
        gw, gb = np.bincount(cols, g[rows], n_features) + l2 * w, g.sum()
        m, mb = 0.9 * m + 0.1 * gw, 0.9 * mb + 0.1 * gb
        s, sb = 0.999 * s + 0.001 * gw**2, 0.999 * sb + 0.001 * gb**2
        step = rate * np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
        w -= step * m / (np.sqrt(s) + 1e-9)
        bias -= step * mb / (np.sqrt(sb) + 1e-9)
    return w, float(bias)


def fit(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> tuple[dict[str, float], float]:
    """Train on the rows outside the held-out fold; only the bounded sample reaches the driver."""
    prepare(docs.sparkSession)
    learn = fold() != HELD_OUT
    known = labels.where(learn & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = known.agg(F.count("*").alias("n"), F.sum("toxic").alias("p")).first()
    n_docs = docs.where(learn).count()
    if not n["p"] or not n_docs:
        return {}, -50.0

    def share(most, of, *key):
        return F.pmod(F.xxhash64(*key, F.lit(17)), F.lit(1 << 30)) < int(min(1.0, most / max(of, 1)) * (1 << 30))

    def sampled(rows_, most, of):
        # by row, not by id; rows that are repeated are one (combined map-side), so no id fills the sample
        return rows_.where(share(most, of, "doc_id", "text")).dropDuplicates(["doc_id", "text"])

    rows = docs.where(learn).select("doc_id", "text")
    # the sampled positives are a bounded set of ids, so they are joined as a broadcast
    wanted = known.where((F.col("toxic") == 1) & share(max_positive, n["p"], "doc_id")).select("doc_id")
    toxic = rows.join(F.broadcast(wanted), "doc_id")
    pos = sampled(toxic, max_positive, toxic.count()).select(F.lit(1).alias("label"), "text")
    unl = sampled(rows, max_unlabelled, n_docs).select(F.lit(0).alias("label"), "text")
    sample = stage(pos.unionAll(unl).mapInArrow(_featurise, "label int, features array<string>"), "toxicity-sample")
    size = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_p, n_u = size.get(1, 0), size.get(0, 0)
    if not n_p:
        return {}, -50.0
    # features whose shares of P and of U differ by MIN_Z standard errors
    counted = sample.select("label", F.explode("features").alias("f")).groupBy("f").agg(F.sum("label").alias("p"), F.count("*").alias("n"))
    share = F.col("n") / (n_p + n_u)
    error = F.sqrt(share * (1 - share) * (1 / n_p + 1 / max(n_u, 1)))
    z = F.abs(F.col("p") / n_p - (F.col("n") - F.col("p")) / max(n_u, 1)) / error
    names = sorted(r["f"] for r in counted.where((F.col("n") >= MIN_DOCS) & (share < 1) & (z >= MIN_Z)).select("f").collect())
    at = {f: i for i, f in enumerate(names)}

    def indexed(batches):
        for batch in batches:
            found = [[at[f] for f in fs if f in at] for fs in batch.column("features").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(found, pa.list_(pa.int32()))], names=["label", "cols"])

    held = sample.mapInArrow(indexed, "label int, cols array<int>").toArrow()
    label, cols = held.column("label").to_numpy(), held.column("cols").to_pylist()
    order = np.argsort(-label, kind="stable")
    rows = np.repeat(np.arange(len(order)), [len(cols[i]) for i in order])
    flat = np.asarray([c for i in order for c in cols[i]], np.int64)
    w, bias = train(rows, flat, len(names), n_p, n_u, n["p"] / n["n"])
    discard(sample)
    return {f: float(x) for f, x in zip(names, w, strict=True) if x}, bias


def _score(shared):
    def run(batches):
        weights, bias = shared.value
        known: dict[str, list[tuple[str, float]]] = {}
        for batch in batches:
            scores = []
            for text in texts(batch):
                if len(known) > 200_000:
                    known.clear()
                total: dict[str, float] = {}
                for word in set(LETTERS.findall(text.lower())):
                    found = known.get(word)
                    if found is None:
                        found = [(f, weights[f]) for f in word_features(word) if f in weights]
                        if len(word) <= 64:
                            known[word] = found
                    if found:
                        total.update(found)
                scores.append(float(1 / (1 + np.exp(-np.clip(bias + sum(sorted(total.values())), -50, 50)))))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in batch.schema.names if c != "text"] + [pa.array(scores, pa.float64())], names=[c for c in batch.schema.names if c != "text"] + ["score"])

    return run


def score(docs: DataFrame, model: tuple[dict[str, float], float]) -> DataFrame:
    """doc_id, score of every document row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the training sample
    return docs.select("doc_id", "text").mapInArrow(_score(shared), "doc_id long, score double")


def keep_clean(docs: DataFrame, model: tuple[dict[str, float], float], threshold: float = THRESHOLD) -> DataFrame:
    """The document rows whose score is below the threshold, all columns kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = _score(shared)
        for batch in batches:
            only = pa.RecordBatch.from_arrays([batch.column("text")], names=["text"])
            scored = next(scorer(iter([only]))).column("score").to_numpy()
            yield batch.filter(pa.array(scored < threshold))

    return docs.mapInArrow(run, docs.schema)

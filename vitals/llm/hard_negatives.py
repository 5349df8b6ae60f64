"""Operator 12: hard negatives by L2AP-style threshold joins.

For each anchor the ``n_positives`` best other rows of its label are its positives; for each positive of score p the
``n_negatives`` best rows of other labels whose score lies in [``low_percent`` % of p, p] are its negatives. Scores are integer
inner products, equal scores go by the smaller vec_id.

The anchors are the stated query set: they come in blocks of at most about ``BLOCK_BYTES``, and each block is joined with all
rows at a threshold per anchor that is lowered until its windows are full (or a lower score can't matter).
In a task each Arrow batch of rows is joined with the block so (``_Join``):

* inverted index: dimensions are ordered by the anchors' energy; of a row only those dimensions are indexed that its
  suffix norm does not cover, i.e. the suffix alone times any anchor's suffix norm stays below that anchor's threshold;
* partial scores are accumulated over the postings, strip by strip of dimensions;
* a pair is pruned when its partial score plus the product of the remaining norms is below the threshold;
* what is left is scored to the end, exactly. A task's own full windows raise its thresholds further.

A task emits the best rows of each window alone; they are merged by a window function with group limits. The driver
holds one block of anchors, their thresholds and positives.

Cases: rows with null vec_id, label or vector, or with a null or non-finite component take no part; a vector that is
shorter than another has zeros there; an empty vector scores 0; rows are told apart by vec_id, label and vector, exact repeats
count once, and "other" rows have another vec_id; of rows with one vec_id those with equal scores count once; scores are
clipped to the range of a long, components too; an empty table gives no rows; other columns are ignored. Positives below 0 have
empty windows, so thresholds end at 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from vitals.llm.common import discard, prepare, stage
from vitals.session import scratch_path

#: Bytes of the anchors' components in one block (8 each).
BLOCK_BYTES = 16 << 20
#: Shares of an anchor's squared norm, and of its least positive, that the thresholds go down by.
POSITIVE_STEPS, NEGATIVE_STEPS = (0.6, 0.3, 0.0), (0.95, 0.0)
#: Dimensions accumulated at once, anchors joined at once, share of pairs below which they are kept one by one.
STRIP, QUERIES, SPARSE = 8, 1024, 1 / 16

LONG = np.iinfo(np.int64)
SCHEMA = "anchor int, slot int, anchor_id long, positive_id long, positive_score long, vec_id long, score long"


def quantise(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, label and the floor of ``scale`` times each component of the rows that take part."""
    whole = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x))
    scaled = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return embeddings.where(whole).where(finite).select("vec_id", "label", scaled.alias("vector"))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column as a matrix of ``dims`` columns, shorter ones filled with zeros."""
    ends = np.asarray(column.offsets, np.int64)
    sizes, values = np.diff(ends), np.asarray(column.values.to_numpy(zero_copy_only=False), np.int64)
    if len(sizes) and (sizes == dims).all():
        return values[ends[0] : ends[-1]].reshape(-1, dims)
    out = np.zeros((len(sizes), dims), np.int64)
    at = np.arange(dims)
    rows, cols = np.nonzero(at[None, :] < sizes[:, None])
    out[rows, cols] = values[ends[:-1][rows] + cols]
    return out


class _Join:
    """The threshold join of one block of anchors with batches of rows."""

    def __init__(self, vectors: np.ndarray):
        self.order = np.argsort(-(vectors.astype(float) ** 2).sum(0), kind="stable")
        self.whole = vectors[:, self.order]
        self.q = self.whole.astype(float)
        self.cuts = [*range(0, self.q.shape[1], STRIP), self.q.shape[1]]
        self.norms = self._suffix_norms(self.q)

    def _suffix_norms(self, m: np.ndarray) -> np.ndarray:
        """Norms of the components from each cut on, rounded up."""
        squares = np.concatenate([np.cumsum((m**2)[:, ::-1], 1)[:, ::-1], np.zeros((len(m), 1))], 1)
        return np.sqrt(squares[:, self.cuts]) * (1 + 1e-12)

    def pairs(self, vectors: np.ndarray, least: np.ndarray, allowed) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of all pairs with a score of at least ``least`` of the anchor.
        ``allowed(anchors)``: which rows each of them may meet, as a matrix."""
        whole = vectors[:, self.order]
        x = whole.astype(float)
        norms = self._suffix_norms(x)
        exact = float(np.abs(self.q).max(initial=0)) * float(np.abs(x).max(initial=0)) * x.shape[1] < 2**52
        found = []
        # anchors with like thresholds share an index, which then omits more
        ranked = np.argsort(least / np.maximum(self.norms[:, 0], 1e-9), kind="stable")
        for start in range(0, len(ranked), QUERIES):
            found.append(self._some(ranked[start : start + QUERIES], x, norms, least, allowed))
        a, r = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(2))
        if exact:
            scores = np.einsum("ij,ij->i", self.q[a], x[r]).astype(np.int64)
        else:
            sums = [sum(int(p) * int(q) for p, q in zip(self.whole[i], whole[j], strict=True)) for i, j in zip(a, r, strict=True)]
            scores = np.asarray([min(max(s, LONG.min), LONG.max) for s in sums], np.int64)
        keep = scores >= least[a]
        return a[keep], r[keep], scores[keep]

    def _some(self, anchors, x, norms, least, allowed):
        q, q_norms, t = self.q[anchors], self.norms[anchors], least[anchors].astype(float)
        t = t - 1e-9 * q_norms[:, 0] * norms[:, 0].max(initial=0)  # for rounding
        # index: the cuts up to which a row's dimensions have postings
        with np.errstate(divide="ignore", invalid="ignore"):
            reach = np.where(t[:, None] > 0, q_norms / t[:, None], np.inf).max(0)
        reach = np.where(np.isnan(reach), np.inf, reach)
        covered = norms * np.where(np.isinf(reach), 0, reach) < 1
        covered &= ~np.isinf(reach)
        indexed = np.where(covered.any(1), covered.argmax(1), len(self.cuts) - 1)
        by = np.argsort(-indexed, kind="stable")
        postings = [int((indexed > k).sum()) for k in range(len(self.cuts) - 1)]
        n = postings[0] if postings else 0
        if not n and (t > 0).all():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not n:
            n = len(by)
        rows = by[:n]
        scores = np.zeros((len(anchors), n))
        alive = allowed(anchors)[:, rows]
        done = len(self.cuts) - 1
        for k in range(len(self.cuts) - 1):
            m = postings[k]
            if not m:
                done = k
                break
            part = slice(self.cuts[k], self.cuts[k + 1])
            scores[:, :m] += q[:, part] @ x[rows[:m], part].T
            # rows whose postings have ended keep the bound of their last cut
            at = np.minimum(k + 1, indexed[rows])
            for cut in np.unique(at):
                own = at == cut
                lo, hi = int(own.argmax()), int(len(own) - own[::-1].argmax())
                alive[:, lo:hi] &= scores[:, lo:hi] + q_norms[:, cut, None] * norms[rows[lo:hi], cut] >= t[:, None]
            if np.count_nonzero(alive) < SPARSE * alive.size:
                done = k + 1
                break
        a, r = np.nonzero(alive)
        partial, seen = scores[a, r], np.minimum(done, indexed[rows[r]])
        r = rows[r]
        for k in range(len(self.cuts) - 1):  # what is left, pair by pair
            part, here = slice(self.cuts[k], self.cuts[k + 1]), seen <= k
            if not here.any():
                continue
            partial[here] += np.einsum("ij,ij->i", q[a[here], part], x[r[here], part])
            cut = np.maximum(seen, k + 1)
            keep = partial + q_norms[a, cut] * norms[r, cut] >= t[a]
            a, r, partial, seen = a[keep], r[keep], partial[keep], seen[keep]
        return anchors[a], r


def _best(columns: list[np.ndarray], k: int) -> list[np.ndarray]:
    """Of (anchor, slot, vec_id, score) the first k of each anchor and slot, equal ones once."""
    anchor, slot, vec_id, score = columns
    by = np.lexsort((vec_id, -score.astype(float) if len(score) and score.min() == LONG.min else -score, slot, anchor))
    anchor, slot, vec_id, score = (c[by] for c in columns)
    if not len(by):
        return [anchor, slot, vec_id, score]
    group = np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(slot) != 0)])
    fresh = group | np.concatenate([[True], (np.diff(vec_id) != 0) | (np.diff(score) != 0)])
    anchor, slot, vec_id, score, group = (c[fresh] for c in (anchor, slot, vec_id, score, group))
    starts = np.flatnonzero(group)
    rank = np.arange(len(group)) - np.repeat(starts, np.diff([*starts, len(group)]))
    return [c[rank < k] for c in (anchor, slot, vec_id, score)]


def _task(shared, k: int):
    """The best k rows of each anchor's windows in a task. A block: ids, labels, vectors of the anchors, their thresholds,
    ``same`` (whether rows of the anchor's label are wanted), and low and high ends of the windows (one row an anchor)."""

    def run(batches):
        block = shared.value
        ids, labels, least = block["ids"], block["labels"], block["least"].copy()
        low, high, same = block["low"], block["high"], block["same"]
        join, dims = _Join(block["vectors"]), block["vectors"].shape[1]
        best = [np.zeros(0, np.int64) for _ in range(4)]
        for batch in batches:
            vec_ids, own = (np.asarray(batch.column(c).to_numpy(zero_copy_only=False), np.int64) for c in ("vec_id", "label"))

            def allowed(anchors, vec_ids=vec_ids, own=own):
                equal = labels[anchors, None] == own
                return equal & (ids[anchors, None] != vec_ids) if same else ~equal

            a, r, score = join.pairs(matrix(batch.column("vector"), dims), least, allowed)
            new = [best]
            for slot in range(low.shape[1]):
                fits = (score >= low[a, slot]) & (score <= high[a, slot])
                new.append([a[fits], np.full(int(fits.sum()), slot), vec_ids[r[fits]], score[fits]])
            best = _best([np.concatenate(c) for c in zip(*new, strict=True)], k)
            # full windows raise the thresholds
            need = low.copy()
            starts = np.flatnonzero(np.concatenate([[True], (np.diff(best[0]) != 0) | (np.diff(best[1]) != 0)])) if len(best[0]) else np.zeros(0, int)
            full = starts[np.diff([*starts, len(best[0])]) == k] + k - 1
            need[best[0][full], best[1][full]] = best[3][full]
            least = np.maximum(block["least"], need.min(1))
        a, slot, vec_id, score = best
        if len(a):
            positive = (block["positive_ids"], high)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (a.astype(np.int32), slot.astype(np.int32), ids[a], positive[0][a, slot], positive[1][a, slot], vec_id, score)],
                names=[c.split()[0] for c in SCHEMA.split(", ")],
            )

    return run


def _join_round(rows: DataFrame, block: dict, k: int) -> DataFrame:
    """One threshold join over all rows: the first k rows of each (anchor, slot), ranked."""
    shared = rows.sparkSession.sparkContext.broadcast(block)  # one block of anchors: bounded by BLOCK_BYTES
    found = rows.mapInArrow(_task(shared, k), SCHEMA).distinct()
    rank = F.row_number().over(W.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _positives(rows: DataFrame, block: dict, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of each anchor's first k rows of its label with scores of 0 or more; -1 fills."""
    n = len(block["ids"])
    ids, scores, count = np.full((n, k), -1, np.int64), np.full((n, k), -1, np.int64), np.zeros(n, np.int64)
    squares = (block["vectors"].astype(float) ** 2).sum(1)
    still = np.arange(n)
    for step in POSITIVE_STEPS:
        least = np.minimum(np.floor(step * squares[still]), 2.0**62).astype(np.int64)
        part = {c: block[c][still] for c in ("ids", "labels", "vectors")} | {"same": True, "least": least, "low": least[:, None], "high": np.full((len(still), 1), LONG.max)}
        got = _join_round(rows, part | {"positive_ids": np.zeros((len(still), 1), np.int64)}, k).select("anchor", "rank", "vec_id", "score").toArrow()
        a, rank, vec_id, score = (got.column(c).to_numpy().astype(np.int64) for c in ("anchor", "rank", "vec_id", "score"))
        ids[still[a], rank - 1], scores[still[a], rank - 1] = vec_id, score
        count[still] = np.bincount(a, minlength=len(still))
        still = still[count[still] < k]
        if not len(still):
            break
    return ids, scores


def mine(rows: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 5, low_percent: int = 80, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows``: vec_id long, label int, vector array<long> without nulls; ``is_anchor`` picks the anchors among them."""
    spark = prepare(rows.sparkSession)
    held = stage(rows.select("vec_id", "label", "vector"), "mine-rows")
    anchors = stage(held.where(is_anchor).distinct(), "mine-anchors")
    size = anchors.agg(F.sum(8 * F.size("vector") + 64).alias("bytes")).first()["bytes"] or 0
    blocks = -(-size // block_bytes)
    out = scratch_path(spark, "mine-found")
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], result).write.parquet(out)
    for b in range(blocks):
        mark = F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(blocks)) == b
        got = anchors.where(mark).toArrow().combine_chunks()
        if not got.num_rows:
            continue
        vector = got.column("vector").chunk(0)
        dims = max(1, int(np.diff(np.asarray(vector.offsets)).max(initial=1)))
        block = {"ids": got.column("vec_id").to_numpy().astype(np.int64), "labels": got.column("label").to_numpy().astype(np.int64), "vectors": matrix(vector, dims)}
        ids, scores = _positives(held, block, n_positives)
        some = np.flatnonzero((scores >= 0).any(1))
        # empty windows, low above high, stand for missing positives
        low = np.asarray([[-(-low_percent * int(s) // 100) if s >= 0 else LONG.max for s in row] for row in scores], np.int64).reshape(scores.shape)
        high = np.where(scores >= 0, scores, -1)
        for step in NEGATIVE_STEPS:
            if not len(some):
                break
            goal = low[some].min(1)  # no window reaches below
            lowest = np.where(scores[some] >= 0, scores[some], LONG.max).min(1)
            least = np.maximum(goal, np.floor(step * lowest.astype(float)).astype(np.int64))
            part = {c: block[c][some] for c in ("ids", "labels", "vectors")} | {"same": False, "least": least, "low": low[some], "high": high[some], "positive_ids": ids[some]}
            found = stage(_join_round(held, part, n_negatives), "mine-round")
            counts = found.groupBy("anchor", "slot").agg(F.count("*").alias("n")).where(F.col("n") == n_negatives).select("anchor", "slot").toArrow()
            filled = np.zeros((len(some), low.shape[1]), bool)
            filled[counts.column("anchor").to_numpy(), counts.column("slot").to_numpy()] = True
            # done: each window is full or lies above the threshold as a whole
            done = (filled | (low[some] >= least[:, None])).all(1)
            finished = spark.createDataFrame(pa.table({"anchor": pa.array(np.flatnonzero(done).astype(np.int32))})) if done.any() else None
            if finished is not None:
                kept = found.join(F.broadcast(finished), "anchor", "left_semi")  # a block's anchors at most
                kept.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")).write.mode("append").parquet(out)
            discard(found)
            some = some[~done]
    discard(held, anchors)
    return spark.read.schema(result).parquet(out)

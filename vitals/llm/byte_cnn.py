"""Operator 11: quality by a byte-level convolutional network in numpy.

A text's UTF-8 bytes are embedded (``EMBED`` numbers a byte) and read by ``FILTERS`` learned filters of ``WIDTH`` bytes, every
``STRIDE`` bytes. The rectified responses are averaged over chunks of two blocks of ``BLOCK`` positions; chunks
overlap by half and cover the whole document. Each filter's maximum over all chunks goes, by its logarithm, through one hidden
layer into one probability. A text is read in slabs that overlap, so memory is bounded, and no
response or chunk depends on where a slab ends.

Training: Adam on minibatches from a bounded sample, at most ``MAX_ROWS`` labelled rows of each class with texts of up to
``MAX_BYTES`` bytes (of a class without such texts the shortest row, whole), in the order of a hash of row and text; a class weighs as many
rows as it has. Back-propagation reaches
a filter through its greatest chunk alone. Scoring reads every whole text.

Cases: a null or empty text is scored as one chunk without responses; with labels of one class only (or none) every
score is that class (0.5); labels other than 0 and 1 and null ones are ignored, of several labels of an id the greatest holds;
null doc_ids are neither learnt from nor held out; repeated rows score alike; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitals.llm.common import prepare, texts

#: Bound of the training sample: rows of a class, and bytes of a text.
MAX_ROWS, MAX_BYTES = 1200, 16_384
EMBED, WIDTH, STRIDE, FILTERS, BLOCK, HIDDEN = 8, 8, 2, 32, 64, 16
STEPS, BATCH, RATE, DECAY = 320, 32, 0.004, 1e-4
FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.5
#: Blocks read at once.
SLAB = 256
#: Rows of STRIDE bytes that a window reads.
REACH = WIDTH // STRIDE
#: Positions that a short chunk counts as at least.
LEAST = 32

Model = dict[str, np.ndarray]


def fold(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string").cast("binary")) % FOLDS


def fresh(seed: int = 11) -> Model:
    """An untrained network."""
    r = np.random.default_rng(seed)
    shapes = {"embed": ((256, EMBED), 0.5), "filters": ((WIDTH * EMBED, FILTERS), 1 / np.sqrt(WIDTH * EMBED)), "hidden": ((FILTERS, HIDDEN), 1 / np.sqrt(FILTERS)), "out": ((HIDDEN,), 1 / np.sqrt(HIDDEN))}
    model = {k: r.normal(0, s, shape).astype(np.float32) for k, (shape, s) in shapes.items()}
    return model | {"filters_b": np.full(FILTERS, -0.2, np.float32), "hidden_b": np.zeros(HIDDEN, np.float32), "out_b": np.zeros(1, np.float32)}


def steps(model: Model, data: np.ndarray) -> np.ndarray:
    """The embedded bytes, ``STRIDE`` of them a row, filled with zero bytes so that each row begins a window."""
    n = -(-len(data) // STRIDE)
    padded = np.zeros((n + REACH - 1) * STRIDE, np.uint8)
    padded[: len(data)] = data
    return np.take(model["embed"], padded, axis=0).reshape(-1, STRIDE * EMBED)


def windows(rows: np.ndarray) -> np.ndarray:
    """What each window reads, one a row."""
    shape = max(len(rows) - REACH + 1, 0), WIDTH * EMBED
    return np.ascontiguousarray(np.lib.stride_tricks.as_strided(rows, shape, (rows.strides[0], rows.itemsize)))


def responses(model: Model, seen: np.ndarray) -> np.ndarray:
    """Rectified responses to windows."""
    out = seen @ model["filters"]
    out += model["filters_b"]
    return np.maximum(out, 0, out=out)


def chunk_means(sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Means over chunks of two neighbouring blocks; a lone block is a chunk."""
    if len(sums) > 1:
        sums, counts = sums[:-1] + sums[1:], counts[:-1] + counts[1:]
    return sums / np.maximum(counts, LEAST)[:, None]


def _block_sums(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    whole, rest = divmod(len(r), BLOCK)
    ones, counts = np.ones(BLOCK, r.dtype), [BLOCK] * whole + [rest] * (rest > 0)
    sums = ones @ r[: whole * BLOCK].reshape(whole, BLOCK, r.shape[1])
    if rest:
        sums = np.concatenate([sums, ones[None, :rest] @ r[whole * BLOCK :]])
    return sums, np.asarray(counts)


def pooled(model: Model, text: str) -> np.ndarray:
    """Each filter's greatest chunk mean over the whole text."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    best, span, before = np.zeros(FILTERS, np.float32), SLAB * BLOCK * STRIDE, None
    for start in range(0, len(data), span):
        # the last windows of a slab reach into the next one
        seen = windows(steps(model, data[start : start + span + WIDTH - STRIDE]))[: SLAB * BLOCK]
        sums, counts = _block_sums(responses(model, seen))
        if before is not None:
            sums, counts = np.concatenate([before[0], sums]), np.concatenate([before[1], counts])
        best = np.maximum(best, chunk_means(sums, counts).max(0))
        before = sums[-1:], counts[-1:]
    return best


def _head(model: Model, pools: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs of the hidden layer, its outputs, and the probabilities."""
    logs = np.log(pools + 0.01) + 2
    hidden = np.maximum(logs @ model["hidden"] + model["hidden_b"], 0)
    z = hidden @ model["out"] + model["out_b"]
    return logs, hidden, 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def probability(model: Model, text: str) -> float:
    return float(_head(model, pooled(model, text)[None])[2][0])


def gradients(model: Model, sample: list[np.ndarray], labels: np.ndarray, weights: np.ndarray) -> tuple[Model, float]:
    """Of the weighted logistic loss of a minibatch; ``sample``: the bytes of each text."""
    kind = model["out"].dtype
    pools, held = np.zeros((len(sample), FILTERS), kind), []
    for i, data in enumerate(sample):
        if not len(data):
            held.append(None)
            continue
        seen = windows(steps(model, data))
        r = responses(model, seen)
        sums, counts = _block_sums(r)
        means = chunk_means(sums, counts)
        top = means.argmax(0)
        pools[i] = means[top, np.arange(FILTERS)]
        held.append((seen, r, top))
    logs, hidden, p = _head(model, pools)
    weights = weights / weights.sum()
    loss = float(-(weights * np.log(np.clip(np.where(labels == 1, p, 1 - p), 1e-9, 1))).sum())
    dz = (weights * (p - labels)).astype(kind)
    out: Model = {"out": hidden.T @ dz, "out_b": dz.sum(keepdims=True)}
    dh = dz[:, None] * model["out"] * (hidden > 0)
    out |= {"hidden": logs.T @ dh, "hidden_b": dh.sum(0)}
    dpool = dh @ model["hidden"].T / (pools + 0.01)
    out |= {k: np.zeros_like(model[k]) for k in ("filters", "filters_b", "embed")}
    for i, (data, kept) in enumerate(zip(sample, held, strict=True)):
        if kept is None:
            continue
        seen, r, top = kept
        n, at = len(r), np.arange(len(r))[:, None] // BLOCK
        chosen = (at == top) | (at == top + 1)  # each filter's own chunk
        g = np.where(chosen & (r > 0), dpool[i] / np.maximum(chosen.sum(0), LEAST), 0).astype(kind)
        some = np.flatnonzero(g.any(1))
        g = g[some]
        out["filters"] += seen[some].T @ g
        d_rows, d_seen = np.zeros((n + REACH - 1, STRIDE * EMBED), kind), (g @ model["filters"].T).reshape(len(some), REACH, STRIDE * EMBED)
        for j in range(REACH):
            d_rows[some + j] += d_seen[:, j]
        out["filters_b"] += g.sum(0)
        padded = np.zeros((n + REACH - 1) * STRIDE, np.uint8)
        padded[: len(data)] = data
        d_bytes = d_rows.reshape(-1, EMBED)
        for e in range(EMBED):
            out["embed"][:, e] += np.bincount(padded, d_bytes[:, e], 256)
    return out, loss


def train(sample: list[str], labels: np.ndarray, weights: np.ndarray, steps: int = STEPS, seed: int = 11) -> Model:
    """``steps`` minibatches by Adam with a linearly falling rate; the sample is passed through as often as that takes."""
    model, r = fresh(seed), np.random.default_rng(seed)
    data = [np.frombuffer(t.encode("utf-8", "replace"), np.uint8) for t in sample]
    first, second = ({k: np.zeros_like(v) for k, v in model.items()} for _ in range(2))
    queue = np.zeros(0, np.int64)
    for t in range(1, steps + 1):
        while len(queue) < BATCH:
            queue = np.concatenate([queue, r.permutation(len(sample))])
        some, queue = queue[:BATCH], queue[BATCH:]
        grads, _ = gradients(model, [data[i] for i in some], labels[some], weights[some])
        rate = RATE * (1 - (t - 1) / steps)
        for k, g in grads.items():
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g**2
            step = first[k] / (1 - 0.9**t) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
            model[k] = (model[k] - rate * (step + DECAY * model[k])).astype(np.float32)
    return model


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> Model:
    """Train on labelled rows outside the held-out fold. The driver gets the sample: max_rows of each class, max_bytes a row."""
    prepare(docs.sparkSession)
    learn = fold() != HELD_OUT
    known = labels.where(learn & F.col(column).isin(0, 1)).groupBy("doc_id").agg(F.max(F.col(column).cast("int")).alias("label"))
    rows = docs.where(learn).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(known, "doc_id").select("label", "text", F.xxhash64("doc_id", "text").alias("h"))
    size = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(size) < 2:
        constant = {k: np.zeros_like(v) for k, v in fresh().items()}
        return constant | {"out_b": np.full(1, {0: -50.0, 1: 50.0}.get(next(iter(size), None), 0.0), np.float32)}

    def some(label):
        own = rows.where(F.col("label") == label)
        share = int(min(1.0, 2 * max_rows / size[label]) * (1 << 30))
        got = own.where((F.pmod("h", F.lit(1 << 30)) < share) & (F.octet_length("text") <= max_bytes)).orderBy("h", "text").limit(max_rows).select("label", "text").toArrow()
        return got if got.num_rows else own.orderBy(F.octet_length("text"), "h", "text").limit(1).select("label", "text").toArrow()

    parts = [some(0), some(1)]
    sample = pa.concat_tables(parts)
    y = sample.column("label").to_numpy().astype(np.float32)
    weights = np.where(y == 1, size[1] / parts[1].num_rows, size[0] / parts[0].num_rows).astype(np.float32)
    return train(sample.column("text").to_pylist(), y, weights)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every document row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches):
        for batch in batches:
            pools = np.stack([pooled(shared.value, t) for t in texts(batch)]) if batch.num_rows else np.zeros((0, FILTERS), np.float32)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_head(shared.value, pools)[2].astype(float))], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")

"""Operator 9: near-duplicate vectors with randomised-rotation binary codes.

Each vector is scaled to length 1 and turned by one random rotation R, once; R x, its code (the packed signs of R x) and its
factor go to the tables and blocks. The factor f = <R x, code> / sqrt(D) corrects the estimate: <code_x, R y> / (sqrt(D) f) is an unbiased
estimate of <x, y> whose error exceeds ``WIDTH`` * sqrt((1 - f^2) / (f^2 (D - 1))) with the negligible probability of
a WIDTH-sigma event. Pairs whose upper bound lies below the threshold are dropped; all others are
recomputed exactly, in double precision, so no pair below the threshold is ever linked.

Vectors of each length have rotations and tables of their own, so vectors meet those of their length only.

Candidates share all bits of a band of the code in one of T tables. A pair at the threshold agrees in a bit with
probability 1 - acos(threshold) / pi; bands have about log2(N / BUCKET) bits and T is chosen so that such a pair is
missed by all tables with probability ``MISS`` at most. A pair is counted in the first table it meets in only.
Buckets larger than ``BLOCK`` are dealt into blocks, and every two blocks meet in a task of their own.

Equal vectors are joined first and count with their number. Tasks return counts and the edges of
local spanning forests, not pairs, so a bucket of m near copies gives about m rows.

Cases: null vectors, zero vectors and vectors with null or non-finite components link with nothing; vectors of different
lengths don't link with each other; rows with the same vec_id are vectors of their own that share their id's component; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitals.llm.common import components, prepare, rows_batches, stage

THRESHOLD = 0.9
#: A bucket of about BUCKET vectors is compared at about the price of handing over its rows.
MISS, BUCKET, BLOCK, WIDTH, SEED = 0.005, 256, 2048, 4.0, 20240229


@lru_cache(maxsize=64)
def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def plan(n: int, threshold: float, bucket: int = BUCKET, miss: float = MISS) -> tuple[int, int]:
    """(bits of a band, tables)."""
    bits = max(4, round(math.log2(max(n, 1) / bucket + 1)))
    hit = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-hit)))


@lru_cache(maxsize=4)
def band_planes(dim: int, bits: int, tables: int) -> np.ndarray:
    """Signs along further random directions extend the code when the bands need more bits than it has."""
    need, blocks = bits * tables, []
    while sum(len(b) for b in blocks) < need:
        blocks.append(rotation(dim, SEED + len(blocks)))
    return np.vstack(blocks)[:need]


def unit(vector) -> np.ndarray | None:
    """The vector at length 1, or None if it links with nothing."""
    if vector is None or any(v is None for v in vector):
        return None
    x = np.asarray(vector, np.float64)
    if not np.isfinite(x).all():
        return None
    top = np.abs(x).max(initial=0.0)
    return None if not top else (x / top) / np.linalg.norm(x / top)


def _units(batches):
    """vec_id, digest of the scaled vector and the vector itself (bytes of doubles)."""

    def rows():
        for batch in batches:
            for vec_id, v in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist(), strict=True):
                x = unit(v)
                data = None if x is None else np.asarray(v, np.float64).tobytes()
                yield vec_id, None if x is None else xxhash.xxh3_128_digest(data), None if x is None else x.tobytes()

    return rows_batches(rows(), pa.schema([("vec_id", pa.int64()), ("digest", pa.binary()), ("x", pa.binary())]), 2000)


def band_keys(x: np.ndarray, planes: np.ndarray, bits: int) -> np.ndarray:
    """[vector, table] band values."""
    signs = (x @ planes.T > 0).reshape(len(x), -1, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def coded(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed signs, correction factors <r, code> / sqrt(D)) of turned vectors."""
    return np.packbits(r >= 0, axis=1), np.abs(r).sum(1) / math.sqrt(r.shape[1])


_BANDED = "node long, n long, dim int, r binary, code binary, factor double, bands array<long>"


def _banded(bits: int, tables: int):
    def run(batches):
        for batch in batches:
            lengths = np.array([len(v) // 8 for v in batch.column("x").to_pylist()])
            for dim in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == dim))
                x = np.frombuffer(b"".join(part.column("x").to_pylist()), np.float64).reshape(-1, dim)
                keys = band_keys(x, band_planes(dim, bits, tables), bits)
                r = x @ rotation(dim).T
                code, factor = coded(r)
                columns = [pa.array(np.full(len(x), dim, np.int32)), pa.array([v.tobytes() for v in r], pa.binary()), pa.array([c.tobytes() for c in code], pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), part.column("n"), *columns, pa.array(factor), pa.array(keys.tolist(), pa.list_(pa.int64()))],
                    names=["node", "n", "dim", "r", "code", "factor", "bands"],
                )

    return run


def estimate(code: np.ndarray, factor: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unbiased estimates of all inner products of coded vectors with turned ones (float32), half-widths for the
    coded ones), from the stored codes and factors."""
    dim = turned.shape[1]
    signs = np.unpackbits(code, axis=1, count=dim).astype(np.float32) * 2 - 1
    est = (signs @ turned.T) / (math.sqrt(dim) * factor[:, None])
    return est, WIDTH * np.sqrt(np.maximum(1 - factor**2, 0) / (factor**2 * max(dim - 1, 1)))


def block_links(a: dict, b: dict | None, table: int, threshold: float):
    """Links between two blocks of a bucket (or within one): (counts of a, counts of b, forest edges)."""
    other = a if b is None else b
    na, nb, edges = np.zeros(len(a["node"]), np.int64), np.zeros(len(other["node"]), np.int64), []
    parent: dict[int, int] = {}
    turned = other["r"].astype(np.float32)

    def root(v):
        while parent.get(v, v) != v:
            parent[v] = parent.get(parent[v], parent[v])
            v = parent[v]
        return v

    for at in range(0, len(a["node"]), 512):
        rows = slice(at, at + 512)
        est, half = estimate(a["code"][rows], a["factor"][rows], turned)
        i, j = np.nonzero(est + half[:, None] >= threshold)
        i += at
        if b is None:
            i, j = i[i < j], j[i < j]
        if table:  # met in an earlier table already
            fresh = ~(a["bands"][i, :table] == other["bands"][j, :table]).any(1)
            i, j = i[fresh], j[fresh]
        for k in range(0, len(i), 50_000):
            p, q = i[k : k + 50_000], j[k : k + 50_000]
            ok = np.einsum("ij,ij->i", a["r"][p], other["r"][q]) >= threshold
            p, q = p[ok], q[ok]
            np.add.at(na, p, other["n"][q])
            np.add.at(nb, q, a["n"][p])
            for u, v in zip(a["node"][p].tolist(), other["node"][q].tolist(), strict=True):
                ru, rv = root(u), root(v)
                if ru != rv:
                    parent[max(ru, rv)] = min(ru, rv)
                    edges.append((u, v))
    return na, nb, edges


_LINK = "a long, b long, links long"
_LINK_PA = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])


def _arrays(t: pa.Table) -> dict:
    n = t.num_rows
    return {
        "node": t.column("node").to_numpy(),
        "n": t.column("n").to_numpy(),
        "r": np.frombuffer(b"".join(t.column("r").to_pylist()), np.float64).reshape(n, -1),
        "code": np.frombuffer(b"".join(t.column("code").to_pylist()), np.uint8).reshape(n, -1),
        "factor": t.column("factor").to_numpy(),
        "bands": np.array(t.column("bands").to_pylist(), np.int64).reshape(n, -1),
    }


def _meet(threshold: float):
    def run(t: pa.Table) -> pa.Table:
        table = t.column("t")[0].as_py()
        side = t.column("block").to_numpy()
        lo, hi = t.column("p")[0].as_py(), t.column("q")[0].as_py()
        a = _arrays(t.filter(pa.array(side == lo)))
        b = None if lo == hi else _arrays(t.filter(pa.array(side == hi)))
        na, nb, edges = block_links(a, b, table, threshold)
        rows = [(u, None, n) for u, n in zip(a["node"].tolist(), (na if b is not None else na + nb).tolist(), strict=True) if n]
        if b is not None:
            rows += [(u, None, n) for u, n in zip(b["node"].tolist(), nb.tolist(), strict=True) if n]
        rows += [(u, v, 0) for u, v in edges]
        return pa.Table.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], schema=_LINK_PA)

    return run


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding)."""
    prepare(vectors.sparkSession)
    rows = stage(vectors.select("vec_id", "embedding").mapInArrow(_units, "vec_id long, digest binary, x binary"), "vectors-units")
    # equal vectors: one node, the smallest id, that counts n times
    nodes = rows.where("digest is not null and vec_id is not null").groupBy("digest").agg(F.min("vec_id").alias("node"), F.count("*").alias("n"))
    held = rows.join(nodes, "digest").where("vec_id = node").select("node", "n", "x").dropDuplicates(["node", "x"])
    count = rows.where("digest is not null").count()
    bits, tables = plan(count, threshold)
    banded = stage(held.mapInArrow(_banded(bits, tables), _BANDED), "vectors-banded")
    tagged = banded.select("node", "n", "dim", "r", "code", "factor", "bands", F.posexplode("bands").alias("t", "band"))
    buckets = banded.select("dim", F.posexplode("bands").alias("t", "band")).groupBy("dim", "t", "band").agg(F.count("*").alias("m")).where("m > 1")
    blocks = F.ceil(F.col("m") / block).cast("int")
    dealt = tagged.join(buckets, ["dim", "t", "band"]).withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # every two blocks of a bucket meet once: a block goes to the pairs (p, q) that hold it
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns({"p": F.least("block", "other"), "q": F.greatest("block", "other")})
    found = met.select("dim", "t", "band", "p", "q", "block", "node", "n", "r", "code", "factor", "bands").groupBy("dim", "t", "band", "p", "q").applyInArrow(_meet(threshold), _LINK)
    found = stage(found, "vectors-links")
    links = found.where("b is null").groupBy("a").agg(F.sum("links").alias("links"))
    # rows that repeat a vec_id tie their vectors together
    same = rows.join(nodes, "digest").groupBy("vec_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b").select("a", "b")
    whole = components(found.where("b is not null").select("a", "b").unionAll(same), "vectors-cc")
    per_node = nodes.join(links, nodes["node"] == links["a"], "left").select("digest", "node", "n", F.coalesce("links", F.lit(0)).alias("links"))
    per_node = per_node.join(whole.withColumnRenamed("node", "w"), F.col("node") == F.col("w"), "left").select("digest", "n", "links", F.coalesce("component", "node").alias("component"))
    out = rows.select("vec_id", "digest").join(per_node, "digest", "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce(F.col("links") + F.col("n") - 1, F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )

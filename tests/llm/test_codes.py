"""The near vectors' estimates come from packed codes and factors that are stored once."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import functions as F

from vitals.llm import vectors
from vitals.llm.warc import base32_of, base32_sha1


def test_estimates_from_stored_codes():
    rng = np.random.default_rng(4)
    for dim in (16, 100):  # a code that fills its bytes, and one that does not
        x = rng.standard_normal((300, dim))
        x[150:] = x[:150] + 0.3 * x[150:]
        x /= np.linalg.norm(x, axis=1)[:, None]
        r = x @ vectors.rotation(dim).T
        code, factor = vectors.coded(r)
        assert code.shape == (300, -(-dim // 8)) and code.dtype == np.uint8
        est, half = vectors.estimate(code, factor, r.astype(np.float32))
        assert (est + half[:, None] >= x @ x.T).mean() > 0.999
        a = {"node": np.arange(300), "n": np.ones(300, np.int64), "r": r, "code": code, "factor": factor, "bands": np.zeros((300, 1), np.int64)}
        na, nb, _ = vectors.block_links(a, None, 0, 0.9)
        linked = (x @ x.T >= 0.9).sum() - 300
        assert 0.99 * linked <= (na + nb).sum() <= linked


def test_base32_of_digests_converts_each_digit_once(spark):
    texts = [b"", b"a", b"<html></html>", bytes(range(256))]
    digests = [hashlib.sha1(t).hexdigest() for t in texts] + ["0" * 40, "f" * 40, None]
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(digests)], "i int, d string")
    coded = rows.select("i", base32_of(F.col("d")).alias("code"))
    got = [r["code"] for r in coded.orderBy("i").collect()]
    assert got == [*map(base32_sha1, texts), "A" * 32, "7" * 32, None]
    # numbers of five hex digits: no text of bits is made and converted again for each letter
    plan = coded._jdf.queryExecution().analyzed().toString()
    assert ", 16, 10" in plan and ", 16, 2" not in plan and ", 2, 10" not in plan

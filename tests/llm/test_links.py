"""All links of the n-gram join."""

from __future__ import annotations

import numpy as np

from vitals.llm import ngram_join


def test_every_link_is_given(spark):
    rng = np.random.default_rng(6)
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join(f"x{k}_{i}" if rng.random() < 0.015 * (k % 3) else w for i, w in enumerate(base)) for k in range(40)]
    docs = [*enumerate(texts), (40, texts[3]), (41, ""), (42, None), (43, "one two"), (7, "one two"), (None, texts[3])]
    sets = {}
    for i, t in docs:
        w = (t or "").split()
        k = min(4, len(w))
        if w and i is not None:
            sets.setdefault(frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)), []).append(i)
    want = [(min(i), min(i), len(i) * (len(i) - 1) // 2) for i in sets.values() if len(i) > 1]
    for x, i in sets.items():
        for y, j in sets.items():
            if min(i) < min(j) and 100 * len(x & y) >= 85 * len(x | y):
                want.append((min(i), min(j), len(i) * len(j)))
    got = [tuple(r) for r in ngram_join.jaccard_links(spark.createDataFrame(docs, "doc_id long, text string"), 4, 85).collect()]
    assert sorted(got) == sorted(want)
    assert len(want) > 20


def test_rarest_signatures_are_shared_by_linked_sets():
    rng = np.random.default_rng(4)
    for size in (2, 7, 40, 200, 900):
        for drop in (True, False):  # the partner lacks tokens, or has others in their place
            x = np.sort(rng.integers(0, 1 << 62, size).astype(np.uint64))
            most = size - ngram_join.ceil_share(size, 85) if drop else (size * 15) // 185
            y = np.setdiff1d(x, x[:most])
            y = y if drop else np.sort(np.concatenate([y, rng.integers(0, 1 << 62, most).astype(np.uint64)]))
            a, b = (ngram_join.signatures(s, np.zeros(len(s), bool), 85) for s in (x, y))
            for seed in range(5):  # whatever the order of the tokens, the ends may be left out
                order = lambda s, seed=seed: s[np.argsort(ngram_join._mix(s + np.uint64(seed)))]
                a_, b_ = (order(s)[: len(s) - ngram_join.spare(n, n, 85)] for s, n in ((a, len(x)), (b, len(y))))
                assert len(np.intersect1d(a_, b_)), (size, drop, seed)


def test_sets_with_many_tokens_of_their_own_make_no_candidates(spark):
    # one passage in texts that are else their own: too few tokens are left for a link, so no signature is
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [f"{passage} " + " ".join(f"x{k}_{i}" for i in range(140)) for k in range(30)]
    texts += [" ".join(f"y{k // 2}_{i + k % 2}" for i in range(100)) for k in range(4)]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    shared = spark.sparkContext.broadcast(np.zeros((1 << ngram_join.BITMAP_BITS) // 8, np.uint8))
    signed = docs.mapInArrow(ngram_join._signatures(4, 85, shared), "doc_id long, size int, spare int, sigs array<long>, sketch binary")
    kept = ngram_join._rarest(signed.selectExpr("doc_id", "size", "spare", "explode(sigs) as sig"))
    assert {r["doc_id"] for r in kept.select("doc_id").distinct().collect()} == {30, 31, 32, 33}
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_join(docs, 4, 85).collect()}
    assert got == {**{k: k for k in range(30)}, 30: 30, 31: 30, 32: 32, 33: 32}

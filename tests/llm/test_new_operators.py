"""Operators 11 to 13 against finite differences, enumeration and brute force, and their edge cases."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitals.llm import byte_cnn, conversations, hard_negatives


#: Ids outside the held-out fold.
LEARNT = [i for i in range(1, 40) if zlib.crc32(str(i).encode()) % 3 != 1]


# 11: byte-level network
def test_network_gradients_agree_with_finite_differences():
    model = {k: v.astype(np.float64) for k, v in byte_cnn.fresh(3).items()}
    r = np.random.default_rng(0)
    sample = [r.integers(97, 110, n).astype(np.uint8) for n in (0, 3, 300, 700, 129)]
    labels, weights = np.array([0, 1, 0, 1, 1.0]), np.ones(5)
    grads, _ = byte_cnn.gradients(model, sample, labels, weights)
    for k, at in (("embed", (100, 2)), ("filters", (5, 7)), ("filters_b", (3,)), ("hidden", (2, 4)), ("hidden_b", (4,)), ("out", (4,)), ("out_b", (0,))):
        up, down = ({**model, k: model[k].copy()} for _ in range(2))
        up[k][at] += 1e-6
        down[k][at] -= 1e-6
        slope = (byte_cnn.gradients(up, sample, labels, weights)[1] - byte_cnn.gradients(down, sample, labels, weights)[1]) / 2e-6
        assert grads[k][at] == pytest.approx(slope, rel=1e-4, abs=1e-8)


def test_slabs_cover_the_text_like_one_pass(monkeypatch):
    model = byte_cnn.fresh(5)
    text = "".join(random.Random(2).choices("abcdé .", k=9000))
    whole = byte_cnn.pooled(model, text)
    monkeypatch.setattr(byte_cnn, "SLAB", 3)
    np.testing.assert_allclose(byte_cnn.pooled(model, text), whole, rtol=1e-5)


def test_junk_after_a_long_clean_text_is_seen():
    r = random.Random(4)
    words = ["river", "stone", "light", "under", "garden", "the", "of", "walks"]

    def clean(n):
        return " ".join(r.choice(words) for _ in range(n)) + "."

    def junk(n):
        return " ".join(r.choice(words).upper() + "!!" for _ in range(n))

    sample = [clean(r.randint(5, 200)) for _ in range(80)] + [clean(r.randint(0, 100)) + " " + junk(r.randint(20, 60)) for _ in range(80)]
    labels = np.array([1.0] * 80 + [0.0] * 80)
    model = byte_cnn.train(sample, labels, np.ones(160, np.float32), steps=60)
    assert byte_cnn.probability(model, clean(20000)) > 0.5
    assert byte_cnn.probability(model, clean(20000) + " " + junk(40)) < 0.5


def test_quality_edge_cases(spark):
    a, b, c, d = LEARNT[:4]
    docs = spark.createDataFrame([(a, "plain text here"), (a, "plain text here"), (b, None), (c, ""), (None, "x"), (d, "!! !! !!")], "doc_id long, text string").withColumn("label", F.lit(1)).withColumn("quality", F.lit(0))
    none = spark.createDataFrame([], "doc_id long, quality int")
    for labels, expected in ((none, 0.5), (spark.createDataFrame([(b, 1), (c, None), (d, 7)], "doc_id long, quality int"), 1.0)):
        rows = byte_cnn.score(docs, byte_cnn.fit(docs, labels)).collect()
        assert len(rows) == 6 and all(x.score == pytest.approx(expected, abs=1e-6) for x in rows)
    both = spark.createDataFrame([(b, 1), (c, 1), (d, 0)], "doc_id long, quality int")
    rows = byte_cnn.score(docs, byte_cnn.fit(docs, both)).collect()
    assert len(rows) == 6 and all(0 <= x.score <= 1 for x in rows)
    assert byte_cnn.score(docs.limit(0), byte_cnn.fresh()).count() == 0


def test_quality_sample_is_bounded(spark):
    a, b, c = LEARNT[:3]
    docs = spark.range(400).select(F.element_at(F.array(*(F.lit(i).cast("long") for i in (a, b, c))), (F.col("id") % 3 + 1).cast("int")).alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    labels = spark.createDataFrame([(a, 0), (b, 1), (c, 1)], "doc_id long, quality int")
    held = []
    original = byte_cnn.train
    byte_cnn.train = lambda sample, *_: held.append(sample) or byte_cnn.fresh()
    try:
        byte_cnn.fit(docs, labels, max_rows=10)
    finally:
        byte_cnn.train = original
    assert len(held[0]) == 20


# 12: hard negatives
def brute_negatives(rows, n_positives=5, n_negatives=5, low=80):
    rows = sorted({(i, label, tuple(v)) for i, label, v in rows})
    out = set()
    for a, label, v in rows:
        if a % 100:
            continue

        def score(w, v=v):
            return sum(x * y for x, y in zip(v, w, strict=False))

        same = sorted({(-score(w), i) for i, other, w in rows if other == label and i != a})[:n_positives]
        for s, p in same:
            fit = sorted({(-score(w), i) for i, other, w in rows if other != label and low * -s <= 100 * score(w) <= 100 * -s})[:n_negatives]
            out |= {(a, p, k + 1, i, -s, -t) for k, (t, i) in enumerate(fit)}
    return out


def mined(spark, rows, **kwargs):
    frame = spark.createDataFrame(rows, "vec_id long, label int, vector array<long>")
    return {tuple(r) for r in hard_negatives.mine(frame, F.col("vec_id") % 100 == 0, **kwargs).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_hard_negatives_agree_with_brute_force(spark, seed):
    r = random.Random(seed)
    rows = [(i, r.randint(0, 3), [r.randint(-40, 60) for _ in range(19)]) for i in range(900)]
    copies = [(1000 + i, i % 4, rows[0][2][:-1] + [r.randint(0, 3)]) for i in range(60)]  # near copies of an anchor
    assert mined(spark, rows + copies, block_bytes=1500) == brute_negatives(rows + copies)


def test_hard_negatives_ties_lengths_repeats_and_large_numbers(spark):
    rows = [(0, 1, [3, 4]), (100, 1, [3, 4, 0, 9]), (100, 1, [3, 4, 0, 9]), (200, 2, []), (300, 2, [0, 0]), (400, 3, [-5, -5]), (500, 1, [2**40, 1])]
    rows += [(600 + i, i % 3, [3, 4]) for i in range(1, 30)] + [(700 + i, 2, [2**40, i]) for i in range(1, 4)]
    want = brute_negatives(rows)
    assert want and mined(spark, rows) == want


def test_quantise_leaves_out_broken_rows(spark):
    rows = [(1, 1, [0.5, -0.001]), (2, None, [1.0]), (None, 1, [1.0]), (3, 1, None), (4, 1, [1.0, None]), (5, 1, [float("nan")]), (6, 1, [float("inf")]), (7, 1, [])]
    got = {r.vec_id: r.vector for r in hard_negatives.quantise(spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumn("score", F.lit(1))).collect()}
    assert got == {1: [128, -1], 7: []}
    empty = spark.createDataFrame([], "vec_id long, label int, vector array<long>")
    assert hard_negatives.mine(empty, F.col("vec_id") % 100 == 0).count() == 0


# 13: conversation repair
def cheapest(rows):
    """Every sequence of edits with up to two inserts in a row."""
    best = None

    def go(i, roles, cost, audit):
        nonlocal best
        if best and cost > best[0]:
            return
        for added in ("", "u", "a", "ua", "au"):
            base, done, said = cost + 5 * len(added), roles + added, audit + "I" * len(added)
            if i == len(rows):
                if re.fullmatch("(s?(ua)+)?", done) and (best is None or (base, said) < best):
                    best = base, said
                continue
            role, fault = rows[i]
            go(i + 1, done, base + 2, said + "D")
            if fault != conversations.FORCED:
                more = 5 * (fault == conversations.CUT_OFF)
                if role:
                    go(i + 1, done + "?sua"[role], base + more, said + "K")
                for to in "ua":
                    go(i + 1, done + to, base + 1 + more, said + "R")

    go(0, "", 0, "")
    return best


def test_search_is_optimal_with_the_least_audit():
    r = random.Random(1)
    for _ in range(250):
        rows = [(r.choice([0, 1, 2, 2, 3, 3]), r.choice([0, 0, 0, 1, 2])) for _ in range(r.randint(0, 4))]
        (found,) = conversations.search(rows, {conversations.START: (0, "")}).values()
        assert found == cheapest(rows), rows


def test_windows_give_what_one_search_gives():
    r = random.Random(3)
    for _ in range(100):
        data = [(r.choice(["system", "user", "assistant", "tool", ""]), r.choice(["Hi.", f"no end {i}", "", "x!"])) for i in range(r.randint(0, 60))]
        seen = []
        for window in (3, 7, 1000):
            c = conversations.Conversation(1, window)
            turns = [t for i, (role, text) in enumerate(data) for t in c.add(i, role, text, 1, True)]
            turns += list(c.end())
            seen.append((c.digest(), turns))
        assert seen[0] == seen[1] == seen[2]


def test_long_conversations_hold_few_rows():
    r = random.Random(5)
    c, most = conversations.Conversation(1), 0
    for i in range(20000):
        for _ in c.add(i, r.choice(["user", "assistant", "system"]), r.choice(["Hi.", "cut", " "]), 1, True):
            pass
        most = max(most, len(c.held))
    assert most < 3 * conversations.WINDOW


def test_repair_edge_cases(spark):
    rows = [
        (1, 0, "system", "S."), (1, 1, "user", "Q?"), (1, 2, "assistant", "A."),
        (2, None, None, "null role."), (2, 5, "user", "q?"), (2, 5, "user", "q?"), (2, 9, "assistant", None),
        (None, 0, "user", "x."), (None, 1, "assistant", "y."),
        (3, 0, "user", "same."), (3, 4, "user", "same."), (3, 5, "assistant", "cut"),
        (4, 0, "user", "only"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("key", F.lit("z")).withColumn("copies", F.lit(9))
    got = {r.conv_id: r for r in conversations.repair(frame).collect()}
    digest = lambda *lines: hashlib.sha256("\n".join(lines).encode()).hexdigest()
    assert tuple(got[1]) == (1, 0, 0, 0, 0, 0, 0, "KKK", digest("system:S.", "user:Q?", "assistant:A."))
    # two reroles are cheaper than deleting both rows
    assert tuple(got[2]) == (2, 3, 1, 1, 0, 2, 6, "RRDD", digest("user:null role.", "assistant:q?"))
    assert tuple(got[None])[1:] == (0, 0, 0, 0, 0, 0, "KK", digest("user:x.", "assistant:y."))
    assert got[3].duplicate == 1 and got[3].truncated == 1 and got[3].gaps == 3
    assert (got[4].cost, got[4].audit, got[4].repaired_sha256) == (2, "D", digest())
    turns = sorted(tuple(r) for r in conversations.repaired_turns(frame.where("conv_id = 1")).collect())
    assert turns == [(1, 0, "K", "system", "S."), (1, 1, "K", "user", "Q?"), (1, 2, "K", "assistant", "A.")]
    assert conversations.repair(frame.limit(0)).count() == 0


def test_damage_by_kind(spark):
    rows = [(i, t, "assistant" if t % 2 else "user", f"a.b!c? {t}.") for i in range(12) for t in range(6)]
    got = sorted(tuple(r) for r in conversations.damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect())
    want = []
    for i, t, role, text in rows:
        kind = zlib.crc32(f"{i}:{t}".encode()) % 20
        row = (i, t, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
        want += [row] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert got == sorted(want)


def test_queries_run_over_edge_case_tables(spark, tmp_path):
    from vitals.llm import queries

    spark.createDataFrame([(1, None, "x"), (None, "", "y"), (1, "word " * 3000, "z")], "doc_id long, text string, score string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (100, [], 1), (7, [1.0], 9), (None, [1.0], 1)], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    spark.createDataFrame([(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, None, None, None), (None, 3, "tool", "x" * 5000), (2, 1, "", "")], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert len(queries.op11_quality(spark, str(tmp_path)).collect()) == 3
    assert queries.op12_hard_negatives(spark, str(tmp_path)).count() >= 0
    repaired = {r.conv_id: r for r in queries.op13_conversation_repair(spark, str(tmp_path)).collect()}
    assert set(repaired) == {1, 2, None} and repaired[1].duplicate == 1

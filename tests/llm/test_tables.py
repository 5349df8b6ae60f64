"""Every query of the training-data operators on an edge-case table and on an empty one."""

from __future__ import annotations

import base64
import datetime as dt
import hashlib
import os
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vitals.llm import decontam, html_extract, mixing, ngram_join, queries, rans, substrings, tokens, toxicity, vectors, warc
from vitals.llm.bpe import WordEncoder

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, copies int"
PASSAGE = " ".join(f"wort{i}" for i in range(90))
LONG = "a b c d e f g h " * 4000


def _docs():
    rows = [
        (1, "The quick idiot fox, moron! " + PASSAGE, "en", "s1"),
        (2, PASSAGE + " end", "en", "s1"),
        (3, PASSAGE + " END", "en", None),
        (4, None, None, "s2"),
        (5, "", "de", "s2"),
        (6, " \t\n", None, "s2"),
        (7, LONG, "fr", "s1"),
        (8, "Straße ÉTÉ 日本語 😀 x", "de", "s3"),
        (9, "one two", None, "s3"),
        (9, "one two", None, "s3"),
        (9, "other words here now", "en", "s3"),
        (None, "null id text", "en", "s3"),
    ]
    return [(i, t, la, s, None if t is None else len(t), "clash", 1) for i, t, la, s in rows]


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("edge")
    spark.createDataFrame(_docs(), DOCS).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([("q1", PASSAGE), ("q2", "One TWO"), (None, "quick idiot fox"), ("q4", None), ("q5", "")], "item_id string, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 1), (2, 1, 0), (3, 0, None), (4, 1, 0), (8, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    html = "<body><nav><a href='/'>menu</a></nav><article><h1>T &amp; é</h1><p>One <b>two</b>\n three<p>four</article><footer>foot</footer></body>"
    pages = [(1, "http://h.org/1", html), (2, "http://h.org/2", html), (3, None, None), (4, "http://x.org", ""), (5, "u\r\nv", "é" * 40000 + "\r\n\r\nWARC/1.1\r\n"), (6, "http://h.org/3", "plain <b>text"), (7, "http://h.org/4", "")]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{d}/pages.parquet")
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 16))
    vecs = [(i, v.tolist()) for i, v in enumerate(base)] + [(100 + i, (base[0] + 0.05 * rng.standard_normal(16)).tolist()) for i in range(30)]
    vecs += [(200, base[5].tolist()), (201, None), (202, [0.0] * 16), (203, [float("nan")] * 16), (204, [None] * 16), (205, [1.0]), (205, base[6].tolist()), (206, (3 * base[7]).tolist())]
    vecs = [(i, v, None if i == 3 else i % 10) for i, v in vecs]
    spark.createDataFrame(vecs, "vec_id long, embedding array<double>, label int").write.parquet(f"{d}/embeddings.parquet")
    turns = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, None, None, None), (None, 3, "tool", "x" * 5000), (2, 1, "", "")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{d}/conversations.parquet")
    return str(d)


@pytest.fixture(scope="module")
def empty(spark, sf, tmp_path_factory):
    d = tmp_path_factory.mktemp("empty")
    for name in ("documents", "benchmark", "labels", "pages", "embeddings", "conversations"):
        spark.read.parquet(f"{sf}/{name}.parquet").limit(0).write.parquet(f"{d}/{name}.parquet")
    return str(d)


def rows(df):
    return [r.asDict() for r in df.collect()]


def key(i):
    return (i is not None, i or 0)


def test_token_files_round_trip(spark, sf):
    got = sorted(rows(queries.op1_token_ids(spark, sf)), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in _docs()), key=key) and all(r["block_ok"] for r in got)
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.word_tokenizer())
    want = sorted((key(i), len(e), zlib.crc32(np.array(e, "<u4").tobytes())) for i, t, *_ in _docs() for e in [tok.encode(t or "", add_special_tokens=False).ids + [1]])
    assert sorted((key(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == want
    assert [r["start"] for r in got] == np.concatenate([[0], np.cumsum([r["n_tokens"] for r in got])[:-1]]).tolist()


def test_rans_checkpoints_and_checksums(spark, sf, tmp_path):
    rng = np.random.default_rng(1)
    ids = rng.zipf(1.3, 5000) % 1000
    table = rans.Table(rans.quantise(np.bincount(ids, minlength=1000), 16), 16)
    for n in (0, 1, 63, 64, 65, 5000):
        coded = rans.encode(ids[:n], table, 64, 8)
        assert (rans.decode(*coded, n, table, 64, 8) == ids[:n]).all()
        for part in range(len(coded[2])):
            assert (rans.decode(*coded, n, table, 64, 8, part=part) == ids[:n][part * 512 : (part + 1) * 512]).all()
    out = str(tmp_path / "t")
    tokens.write_tokens(spark.read.parquet(f"{sf}/documents.parquet"), out, queries.word_tokenizer(), block_tokens=100, lanes=8, checkpoint=4)
    assert sum(r["n_tokens"] for r in rows(tokens.read_tokens(spark, out))) == sum(r["n_tokens"] for r in rows(queries.op1_token_ids(spark, sf)))


def test_word_encoder_equals_the_library():
    enc = WordEncoder(queries.word_tokenizer())
    for t in ["a'sb don't I'LL ''s !!'s 'S x's", "K Å İ ΣΣ ẞ", "é x ́a", "a b\tc\r\nd\x1cf", "12 3a4 _x_", "<|endoftext|> x<|startoftext|>y <|END", "中文 😀", "ªºµ"]:
        assert np.frombuffer(enc.encode(t), enc.dtype).tolist() == enc.tok.encode(t, add_special_tokens=False).ids


def test_batches_and_small_caches_encode_alike():
    many = ["", " ", "a  b", "\n\n", "x\ty", "éİ ẞ", "<|endoftext|> a", *(f"w{i} word{chr(97 + i % 26) * (i % 7)}, of" for i in range(60))] * 2
    enc, small = WordEncoder(queries.word_tokenizer()), WordEncoder(queries.word_tokenizer(), 5, 3)
    want = [enc.tok.encode(t, add_special_tokens=False).ids for t in many]
    for most in (1, 40, 1 << 20):
        assert [a.tolist() for a in enc.encode_all(many, most)] == want
        assert [a.tolist() for a in small.encode_all(many, most)] == want
    assert max(len(small.words), len(small.words.older)) <= 5
    assert list(enc.encode_all([])) == []


def test_forms_of_a_word_pass_the_tokenizer_as_one_part():
    enc, made = WordEncoder(queries.word_tokenizer()), []
    make, enc.words.make = enc.words.make, lambda part: made.append(part) or make(part)
    many = ["Größe größe, GRÖSSE", "größe. Größe... größe,,", "word Word WORD, word's ſ÷ Ÿes"] * 2
    want = [enc.tok.encode(t, add_special_tokens=False).ids for t in many]
    assert [a.tolist() for a in enc.encode_all(many, 30)] == want
    assert sorted(made) == sorted(["größe", "grösse", "word", "", ",", ".", "...", ",,", "word's", "ſ÷", "Ÿes"])
    assert [a.tolist() for a in enc.encode_all(pa.array([None, *many, None]))] == [[], *want, []]


def test_small_batches_are_encoded_together():
    rows_ = [(i, None if i % 5 == 3 else f"text {i:02}") for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows_]), pa.array([t for _, t in rows_])], names=["doc_id", "text"])
    cut = [batch.slice(i, 5) for i in range(0, 40, 5)]
    for most, n in ((1 << 20, 1), (2 * cut[0].nbytes + 8, 4), (1, 8)):
        got = list(tokens._stretches(iter(cut), most))
        assert len(got) == n
        assert [r for ids, texts in got for r in zip(ids, texts.to_pylist(), strict=True)] == rows_
    assert list(tokens._stretches(iter([]))) == []


def test_mix_meets_targets(spark, sf):
    got = rows(queries.op2_mixing(spark, sf))
    assert sorted(key(r["doc_id"]) for r in got) == sorted(key(r[0]) for r in _docs())
    size = {"s1": 0, "s2": 0, "s3": 0, None: 0}
    for _, t, _, s, *_ in _docs():
        size[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    weight, total = {"s1": 5, "s2": 2, "s3": 1, None: 5}, sum(size.values())
    full: set = {s for s in size if not size[s]}
    while True:
        m = (total - sum(3 * size[s] for s in full)) / sum(weight[s] for s in size if s not in full)
        more = {s for s in size if s not in full and m * weight[s] > 3 * size[s]}
        if not more:
            break
        full |= more
    for s in size:
        target = 3 * size[s] if s in full else m * weight[s]
        mine = [r for r in got if r["source_size"] == size[s]]
        assert mine and all(abs(r["target"] - target) < 1e-6 for r in mine)
    assert all(0 <= r["copies"] <= 3 and r["taken"] <= 3 * r["size"] for r in got)
    assert sorted(map(str, got)) == sorted(map(str, rows(queries.op2_mixing(spark, sf))))


def test_mix_splits_large_cells(spark):
    docs = spark.range(60_000).selectExpr("id AS doc_id", "'a b c' AS text", "CASE WHEN id < 50000 THEN 'x' ELSE 'y' END AS source")
    by = mixing.mix(docs).groupBy("source").agg({"copies": "sum"}).collect()
    assert sum(r[1] for r in by) == 60_000 and abs({r[0]: r[1] for r in by}["x"] - 60_000 * 5 / 7) <= 1


def _contaminated(benchmark):
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

    def w(t):
        return word.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))

    wins: dict = {}
    for item, text in benchmark:
        x = w(text)
        for i in range(max(1, len(x) - 12) if x else 0):
            wins.setdefault(tuple(x[i : i + 13]), set()).add(item)
    for i, t, *_ in _docs():
        x, items = w(t), set()
        hit = np.zeros(len(x), bool)
        for g, who in wins.items():
            for k in range(len(x) - len(g) + 1):
                if tuple(x[k : k + len(g)]) == g:
                    hit[k : k + len(g)] = True
                    items |= who - {None}
        n = int(hit.sum())
        yield i, len(x), n, len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), n > 0 and 20 * n >= len(x)


def test_decontamination(spark, sf):
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = sorted(map(str, _contaminated(bench)))
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    got = rows(queries.op3_decontamination(spark, sf))
    assert sorted(str(tuple(r[n] for n in names)) for r in got) == want
    docs, b = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    whole, sliced = (sorted(str((r["doc_id"], r["items"], r["hit_words"], r["spans"])) for r in rows(decontam.decontaminate(docs, b, slice_windows=n))) for n in (10**6, 20))
    assert whole == sliced
    span = next(r for r in rows(decontam.decontaminate(docs, b)) if r["doc_id"] == 2)["spans"][0]
    assert _docs()[1][1][span["start"] : span["end"]] == PASSAGE


def test_toxicity_and_language_edge_cases(spark, sf, empty):
    t = rows(queries.op4_toxicity(spark, sf))
    assert len(t) == len(_docs()) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in t)
    g = {r["doc_id"]: r for r in rows(queries.op5_language(spark, sf))}
    assert all(g[i]["lang_pred"] == "und" and g[i]["score"] == 0 for i in (4, 5, 6)) and g[7]["lang_pred"] != "und"
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in g.items() if i is not None)


def test_toxicity_and_language_held_out(spark):
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    scored = queries.op4_toxicity(spark, d).join(labels, "doc_id").where("held_out").toPandas()
    pos, neg = scored[scored.toxic == 1].score.to_numpy(), scored[scored.toxic == 0].score.to_numpy()
    assert (pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean() > 0.9
    lang = queries.op5_language(spark, d).join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (lang.lang == lang.lang_pred).mean() > 0.97


def _components(docs, n, percent):
    sets, up = {}, {}
    for i, t in docs:
        w = [x for x in re.split("[\x09-\x0d ]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) if x]
        k = min(n, len(w))
        sets.setdefault(i, []).append(frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if w else frozenset())
    up = {i: i for i in sets}

    def root(x):
        return x if up[x] == x else root(up[x])

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                ra, rb = root(a), root(b)
                up[max(ra, rb)] = min(ra, rb)
    return {i: root(i) for i in ids}


def test_ngram_join_brute_force(spark, sf, monkeypatch):
    words = [f"w{i}" for i in range(40)]
    rng = np.random.default_rng(5)
    base = [words[int(i)] for i in rng.integers(0, 40, 90)]
    docs = [(i, t) for i, t, *_ in _docs() if i is not None]
    for i in range(60):  # near copies at all distances, long and short
        w = list(base[: 30 + 60 * (i % 2)])
        for at in rng.integers(0, len(w), int(rng.integers(0, 5))):
            w[at] = f"x{rng.integers(0, 3)}"
        docs.append((1000 + i, " ".join(w)))
    monkeypatch.setattr(ngram_join, "LOCAL", 2)
    monkeypatch.setattr(ngram_join, "FREQUENT", 3)  # the code's classes on small data
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    for n, percent in ((4, 85), (5, 80)):
        got = {r["doc_id"]: r["component_id"] for r in rows(ngram_join.jaccard_join(df, n, percent))}
        assert got == _components(docs, n, percent)
    got = rows(queries.op6_ngram_join(spark, sf))
    assert len(got) == len(_docs()) and all(r["n_shingles"] == 0 for r in got if r["doc_id"] in (4, 5, 6))


def test_ngram_join_rows_left_after_the_pivots(spark, monkeypatch):
    # near copies of one text with a few words exchanged; without pivot rounds all of them are joined anew
    rng = np.random.default_rng(6)
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join(f"x{k}_{i}" if rng.random() < 0.04 * (k % 4) else w for i, w in enumerate(base)) for k in range(40)]
    docs = [(k, t) for k, t in enumerate([*texts, texts[3], "", None, "one two"])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = _components(docs, 4, 85)
    assert 1 < len(set(want.values())) < len(docs)
    for pivots, earlier in ((0, 64), (0, 0), (1, 2)):
        monkeypatch.setattr(ngram_join, "PIVOTS", pivots)
        monkeypatch.setattr(ngram_join, "EARLIER", earlier)
        assert {r["doc_id"]: r["component_id"] for r in rows(ngram_join.jaccard_join(df, 4, 85))} == want


def test_signatures_are_shared_by_linked_sets():
    rng = np.random.default_rng(2)
    for size in (2, 5, 40, 60, 64, 70, 900, 1030):
        for share in (0.0, 0.5, 1.0):
            x = np.sort(rng.integers(0, 1 << 62, size).astype(np.uint64))
            often = lambda s, share=share: ngram_join._mix(s) % np.uint64(1000) < np.uint64(int(share * 1000))
            y = x.copy()
            t = 0
            while 100 * (size - t - 1) >= 85 * (size + t + 1):
                t += 1
            y[rng.choice(size, t, replace=False)] = rng.integers(0, 1 << 62, t).astype(np.uint64)
            y = np.sort(y)
            a, b = (ngram_join.signatures(s, often(s), 85) for s in (x, y))
            assert t == 0 or len(np.intersect1d(a, b))


def test_warc_round_trip(spark, sf, tmp_path):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    first: dict = {}
    want = []
    for r in sorted(rows(pages), key=lambda r: r["page_id"]):
        p = (r["html"] or "").encode()
        f = first.setdefault(p, r["page_id"])
        want.append((r["page_id"], len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if f == r["page_id"] else "revisit", None if f == r["page_id"] else f))
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    got = rows(queries.op7_warc(spark, sf))
    assert sorted(tuple(r[n] for n in names) for r in got) == want and not any(r["error"] for r in got)
    for size in (40, 1000):
        out = str(tmp_path / f"w{size}")
        warc.write_warc(pages, out, segment_bytes=size)
        again = rows(warc.resolve(warc.read_warc(spark, out)))
        assert sorted(tuple(r[n] for n in names) for r in again) == want


def test_warc_faults_are_reported():
    parts = [warc.parse(r) for r in warc.records(1, "u", "x" * 300, None, 100)]
    named = [dict(zip(("type", "record_id", "origin", "number", "total", "refers_to", "block", "error"), p, strict=True)) for p in parts]
    assert warc.payload_of(warc.reassemble(named[::-1])[0][0]) == b"x" * 300
    assert warc.reassemble(named[:1] + named[2:])[0][1] == "segment missing"
    named[1]["block"] += b"y"
    assert warc.reassemble(named)[0][1] == "total length wrong"


def _stripped(texts, length):
    data = [(t or "").encode() for t in texts]
    seen: dict = {}
    for d in data:
        for i in range(len(d) - length + 1):
            seen[d[i : i + length]] = seen.get(d[i : i + length], 0) + 1
    for d in data:
        hit = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                hit[i : i + length] = True
        runs = int((np.diff(np.concatenate([[0], hit.astype(int)])) == 1).sum())
        yield len(d), int(hit.sum()), runs, hashlib.sha256(np.frombuffer(d, np.uint8)[~hit].tobytes()).hexdigest()


def test_repeated_substrings_brute_force(spark, sf, monkeypatch):
    got = rows(queries.op8_repeated_substrings(spark, sf))
    want = sorted(_stripped([t for _, t, *_ in _docs()], 400))
    assert sorted((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == want
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = sorted(_stripped(texts, 100))
    for hot in (substrings.HOT, 1):  # indexed, and dealt by windows
        monkeypatch.setattr(substrings, "HOT", hot)
        got = rows(substrings.strip_repeats(df, 100))
        assert sorted((r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in got) == want


def test_run_index_matches():
    strings = [b"abracadabra", b"cadabra!", b"xyz", b"abra"]
    index = substrings.RunIndex(strings)
    flat = [s + bytes([0, i]) for i, s in enumerate(strings)]
    for s, a in zip(strings, index.start.tolist(), strict=True):
        for i in range(len(s)):
            best = 0
            for t, f in zip(strings, flat, strict=True):
                for j in range(len(t)):
                    if t is s and i == j:
                        continue
                    n = 0
                    while i + n < len(s) and j + n < len(t) and s[i + n] == t[j + n]:
                        n += 1
                    best = max(best, n)
            assert max(index.before[a + i], index.after[a + i]) == best


def test_run_index_of_repetitive_strings():
    rng = np.random.default_rng(5)
    for letters in (1, 2, 4):
        for _ in range(12):
            strings = [bytes(rng.integers(97, 97 + letters, rng.integers(1, 40)).tolist()) for _ in range(rng.integers(1, 8))]
            index = substrings.RunIndex(strings)
            suffixes = [(i, a, s[a:]) for i, s in enumerate(strings) for a in range(len(s))]
            for i, a, s in suffixes:
                best = max((len(os.path.commonprefix([s, t])) for j, b, t in suffixes if (j, b) != (i, a)), default=0)
                at = index.start[i] + a
                assert max(index.before[at], index.after[at]) == best


def test_warc_records_are_framed_by_their_length():
    inner = b"before" + warc.SEPARATOR + b"WARC-Type: response\r\nContent-Length: 3\r\n\r\nabc" + warc.SEPARATOR + b"after"
    head = b"WARC-Type: response\r\nWARC-Record-ID: <urn:page:1:x>\r\nContent-Length: %d\r\n\r\n"
    http = b"HTTP/1.1 200 OK\r\n\r\n"
    plain = head % (len(http) + 4) + http + b"text"
    foreign = head % (len(http) + len(inner)) + http + inner
    wrong = head % 10_000 + http + b"short"
    for order in ([plain, foreign, plain], [foreign], [wrong, plain, foreign], [foreign, wrong, plain], [plain, foreign, wrong]):
        data = warc.VERSION + warc.SEPARATOR.join(order) + warc.END
        pieces = data.split(warc.SEPARATOR) * 2  # two files, as one task reads them
        got = [warc.parse(r) for r in warc.framed(iter(pieces))]
        assert [(r[7] is None, None if r[7] else warc.payload_of(r[6])) for r in got] == [(r is not wrong, {plain: b"text", foreign: inner}.get(r)) for r in order] * 2


def test_warc_files_of_other_writers(spark, tmp_path):
    inner = b"x" + warc.SEPARATOR + b"y"
    http = b"HTTP/1.1 200 OK\r\n\r\n" + inner
    record = b"WARC-Type: response\r\nWARC-Record-ID: <urn:page:7:x>\r\nContent-Length: %d\r\n\r\n%b" % (len(http), http)
    (tmp_path / "one.warc").write_bytes(warc.VERSION + warc.SEPARATOR.join([record, record]) + warc.END)
    got = rows(warc.read_warc(spark, str(tmp_path)))
    assert [(r["payload"], r["error"]) for r in got] == [(inner, None)] * 2


def test_warc_records_carry_their_date(spark, sf, tmp_path):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    warc.write_warc(pages, str(tmp_path / "w"), segment_bytes=1000, date=dt.datetime(2024, 2, 29, 1, 2, 3, tzinfo=dt.UTC))
    records = [r["value"] for r in spark.read.option("lineSep", warc.SEPARATOR.decode()).text(str(tmp_path / "w")).collect() if r["value"].strip()]
    assert records and all("WARC-Date: 2024-02-29T01:02:03Z\r\n" in r.split("\r\n\r\n")[0] + "\r\n" for r in records)


def _vector_truth(table):
    good = [(i, np.array(v, float)) for i, v in table if v is not None and len(v) == 16 and None not in v and np.isfinite(v).all() and np.any(v)]
    u = np.array([v / np.linalg.norm(v) for _, v in good])
    ids, close = [i for i, _ in good], u @ u.T >= 0.9
    return ids, close


def test_near_vectors_brute_force(spark, sf):
    table = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    ids, close = _vector_truth(table)
    for block in (vectors.BLOCK, 8):
        got = rows(vectors.near_vectors(spark.read.parquet(f"{sf}/embeddings.parquet"), block=block))
        assert len(got) == len(table)
        links = sum(r["n_links"] for r in got)
        assert 0.9 * (close.sum() - len(ids)) <= links <= close.sum() - len(ids)
        by = {r["vec_id"]: r for r in got}
        assert all(by[i]["n_links"] == 0 and by[i]["kept"] for i in (201, 202, 203, 204))
        assert by[200]["component_id"] == 5 and by[206]["component_id"] == 7 and by[129]["component_id"] == 0


def test_vectors_of_every_length_meet_their_own(spark):
    rng = np.random.default_rng(8)
    table = []
    for dim in (1, 3, 16, 40):
        base = rng.standard_normal((3 if dim == 3 else 12, dim))
        table += [v.tolist() for v in base] + [(2 * base[0]).tolist(), (base[1] + 0.02 * rng.standard_normal(dim)).tolist()]
    table = list(enumerate([*table, [], [1.0, None], [1.0, float("inf")]]))
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in rows(vectors.near_vectors(df))}
    units = {i: np.array(v, float) for i, v in table if v and None not in v and np.isfinite(v).all()}
    units = {i: v / np.linalg.norm(v) for i, v in units.items()}
    want = {i: sum(j != i and len(u) == len(v) and float(u @ v) >= 0.9 for j, u in units.items()) for i, v in units.items()}
    assert {i: r["n_links"] for i, r in got.items()} == {i: want.get(i, 0) for i, _ in table}
    assert all(got[i]["kept"] for i, _ in table if not want.get(i))


def test_repeated_rows_do_not_fill_the_toxicity_sample(spark, monkeypatch):
    docs = [(1, "bad word here")] * 500 + [(2, f"other text {i}") for i in range(500)] + [(i, "plain clean text") for i in range(10, 60)]
    labels = spark.createDataFrame([(1, 1), (2, 1), (10, 0), (11, 0)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "FOLDS", 3)
    seen = {}
    monkeypatch.setattr(toxicity, "train", lambda r, c, k, n_p, n_u, prior: (seen.update(p=n_p, u=n_u), (np.zeros(k), 0.0))[1])
    everything = F.lit(0)
    monkeypatch.setattr(toxicity, "fold", lambda *a: everything)
    toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string"), labels, max_positive=50, max_unlabelled=100)
    assert 0 < seen["p"] <= 90 and 0 < seen["u"] <= 170


def test_main_text(spark, sf):
    got = {r["page_id"]: r for r in rows(queries.op10_main_text(spark, sf))}
    assert got[1]["text"] == got[2]["text"] == "T & é\n\nOne two three\n\nfour" and got[1]["n_chars"] == len(got[1]["text"])
    assert got[3]["text"] == got[4]["text"] == got[7]["text"] == "" and got[6]["text"] == "plain text"


def test_boilerplate_is_left_out():
    page = (
        "<html><body><header>top</header><div id=cookie-notice>We use cookies</div><div class='main-content'><div class=breadcrumbs>a / b</div><h2>Head</h2>"
        "<p>First<br>line &lt;1&gt;</p><script>var x='<p>no</p>'</script><ul><li>one<li>two</ul><aside>aside</aside><form><input>go</form><table><tr><td>cell</td></tr></table>"
        "<div class='ad-slot'>buy</div><div class=share>share</div></div><section id=comments><p>A very long reader comment that goes on and on and on and on.</p></section><footer>end</footer></body></html>"
    )
    assert html_extract.extract(page, None).split("\n\n") == ["Head", "First line <1>", "one", "two", "cell"]


def test_broken_pages_are_read_in_linear_time():
    parts = ['<a "', '<a ">', "<div class='x ", "<div>", '<div class="a b"><p>t', "</b>", "<!", "<b><div></div>", "<" + "a" * 50, '<p x="> "', "<i a" + "b" * 40 + " ", '<div class="' + "_advert" * 20 + '">']
    for part in parts:
        page = part * (1_000_000 // len(part))
        began = time.process_time()
        html_extract.read(page)
        html_extract.scores(page)
        assert time.process_time() - began < 60, part
    deep = "<div>" * 30_000 + "<b>" * 30_000 + "text" + "</i></b>" * 60_000
    assert html_extract.extract(deep, None) == "text"


def test_quoted_values_and_unclosed_ones():
    assert html_extract.extract('<p title="a > b">one</p><p title=\'>"\'>two</p>', None) == "one\n\ntwo"
    assert html_extract.extract('<p>one</p><p title="a>two</p><p>three</p>', None) == "one\n\ntwo\n\nthree"
    assert html_extract.extract("<p>a < b</p><p>c <d", None) == "a < b\n\nc <d"


def test_host_path_wins_over_the_page(spark):
    # on this page alone the sidebar's text is the longest; its host's other pages have theirs in the post
    def page(post, box):
        return f"<body><div class=post><p>{post}</p></div><div class=box><p>{box}</p></div></body>"

    long, short = "many words of text " * 30, "few words"
    pages = [(i, f"http://h.org/{i}", page(long, short)) for i in range(5)] + [(9, "http://h.org/9", page(short, long)), (10, "http://o.org/1", page(short, long))]
    got = {r["page_id"]: r["text"] for r in rows(html_extract.extract_main_text(spark.createDataFrame(pages, "page_id long, url string, html string")))}
    # an independent vote: letters of either container by host
    votes = {}
    for _, url, html in pages:
        for name in ("post", "box"):
            text = re.search(f"<div class={name}><p>(.*?)</p>", html)[1]
            votes.setdefault(url[:12], {}).setdefault(name, 0)
            votes[url[:12]][name] += len(text)
    for i, url, html in pages:
        best = max(votes[url[:12]], key=votes[url[:12]].get)
        assert got[i] == re.search(f"<div class={best}><p>(.*?)</p>", html)[1].strip()


def test_empty_tables(spark, empty):
    for name, query in queries.queries().items():
        assert rows(query(spark, empty)) == [], name
    assert rows(corpus_pipeline.run(spark, empty)) == []


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    kept = rows(corpus_pipeline.drop_near_copies(spark, docs, sf))
    # a node is a doc_id with its text; of each group that with the smallest doc_id stays, rows without words or doc_id do
    order = sorted({(i, t) for i, t, *_ in _docs() if i is not None and (t or "").strip()})
    truth = _components(list(enumerate(t for _, t in order)), 5, 80)
    want = [order[k] for k in truth if truth[k] == k] + [(i, t) for i, t, *_ in _docs() if i is None or not (t or "").strip()]
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted(want, key=str)
    clean = rows(corpus_pipeline.drop_contaminated(spark, docs, sf))
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert len(clean) == sum(not c[-1] for c in _contaminated(bench)) and list(clean[0]) == columns
    mixed = corpus_pipeline.mix_sources(spark, docs, sf)
    taken = sum(r["copies"] for r in rows(mixing.mix(docs)))
    assert mixed.columns == columns and mixed.count() == taken
    # columns named like the stages' own ones are carried along as they are
    clash = docs.select("*", *(F.lit(f"own {c}").alias(c) for c in ("m_id", "k_id", "m_words", "b_key", "m_take", "k_row")))
    for step in (corpus_pipeline.drop_near_copies, corpus_pipeline.drop_contaminated, corpus_pipeline.mix_sources):
        out = rows(step(spark, clash, sf))
        assert len(out) == step(spark, docs, sf).count() and all(r["m_id"] == "own m_id" and r["m_words"] == "own m_words" and r["b_key"] == "own b_key" for r in out)
    assert corpus_pipeline.drop_toxic(spark, docs, sf).columns == columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "decontamination", "mixing", "token_output"]

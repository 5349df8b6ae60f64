"""Operator 3: benchmark decontamination with one Aho-Corasick automaton.

Every window of 13 item words is a pattern, spelled out as blank-separated normalised words. Each
document is normalised byte by byte (so offsets are kept), scanned once, and every word inside a
match is marked; matches are mapped back to character offsets of the original text.

The benchmark is shipped to the executors only in slices of at most ``SLICE_WINDOWS`` windows; a larger
one is scanned slice by slice and the hits are united.

Cases: null text (documents or items) has no words; an item of fewer than 13 words, but not none, is
one window; equal windows of several items count for each of them; items with a null id mark words
but are not listed; an empty benchmark hits nothing; repeated rows are judged each; an empty table
gives no rows.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitals.llm.common import prepare, rows_batches, stage, texts

WINDOW = 13
#: Windows of one automaton: at about 200 bytes a window, and a few kB of trie each, under 500 MB.
SLICE_WINDOWS = 50_000

#: A-Z to a-z; ASCII letters and digits and all other bytes of UTF-8 stay; the rest are gaps.
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))



def _words(text: str) -> tuple[bytes, list[bytes]]:
    flat = text.encode("utf-8", "surrogatepass").translate(NORMAL)
    return flat, flat.split()


def _windows(size: int):
    def rows(batches):
        for batch in batches:
            for item, text in zip(batch.column("item_id").to_pylist(), texts(batch), strict=True):
                w = _words(text)[1]
                for i in range(max(1, len(w) - size + 1) if w else 0):
                    yield b" ".join(w[i : i + size]), item

    return lambda batches: rows_batches(rows(batches), pa.schema([("pattern", pa.binary()), ("item", pa.string())]))


_BUILT: dict[str, object] = {}


def _automaton(shared):
    """One automaton for each worker process and slice."""
    import ahocorasick

    key, patterns, _ = shared.value
    if key not in _BUILT:
        _BUILT.clear()
        a = ahocorasick.Automaton()
        for at, pattern in enumerate(patterns):
            a.add_word(" " + pattern.decode("latin-1") + " ", at)
        if patterns:
            a.make_automaton()
        _BUILT[key] = a
    return _BUILT[key]


_OUT = "doc_id long, row_hash long, n_words long, items array<string>, hit_words array<int>, spans array<struct<first:int,last:int,start:int,end:int>>"
_SPAN = pa.struct([(n, pa.int32()) for n in ("first", "last", "start", "end")])
_OUT_PA = pa.schema([("doc_id", pa.int64()), ("row_hash", pa.int64()), ("n_words", pa.int64()), ("items", pa.list_(pa.string())), ("hit_words", pa.list_(pa.int32())), ("spans", pa.list_(_SPAN))])


def _spans(flat: bytes, hit: np.ndarray) -> list[dict]:
    """The runs of hit words: first and last word, and character offsets in the original text."""
    raw = np.frombuffer(flat, np.uint8)
    gap = raw == 32
    edge = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8)))
    first, last = edge[::2], edge[1::2]
    run = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return [{"first": int(a), "last": int(b) - 1, "start": int(chars[first[a]]), "end": int(chars[last[b - 1]])} for a, b in zip(run[::2], run[1::2], strict=True)]


def _scan(shared):
    def rows(batches):
        auto = _automaton(shared)
        _, patterns, owners = shared.value
        for batch in batches:
            for doc_id, row_hash, text in zip(batch.column("doc_id").to_pylist(), batch.column("row_hash").to_pylist(), texts(batch), strict=True):
                flat, found = _words(text)
                hit, items, spans = [], [], []
                if found and len(patterns):
                    line = b" " + b" ".join(found) + b" "
                    matches = list(auto.iter(line.decode("latin-1")))
                    if matches:
                        blank = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
                        mark = np.zeros(len(found), bool)
                        for end, at in matches:
                            a = int(np.searchsorted(blank, end - len(patterns[at]) - 1))
                            mark[a : a + patterns[at].count(b" ") + 1] = True
                        items = sorted({i for at in {at for _, at in matches} for i in owners[at]})
                        hit, spans = np.flatnonzero(mark), _spans(flat, mark)
                yield doc_id, row_hash, len(found), items, hit, spans

    return lambda batches: rows_batches(rows(batches), _OUT_PA)


def _unite(slices: int):
    def rows(batches):
        for batch in batches:
            for r in batch.to_pylist():
                spans: list[dict] = []
                for x in sorted(r["spans"], key=lambda x: (x["first"], x["last"])):
                    if spans and x["first"] <= spans[-1]["last"] + 1:
                        if x["last"] > spans[-1]["last"]:
                            spans[-1] |= {"last": x["last"], "end": x["end"]}
                    else:
                        spans.append(dict(x))
                for _ in range(r["n"] // slices):
                    yield r["doc_id"], r["row_hash"], r["n_words"], sorted(r["items"]), sorted(r["hit_words"]), spans

    return lambda batches: rows_batches(rows(batches), _OUT_PA)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slice_windows: int = SLICE_WINDOWS) -> DataFrame:
    """One row per document row: doc_id, row_hash (of doc_id and text), n_words, items (ids with an
    occurring window), hit_words (indices) and spans (character offsets in the original text)."""
    spark = prepare(docs.sparkSession)
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    windows = stage(items.mapInArrow(_windows(window), "pattern binary, item string").groupBy("pattern").agg(F.collect_set("item").alias("items")), "decontam-windows")
    slices = max(1, -(-windows.count() // slice_windows))
    out = None
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row_hash"), "text")
    for k in range(slices):
        part = windows if slices == 1 else windows.where(F.pmod(F.xxhash64("pattern"), F.lit(slices)) == k)
        held = part.orderBy("pattern").collect()  # at most about slice_windows rows
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, [bytes(r["pattern"]) for r in held], [r["items"] for r in held]))
        one = rows.mapInArrow(_scan(shared), _OUT)
        out = one if out is None else out.unionAll(one)
    if slices > 1:
        # the slices' hits of a row are united; equal rows have equal results, each of which comes back
        out = (
            out.groupBy("doc_id", "row_hash", "n_words")
            .agg(F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"), F.array_distinct(F.flatten(F.collect_list("hit_words"))).alias("hit_words"), F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"), F.count("*").alias("n"))
            .mapInArrow(_unite(slices), _OUT)
        )
    return out


def is_contaminated():
    """The contract's rule on n_words and hit_words."""
    return (F.size("hit_words") > 0) & (F.size("hit_words") * 20 >= F.col("n_words"))

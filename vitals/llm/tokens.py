"""Operator 1: token ids in rANS-coded block files.

Layout of a written folder (plain Parquet, so Spark's commit protocol and any store work):

* ``symbols``: (id, freq) – the frequency table shared by all blocks;
* ``blocks/shard=K``: one row per block of whole documents in ascending doc_id order, with its
  absolute ``start``, the documents' ids and lengths, the interleaved rANS words, the lane states and
  word offsets of its checkpoints, and crc32 checksums of words and ids.

Blocks are independent, so they decode in parallel; checkpoints allow to decode from within a block.

Cases: a null text is empty and gives the end id alone; null doc_ids come first; rows with the same
doc_id are kept, ordered by a hash of their text; an empty table gives no blocks and no rows;
other columns are ignored; a very long document is one block of its own.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vitals.llm import rans
from vitals.llm.bpe import encoder
from vitals.llm.common import discard, prepare, rows_batches, stage

BLOCK_TOKENS, LANES, CHECKPOINT, SCALE_BITS = 1 << 19, 4096, 64, 18

_RAW = "shard int, block int, n_tokens long, doc_ids array<long>, lens array<int>, raw binary"
_BLOCK = (
    "shard int, block int, start long, n_tokens long, doc_ids array<long>, lens array<int>, lanes int, checkpoint int, "
    "words binary, states binary, offsets array<int>, words_crc32 long, ids_crc32 long"
)
_DOC = "doc_id long, start long, n_tokens long, ids_crc32 long, block_ok boolean"

_P = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(c.split()[0], _P[c.split()[1]]) for c in ddl.split(", ")])


def _stretches(batches, most_bytes: int = 1 << 23):
    """(doc_ids, texts) of as many batches together as hold ``most_bytes`` at most: what the encoder knows is searched
    once for each."""
    held, size = [], 0

    def joined():
        return [i for b in held for i in b.column("doc_id").to_pylist()], pa.concat_arrays([b.column("text").cast(pa.large_string()) for b in held])

    for batch in batches:
        if held and size + batch.nbytes > most_bytes:
            yield joined()
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield joined()


def _raw_blocks(path: str, end_id: int, block_tokens: int):
    def blocks(batches):
        enc, shard = encoder(path), TaskContext.get().partitionId()
        end = np.asarray([end_id], enc.dtype).tobytes()
        width, block, size, ids, lens, raw = np.dtype(enc.dtype).itemsize, 0, 0, [], [], []
        for doc_ids, texts in _stretches(batches):
            for doc_id, found in zip(doc_ids, enc.encode_all(texts), strict=True):
                data = found.tobytes() + end
                n = len(data) // width
                if size and size + n > block_tokens:
                    yield shard, block, size, ids, lens, b"".join(raw)
                    block, size, ids, lens, raw = block + 1, 0, [], [], []
                ids.append(doc_id)
                lens.append(n)
                raw.append(data)
                size += n
        if size:
            yield shard, block, size, ids, lens, b"".join(raw)

    return lambda batches: rows_batches(blocks(batches), _schema(_RAW), 8)


def _count(path: str):
    def run(batches):
        enc = encoder(path)
        total = np.zeros(enc.vocab, np.int64)
        for batch in batches:
            for raw in batch.column("raw").to_pylist():
                total += np.bincount(np.frombuffer(raw, enc.dtype), minlength=enc.vocab)
        used = np.flatnonzero(total)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["id", "n"])

    return run


def _code(freq: np.ndarray, bits: int, path: str, lanes: int, checkpoint: int):
    def rows(batches):
        table, dtype = rans.Table(freq, bits), encoder(path).dtype
        for batch in batches:
            for r in batch.to_pylist():
                ids = np.frombuffer(r["raw"], dtype)
                words, states, offsets = rans.encode(ids, table, lanes, checkpoint)
                yield r["shard"], r["block"], r["start"], r["n_tokens"], r["doc_ids"], r["lens"], lanes, checkpoint, words, states, offsets, zlib.crc32(words), rans.crc_ids(ids)

    return lambda batches: rows_batches(rows(batches), _schema(_BLOCK), 8)


def _read(freq: np.ndarray, bits: int):
    def rows(batches):
        table = rans.Table(freq, bits)
        for batch in batches:
            for r in batch.to_pylist():
                if zlib.crc32(r["words"]) != r["words_crc32"]:
                    raise ValueError(f"damaged block {r['shard']}/{r['block']}")
                ids = rans.decode(r["words"], r["states"], r["offsets"], r["n_tokens"], table, r["lanes"], r["checkpoint"])
                ok, at = rans.crc_ids(ids) == r["ids_crc32"], 0
                for doc_id, n in zip(r["doc_ids"], r["lens"], strict=True):
                    yield doc_id, r["start"] + at, n, rans.crc_ids(ids[at : at + n]), ok
                    at += n

    return lambda batches: rows_batches(rows(batches), _schema(_DOC), 2000)


def write_tokens(
    docs: DataFrame, out: str, tokenizer: str, end_id: int = 1, block_tokens: int = BLOCK_TOKENS, lanes: int = LANES, checkpoint: int = CHECKPOINT, bits: int = SCALE_BITS
) -> None:
    """Encode ``docs`` (doc_id, text) into block files under ``out``.

    One range shuffle of the texts orders them; ids are staged once, because the shared frequency
    table needs a count over all of them before the first block can be coded. The counts that reach
    the driver are one row per vocabulary entry.
    """
    spark = prepare(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    ordered = docs.select("doc_id", text.alias("text")).repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    raw = stage(ordered.mapInArrow(_raw_blocks(tokenizer, end_id, block_tokens), _RAW), "token-ids")
    counted = raw.select("raw").mapInArrow(_count(tokenizer), "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(encoder(tokenizer).vocab, np.int64)
    for r in counted:
        counts[r["id"]] = r["n"]
    freq = rans.quantise(counts, bits)
    spark.createDataFrame([(int(i), int(freq[i])) for i in np.flatnonzero(freq)], "id int, freq int").coalesce(1).write.parquet(f"{out}/symbols")
    shards = raw.groupBy("shard").agg(F.sum("n_tokens").alias("n"))  # one row per shard
    base = shards.select("shard", (F.sum("n").over(W.orderBy("shard")) - F.col("n")).alias("base"))
    inner = raw.select("shard", "block", (F.sum("n_tokens").over(W.partitionBy("shard").orderBy("block")) - F.col("n_tokens")).alias("inner"))
    starts = inner.join(base, "shard").select("shard", "block", (F.col("base") + F.col("inner")).alias("start"))
    # a block is some 2**19 ids and its start a few bytes, so the starts travel and the ids stay
    coded = raw.join(F.broadcast(starts), ["shard", "block"]).mapInArrow(_code(freq, bits, tokenizer, lanes, checkpoint), _BLOCK)
    coded.sortWithinPartitions("shard", "block").write.partitionBy("shard").parquet(f"{out}/blocks")
    discard(raw)


def read_tokens(spark: SparkSession, out: str, bits: int = SCALE_BITS) -> DataFrame:
    """Decode the files under ``out``: per document doc_id, start, n_tokens, ids_crc32, block_ok.

    Raises on a block whose words fail their checksum; ``block_ok`` tells whether the decoded ids
    match theirs.
    """
    prepare(spark)
    rows = spark.read.parquet(f"{out}/symbols").collect()
    freq = np.zeros(max([r["id"] for r in rows], default=0) + 1, np.int64)
    for r in rows:
        freq[r["id"]] = r["freq"]
    blocks = spark.read.schema(_BLOCK).parquet(f"{out}/blocks")
    return blocks.mapInArrow(_read(freq, bits), _DOC)

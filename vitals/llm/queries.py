"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitals.llm import byte_cnn, conversations, decontam, hard_negatives, html_extract, langid, mixing, ngram_join, substrings, tokens, toxicity, vectors, warc
from vitals.llm.common import table
from vitals.session import scratch_path

QueryFn = Callable[[SparkSession, str], DataFrame]


def word_tokenizer() -> str:
    """Path of the public word-level BPE vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def piece_vocabulary() -> str:
    """Path of the public 32k piece vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "token-files")
    tokens.write_tokens(table(spark, sf_dir, "documents"), out, word_tokenizer())
    return tokens.read_tokens(spark, out)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "rate", "copies")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("hit_words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        decontam.is_contaminated().alias("contaminated"),
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    held = (toxicity.fold() == toxicity.HELD_OUT).alias("held_out")
    return scored.select("doc_id", held, "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = piece_vocabulary()
    found = langid.predict(docs, langid.fit(docs, path), path)
    held = (toxicity.fold(folds=langid.FOLDS) == langid.HELD_OUT).alias("held_out")
    return found.select("doc_id", held, "lang_pred", "score")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_join(table(spark, sf_dir, "documents"), n=4, percent=85)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), out)
    return warc.resolve(warc.read_warc(spark, out))


def op8_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.strip_repeats(table(spark, sf_dir, "documents"), with_text=False)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op9_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract_main_text(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = byte_cnn.score(docs, byte_cnn.fit(docs, table(spark, sf_dir, "labels")))
    held = (byte_cnn.fold() == byte_cnn.HELD_OUT).alias("held_out")
    return scored.select("doc_id", held, "score", (F.col("score") >= byte_cnn.THRESHOLD).cast("int").alias("predicted"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.quantise(table(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    found = conversations.repair(conversations.damage(rows)).withColumnRenamed("conv_id", "r_id")
    ids = rows.select("conv_id").distinct()
    joined = ids.join(found, ids["conv_id"].eqNullSafe(found["r_id"]), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256().hexdigest()
    return joined.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))


def queries() -> dict[str, QueryFn]:
    return {
        "op1_token_ids": op1_token_ids,
        "op2_mixing": op2_mixing,
        "op3_decontamination": op3_decontamination,
        "op4_toxicity": op4_toxicity,
        "op5_language": op5_language,
        "op6_ngram_join": op6_ngram_join,
        "op7_warc": op7_warc,
        "op8_repeated_substrings": op8_repeated_substrings,
        "op9_near_vectors": op9_near_vectors,
        "op10_main_text": op10_main_text,
        "op11_quality": op11_quality,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_conversation_repair": op13_conversation_repair,
    }

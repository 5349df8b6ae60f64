"""A training-corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again
as the next stage's docs; all but the last return the columns of ``documents``. Each stage handles nulls, empty
texts, repeated rows and empty tables as its operator states; extra columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vitals.llm import decontam, mixing, ngram_join, tokens, toxicity
from vitals.llm.common import prepare, stage, table
from vitals.llm.queries import word_tokenizer
from vitals.session import scratch_path


def _free(docs: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that ``docs`` doesn't have."""
    return [next(c for c in (name + "_" * i for i in range(len(docs.columns) + 1)) if c not in docs.columns) for name in names]


def _same(left, right, keys):
    """Null-safe equality of the keys of two frames."""
    out = None
    for k, other in keys:
        c = left[k].eqNullSafe(right[other])
        out = c if out is None else out & c
    return out


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score reaches the threshold go."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles at a Jaccard similarity of 0.8, the row with the smallest doc_id stays.

    A row's node is the hash of its doc_id and text, so unrelated texts that share a doc_id are judged on their own. Rows without
    words or doc_id stay; of rows with equal doc_id and text one stays.
    """
    prepare(spark)
    k_key, k_stays, k_many, k_row = _free(docs, "k_key", "k_stays", "k_many", "k_row")
    keyed = docs.withColumn(k_key, F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text")))
    found = ngram_join.jaccard_join(keyed.select(F.col(k_key).alias("doc_id"), "text"), n=5, percent=80)
    nodes = found.where("doc_id is not null and n_shingles > 0").groupBy("doc_id").agg(F.min("component_id").alias("component"), F.count("*").alias("rows"))
    nodes = stage(nodes.withColumnRenamed("doc_id", "node"), "pipeline-nodes")
    ids = keyed.select(F.col(k_key).alias("node"), F.col("doc_id").alias("id"))
    # the smallest id of each group, combined map-side
    first = ids.join(nodes, "node").groupBy("component").agg(F.min(F.struct("id", "node")).alias("first")).select(F.col("first.node").alias("f"))
    marked = nodes.join(first, F.col("node") == F.col("f"), "left")
    marked = stage(marked.select(F.col("node").alias(k_key), F.col("f").isNotNull().alias(k_stays), (F.col("rows") > 1).alias(k_many)), "pipeline-groups")
    joined = keyed.join(marked, k_key, "left").where(F.col(k_stays).isNull() | F.col(k_stays))
    # rows that repeat both are rare, and one of them is picked map-side
    many = F.coalesce(k_many, F.lit(False))
    one = joined.where(many).groupBy(k_key).agg(F.min_by(F.struct(*docs.columns), F.xxhash64("text")).alias(k_row))
    return joined.where(~many).select(docs.columns).unionAll(one.select(f"{k_row}.*"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the contamination rule marks go."""
    found = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    bad = found.where(decontam.is_contaminated()).select(F.col("doc_id").alias("b_id"), F.col("row_hash").alias("b_hash")).distinct()
    (b_key,) = _free(docs, "b_key")
    hashed = docs.withColumn(b_key, F.xxhash64("doc_id", "text"))
    return hashed.join(bad, _same(hashed, bad, [("doc_id", "b_id"), (b_key, "b_hash")]), "left_anti").select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row comes as many times as the mix takes it, 0 to 3 times.

    Rows that share doc_id, source and size share their copies as evenly as can be, in the order of their text hashes.
    """
    m_id, m_source, m_size, m_copies, m_rows, m_words, m_rank, m_take, m_copy = _free(docs, *(f"m_{c}" for c in "id source size copies rows words rank take copy".split()))
    mixed = mixing.mix(docs).groupBy("doc_id", "source", "size").agg(F.sum("copies").alias(m_copies), F.count("*").alias(m_rows))
    mixed = mixed.withColumnsRenamed({"doc_id": m_id, "source": m_source, "size": m_size})
    sized = docs.withColumn(m_words, F.coalesce(F.regexp_count("text", F.lit(mixing.WORD)), F.lit(0)).cast("long"))
    joined = sized.join(mixed, _same(sized, mixed, [("doc_id", m_id), ("source", m_source), (m_words, m_size)]))
    rank = F.row_number().over(W.partitionBy(m_id, m_source, m_size).orderBy(F.xxhash64("text")))
    shared = joined.where(F.col(m_rows) > 1).withColumn(m_rank, rank)
    share = F.floor(F.col(m_rank) * F.col(m_copies) / F.col(m_rows)) - F.floor((F.col(m_rank) - 1) * F.col(m_copies) / F.col(m_rows))
    alone = joined.where(F.col(m_rows) == 1).select(*docs.columns, F.col(m_copies).alias(m_take))
    both = alone.unionAll(shared.select(*docs.columns, share.alias(m_take)))
    return both.where(F.col(m_take) > 0).withColumn(m_copy, F.explode(F.sequence(F.lit(1), F.col(m_take).cast("int")))).select(docs.columns)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left; returns their rows as read back."""
    out = scratch_path(spark, "token-files")
    tokens.write_tokens(docs, out, word_tokenizer())
    return tokens.read_tokens(spark, out)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_output", write_token_ids),
]

#: Training and iterations can't be put in SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: documents pass through five operators, each stage written as Parquet and read by the next.

Each stage takes (spark, docs, sf_dir) and works on every row its predecessor kept.  Rows with a null text or a null or repeated ID pass
like any other; extra columns are carried along; an empty table stays empty.

1. ``quality``: documents that the quality classifier rejects go.
2. ``near_dedup``: one document of each group of SimHash near-duplicates stays, the one with the smallest ID.
3. ``decontaminate``: documents that hold a benchmark item, exactly or edited, go.
4. ``pii``: personal data is replaced by its kind in brackets; ``n_chars`` follows.
5. ``tokenize``: token IDs (``ids``), their number (``n_tokens``) and the text decoded from them (``decoded``) take the place of the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnrisk.llm import bpe, decontaminate, pii, quality, simhash
from txnrisk.llm.common import discard, free_name, remainder, row_key, small_batches
from txnrisk.session import working_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels.where(remainder(F.col("doc_id"), 5) != 0))
    return docs.where(quality.scored(F.col("text"), model) >= quality.THRESHOLD)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return simhash.keep_one(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    key = free_name(docs, "__key")
    keyed = row_key(docs, key)
    found = decontaminate.contaminated(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), doc_id=key)
    return keyed.join(found.select(F.col("doc_id").alias(key)).distinct(), key, "left_anti").select(*docs.columns)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    clean = docs.withColumn("text", pii.redacted(F.col("text")))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def tokenize_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    codec = bpe.Codec(spark, public_tokenizers.path("word_bpe_49k.json"))
    others = [c for c in docs.columns if c not in ("text", "ids", "n_tokens", "decoded")]
    name = free_name(docs, "__coded")
    coded = docs.select(*others, codec.round_trip(F.col("text")).alias(name))
    return coded.select(*others, F.col(f"{name}.ids"), F.size(f"{name}.ids").cast("long").alias("n_tokens"), F.col(f"{name}.decoded"))


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("pii", pii_stage),
    ("tokenize", tokenize_stage),
]

# Hashes, learned tables and alignments are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``.  A stage's table is removed once the next one is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = working_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            discard(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)

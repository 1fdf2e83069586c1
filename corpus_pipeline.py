"""A corpus pipeline of five operators: each stage gets what the one before kept, written as Parquet and read again.

All stages but the last return the columns of `documents`. A stage's rows are settled by its operator's docstring.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradebars.llm import bpe, decontaminate, jaccard, quality, secrets
from tradebars.llm._tables import settle, shipped


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the thresholds of their language and source reject go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of the n-gram Jaccard join, the document of the least doc_id stays."""
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that an item of `benchmark` leaks into go."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay; every reported secret in their texts is masked, and n_chars follows the text."""
    masked = secrets.redact(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast("bigint")) if "n_chars" in docs.columns else masked


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256): the ids of each text, and the digest of what they decode to."""
    coded = bpe.encode(docs, shipped(spark, "byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, keep=["doc_id"], decoded=True)
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("byte-level BPE", token_ids),
]

#: The fifth stage's ids are beyond SQL; the stages are tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = settle(docs)
    return docs

"""The registered queries over the corpus tables and, where SQL can say them, their DuckDB counterparts."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradebars.llm import _sql, bpe, decontaminate, factors, html, jaccard, langid, licenses, negatives, quality, resample, secrets, sharding, tokens
from tradebars.llm._tables import shipped

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_groups(_table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return tokens.count_tokens(docs, shipped(spark, "piece_bpe_32k.model"), keep=["doc_id"], limit=4096)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < len(secrets.STRONG))
    n = lambda kind: F.size(F.filter("spans", lambda s: s["name"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *[n(k) for k in secrets.STRONG], F.sha2(secrets.written(base), 256).alias("base_sha256"), secrets.written(F.col("spans")).alias("spans"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), shared=True).drop("text_hash")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_table(spark, sf_dir, "pages"))


def op8_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(_table(spark, sf_dir, "documents"), 24)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(_table(spark, sf_dir, "documents"), keep=["doc_id"])


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = shipped(spark, "byte_bpe_multi_50k.tiktoken")
    coded = bpe.encode(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, keep=["doc_id"], decoded=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", factors.held_out())
    scored = factors.classify(docs, _table(spark, sf_dir, "labels"), metadata=["n_chars"], keep=["doc_id", "held_out"])
    return scored.select("doc_id", "held_out", "score", "predicted")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows, label=label, anchor=F.col("vec_id") % 100 == 0)


@functools.lru_cache(1)
def _archive() -> str:
    """The package as a zip file, to be shipped to executors."""
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="spark-"), "tradebars.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(os.path.join(top, "tradebars")):
            for name in names:
                if name.endswith(".py"):
                    out.write(full := os.path.join(folder, name), os.path.relpath(full, top))
    return path


def _shipped(query: Query) -> Query:
    """The query, run where executors have this package."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.sparkContext.addPyFile(_archive())
        return query(spark, sf_dir)

    return run


QUERIES = (
    op1_license_scan, op2_ngram_jaccard, op3_token_counts, op4_secret_scan, op5_decontamination,
    op6_language_id, op7_html_text, op8_kd_shards, op9_quality_rules, op10_byte_bpe,
    op11_importance_resampling, op12_quality_classifier, op13_hard_negatives,
)


def queries() -> dict[str, Query]:
    return {f.__name__: _shipped(f) for f in QUERIES} | {"pipeline": _shipped(corpus_pipeline.run)}


def oracle_sql() -> dict[str, str]:
    said = {"op2_ngram_jaccard": _sql.JACCARD, "op9_quality_rules": _sql.QUALITY, "op11_importance_resampling": _sql.RESAMPLING, "op13_hard_negatives": _sql.NEGATIVES}
    return said | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})

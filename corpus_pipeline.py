"""Five stages from raw documents to token ids; each is written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomelake.llm import bpe, minhash_dedup, mixing, quality_rules, secret_scan
from outcomelake.llm.common import materialize, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the model learns from the labels of documents that are here."""
    return quality_rules.accepted(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of every group of near-duplicates (five words, similarity 0.8)."""
    return minhash_dedup.deduplicated(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a marker."""
    return secret_scan.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated (or left out) so that sources have their target weights, shuffled."""
    return mixing.mix_sources(docs).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and byte offsets of every text."""
    keep = [c for c in docs.columns if c != "text"]
    return bpe.encode(docs, keep=keep).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("near-duplicates", near_dedup),
    ("secrets", redact_secrets),
    ("mixing", mix),
    ("byte-level BPE", encode),
]

#: The fitted models have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; null or empty texts leave in the first."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{k}")
    return docs

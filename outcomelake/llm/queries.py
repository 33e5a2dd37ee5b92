"""One registered query per operator, over its whole table, and the SQL of those that SQL expresses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomelake.llm import (
    bpe, compression_quality, embedding_dedup, html_text, language_id, lexical_search, minhash_dedup, mixing, packing, quality_rules, secret_scan,
    suffix_dedup, vector_codes,
)
from outcomelake.llm.common import hash_mod, table


def op1_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = hash_mod(F.col("doc_id"), 5) == 0
    labels = table(spark, sf_dir, "labels").where(~held_out)
    scored = compression_quality.score(docs, compression_quality.fit(docs, labels), keep=["doc_id"])
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = hash_mod(F.col("doc_id"), 4) == 2
    network = language_id.fit(docs.where(~held_out))
    found = language_id.identify(docs.select("doc_id", "text"), network, keep=["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, model, keep=["doc_id"])


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.digests(table(spark, sf_dir, "embeddings"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_compression_quality": op1_compression_quality,
        "op2_minhash_dedup": op2_minhash_dedup,
        "op3_byte_bpe": op3_byte_bpe,
        "op4_mixing": op4_mixing,
        "op5_html_text": op5_html_text,
        "op6_embedding_dedup": op6_embedding_dedup,
        "op7_language_id": op7_language_id,
        "op8_quality_rules": op8_quality_rules,
        "op9_suffix_dedup": op9_suffix_dedup,
        "op10_secrets": op10_secrets,
        "op11_vector_codes": op11_vector_codes,
        "op12_lexical_search": op12_lexical_search,
        "op13_packing": op13_packing,
    }


def llm_oracles() -> dict[str, str]:
    return {
        "op4_mixing": mixing.ORACLE_SQL,
        "op6_embedding_dedup": embedding_dedup.ORACLE_SQL,
        "op11_vector_codes": vector_codes.ORACLE_SQL,
        "op12_lexical_search": lexical_search.ORACLE_SQL,
    }

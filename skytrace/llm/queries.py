"""The thin queries over the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytrace.llm import fingerprints, hmm, html, mixing, neardup, packing, quality, secrets, sql, suffixdedup, tokencount
from skytrace.llm.common import materialise, table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = mixing.with_size(table(spark, sf_dir, "documents"))
    light = materialise(docs.select("doc_id", "source", "size"), "mix-light")
    return mixing.copies(light).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate")


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.remove(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokencount.count_tokens(docs, tokenizer_path("piece_bpe_32k.model")).drop("text")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return quality.judge(docs).drop("text", "lang", "char_distance", "word_distance")


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.scan(docs).withColumn("base_sha256", F.sha2("base_spans", 256)).drop("text", "base_spans")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", neardup.hex_fingerprint().alias("fingerprint"), "component_id")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_packing, op2_mixing, op3_document_fingerprints, op4_html_extraction, op5_suffix_array_dedup, op6_token_counts, op7_quality_rules, op8_secret_scans, op9_simhash_near_dedup, op10_lm_scoring]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    """The other nine rest on hashes, tokenizers, iteration or suffix order; tests hold them against brute force."""
    return {"op7_quality_rules": sql.quality_rules()}

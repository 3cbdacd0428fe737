"""Registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    byte_bpe,
    embedding_dedup,
    hard_negatives,
    html_text,
    license_scan,
    line_dedup,
    minhash_dedup,
    source_mix,
    suffix_dedup,
    topk_search,
    toxicity,
    url_filter,
    vector_codes,
)
from strata.llm.common import read
from strata.llm.oracle import ORACLE

#: Vocabulary of op6 (a parameter of the operator; the file is never copied).
BPE_FILE = "byte_bpe_multi_50k.tiktoken"


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_documents(read(spark, sf_dir, "documents"), license_scan.known_digests(spark))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.train(pages))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash_dedup.near_duplicates(read(spark, sf_dir, "documents"), shingle_words=2, percent=80)
    return found.drop("h", "root")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(read(spark, sf_dir, "documents"), ["doc_id"])


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.round_trip(
        read(spark, sf_dir, "documents"), public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN)


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = topk_search.vectors(read(spark, sf_dir, "embeddings"))
    return topk_search.topk(v.filter(F.col("vec_id") % 50 == 0), v, k=5)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    rules = spark.createDataFrame(url_filter.RULES, "action string, rule string")
    return url_filter.judge(pages, rules, url_filter.link_edges(pages)).select(
        "page_id", "host", "path", "rule", "verdict")


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"), threshold=0.95)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read(spark, sf_dir, "embeddings"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hard_negatives.prepared(read(spark, sf_dir, "embeddings").withColumn("label", moved))
    return hard_negatives.mine(rows.filter(F.col("vec_id") % 50 == 0), rows)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_license_scan, op2_html_text, op3_source_mix, op4_minhash_dedup, op5_line_dedup, op6_byte_bpe,
        op7_topk_search, op8_url_filter, op9_embedding_dedup, op10_toxicity, op11_vector_codes, op12_suffix_dedup,
        op13_hard_negatives)
}

__all__ = ["ORACLE", "QUERIES"]

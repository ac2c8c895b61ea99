"""The document operators as queries on the data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientela.llm import (
    centroids,
    decontaminate,
    line_dedup,
    pieces,
    pii,
    quality,
    search,
    secret_scan,
    sharding,
    simhash,
    token_counts,
    vector_codes,
    warc,
)
from clientela.llm.common import load


def sha256(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.context_limits(token_counts.length_histogram(load(spark, folder, "documents")))


def span_digest(found: DataFrame, operator, kinds: list[str]) -> DataFrame:
    """Counts of the base spans, their digest, and all spans as text."""
    return found.select(
        "doc_id",
        *[operator.count_kind("base", k).alias(f"n_{k}") for k in kinds],
        sha256(operator.span_list(F.col("base"))).alias("base_sha256"),
        operator.span_list(F.concat("base", "added")).alias("spans"),
    )


def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    return span_digest(pii.find_personal_data(load(spark, folder, "documents")), pii, pii.KINDS)


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.drop_shared_lines(load(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", sha256(F.col("text")).alias("kept_sha256"))


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(load(spark, folder, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op5_search(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    found = search.top_k(docs, docs.where("doc_id % 50 = 0"))
    return found.select(F.col("query").alias("query_id"), F.col("id").alias("doc_id"), "score", "rank")


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    chunks = warc.archive_pages(spark, load(spark, folder, "pages"))
    return warc.records(chunks).withColumnRenamed("page", "page_id")


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_contamination(load(spark, folder, "documents"), load(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        sha256(F.array_join("items", ",")).alias("items_sha256"),
        "contaminated",
    )


def op8_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.round_trip(load(spark, folder, "documents"))


def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.find_secrets(load(spark, folder, "documents"))
    return span_digest(found, secret_scan, list(secret_scan.BASE))


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_documents(load(spark, folder, "documents"), load(spark, folder, "labels"))


def op11_sharding(spark: SparkSession, folder: str) -> DataFrame:
    found = sharding.shard_documents(load(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op12_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster_report(load(spark, folder, "embeddings"))


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.code_report(load(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_pii": op2_pii,
    "op3_line_dedup": op3_line_dedup,
    "op4_simhash": op4_simhash,
    "op5_search": op5_search,
    "op6_warc": op6_warc,
    "op7_decontaminate": op7_decontaminate,
    "op8_pieces": op8_pieces,
    "op9_secrets": op9_secrets,
    "op10_quality": op10_quality,
    "op11_sharding": op11_sharding,
    "op12_clustering": op12_clustering,
    "op13_vector_codes": op13_vector_codes,
}

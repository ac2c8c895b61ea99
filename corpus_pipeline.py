"""The document pipeline: quality, shared lines, near duplicates, benchmark passages, tokens.

Null texts count as empty throughout. An empty text is scored like any other (stage 1), is one empty line (2), has the
fingerprint zero, so that one of all texts without words stays (3), holds no passage (4) and has no pieces (5). Repeated
rows are separate rows until stage 3, which keeps one. Rows with a null ``doc_id`` go on like others; in stage 3 one
stays only where its group has no other. Ties are broken by key, then text hash. Empty tables give empty results:
without labels nothing is rejected, without a benchmark nothing is contaminated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientela.llm import decontaminate, line_dedup, pieces, quality, simhash
from clientela.llm.common import load
from clientela.session import materialise


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 1: documents that the quality model rejects go."""
    return quality.drop_rejected(docs, load(spark, sf_dir, "labels"))


def own_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 2: lines shared by many documents stay in one of them only."""
    cut = line_dedup.drop_shared_lines(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 3: one document of each group of near duplicates stays (shingles of three words, 3 bits at most)."""
    return simhash.keep_one(docs, shingle=simhash.SHINGLE, reach=simhash.DISTANCE)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 4: documents with a benchmark passage go."""
    return decontaminate.drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 5: piece ids of every text, with the digest of what they decode to."""
    return pieces.round_trip(docs)


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", own_lines),
    ("simhash near-dedup", one_of_each),
    ("benchmark decontamination", uncontaminated),
    ("sentencepiece encoding and decoding", token_ids),
]

# The quality model and the fingerprints have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and reread as the next stage's input."""
    docs = load(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{number + 1}")
    return docs

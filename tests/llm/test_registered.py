"""The registered document queries: names, SQL, and results on the smallest data folder."""

import os
from pathlib import Path

import pytest
from compare import connect, differences

import __spark_entry__ as entry
import corpus_pipeline

FOLDER = os.environ.get("CLIENTELA_SMALL_DATA", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")


def test_every_operator_has_one_query():
    numbers = [n.split("_")[0] for n in entry.queries() if n.startswith("op")]
    assert sorted(numbers) == sorted(f"op{i}" for i in range(1, 14))
    assert "pipeline" in entry.queries()
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", ["op3_line_dedup", "op5_search", "op6_warc", "op7_decontaminate", "op9_secrets", "op11_sharding", "op12_clustering", "op13_vector_codes"])
def test_queries_match_sql(spark, name):
    assert differences(entry.queries()[name](spark, FOLDER), connect(FOLDER), entry.oracle_sql()[name]) == []


def test_one_row_per_document(spark):
    count = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    for name in ("op2_pii", "op4_simhash", "op8_pieces", "op9_secrets", "op10_quality", "op11_sharding"):
        found = entry.queries()[name](spark, FOLDER)
        assert found.columns[0] == "doc_id" and found.count() == count

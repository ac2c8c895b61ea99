"""Every stage of the pipeline against brute force on what the stage before it left."""

import random

import pytest
from rows import DOCS, PASSAGE, docs_table, prose
from test_lines_and_windows import brute_lines, brute_windows
from test_simhash import brute_components

import corpus_pipeline
from clientela.llm import quality
from clientela.session import materialise

LINE = "A line that many of these documents share, whatever they are about."


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("data"))
    rng = random.Random(1)
    rows, labels = list(DOCS), []
    for i in range(200, 420):
        good = rng.random() < 0.8
        text = prose(i, 50 + i % 30)
        text = text if good else " ".join(w + rng.choice(["###", "&&&", "$$$"]) for w in text.split())
        rows.append((i, text + ("\n" + LINE if i % 9 == 0 else "") + (" " + PASSAGE if i % 31 == 0 else "")))
        labels.append((i, int(good), 0))
    rows += [(1000 + k, t) for k, t in rows[30:60]]
    docs = docs_table(spark, rows, clash=False).selectExpr("doc_id", "text", "'en' lang", "'s' source", "length(text) n_chars")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, PASSAGE), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    left = [spark.read.parquet(f"{folder}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        left.append(materialise(stage(spark, left[-1], folder), name.replace(" ", "-")))
    return folder, left


def pairs(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_columns_and_growth(stages):
    _, left = stages
    assert all(df.columns == left[0].columns for df in left[:-1])
    counts = [df.count() for df in left]
    assert counts == sorted(counts, reverse=True)
    assert counts[0] > counts[1] == counts[2] > counts[3] > counts[4] == counts[5]


def test_quality_stage(spark, stages):
    folder, left = stages
    scored = quality.score_documents(left[0], spark.read.parquet(f"{folder}/labels.parquet"))
    assert sorted(str(r["doc_id"]) for r in scored.where("predicted = 1").collect()) == sorted(str(k) for k, _ in pairs(left[1]))


def test_line_stage(stages):
    _, left = stages
    want = sorted(((k, t) for (k, t, _, _), n in brute_lines(pairs(left[1])).items() for _ in range(n)), key=str)
    assert pairs(left[2]) == want
    assert all(r["n_chars"] == len(r["text"]) for r in left[2].collect())


def test_near_duplicate_stage(stages):
    _, left = stages
    before = pairs(left[2])
    groups = {c if c is not None else ("none", f) for _, f, c in brute_components(before)}
    after = pairs(left[3])
    assert len(after) == len(groups) and set(after) <= set(before)
    assert {k for k, _ in after if k is not None} == {c for c in groups if isinstance(c, int)}


def test_benchmark_stage(stages):
    _, left = stages
    bad = {k for (k, *_, hit), _ in brute_windows(pairs(left[3]), [(1, PASSAGE), (2, None)]).items() if hit}
    assert bad and pairs(left[4]) == [r for r in pairs(left[3]) if r[0] not in bad]


def test_token_stage(stages):
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file="/opt/tokenizers/piece_bpe_32k.model")
    _, left = stages
    got = sorted(((r["doc_id"], r["ids"]) for r in left[5].collect()), key=str)
    assert got == sorted(((k, library.encode(t)) for k, t in pairs(left[4])), key=str)
    assert left[5].where("not exact").count() == 0


def test_pipeline_of_empty_tables(spark, tmp_path):
    docs_table(spark, [], clash=False).selectExpr("doc_id", "text", "'en' lang", "'s' source", "0L n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

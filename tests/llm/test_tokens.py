"""Token counts and pieces against the public libraries."""

import hashlib
from bisect import bisect_left

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from rows import DOCS, docs_table

from clientela.llm import pieces, token_counts

MORE = [(200, " lead and  double   spaces\n\n\ttabs\r\n"), (201, "▁a▁▁b"), (202, "<s> <0x0A> </s>\x00b"), (203, "a" * 700 + " " + "ab" * 900), (204, " " * 50 + "x" + " " * 37)]


@pytest.fixture(scope="module")
def library():
    sentencepiece = pytest.importorskip("sentencepiece")
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_FILE)


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(pieces.Vocabulary.read(pieces.MODEL_FILE))


def test_ids_are_the_library_s(spark, library):
    rows = DOCS + MORE
    got = pieces.encode(docs_table(spark, rows)).select("doc_id", "ids", "n_tokens").collect()
    want = sorted((k or -1, library.encode(t or "")) for k, t in rows)
    assert sorted((r["doc_id"] or -1, r["ids"]) for r in got) == want
    assert all(r["n_tokens"] == len(r["ids"]) for r in got)


def test_decoding_gives_the_text_back(spark):
    rows = DOCS + MORE
    table = docs_table(spark, rows)
    back = pieces.decode(pieces.encode(table)).select("doc_id", "text").collect()
    want = sorted((k or -1, (t or "").replace("▁", " ")) for k, t in rows)
    assert sorted((r["doc_id"] or -1, r["text"]) for r in back) == want
    trip = pieces.round_trip(table).collect()
    assert {r["doc_id"] for r in trip if not r["exact"]} == {201}
    digest = hashlib.sha256(MORE[0][1].encode()).hexdigest()
    assert [r["text_sha256"] for r in trip if r["doc_id"] == 200] == [digest]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab etn \n▁é日.,1<>\t\x00😀", max_size=300), max_size=8))
def test_random_texts(encoder, library, texts):
    got = [np.frombuffer(e, np.int32).tolist() for e in encoder.encode(texts)]
    assert got == [library.encode(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abcé日", min_size=1, max_size=200), st.integers(1, 20))
def test_suffix_array_orders_by_depth(text, depth):
    codes = pieces.codes_of(text)
    order = pieces.suffix_array(codes, depth).tolist()
    assert sorted(order) == list(range(len(text)))
    ahead = [text[i : i + depth] for i in order]
    assert ahead == sorted(ahead)


def test_remembered_words_do_not_change_ids(encoder, library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    monkeypatch.setattr(pieces, "INDEX_AT_ONCE", 10)
    for text in ("one two three four five six", "six seven", "one two nine"):
        assert np.frombuffer(encoder.encode([text])[0], np.int32).tolist() == library.encode(text)


@pytest.fixture(scope="module")
def lengths():
    with open(token_counts.RANKS_FILE, "rb") as file:
        encode = token_counts.encoder(file.read(), token_counts.PATTERN).encode_ordinary
    return sorted(len(encode(t)) if t else 0 for _, t in DOCS)


def test_limits_match_brute_force(spark, lengths):
    limits = token_counts.context_limits(token_counts.length_histogram(docs_table(spark)))
    rows = {r["length"]: r for r in limits.collect()}
    assert set(rows) == set(lengths)
    for at, row in rows.items():
        assert row["n_docs"] == lengths.count(at)
        assert row["docs_longer"] == sum(n > at for n in lengths)
        assert row["tokens_longer"] == sum(n for n in lengths if n > at)
        assert row["docs_upto"] == sum(n <= at for n in lengths)
        assert row["tokens_upto"] == sum(n for n in lengths if n <= at)
        assert row["tokens_truncated"] == sum(min(n, at) for n in lengths)


def test_any_limit_and_quantile(spark, lengths):
    limits = token_counts.context_limits(token_counts.length_histogram(docs_table(spark)))
    for at in (0, 1, 100, 101, 5000, 10**9):
        kept = token_counts.truncated_total(limits, at).first()
        assert (kept["docs_whole"], kept["tokens_kept"]) == (sum(n <= at for n in lengths), sum(min(n, at) for n in lengths))
    for share in (0.1, 0.5, 1.0):
        want = lengths[max(0, bisect_left(range(1, len(lengths) + 1), share * len(lengths)))]
        assert token_counts.length_quantile(limits, share).first()["length"] == want


@pytest.mark.parametrize("blanks", [" " * 30_000, "\n" * 20_001, " \t" * 9_000, "\u3000" * 10_000])
def test_long_blank_runs_count_the_same(blanks, monkeypatch):
    with open(token_counts.RANKS_FILE, "rb") as file:
        tokenizer = token_counts.encoder(file.read(), token_counts.PATTERN)
    for text in (blanks, blanks + "x", "x" + blanks, "a b," + blanks + "c " + blanks + "\n", blanks + "7" + blanks):
        assert token_counts.encoded_length(tokenizer, text) == len(tokenizer.encode_ordinary(text))
    assert token_counts.encoded_length(tokenizer, "x" + " " * 3_000_000 + "y") > 1000


def test_groups_and_empty_tables(spark):
    docs = docs_table(spark, [(1, "a b"), (2, "a b c"), (3, None)], clash=False).selectExpr("*", "case when doc_id < 3 then doc_id > 1 end as late")
    histogram = token_counts.length_histogram(docs, by=["late"])
    limits = token_counts.context_limits(histogram, by=["late"]).collect()
    assert {(r["late"], r["length"], r["docs_longer"]) for r in limits} == {(False, 2, 0), (True, 3, 0), (None, 0, 0)}
    assert token_counts.context_limits(token_counts.length_histogram(docs_table(spark, []))).count() == 0
    assert pieces.round_trip(docs_table(spark, [])).count() == 0

"""The language model against its formula, and its corner cases."""

import brute_lm
import pytest

from sheafline.llm import lm
from sheafline.llm.queries import op2_language_model

SCHEMA = "doc_id LONG, text STRING"


def check(got, rows):
    want = brute_lm.scores(rows)
    assert len(got) == len(rows)
    for r in got:
        held, tokens, known, total, base, score = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, tokens, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)


def run(spark, rows, monkeypatch=None):
    docs = spark.createDataFrame(rows, SCHEMA)
    docs = docs.select("doc_id", "text", lm.held_out(docs.doc_id).alias("held_out"))
    return lm.score(docs, lm.train(docs.where("NOT held_out")), keep=("doc_id", "held_out")).collect()


def test_query_matches_formula(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    check(op2_language_model(spark, sf).collect(), [tuple(r) for r in docs])


def test_many_buckets_and_frequent_contexts(spark, sf, monkeypatch):
    """The same numbers when texts fall into many buckets and frequent contexts are dealt out by pair."""
    monkeypatch.setattr(lm, "BUCKET_BYTES", 20_000)
    monkeypatch.setattr(lm, "SAMPLE", 1)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    docs = spark.createDataFrame(rows, SCHEMA)
    docs = docs.select("doc_id", "text", lm.held_out(docs.doc_id).alias("held_out"))
    model = lm.train(docs.where("NOT held_out"))
    assert model.buckets > 2 and len(model.hot) > 3
    check(lm.score(docs, model, keep=("doc_id", "held_out")).collect(), rows)


def test_corner_cases(spark):
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "A a\x0bA b"), (4, "a a a a"), (None, "a b"), (5, "Ä ä"),
            (6, "word " * 30_000), (7, "a a a a"), (8, "a a a a")]
    check(run(spark, rows), rows)


def test_empty_table_and_empty_training(spark):
    assert run(spark, []) == []
    rows = [(None, "a b c")]  # held out, so nothing is learnt
    (r,) = run(spark, rows)
    assert (r.score, r.base_score, r.n_known, r.train_tokens) == (0, 0, 0, 0)


def test_perplexity_is_below_the_base_on_unseen_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = op2_language_model(spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert len(rows) > 50 and docs.count() == 1000
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)

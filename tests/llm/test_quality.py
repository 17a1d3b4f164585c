"""Ordinal regression: gradient, held-out accuracy, and corner cases."""

import numpy as np
from pyspark.sql import functions as F

from sheafline.llm import quality
from sheafline.llm.queries import op3_quality

SF = "/root/testdata/sf0.1"


def test_probabilities_are_ordered_and_sum_to_one():
    p = quality.probabilities(np.array([-5.0, 0.0, 5.0]), np.array([-1.0, 1.0]))
    assert np.allclose(p.sum(1), 1) and (p >= 0).all()
    assert (np.diff(p @ np.arange(3)) > 0).all()


def test_fit_finds_known_thresholds(monkeypatch):
    """Grades drawn from the model itself: the fit comes back to its order and its thresholds."""
    monkeypatch.setattr(quality, "STEPS", 400)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(6000, 3))
    w, t = np.array([2.0, -1.0, 0.0]), np.array([-1.0, 0.5, 2.0])
    grade = (rng.logistic(size=6000)[:, None] + (x @ w)[:, None] > t[None, :]).sum(1)
    doc, cell = np.repeat(np.arange(6000), 3), np.tile(np.arange(3), 6000)
    model = quality._fit(doc, cell, x.reshape(-1), grade, np.ones(6000), 4)
    assert np.allclose(model.weights[:3], w, atol=0.15) and np.allclose(model.thresholds, t, atol=0.15)


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in op3_quality(spark, SF).collect() if r.held_out and r.doc_id in labels]
    good, poor = ([r for r in rows if labels[r.doc_id] == q] for q in (1, 0))
    assert len(good) > 300 and len(poor) > 30
    assert np.mean([r.selected for r in good]) > 0.99 and np.mean([r.selected for r in poor]) < 0.05


def test_odd_tables(spark):
    docs = spark.createDataFrame([(i, f"good words number {i}" if i % 2 else f"% {i} %%", 1, "x") for i in range(40)]
                                 + [(100, None, 1, "x"), (None, "", 1, "x"), (None, "%% " * 200_000, 1, "x"), (1, "good words number 1", 1, "x")],
                                 "doc_id LONG, text STRING, quality INT, expected_grade STRING")
    schema = "doc_id LONG, quality INT, toxic INT"
    grade = quality.grade_of(F.col("quality"), F.col("toxic"))
    model = quality.train(docs, spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, 1, 1), (3, None, None)], schema), grade)
    got = quality.score(docs, model, keep=docs.columns, prefix="__").collect()
    assert len(got) == 44 and got[0].expected_grade == "x"
    by = {r.text: r["__tail_probability"] for r in got}
    assert all((by[f"good words number {i}"] if i % 2 else 1 - by[f"% {i} %%"]) > 0.5 for i in range(40))
    assert by[None] == by[""] and by["%% " * 200_000] < 0.5
    for rows in ([], [(1, 1, 0)], [(1, 7, 0)]):  # nothing, or one grade, to learn from
        bare = quality.train(docs, spark.createDataFrame(rows, schema), grade)
        assert len({r.tail_probability for r in quality.score(docs, bare).collect()}) == 1
    assert quality.score(docs.limit(0), model).collect() == []

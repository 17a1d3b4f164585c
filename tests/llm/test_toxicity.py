"""Toxicity: exact nearest neighbours, held-out accuracy, and corner cases."""

import zlib

import numpy as np
import pytest

from sheafline.llm import examples, toxicity
from sheafline.llm.queries import op9_toxicity

SF = "/root/testdata/sf0.1"


def tables(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


def test_nearest_examples_are_exact(spark):
    """Block bounds lose nothing: the same neighbours as by comparing with every example."""
    rng = np.random.default_rng(0)
    index = toxicity.Index([f"t{i}" for i in range(40)], rng.uniform(1, 5, 40))
    vectors = [tuple((int(t), int(rng.integers(1, 4))) for t in sorted(rng.choice(40, rng.integers(1, 9), replace=False))) for _ in range(700)]
    index.build(sorted(vectors))
    dense = np.zeros((700, 40))
    for i, v in enumerate(sorted(vectors)):
        t, w = index.vector(v)
        dense[i, t] = w
    for v in vectors[:150]:
        terms, weight = index.vector(v)
        cosine = np.round(np.minimum(dense[:, terms] @ weight, 1), 12)
        want = [i for i in np.lexsort((np.arange(700), -cosine)) if cosine[i] > 0][:15]
        at, got = index.nearest(terms, weight, 15)
        assert at.tolist() == want and np.allclose(got, cosine[want])


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.toxic for r in tables(spark)[1].collect()}
    rows = [r for r in op9_toxicity(spark, SF).collect() if r.held_out and r.doc_id in labels]
    toxic, clean = ([r for r in rows if labels[r.doc_id] == t] for t in (1, 0))
    assert len(toxic) > 50 and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.predicted for r in toxic]) > 0.9 and np.mean([r.predicted for r in clean]) < 0.02
    order = np.array([r.score for r in toxic])[:, None] - np.array([r.score for r in clean])[None, :]
    assert ((order > 0) + 0.5 * (order == 0)).mean() > 0.97


def test_ids_and_layout_do_not_matter(spark):
    docs, labels = tables(spark, "/root/testdata/sf0.01")
    index = toxicity.train(docs, labels)
    again = toxicity.train(docs.repartition(5), labels.repartition(3))
    assert index.terms == again.terms and index.ids.tolist() == again.ids.tolist()
    rows = [(1, "what an idiot"), (2, "what an idiot"), (None, "what an idiot"), (3, None), (4, ""), (5, "idiot " * 100_000)]
    frame = spark.createDataFrame([(i, t, 1, 0.5) for i, t in rows], "doc_id LONG, text STRING, toxic INT, score DOUBLE")
    got = toxicity.score(frame, index, keep=frame.columns, prefix="__").collect()
    assert len(got) == 6 and len({r["__score"] for r in got if r.text == "what an idiot"}) == 1
    assert [r.toxic for r in got] == [1] * 6
    (empty,) = {r["__score"] for r in got if not r.text}
    assert empty == pytest.approx(index.none) and len(got[0].evidence if "evidence" in frame.columns else got[0]["__evidence"]) > 0


def test_odd_labels(spark):
    docs = spark.createDataFrame([(i, f"text {i} bad word") for i in range(20)], "doc_id LONG, text STRING")
    none = spark.createDataFrame([], "doc_id LONG, quality INT, toxic INT")
    assert {r.score for r in toxicity.score(docs, toxicity.train(docs, none)).collect()} == {0.0}
    odd = spark.createDataFrame([(None, 1, 1), (3, 1, None), (5, 1, 0), (5, 1, 0), (77, 1, 1)], "doc_id LONG, quality INT, toxic INT")
    assert {r.score for r in toxicity.score(docs, toxicity.train(docs, odd)).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), toxicity.train(docs, odd)).collect() == []


def test_held_out_labels_are_not_learnt(spark):
    docs, labels = tables(spark, "/root/testdata/sf0.01")
    sample, counts = examples.labelled(docs, labels, labels.toxic, range(2), 4000)
    import zlib
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 != 2 for r in sample.collect()) and set(counts) == {0, 1}


def test_only_verified_copies_of_one_label_leave(spark):
    """A shared passage is no copy, and a toxic edit of a clean text stays."""
    passage = " ".join(f"p{i}" for i in range(30))
    own = {i: " ".join(f"{i}x{j}" for j in range(30)) for i in range(6)}
    rows = [(1, 0, f"{passage} {own[1]}"), (2, 0, f"{passage} {own[2]}"), (3, 0, f"{passage} {own[1]} more"), (4, 1, f"{passage} {own[1]} idiot"),
            (5, 1, f"{passage} {own[5]}")]
    sample = spark.createDataFrame(rows, "doc_id LONG, label INT, text STRING")
    assert sorted(r.doc_id for r in examples.without_copies(sample).collect()) == [1, 2, 4, 5]


def test_rare_significant_terms_are_kept(spark):
    """A word of 12 in about 1,500 toxic examples and of no clean one is significant, though below 1 % of them."""
    ids = [i for i in range(4200) if zlib.crc32(str(i).encode()) % 4 != 2][:3000]
    rare = set(ids[0:240:20])
    docs = [(i, f"a{i} b{i} c{i} d{i} e{i} f{i}" + (" rareinsult" if i in rare else "")) for i in ids]
    labels = [(i, int(n % 2 == 0)) for n, i in enumerate(ids)]
    index = toxicity.train(spark.createDataFrame(docs, "doc_id LONG, text STRING"), spark.createDataFrame(labels, "doc_id LONG, toxic INT"))
    assert " rareinsult " in index.terms and len(index.ids) == 12

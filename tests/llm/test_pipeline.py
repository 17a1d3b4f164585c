"""The corpus pipeline: every stage against its operator's test of single rows, and odd tables."""

import numpy as np
import test_leaks
import test_native

import corpus_pipeline


def stages(spark, docs, sf):
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out.append(stage(spark, out[-1], sf))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out[-1].columns == docs.columns
            out[-1] = spark.createDataFrame(out[-1].collect(), docs.schema)
    return out


def test_stages_on_the_given_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    steps = stages(spark, docs, sf)
    ids = [{r.doc_id for r in s.collect()} for s in steps]
    assert all(b <= a for a, b in zip(ids, ids[1:]))
    clean = [i for i, r in labels.items() if r.toxic == 0]
    assert np.mean([i in ids[1] for i in clean]) > 0.96
    sound = [i for i, r in labels.items() if r.quality == 1 and i in ids[1]]
    assert np.mean([i in ids[2] for i in sound]) > 0.99
    texts = {r.doc_id: r.text for r in docs.collect()}
    exact = {}
    for i in sorted(ids[2]):
        exact.setdefault(" ".join(texts[i].split()), i)
    assert ids[3] <= set(exact.values())
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    leaking = {d for d, _ in test_leaks.brute([(i, texts[i]) for i in ids[3]], items)}
    assert ids[4] == ids[3] - leaking and leaking
    left = [(r.doc_id, r.text, r.source) for r in steps[4].collect()]
    test_native.check_mix(steps[5].collect(), left, 3)
    again = corpus_pipeline.run(spark, sf).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, steps[5].collect()))


def test_odd_documents(spark, tmp_path):
    schema = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, score DOUBLE, node STRING, leaks INT, again STRING, place INT"
    rows = [(1, "an item that tests well should not be here at all today", None, None, None), (2, None, "en", "a", 0), (3, "", "en", "a", 0),
            (4, "some words stand here for once", "en", "a", 1), (5, "some words stand here for once", "en", "b", 1),
            (5, "some words stand here for once", "en", "b", 1), (None, "a row without an id", "en", None, 1), (6, "long " * 40_000, "en", "b", 9)]
    docs = spark.createDataFrame([(*r, 0.1, "n", 3, "g", 4) for r in rows], schema)
    spark.createDataFrame([], "doc_id LONG, quality INT, toxic INT").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "an item that tests well should not be here")], "item_id LONG, text STRING").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id for r in got), key=repr) == sorted([2, 4, 6, None], key=repr)
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{tmp_path}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/none/{t}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []

"""Benchmark decontamination against plain search."""

import re

from sheafline.llm import leaks
from sheafline.llm.queries import op5_decontamination


def words(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def runs(w):
    k = min(5, len(w))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if k else set()


def brute(docs, items):
    """Items of which a document holds at least 0.8 of the five-word runs, anywhere in it."""
    found = set()
    known = [(i, words(t)) for i, t in items]
    wanted = {}
    for i, w in known:
        for r in runs(w):
            wanted.setdefault(r, []).append(i)
    size = {i: len(runs(w)) for i, w in known}
    lengths = {min(5, len(w)) for _, w in known}
    for d, t in docs:
        w, hit = words(t), {}
        for k in lengths - {0}:
            for r in {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}:
                for i in wanted.get(r, ()):
                    hit[i] = hit.get(i, 0) + 1
        found |= {(d, i) for i, n in hit.items() if n >= 0.8 * size[i]}
    return found


def test_query_matches_plain_search(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r.doc_id, r.item_id) for r in op5_decontamination(spark, sf).collect()}
    assert got == brute(docs, items) and len(got) > 10


def test_retrieval_is_exact(spark):
    """The pivot and block tests lose no item that reaches the score."""
    import numpy as np
    import pyarrow as pa

    from sheafline.llm.tokens import PLAIN, slices

    sf = "/root/testdata/sf0.01"
    (index,) = leaks.build(spark.read.parquet(f"{sf}/benchmark.parquet"))
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(150).collect()]
    (x,) = slices(pa.array(texts), PLAIN)
    got = {(t, i, first) for t, i, _, first, _ in leaks._find(index, x)}
    want, step, width = set(), index.longest, 2 * index.longest + leaks.GRAM
    weight = {}
    for t, w in enumerate(index.vocabulary):
        for p in range(index.starts[t], index.starts[t + 1]):
            weight.setdefault(int(w), []).append((index.item[p], index.weight[p]))
    for t in range(x.count):
        for first in range(x.bounds[t], x.bounds[t + 1], step):
            score = np.zeros(len(index.ids))
            for w in {int(h) for h in x.hashes[first:min(first + width, x.bounds[t + 1])]}:
                for i, v in weight.get(w, ()):
                    score[i] += v
            want |= {(t, int(i), int(first)) for i in np.flatnonzero(score >= leaks.SCORE)}
    assert got == want and want


def test_corner_cases(spark, monkeypatch):
    monkeypatch.setattr(leaks, "ITEMS", 1)  # several groups
    long = "filler " * 50_000
    items = spark.createDataFrame([(1, "What is the tallest hill in the green land?\nOld Grey Top"), (2, None), (3, ""),
                                   (4, "Short one"), (5, "What is the tallest hill in the green land?\nOld Grey Top"), (None, "an item with no id at all")],
                                  "item_id LONG, text STRING")
    docs = spark.createDataFrame([(1, long + "what is the TALLEST hill, in the green land? old grey top " + long, 0), (2, None, 0), (3, "", 0),
                                  (3, "a short one here", 0), (4, "what is the tallest hill", 0), (None, "x an item with no id at all y", 0)],
                                 "doc_id LONG, text STRING, leaks INT")
    groups = leaks.build(items)
    assert len(groups) > 1
    got = leaks.scan(docs, groups, leaks="found").collect()
    assert len(got) == 6
    assert sorted(((r.doc_id, x.item_id) for r in got for x in r.found), key=repr) == sorted([(1, 1), (1, 5), (3, 4), (None, None)], key=repr)
    (x,) = [x for r in got for x in r.found if x.item_id == 1]
    assert x.question_overlap == x.answer_overlap == x.overlap == 1
    assert leaks.scan(docs.limit(0), groups).collect() == []
    assert all(not r.leaks for r in leaks.scan(docs, leaks.build(items.limit(0))).collect())

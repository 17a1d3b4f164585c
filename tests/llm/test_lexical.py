"""Ranked lexical search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from sheafline.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def plain(docs, queries, k=10):
    counts = [(d, Counter(words(t))) for d, t in docs if words(t)]
    n, size = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for q, text in queries:
        asked, scored = Counter(words(text)), []
        for d, c in counts:
            m = 25 + (75 * sum(c.values()) * n) // size
            score = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                        for t, times in asked.items() if t in c)
            if score > 0:
                scored.append((-score, d))
        out += [(q, rank, d, -s) for rank, (s, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def run(spark, docs, queries, k=10):
    index = lexical.build(spark.createDataFrame(docs, "doc_id LONG, text STRING").repartition(3))
    got = lexical.search(index, spark.createDataFrame(queries, "item_id LONG, text STRING"), k=k)
    return sorted(map(tuple, got.collect()), key=repr)


def corpus(seed, count, longest=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    return [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randint(0, longest)))) for i in rng.sample(range(10 * count), count)], rng, vocabulary


@pytest.mark.parametrize("postings, window, block", [(1 << 21, 1 << 11, 128), (3000, 64, 8), (500, 16, 4)])
def test_against_all_documents(spark, monkeypatch, postings, window, block):
    for name, value in (("POSTINGS", postings), ("WINDOW", window), ("BLOCK", block), ("TOGETHER", 2)):
        monkeypatch.setattr(lexical, name, value)
    docs, rng, vocabulary = corpus(1, 900)
    docs += [(100_000 + i, docs[i % 40][1]) for i in range(120)]  # copies: equal scores
    queries = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 25)))) for i in range(40)]
    assert run(spark, docs, queries) == plain(docs, queries)


def test_bundles_and_long_documents(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BUNDLE", 100)
    docs, rng, vocabulary = corpus(2, 200)
    docs += [(50_000, "w1 " * 300_000 + "rare"), (50_001, "rare"), (50_002, " ".join(f"x{i}" for i in range(70_000)))]
    queries = [(i, " ".join(rng.choices(vocabulary, k=6))) for i in range(30)] + [(99, "rare w1 x3"), (100, "W1 w1 W1")]
    assert run(spark, docs, queries, k=3) == plain(docs, queries, k=3)


def test_blocks_are_rejected_unread():
    """Long lists of common terms are mostly never decompressed."""
    rng = np.random.default_rng(5)
    shard = lexical.Shard()
    for d in range(30_000):
        shard.add(d, [b"common"] * int(rng.integers(1, 4)) + [b"w%d" % i for i in rng.integers(0, 3000, size=int(rng.integers(5, 40)))])
    arrays = shard.arrays()
    lists = type("Held", (), arrays)()
    find = {t: i for i, t in enumerate(bytes(arrays["text"][a:b]) for a, b in zip(np.append(0, arrays["text_end"][:-1]), arrays["text_end"]))}
    n, size = 30_000, int(arrays["length"].sum())
    m = 25 + 75 * arrays["length"] * n // size
    read = []
    for q in range(20):
        own = [lexical.Postings(lists, find[t], m) for t in (b"common", b"w%d" % q, b"w%d" % (q + 50))]
        weighted = [(math.floor(1000 * math.log((2 * n + 2) / (2 * p.df + 1))), p) for p in own]
        total = np.zeros(n, dtype=np.int64)
        for w, p in weighted:
            doc, impact = p.read(np.arange(len(p.firsts)))
            total[doc] += w * impact
        order = np.lexsort((arrays["doc"], -total))[:10]
        seen = []
        scores, ids = lexical.best_of(n, weighted, (np.zeros(0, np.int64),) * 2, arrays["doc"], 10, seen)
        assert scores.tolist() == total[order].tolist() and ids.tolist() == arrays["doc"][order].tolist()
        read.append(sum(seen) / sum(len(p.firsts) for p in own))
    assert np.mean(read) < 0.5


def test_corner_cases(spark):
    docs = [(1, None), (2, ""), (3, "--"), (4, "É É ab"), (4, "É É ab"), (5, "é AB"), (6, "x y")]
    queries = [(1, "É"), (2, "ab AB"), (2, "ab AB"), (3, None), (4, ""), (5, "unknown"), (None, "x"), (7, "\x00.")]
    assert run(spark, docs, queries) == plain(docs, queries)
    assert run(spark, [], queries) == [] and run(spark, docs, []) == [] and run(spark, [(1, None)], queries) == []
    table = spark.createDataFrame([(1, "a b", "c", 5)], "item_id LONG, text STRING, rank STRING, number INT")
    index = lexical.build(spark.createDataFrame([(9, "a", "t", 1)], "doc_id LONG, text STRING, path STRING, size INT"))
    assert [r.doc_id for r in lexical.search(index, table, keep=("item_id", "number")).collect()] == [9]

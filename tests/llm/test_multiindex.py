"""Near-duplicate embeddings against all pairs."""

import math

import numpy as np
import pyarrow as pa
import pytest

from sheafline.llm import multiindex
from sheafline.llm.queries import op6_multi_index


def brute(rows):
    good = [(i, np.array(v, dtype=np.float64)) for i, v in rows
            if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    unit = [(i, v / np.linalg.norm(v)) for i, v in good]
    linked = {k: set() for k in range(len(unit))}
    for a in range(len(unit)):
        for b in range(a):
            if len(unit[a][1]) == len(unit[b][1]) and unit[a][1] @ unit[b][1] >= 0.9:
                linked[a].add(b)
                linked[b].add(a)
    component, out = {}, [(i, 0, i, True) for i, v in rows if i not in {g for g, _ in good}]
    for k in linked:
        if k not in component:
            todo, seen = [k], {k}
            while todo:
                for o in linked[todo.pop()] - seen:
                    seen.add(o)
                    todo.append(o)
            for s in seen:
                component[s] = min(unit[s2][0] for s2 in seen)
    return sorted(out + [(unit[k][0], len(linked[k]), component[k], unit[k][0] == component[k]) for k in linked])


def test_query_matches_all_pairs(spark):
    """Exact here; the operator promises a recall of 0.9 at least."""
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in op6_multi_index(spark, sf).collect())
    want = brute(rows)
    found, true = sum(r[1] for r in got), sum(r[1] for r in want)
    assert len(got) == len(want) and found >= 0.99 * true and all(g[1] <= w[1] for g, w in zip(got, want))
    assert got == want


@pytest.mark.parametrize("dense", [False, True])
def test_recall_of_sparse_links(spark, dense):
    """Planted pairs close to the threshold among vectors without links, also beside a cluster of a quarter of all."""
    rng, size = np.random.default_rng(7), 64
    points = rng.normal(size=(40_000, size))
    if dense:
        points[:10_000] = rng.normal(size=size) + rng.normal(size=(10_000, size)) * 0.05
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    first = points[-600:]
    away = rng.normal(size=first.shape)
    away -= (away * first).sum(1)[:, None] * first
    away /= np.linalg.norm(away, axis=1, keepdims=True)
    cosine = np.where(np.arange(600) % 2, 0.905, 0.92)[:, None]
    points = np.concatenate([points, cosine * first + np.sqrt(1 - cosine ** 2) * away])
    if dense:
        points = points[7_500:]  # the cluster shrinks, its links stay many
    table = pa.table({"vec_id": np.arange(len(points)), "embedding": list(points)})
    frame = spark.createDataFrame(table).repartition(8)
    got = {r.vec_id: r.n_links for r in multiindex.links(frame).where(f"vec_id >= {len(points) - 600}").collect()}
    found = np.array([got[len(points) - 600 + i] for i in range(600)])
    assert found[::2].mean() >= 0.9 and found[1::2].mean() >= 0.9 and found.max() == 1


def test_crowded_cells_are_cut(spark, monkeypatch):
    """Blocks, copies and one-sided visits give the same numbers."""
    monkeypatch.setattr(multiindex, "SIDE", 16)
    monkeypatch.setattr(multiindex, "CHUNK", 8)
    rng = np.random.default_rng(3)
    centre = rng.normal(size=8)
    rows = [(i, (centre + rng.normal(size=8) * 0.25).tolist()) for i in range(150)]
    rows += [(200 + i, rng.normal(size=8).tolist()) for i in range(60)]
    rows += [(300 + i, rows[i % 3][1]) for i in range(40)]
    frame = spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<DOUBLE>")
    got = sorted(tuple(r) for r in multiindex.links(frame).collect())
    want = brute(rows)
    assert sum(r[1] for r in got) >= 0.95 * sum(r[1] for r in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    everything = multiindex.build(frame.selectExpr("vec_id AS node", "CAST(NULL AS BINARY) AS unit").limit(0))
    everything.visits = 1  # no codebooks: one cell, so nothing can be missed
    assert sorted(tuple(r) for r in multiindex.links(frame, index=everything).collect()) == want


def test_corner_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, []),
            (9, [1.0, 0.0, 0.0]), (10, [-1.0, 0.0]), (11, [1e300, 1e300]), (12, [1e-300, 1e-300]), (13, [1.0])]
    frame = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id LONG, embedding ARRAY<DOUBLE>, label INT, node STRING")
    got = sorted(tuple(r) for r in multiindex.links(frame).collect())
    assert got == [(i, n, c, i == c) for i, n, c in [(1, 1, 1), (2, 1, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 0, 8),
                                                     (9, 0, 9), (10, 0, 10), (11, 1, 11), (12, 1, 11), (13, 0, 13)]]
    assert multiindex.links(frame.limit(0)).collect() == []
    twice = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])], "vec_id LONG, embedding ARRAY<FLOAT>")
    assert sorted((tuple(r) for r in multiindex.links(twice).collect()), key=repr) == sorted(
        [(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False)], key=repr)

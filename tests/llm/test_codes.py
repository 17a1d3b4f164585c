"""Vector codes: Ball k-means against comparing with every entry."""

import math

import numpy as np

from sheafline.llm import codes


def plain(rows, parts, entries, rounds):
    """(id, vector) -> {position: (code, error)}, codebooks, by the definition in plain integers."""
    kept = [(i, [math.floor(256 * x) for x in v], n) for n, (i, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0], r[1]))
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width:(p + 1) * width]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))
    for r in range(rounds + 1):
        found = [[near(cut(v, p), books[p]) for p in range(parts)] for _, v, _ in kept]
        if r < rounds:
            for p in range(parts):
                for e in range(len(books[p])):
                    own = [cut(v, p) for (_, v, _), f in zip(kept, found) if f[p][1] == e]
                    if own:
                        books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    return {n: ("".join(f"{i:02x}" for _, i in f), sum(d for d, _ in f)) for (_, _, n), f in zip(kept, found)}, books


def check(spark, rows, schema="vec_id LONG, embedding ARRAY<DOUBLE>, at INT", **how):
    table = spark.createDataFrame([(i, v, n) for n, (i, v) in enumerate(rows)], schema).repartition(3)
    coded, books = codes.compress(table, keep=("at",), **how)
    want, want_books = plain(rows, how.get("parts", codes.PARTS), how.get("entries", codes.ENTRIES), how.get("rounds", codes.ROUNDS))
    assert {r[0]: (r.code, r.error) for r in coded.collect()} == want
    assert books.tolist() == want_books


def test_against_all_entries(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 32))
    rows = [(int(i), (centres[rng.integers(12)] + rng.normal(size=32) * 0.1).tolist()) for i in rng.permutation(500)]
    check(spark, rows)
    check(spark, rows, parts=4, entries=20, rounds=5)


def test_ties_and_copies(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.integers(-1, 2, size=16) / 256).tolist()) for i in range(300)]  # few places, many equal distances
    check(spark, rows + [(i, rows[0][1]) for i in range(100)])
    check(spark, rows[:5])


def test_rings_skip_work_and_lose_nothing():
    rng = np.random.default_rng(4)
    entries = rng.integers(-500, 500, size=(64, 4))
    points = entries[rng.integers(64, size=5000)] + rng.integers(-30, 31, size=(5000, 4))
    want, error = codes.nearest(points, entries)
    near = want.copy()
    near[::50] = 0  # some were elsewhere
    code, best, looked = codes.Balls(entries).assign(points, near)
    assert (code == want).all() and (best == error).all()
    assert looked < 0.1 * 63 * len(points)


def test_corner_cases(spark):
    nan, inf = float("nan"), float("inf")
    good = [0.5] * 16
    rows = [(1, good, "a"), (2, None, "a"), (3, [nan] * 16, "b"), (4, [inf] * 16, None), (5, [None] * 16, None), (6, [], "a"), (7, [1.0] * 32, "a"),
            (8, [1e300] * 16, None), (9, good, None), (9, good, None)]
    table = spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<DOUBLE>, label STRING")
    coded, _ = codes.compress(table, keep=("vec_id", "label"))
    got = codes.grouped_error(coded).collect()
    assert sorted((r.vec_id, r.label, r.error, r.label_error) for r in got if r.vec_id < 9) == [(1, "a", 0, 0), (8, None, 0, 0)]
    assert len(got) == 4
    empty, books = codes.compress(table.limit(0), keep=("vec_id", "label"))
    assert codes.grouped_error(empty).collect() == [] and books.size == 0 and len(codes.digest(books)) == 64
    ragged = spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "vec_id LONG, embedding ARRAY<DOUBLE>")
    assert codes.compress(ragged)[0].collect() == []
    clash = spark.createDataFrame([(1, good, "x", 7)], "vec_id LONG, embedding ARRAY<FLOAT>, __code STRING, `a.b` INT")
    assert [tuple(r) for r in codes.compress(clash, keep=("__code", "a.b", "vec_id"))[0].collect()] == [("x", 7, 1, "00" * 16, 0)]


def test_label_sums_with_hot_and_rare_labels(spark, monkeypatch):
    monkeypatch.setattr(codes, "HOT", 4)
    rows = [(i, 0 if i % 3 == 0 else None if i % 3 == 1 else i, i) for i in range(90)]
    table = spark.createDataFrame(rows, "vec_id LONG, label INT, error LONG")
    want = {None: sum(i for i, l, _ in rows if l is None), 0: sum(i for i, l, _ in rows if l == 0)}
    assert sorted((r.vec_id, r.label_error) for r in codes.grouped_error(table).collect()) == [(i, want.get(l, i)) for i, l, _ in rows]

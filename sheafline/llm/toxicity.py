"""Toxicity of texts by their nearest labelled examples under TF-IDF cosine.

Terms are words and word beginnings (BEGINNINGS letters) of the lower-cased text, a word being a run of letters and
digits. The vector space holds every term whose frequencies among toxic and among clean examples differ, in either
direction, by a log-likelihood ratio of at least SIGNIFICANT; there is no other bound on terms. A weight is
(1 + log tf) * idf with idf from the examples. The examples, at most PER_CLASS documents a class and near copies once
(else one text's words would look typical), form an inverted index: postings of a term are grouped in blocks of BLOCK
examples, each with the largest weight in it. Postings of terms that fill at least 1 / FULL of the examples are held as
whole slabs per block, the others as lists; slabs thus take at most FULL times the memory of their postings, and a
block is opened for many texts by one matrix product. A query sums, per block, its weights times these maxima; the FIRST_BLOCKS blocks of the
largest bounds are opened, then all whose bound reaches the NEIGHBOURS-th best cosine of these. The result is exact;
equal cosines are taken in example order.

Neighbours vote with 1 / (distance + SOFT), a class counting in proportion to its real number. The votes of the
examples themselves, each without its own, are turned into probabilities by isotonic regression. Texts with no term
in common with any example, empty and null ones too, get the share of toxic examples among texts without terms. Equal
texts get equal scores: ids and labels of the scored rows are never inputs. Without toxic examples all scores are 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter, OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import examples
from .passing import with_text

PER_CLASS = 4000
SIGNIFICANT = 13.0
BEGINNINGS = (3, 4, 5, 6)
BLOCK = 64
FIRST_BLOCKS = 4
FULL = 16
TOGETHER = 128  # texts looked up at once
NEIGHBOURS = 15
SOFT = 0.05
EVIDENCE = 3
THRESHOLD = 0.3
_SPLIT = re.compile(r"[\W_]+")
_KEPT_BYTES = 16 << 20  # of judged vectors, per worker
_ENTRY = 400  # bytes of an entry besides its key


def plain(text: str | None) -> str:
    return " " + _SPLIT.sub(" ", (text or "").lower()).strip() + " "


def terms_of(text: str | None) -> Counter:
    """Terms with their counts: ` word ` for a whole word, ` wor` for a beginning."""
    found: Counter = Counter()
    for word, n in Counter(plain(text).split()).items():
        found[f" {word} "] += n
        for size in BEGINNINGS:
            if len(word) >= size:
                found[f" {word[:size]}"] += n
    return found


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            part = batch.slice(at, 200)
            for label, text in zip(part.column(0).to_pylist(), part.column(1)):
                seen[label].update(terms_of(text.as_py()).keys())
            terms = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_pydict({"term": pa.array(terms, pa.string()),
                                              "toxic": pa.array([seen[1][t] for t in terms], pa.int64()),
                                              "clean": pa.array([seen[0][t] for t in terms], pa.int64())})


def _likelihood_ratio(a, b, n1: int, n0: int):
    """G2 of a term in a of n1 toxic and b of n0 clean examples."""
    def cell(x, expected):
        return F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)

    total = n1 + n0
    with_, without = a + b, F.lit(total) - a - b
    return 2 * (cell(a, with_ * n1 / total) + cell(b, with_ * n0 / total)
                + cell(F.lit(n1) - a, without * n1 / total) + cell(F.lit(n0) - b, without * n0 / total))


class Finder:
    """Counts the chosen terms in a text."""

    def __init__(self, terms: list[str]):
        self.machine = ahocorasick.Automaton()
        for i, term in enumerate(terms):
            self.machine.add_word(term, i)
        if terms:
            self.machine.make_automaton()
        self.any = bool(terms)

    def __call__(self, text: str | None) -> tuple[tuple[int, int], ...]:
        if not self.any:
            return ()
        return tuple(sorted(Counter(i for _, i in self.machine.iter(plain(text))).items()))


@dataclass
class Index:
    """Examples by term. `starts` bounds the postings of (term, block); `top` has the largest weight of each."""

    terms: list[str]
    idf: np.ndarray
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    label: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    vote: np.ndarray = field(default_factory=lambda: np.zeros(0))
    example: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))
    starts: np.ndarray = field(default_factory=lambda: np.zeros((0, 1), np.int64))
    top: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    none: float = 0.0
    size: int = 0
    steps: tuple[np.ndarray, np.ndarray] = (np.zeros(0), np.zeros(0))

    def id_type(self) -> str:
        return "BIGINT" if self.ids.dtype.kind == "i" else "STRING"

    def vector(self, counts: tuple[tuple[int, int], ...]) -> tuple[np.ndarray, np.ndarray]:
        terms = np.array([t for t, _ in counts], dtype=np.int64)
        weight = (1 + np.log([n for _, n in counts])) * self.idf[terms]
        return terms, weight / math.sqrt(float(weight @ weight))

    def build(self, vectors: list[tuple[tuple[int, int], ...]]) -> None:
        self.size = len(vectors)
        blocks = -(-len(vectors) // BLOCK)
        found = [self.vector(v) for v in vectors]
        term = np.concatenate([t for t, _ in found])
        example = np.repeat(np.arange(len(found)), [len(t) for t, _ in found])
        weight = np.concatenate([w for _, w in found])
        order = np.lexsort((example, term))
        term, self.example, self.weight = term[order], example[order], weight[order]
        cell = term * blocks + self.example // BLOCK
        bounds = np.searchsorted(cell, np.arange(len(self.terms) * blocks + 1))
        self.starts = np.stack([bounds[:-1], bounds[1:]], 1).reshape(len(self.terms), blocks, 2)
        self.top = np.zeros(len(self.terms) * blocks)
        np.maximum.at(self.top, cell, self.weight)
        self.top = self.top.reshape(len(self.terms), blocks)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "slabs"}  # workers make their own

    def _opened(self) -> tuple[np.ndarray, np.ndarray]:
        """Slot of each term among the filling ones (-1: none), and the weights as (block, slot, example of the block)."""
        if "slabs" not in self.__dict__:
            held = self.starts[:, -1, 1] - self.starts[:, 0, 0]
            filling = np.flatnonzero(held * FULL >= self.size)
            slot = np.full(len(self.terms), -1)
            slot[filling] = np.arange(len(filling))
            at = slot[np.repeat(np.arange(len(self.terms)), held)]
            slabs = np.zeros((self.top.shape[1], len(filling), BLOCK))
            there = at >= 0
            slabs[self.example[there] // BLOCK, at[there], self.example[there] % BLOCK] = self.weight[there]
            self.slabs = slot, slabs
        return self.slabs

    def nearest(self, terms: np.ndarray, weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest cosine above 0, exactly: (example, cosine), best first, ties by example."""
        return self.nearest_of([(terms, weight)], k)[0]

    def nearest_of(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """`nearest` for several vectors.

        The most promising blocks are opened first, then all whose bound reaches the k-th best of these."""
        slot, slabs = self._opened()
        many, blocks = len(vectors), len(slabs)
        filling, bound = np.zeros((many, slabs.shape[1])), np.zeros((many, blocks))
        listed = np.zeros((many, blocks * BLOCK))
        for i, (terms, weight) in enumerate(vectors):
            at = slot[terms]
            filling[i, at[at >= 0]] = weight[at >= 0]
            bound[i] = weight @ self.top[terms]
            rest, factor = terms[at < 0], weight[at < 0]
            if len(rest):
                start = self.starts[rest, 0, 0]
                count = self.starts[rest, -1, 1] - start
                posting = np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())
                listed[i] = np.bincount(self.example[posting], weights=np.repeat(factor, count) * self.weight[posting], minlength=blocks * BLOCK)
        listed, cosine = listed.reshape(many, blocks, BLOCK), np.zeros((many, blocks, BLOCK))

        def open_blocks(wanted: np.ndarray) -> None:
            for block in np.flatnonzero(wanted.any(axis=0)):
                rows = np.flatnonzero(wanted[:, block])
                cosine[rows, block] = np.round(np.minimum(filling[rows] @ slabs[block] + listed[rows, block], 1.0), 12)

        first = np.zeros((many, blocks), dtype=bool)
        if blocks > FIRST_BLOCKS:
            np.put_along_axis(first, np.argpartition(-bound, FIRST_BLOCKS - 1, axis=1)[:, :FIRST_BLOCKS], True, axis=1)
            open_blocks(first)
        flat = cosine.reshape(many, -1)
        kth = np.partition(flat, -k, axis=1)[:, -k] if flat.shape[1] >= k else np.zeros(many)
        # a small slack keeps blocks whose sums differ from the bound by rounding only
        open_blocks(~first & (bound >= np.maximum(kth - 1e-9, 1e-12)[:, None]))
        return [self._best(flat[i, :self.size], k) for i in range(many)]

    @staticmethod
    def _best(cosine: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        least = np.partition(cosine, -k)[-k] if len(cosine) > k else 0.0
        at = np.flatnonzero((cosine >= least) & (cosine > 1e-12))
        at = at[np.argsort(-cosine[at], kind="stable")][:k]
        return at, cosine[at]

    def raw(self, at: np.ndarray, cosine: np.ndarray) -> float:
        votes = self.vote[at] / (1 - cosine + SOFT)
        return float(votes @ self.label[at] / votes.sum())

    def calibrated(self, raw: float) -> float:
        return float(np.interp(raw, *self.steps)) if len(self.steps[0]) else raw


def _isotonic(raw: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Increasing fit of the labels by pooling neighbours that are out of order: (raw, probability) points."""
    x, back = np.unique(raw, return_inverse=True)
    w = np.bincount(back, weights=weight)
    y = np.bincount(back, weights=weight * label) / w
    pools: list[list[float]] = []  # value, weight, first and last x
    for xi, yi, wi in zip(x, y, w):
        pools.append([yi, wi, xi, xi])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            b, a = pools.pop(), pools.pop()
            pools.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2], b[3]])
    points = [(x_, p[0]) for p in pools for x_ in dict.fromkeys((p[2], p[3]))]
    return np.array([p[0] for p in points]), np.array([p[1] for p in points])


def train(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Index:
    """Learns from `labels` (doc_id, toxic 0 or 1) and the documents they belong to."""
    sample, totals = examples.labelled(documents, labels, F.col("toxic"), range(2), per_class)
    sample = examples.without_copies(sample)
    rows = sample.select("label", "text")
    size = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    if not n1:
        return Index([], np.zeros(0))
    toxic, clean = F.col("toxic"), F.col("clean")
    counted = (rows.mapInArrow(_count_terms, "term STRING, toxic BIGINT, clean BIGINT")
               .groupBy("term").agg(F.sum("toxic").cast("double").alias("toxic"), F.sum("clean").cast("double").alias("clean")))
    chosen = counted.where(_likelihood_ratio(toxic, clean, n1, n0) >= SIGNIFICANT).collect()
    terms = sorted(r.term for r in chosen)
    idf = {r.term: math.log((n1 + n0 + 1) / (r.toxic + r.clean + 1)) + 1 for r in chosen}
    index = Index(terms, np.array([idf[t] for t in terms]))
    finder = Finder(terms)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([[x for p in finder(t.as_py()) for x in p] for t in batch.column(2)], pa.list_(pa.int32()))],
                names=["doc_id", "label", "counts"])

    ids = f"doc_id {sample.schema['doc_id'].dataType.simpleString()}"
    got = sample.select("doc_id", "label", "text").mapInArrow(found, f"{ids}, label INT, counts ARRAY<INT>").collect()
    share = {c: totals.get(c, 0) / max(size.get(c, 0), 1) for c in (0, 1)}
    bare = [share[r.label] * np.array([1, r.label]) for r in got if not r.counts]
    if bare:
        index.none = float(sum(b[1] for b in bare) / sum(b[0] for b in bare))
    # examples that share their terms stand together, which makes the blocks' maxima sharp
    got = sorted((tuple(zip(r.counts[::2], r.counts[1::2])), r.doc_id, r.label) for r in got if r.counts)
    if not got:
        return index
    index.ids, index.label = np.array([g[1] for g in got]), np.array([g[2] for g in got])
    index.vote = np.array([share[g[2]] for g in got])
    index.build([g[0] for g in got])
    raw, own = [], []
    for start in range(0, len(got), TOGETHER):
        found_ = index.nearest_of([index.vector(g[0]) for g in got[start:start + TOGETHER]], NEIGHBOURS + 1)
        for i, (at, cosine) in enumerate(found_, start):
            others = np.flatnonzero(at != i)[:NEIGHBOURS]
            if len(others):
                raw.append(index.raw(at[others], cosine[others]))
                own.append(i)
    if raw:
        index.steps = _isotonic(np.array(raw), index.label[own], index.vote[own])
    return index


def _scorer(index: Index, keep: int, place: int, prefix: str):
    state: dict = {}

    def judged(vectors: list) -> list[tuple[float, list[int]]]:
        out = []
        for at, cosine in index.nearest_of([index.vector(v) for v in vectors], NEIGHBOURS):
            out.append((index.calibrated(index.raw(at, cosine)), index.ids[at[:EVIDENCE]].tolist()) if len(at) else (index.none, []))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not state:
            state.update(finder=Finder(index.terms), seen=OrderedDict(), held=0)
        finder, seen = state["finder"], state["seen"]
        for whole in batches:
            for start in range(0, whole.num_rows, TOGETHER):
                batch = whole.slice(start, TOGETHER)
                found = [finder(t.as_py()) for t in batch.column(place)]
                keys = [np.array(v, np.int32).tobytes() for v in found]
                counts = dict(zip(keys, found))
                new = [key for key in counts if key and key not in seen]
                got = {key: seen[key] for key in counts if key in seen} | {b"": (index.none, [])}
                got.update(zip(new, judged([counts[key] for key in new]) if new else []))
                for key in new:
                    seen[key] = got[key]
                    state["held"] += len(key) + _ENTRY
                while state["held"] > _KEPT_BYTES:
                    state["held"] -= len(seen.popitem(last=False)[0]) + _ENTRY
                out = [got[key] for key in keys]
                score = pa.array([min(max(s, 0.0), 1.0) for s, _ in out], pa.float64())
                evidence = pa.array([e for _, e in out], pa.list_(pa.int64() if index.id_type() == "BIGINT" else pa.string()))
                yield pa.RecordBatch.from_arrays([*batch.columns[:keep], score, evidence],
                                                 names=[*batch.schema.names[:keep], prefix + "score", prefix + "evidence"])

    return run


def score(documents: DataFrame, index: Index, keep: tuple[str, ...] = ("doc_id",), text: str = "text", prefix: str = "") -> DataFrame:
    """Columns `keep`, then score (0 to 1) and evidence: the ids of the nearest examples, best first. The names of both
    come after `prefix`."""
    rows, place, kept = with_text(documents, keep, text)
    return rows.mapInArrow(_scorer(index, len(keep), place, prefix), f"{kept}, {prefix}score DOUBLE, {prefix}evidence ARRAY<{index.id_type()}>")

"""Quality of texts by ordinal regression on graded ratings.

A cumulative-link model: P(grade <= k) = s(t_k - w.x) with s the logistic function, ordered thresholds t_k, and one
weight vector w for all thresholds over hashed features x of the whole text:

* words, hashed into WORDS cells: square roots of their counts, of unit length in all;
* word shapes (runs of letters, digits and single signs, such as `a,` or `a%`), hashed into SHAPES cells, and words
  that repeat the word before: shares of all words.

The fit is on a bounded sample, at most PER_GRADE documents of each grade, reweighted to the grades' real numbers; it
is a smooth problem solved by full-batch steps on the driver, which gets the sample's features and nothing else. Scoring
reads every text once. Expected grade and tail probability P(grade >= cut) follow from the thresholds.

Null and empty texts have no features: their scores follow from the thresholds alone. A grade without examples, or
fewer than two grades, leaves the scores at the grades' shares. Equal texts get equal scores; ids are never inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import examples
from .passing import with_text
from .tokens import _BYTE, Texts, slices

PER_GRADE = 3000
WORDS, SHAPES = 1 << 17, 1 << 12
REPEAT = WORDS + SHAPES
SIZE = REPEAT + 1
SHAPE_SCALE = 3.0
STEPS, RATE, RIDGE = 150, 0.1, 1e-5
SELECT = 0.5

_KIND = np.arange(256, dtype=np.uint8)
_KIND[48:58] = 48
_KIND[97:123] = 97
_KIND[128:] = 97


def features(x: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, cell and value of every feature of a slice, by text."""
    total = np.maximum(np.diff(x.bounds), 1).astype(np.float64)

    def counted(cell: np.ndarray, size: int, doc: np.ndarray):
        key, n = np.unique(doc * size + cell, return_counts=True)
        return key // size, key % size, n

    doc, cell, n = counted((x.hashes >> np.uint64(47)).astype(np.int64), WORDS, x.doc)
    length = np.sqrt(np.bincount(doc, weights=n, minlength=x.count))
    parts = [(doc, cell, np.sqrt(n) / length[doc])]
    kind = _KIND[x.data]
    new = x.word.copy()
    new[1:] &= (kind[1:] != kind[:-1]) | ~x.word[:-1]
    new[x.starts] = True
    shape = x.fold(np.where(new, _BYTE[kind], np.uint64(0)))
    doc, cell, n = counted((shape >> np.uint64(52)).astype(np.int64), SHAPES, x.doc)
    parts.append((doc, WORDS + cell, SHAPE_SCALE * n / total[doc]))
    again = np.zeros(len(x.doc), dtype=bool)
    again[1:] = (x.hashes[1:] == x.hashes[:-1]) & (x.doc[1:] == x.doc[:-1])
    n = np.bincount(x.doc[again], minlength=x.count)
    doc = np.flatnonzero(n)
    parts.append((doc, np.full(len(doc), REPEAT), SHAPE_SCALE * n[doc] / total[doc]))
    return tuple(np.concatenate([p[i] for p in parts]) for i in range(3))


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # of grades 0 .. K-2; increasing


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def probabilities(latent: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade = k), one column per grade."""
    below = _logistic(thresholds[None, :] - latent[:, None])
    edges = np.concatenate([np.zeros((len(latent), 1)), below, np.ones((len(latent), 1))], axis=1)
    return np.diff(edges, axis=1)


def _fit(doc, cell, value, grade, weight, grades: int) -> Model:
    """Adam on the weighted mean log-likelihood. Thresholds are a first one and positive steps."""
    shares = np.bincount(grade, weights=weight, minlength=grades) / max(weight.sum(), 1e-9)
    below = np.clip(np.cumsum(shares)[:-1], 1e-4, 1 - 1e-4)
    thresholds = np.log(below / (1 - below))
    model = Model(np.zeros(SIZE), np.maximum.accumulate(thresholds + np.arange(grades - 1) * 1e-3))
    if np.count_nonzero(np.bincount(grade, minlength=grades)) < 2:
        return model
    used, cell = np.unique(cell, return_inverse=True)
    rows = len(grade)
    start = model.thresholds
    steps = np.log(np.maximum(np.diff(start), 1e-3))
    theta = np.concatenate([np.zeros(len(used)), start[:1], steps])
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    weight = weight / weight.sum()
    at = np.arange(rows)
    for step in range(1, STEPS + 1):
        w, t = theta[:len(used)], np.cumsum(np.concatenate([theta[len(used):len(used) + 1], np.exp(theta[len(used) + 1:])]))
        latent = np.bincount(doc, weights=value * w[cell], minlength=rows)
        below = _logistic(t[None, :] - latent[:, None])
        edges = np.concatenate([np.zeros((rows, 1)), below, np.ones((rows, 1))], axis=1)
        slope = edges * (1 - edges)
        p = np.maximum(edges[at, grade + 1] - edges[at, grade], 1e-9)
        upper, lower = slope[at, grade + 1] / p * weight, slope[at, grade] / p * weight
        d_latent = upper - lower  # of the negative log-likelihood
        grad_t = np.zeros(grades - 1)
        np.add.at(grad_t, np.minimum(grade, grades - 2), np.where(grade < grades - 1, -upper, 0))
        np.add.at(grad_t, np.maximum(grade - 1, 0), np.where(grade > 0, lower, 0))
        tail = np.cumsum(grad_t[::-1])[::-1]
        gradient = np.concatenate([np.bincount(cell, weights=value * d_latent[doc], minlength=len(used)) + RIDGE * w,
                                   tail[:1], tail[1:] * np.exp(theta[len(used) + 1:])])
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient ** 2
        theta -= RATE * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-9)
    model.weights[used] = theta[:len(used)]
    model.thresholds = np.cumsum(np.concatenate([theta[len(used):len(used) + 1], np.exp(theta[len(used) + 1:])]))
    return model


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cells, values = [], []
        for x in slices(batch.column(1)):
            doc, cell, value = features(x)
            order = np.argsort(doc, kind="stable")
            bounds = np.searchsorted(doc[order], np.arange(x.count + 1))
            for a, b in zip(bounds[:-1], bounds[1:]):
                cells.append(cell[order[a:b]].astype("<i4").tobytes())
                values.append(value[order[a:b]].astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cells, pa.binary()), pa.array(values, pa.binary())],
                                         names=["label", "cells", "parts"])


def grade_of(quality: Column, toxic: Column) -> Column:
    """Graded rating of a labelled document: 0 poor, 1 sound but toxic, 2 sound."""
    return F.when(quality == 0, 0).when((quality == 1) & (toxic == 1), 1).when(quality == 1, 2)


def train(documents: DataFrame, labels: DataFrame, grade: Column, grades: int = 3, per_grade: int = PER_GRADE) -> Model:
    """Fits `grades` ordered grades (0, 1, ..) given by `grade`, a column over `labels` (doc_id, ..)."""
    sample, totals = examples.labelled(documents, labels, grade, range(grades), per_grade)
    rows = sample.select("label", "text").mapInArrow(_featurize, "label INT, cells BINARY, parts BINARY").collect()
    rows.sort(key=lambda r: (r.label, bytes(r.cells), bytes(r.parts)))  # the same sums on every run
    cells = [np.frombuffer(r.cells, "<i4") for r in rows]
    grade_ = np.array([r.label for r in rows], dtype=np.int64)
    seen = np.bincount(grade_, minlength=grades)
    weight = np.array([totals.get(g, 0) / max(seen[g], 1) for g in range(grades)])[grade_]
    none = np.zeros(0)
    return _fit(np.repeat(np.arange(len(rows)), [len(c) for c in cells]), np.concatenate([none.astype(np.int32), *cells]),
                np.concatenate([none, *(np.frombuffer(r.parts, "<f4") for r in rows)]), grade_, weight, grades)


def _score(model: Model, keep: int, at: int, cut: int, prefix: str):
    weights, thresholds = model.weights.astype(np.float32), model.thresholds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            latent = np.zeros(batch.num_rows)
            for x in slices(batch.column(at)):
                doc, cell, value = features(x)
                latent[x.first:x.first + x.count] = np.bincount(doc, weights=value * weights[cell], minlength=x.count)
            p = probabilities(latent, thresholds)
            more = {"expected_grade": p @ np.arange(p.shape[1]), "tail_probability": p[:, cut:].sum(1)}
            yield pa.RecordBatch.from_arrays([*batch.columns[:keep], *map(pa.array, more.values())],
                                             names=[*batch.schema.names[:keep], *(prefix + c for c in more)])

    return run


def score(documents: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), cut: int = 1, text: str = "text",
          prefix: str = "") -> DataFrame:
    """Columns `keep`, then expected_grade and tail_probability = P(grade >= cut) of every row's whole text, their
    names after `prefix`."""
    rows, at, kept = with_text(documents, keep, text)
    return rows.mapInArrow(_score(model, len(keep), at, cut, prefix),
                           f"{kept}, {prefix}expected_grade DOUBLE, {prefix}tail_probability DOUBLE")

"""Bounded samples of labelled documents, for fitting classifiers."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import omh
from .shared import store
from .tokens import slices


def held_out(doc_id: Column) -> Column:
    """One fourth of the ids; labels are learnt from the others only. A null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def labelled(documents: DataFrame, labels: DataFrame, label: Column, classes: range, most: int) -> tuple[DataFrame, dict[int, int]]:
    """At most `most` documents of each class, and how many labels each class has in all.

    Rows: doc_id, label, text. Ids are taken in hashed order, so the choice does not depend on the layout. Ids that
    are held out, null ids and null labels are left out; an id with several labels has the largest; a label without
    a document is lost from the sample; of several texts of one id the smallest counts.
    """
    known = (labels.select("doc_id", label.cast("int").alias("label")).where(F.col("label").isNotNull() & F.col("doc_id").isNotNull())
             .where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label")))
    counts = {r.label: r["count"] for r in known.groupBy("label").count().collect() if r.label in classes}
    ids = None
    for c in classes:
        some = known.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        ids = some if ids is None else ids.unionByName(some)
    # The broadcast side has at most `most` rows of 12 bytes per class.
    rows = documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")), counts


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, label, text) -> doc_id, label, keys, tokens: the order min-hashes, those of equal texts, and the words."""
    for batch in batches:
        keys, tokens = [], []
        for x in slices(batch.column(2)):
            keys += [np.append(k, n) for k, n in zip(omh._keys(x), omh._nodes(x))]
            tokens += [(x.hashes[a:b] >> np.uint64(32)).astype("<u4").tobytes() for a, b in zip(x.bounds[:-1], x.bounds[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.list_(pa.int64())), pa.array(tokens, pa.binary())],
                                         names=["doc_id", "label", "keys", "tokens"])


def _firsts(table: pa.Table) -> pa.Table:
    """The smallest doc_id of each class of near copies. Texts that share a key are aligned unless in one class already."""
    table = table.sort_by("doc_id")
    words = [np.frombuffer(t.as_buffer(), "<u4") for t in table.column("tokens")]
    parent, sharing = list(range(len(words))), {}

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i, keys in enumerate(table.column("keys").to_pylist()):
        compared = set()
        for key in keys:
            for j in sharing.setdefault(key, []):
                if j in compared or root(i) == root(j):
                    continue
                compared.add(j)
                most = math.floor((1 - omh.SIMILARITY + 1e-9) * max(len(words[i]), len(words[j])))
                if abs(len(words[i]) - len(words[j])) <= most and omh.distance(words[i], words[j], most) <= most:
                    a, b = sorted((root(i), root(j)))
                    parent[b] = a
            sharing[key].append(i)
    return table.select(["doc_id"]).take([i for i in range(len(words)) if root(i) == i])


def without_copies(sample: DataFrame) -> DataFrame:
    """A sample (doc_id, label, text) with one document, the first by id, of each class of verified near copies within a
    label. What a bounded sample says about words should not come from many copies of one text. A label, being bounded,
    is one task."""
    sample = store(sample, "examples")
    ids = f"doc_id {sample.schema['doc_id'].dataType.simpleString()}"
    described = sample.select("doc_id", "label", "text").mapInArrow(_described, f"{ids}, label INT, keys ARRAY<BIGINT>, tokens BINARY")
    return sample.join(described.groupBy("label").applyInArrow(_firsts, ids), "doc_id", "left_semi")

"""Ranked lexical search: BM25 in whole numbers over an inverted index, by Block-Max MaxScore.

Terms are runs of ASCII letters and digits and of characters beyond ASCII; A-Z count as a-z. The score of a document for
a query sums w * ((10^9 tf) div (1000 tf + 8 m)) over the query's terms, repeats included, where
w = floor(1000 ln((2 N + 2) / (2 df + 1))) and m = 25 + (75 n N) div L, with N documents that have a term, L terms in all
and n in the document. `build` writes the index, `search` returns each query's best documents.

Index. A task turns its documents into shards of about POSTINGS terms, each one file in the shared folder. A shard numbers
its documents by length and holds, for every term in order, its postings in blocks of BLOCK: the first document of each
block, then per posting the gap to the one before and tf, in the fewest bytes that fit the term's largest. Beside every
block stand the pairs (n, tf) that no other of the block beats in both: N and L are only known when all shards are written,
and the greatest impact under any N and L is that of one of these pairs, so block maxima are exact.

Search. A term's bound is its greatest block maximum times its weight. Sorted by bound, the terms whose bounds add up to less
than the score to beat (the k-th best so far) cannot bring a document in alone: their lists are non-essential. The
essential lists are read window by window and summed per document. What is found is then held against the non-essential
lists, the strongest first: a document stays while its score, the block maximum of the block it would be in and the bounds
of the lists left reach the score to beat. Only blocks that still hold such documents are decompressed. Scores equal to
the one to beat are kept, so ties are settled by doc_id at the end. A task keeps one heap per query over all its shards, so
later shards begin with a score to beat; the heaps of all tasks are merged by query.

Documents are never shuffled: a lost task is run again from its own documents or shards. Queries are cut into bundles of at
most BUNDLE bytes of text or one query, each a file that tasks load one after another. A shard's memory is bounded by
POSTINGS and its longest text; a search maps the file and reads what it needs.

Null texts and texts without terms hold nothing and do not count in N. Every row is a document and every row of queries a
query of its own, so repeated rows appear as often as they are there; among equal scores of one doc_id any order. doc_id must
be a whole number, not null. Queries without a known term, and empty tables, give no rows. Other columns are not read.
"""

from __future__ import annotations

import bisect
import json
import math
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.session import new_path
from .passing import quoted
from .shared import mapped, put, store

POSTINGS = 1 << 21
BLOCK = 128
WINDOW = 1 << 11  # documents summed at a time
BUNDLE = 1 << 20
BEST = 10
TOGETHER = 16  # shards that a task searches one after another, where there are enough

_TERM = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: str | bytes) -> list[bytes]:
    """The terms of a text, in UTF-8."""
    return (text.encode() if isinstance(text, str) else text).translate(_TERM).split()


# ---- writing shards -----------------------------------------------------------------------------

class Shard:
    """Documents gathered until there are enough of them for a file."""

    def __init__(self):
        self.vocabulary: dict[bytes, int] = defaultdict()
        self.vocabulary.default_factory = self.vocabulary.__len__
        self.docs: list[int] = []
        self.runs: list[np.ndarray] = []
        self.size = 0

    def add(self, doc: int, words: list[bytes]) -> None:
        self.docs.append(doc)
        self.runs.append(np.fromiter(map(self.vocabulary.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def arrays(self) -> dict[str, np.ndarray]:
        docs, length = np.array(self.docs, dtype=np.int64), np.array([len(r) for r in self.runs], dtype=np.int64)
        order = np.lexsort((docs, length))
        place = np.empty(len(docs), dtype=np.int64)
        place[order] = np.arange(len(docs))
        names = list(self.vocabulary)
        by_name = sorted(range(len(names)), key=names.__getitem__)
        rank = np.empty(len(names), dtype=np.int64)
        rank[by_name] = np.arange(len(names))
        key = np.concatenate([rank[r] * len(docs) + p for r, p in zip(self.runs, place)])
        self.runs = []
        key.sort()
        new = np.flatnonzero(np.diff(key, prepend=-1))
        tf = np.diff(np.append(new, len(key)))
        term, doc = np.divmod(key[new], len(docs))
        del key
        df = np.bincount(term, minlength=len(names))
        starts = np.concatenate([[0], np.cumsum(df)])
        within = np.arange(len(doc)) - starts[term]
        head = within % BLOCK == 0
        block = np.cumsum(head) - 1
        gap = np.diff(doc, prepend=0)
        gap[head] = 0
        # (n, tf) that no other pair of the block beats: documents are numbered by length, so tf must exceed all before
        running = np.maximum.accumulate(block * (int(tf.max()) + 1) + tf)
        best = head.copy()
        best[1:] |= running[1:] > running[:-1]
        width = [np.select([x < 1 << 8, x < 1 << 16], [1, 2], 4) for x in (np.maximum.reduceat(gap, starts[:-1]), np.maximum.reduceat(tf, starts[:-1]))]
        offset = np.concatenate([[0], np.cumsum(df * (width[0] + width[1]))])
        data = np.zeros(int(offset[-1]), dtype=np.uint8)
        for values, size, begin in ((gap, width[0], offset[:-1]), (tf, width[1], offset[:-1] + df * width[0])):
            at, wide = begin[term] + within * size[term], size[term]
            for byte in range(4):
                some = wide > byte
                data[at[some] + byte] = values[some] >> (8 * byte) & 255
        texts = [names[i] for i in by_name]
        return {
            "doc": docs[order], "length": length[order], "text": np.frombuffer(b"".join(texts), np.uint8),
            "text_end": np.cumsum([len(t) for t in texts]), "df": df, "offset": offset, "gap_width": width[0].astype(np.uint8),
            "tf_width": width[1].astype(np.uint8), "first_block": np.concatenate([[0], np.cumsum(-(-df // BLOCK))]),
            "block_doc": doc[head].astype(np.int32), "peak": np.append(np.flatnonzero(head[best]), best.sum()),
            "peak_doc": doc[best].astype(np.int32), "peak_tf": tf[best].astype(np.int32), "data": data,
        }

    def write(self, path: str) -> None:
        """One file: a JSON line with the place of every array, then the arrays."""
        arrays = self.arrays()
        at, places = 0, {}
        for name, a in arrays.items():
            places[name] = (str(a.dtype), at, len(a))
            at += -(-a.nbytes // 8) * 8
        head = json.dumps(places).encode() + b"\n"
        head = head[:-1] + b" " * (-len(head) % 8) + b"\n"
        parts = [head]
        for a in arrays.values():
            parts += [memoryview(np.ascontiguousarray(a)).cast("B"), bytes(-a.nbytes % 8)]
        put(path, *[p for p in parts if len(p)])


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc_id, text) -> one row per shard."""
        def close(shard: Shard) -> pa.RecordBatch:
            path = f"{folder}/{uuid.uuid4().hex}"
            docs, size = len(shard.docs), shard.size
            shard.write(path)
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([docs], pa.int64()), pa.array([size], pa.int64())], names=["path", "docs", "size"])

        shard = Shard()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for doc, text in zip(ids, batch.column(1)):
                words = terms(text.as_py()) if text.is_valid else []
                if words:
                    shard.add(doc, words)
                if shard.size >= POSTINGS:
                    yield close(shard)
                    shard = Shard()
        if shard.docs:
            yield close(shard)

    return run


@dataclass
class Index:
    shards: DataFrame  # path, docs, size
    count: int
    docs: int
    size: int


def build(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Index:
    """Writes the shards of all documents."""
    folder = new_path(documents.sparkSession, "lexical")
    rows = documents.select(F.col(doc_id).cast("long").alias("doc"), quoted(text).cast("string").alias("text"))
    shards = store(rows.mapInArrow(_write(folder), "path STRING, docs BIGINT, size BIGINT"), "lexical-shards")
    total = shards.agg(F.sum("docs").alias("docs"), F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).first()
    return Index(shards, total.n, total.docs or 0, total.size or 0)


# ---- reading shards -----------------------------------------------------------------------------

class Lists:
    """A shard's file, mapped."""

    def __init__(self, path: str):
        raw = mapped(path, "uint8")
        end = 0
        while True:  # the JSON line is short
            at = np.flatnonzero(raw[end:end + 4096] == 10)
            if len(at):
                end += int(at[0]) + 1
                break
            end += 4096
        for name, (dtype, at, count) in json.loads(bytes(raw[:end])).items():
            setattr(self, name, raw[end + at:end + at + count * np.dtype(dtype).itemsize].view(dtype))

    def find(self, term: bytes) -> int | None:
        ends, text = self.text_end, self.text
        name = lambda i: bytes(text[ends[i - 1] if i else 0:ends[i]])
        at = bisect.bisect_left(range(len(ends)), term, key=name)
        return at if at < len(ends) and name(at) == term else None


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    tf = tf.astype(np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


class Postings:
    """One term's list in a shard: maxima of its blocks, and blocks on demand."""

    def __init__(self, lists: Lists, term: int, m: np.ndarray):
        self.m = m
        self.df = int(lists.df[term])
        a, b = int(lists.first_block[term]), int(lists.first_block[term + 1])
        self.firsts = lists.block_doc[a:b].astype(np.int64)
        peak = lists.peak[a:b + 1]
        at = slice(int(peak[0]), int(peak[-1]))
        self.top = np.maximum.reduceat(impacts(lists.peak_tf[at], m[lists.peak_doc[at]]), peak[:-1] - peak[0])
        self.greatest = int(self.top.max())
        begin, end = int(lists.offset[term]), int(lists.offset[term + 1])
        middle = begin + self.df * int(lists.gap_width[term])
        self.gaps = lists.data[begin:middle].view(f"<u{lists.gap_width[term]}")
        self.tfs = lists.data[middle:end].view(f"<u{lists.tf_width[term]}")

    def read(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of some blocks, in order."""
        last = len(self.firsts) - 1
        full = blocks[blocks < last] if self.df % BLOCK else blocks
        docs, tfs = [], []
        if len(full):
            if len(full) == full[-1] - full[0] + 1:
                at = slice(int(full[0]) * BLOCK, (int(full[-1]) + 1) * BLOCK)
                gap, tf = self.gaps[at].reshape(-1, BLOCK), self.tfs[at].reshape(-1, BLOCK)
            else:
                at = len(self.gaps) // BLOCK * BLOCK
                gap, tf = self.gaps[:at].reshape(-1, BLOCK)[full], self.tfs[:at].reshape(-1, BLOCK)[full]
            docs.append((np.cumsum(gap, axis=1, dtype=np.int64) + self.firsts[full, None]).ravel())
            tfs.append(tf.ravel())
        if len(full) < len(blocks):
            docs.append(np.cumsum(self.gaps[last * BLOCK:], dtype=np.int64) + self.firsts[last])
            tfs.append(self.tfs[last * BLOCK:])
        doc = np.concatenate(docs) if len(docs) != 1 else docs[0]
        tf = np.concatenate(tfs) if len(tfs) != 1 else tfs[0]
        return doc, impacts(tf, self.m[doc])


def best_of(shard_docs: int, lists: list[tuple[int, Postings]], heap: tuple[np.ndarray, np.ndarray], doc_ids: np.ndarray, k: int,
            seen: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The `k` best (scores, doc ids) of a heap and the documents of one shard, by Block-Max MaxScore.

    lists: (weight, postings) of each of the query's terms. `seen` gathers the number of blocks read."""
    lists = sorted((x for x in lists if x[0] > 0), key=lambda x: x[0] * x[1].greatest)
    bounds = [w * p.greatest for w, p in lists]
    upto = np.concatenate([[0], np.cumsum(bounds)]).tolist()  # bounds of the weakest i lists together
    scores, ids = heap
    for low in range(0, shard_docs, WINDOW):
        high = min(low + WINDOW, shard_docs)
        beat = int(scores[-1]) if len(scores) == k else 1
        essential = bisect.bisect_left(upto, beat) - 1  # the weakest `essential` lists stay below the score to beat
        if essential >= len(lists):
            break
        total = np.zeros(high - low, dtype=np.int64)
        for w, p in lists[essential:]:
            a, b = max(int(np.searchsorted(p.firsts, low, side="right")) - 1, 0), int(np.searchsorted(p.firsts, high))
            if a >= b:
                continue
            doc, impact = p.read(np.arange(a, b))
            if seen is not None:
                seen.append(b - a)
            if doc[0] < low or doc[-1] >= high:
                inside = slice(int(np.searchsorted(doc, low)), int(np.searchsorted(doc, high)))
                doc, impact = doc[inside], impact[inside]
            total[doc - low] += w * impact
        found = np.flatnonzero(total)
        have = total[found]
        found += low
        for i in range(essential - 1, -1, -1):
            alive = have + upto[i + 1] >= beat
            found, have = found[alive], have[alive]
            if not len(found):
                break
            w, p = lists[i]
            block = np.searchsorted(p.firsts, found, side="right") - 1
            most = np.where(block >= 0, w * p.top[block], 0)
            alive = have + most + upto[i] >= beat
            found, have, block = found[alive], have[alive], block[alive]
            wanted = np.unique(block[block >= 0])
            if len(wanted):
                doc, impact = p.read(wanted)
                if seen is not None:
                    seen.append(len(wanted))
                at = np.minimum(np.searchsorted(doc, found), len(doc) - 1)
                have = have + np.where(doc[at] == found, w * impact[at], 0)
        alive = have >= beat
        found, have = found[alive], have[alive]
        if len(found):
            scores, ids = merged(np.concatenate([scores, have]), np.concatenate([ids, doc_ids[found]]), k)
    return scores, ids


def merged(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


# ---- queries ------------------------------------------------------------------------------------

def _bundle(folder: str):
    def run(table: pa.Table) -> pa.Table:
        """Writes one bundle: its different terms in order, and for every query its terms as [place, repeats]."""
        rows = [(n, Counter(terms(t or ""))) for n, t in zip(table["number"].to_pylist(), table["text"].to_pylist())]
        known = sorted(set().union(*(c for _, c in rows)))
        place = {t: i for i, t in enumerate(known)}
        content = {"terms": [t.hex() for t in known], "queries": [[n, sorted((place[t], k) for t, k in c.items())] for n, c in rows if c]}
        path = f"{folder}/terms-{table['bundle'][0].as_py()}-{uuid.uuid4().hex}"
        put(path, json.dumps(content).encode())
        return pa.table({"bundle": table["bundle"].slice(0, 1), "path": pa.array([path])})

    return run


def _read(path: str) -> dict:
    return json.loads(bytes(mapped(path, "uint8")))


def _count(bundles: dict[int, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Paths of shards -> document frequency in them of each term of each bundle."""
        paths = [p for batch in batches for p in batch.column(0).to_pylist()]
        for bundle, path in bundles.items():
            wanted = [bytes.fromhex(t) for t in _read(path)["terms"]]
            total = np.zeros(len(wanted), dtype=np.int64)
            for shard in paths:
                lists = Lists(shard)
                for i, term in enumerate(wanted):
                    at = lists.find(term)
                    if at is not None:
                        total[i] += lists.df[at]
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), bundle), pa.int64()), pa.array(some, pa.int64()), pa.array(total[some])],
                                             names=["bundle", "place", "df"])

    return run


def _weights(folder: str):
    def run(table: pa.Table) -> pa.Table:
        """Writes the document frequencies of one bundle's terms."""
        path = f"{folder}/df-{table['bundle'][0].as_py()}-{uuid.uuid4().hex}"
        put(path, json.dumps([table["place"].to_pylist(), table["df"].to_pylist()]).encode())
        return pa.table({"bundle": table["bundle"].slice(0, 1), "path": pa.array([path])})

    return run


def _search(bundles: dict[int, tuple[str, str]], docs: int, size: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Paths of shards -> each query's best documents in them."""
        paths = [p for batch in batches for p in batch.column(0).to_pylist()]
        for terms_path, df_path in bundles.values():
            asked, frequency = _read(terms_path), dict(zip(*_read(df_path)))
            names = [bytes.fromhex(t) for t in asked["terms"]]
            weight = {p: math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1))) for p, df in frequency.items()}
            heaps = {}
            for path in paths:
                lists = Lists(path)
                length = lists.length if 75 * docs * int(lists.length[-1]) < 1 << 63 else lists.length.astype(object)
                m = (25 + 75 * length * docs // size).astype(np.int64)
                places = {p: lists.find(names[p]) for p in weight}
                postings = {p: Postings(lists, at, m) for p, at in places.items() if at is not None}
                for number, counted in asked["queries"]:
                    own = [(weight[p] * times, postings[p]) for p, times in counted if p in postings]
                    if own:
                        heaps[number] = best_of(len(m), own, heaps.get(number, (np.zeros(0, np.int64),) * 2), lists.doc, k)
            for number, (scores, ids) in heaps.items():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), number), pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())],
                                                 names=["number", "doc_id", "score"])

    return run


def search(index: Index, queries: DataFrame, keep: tuple[str, ...] = ("item_id",), text: str = "text", k: int = BEST) -> DataFrame:
    """Columns `keep` of every row of `queries` with its `k` best documents: rank (from 1), doc_id, score."""
    spark = queries.sparkSession
    folder = new_path(spark, "lexical-queries")
    asked = store(queries.select(F.monotonically_increasing_id().alias("number"), quoted(text).cast("string").alias("text"),
                                 *[quoted(c).alias(f"__{i}") for i, c in enumerate(keep)]), "lexical-asked")
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-total // BUNDLE)
    dealt = asked.select("number", "text", F.pmod(F.xxhash64("number"), F.lit(max(count, 1))).alias("bundle"))
    written = dealt.where("text <> ''").groupBy("bundle").applyInArrow(_bundle(folder), "bundle BIGINT, path STRING")
    named = {r.bundle: r.path for r in written.collect()}  # one row per megabyte of queries
    tasks = max(-(-index.count // TOGETHER), min(index.count, spark.sparkContext.defaultParallelism), 1)
    shards = index.shards.select("path").repartition(tasks)
    counted = (shards.mapInArrow(_count(named), "bundle BIGINT, place BIGINT, df BIGINT")
               .groupBy("bundle", "place").agg(F.sum("df").alias("df")))
    frequent = counted.groupBy("bundle").applyInArrow(_weights(folder), "bundle BIGINT, path STRING")
    bundles = {r.bundle: (named[r.bundle], r.path) for r in frequent.collect()}
    found = store(shards.mapInArrow(_search(bundles, index.docs, index.size, k), "number BIGINT, doc_id BIGINT, score BIGINT"), "lexical-found")
    order = Window.partitionBy("number").orderBy(F.desc("score"), "doc_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return (best.join(asked.drop("text"), "number")
            .select(*[F.col(f"__{i}").alias(c) for i, c in enumerate(keep)], "rank", "doc_id", "score"))

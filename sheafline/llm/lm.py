"""Interpolated modified Kneser-Ney bigram model: counted in Spark, kept as sorted hash arrays, scored by workers that
memory-map them.

Tokens are the words of `tokens`, then one end per text; the token before a text's first is a begin mark that is
never scored. For a context h and a token w

    p(w | h) = (c(h w) - D[c(h w)]) / c(h) + (D1 N1(h) + D2 N2(h) + D3 N3+(h)) / c(h) * p(w)
    p(w)     = (n(w) - D'[n(w)]) / n + (D1' t1 + D2' t2 + D3' t3+) / n / (V + 1)

with n(w) the number of different contexts of w, n their sum, and N1, N2, N3+ (t1, t2, t3+) how many follow h (are
tokens) with that count. The discounts come from the counts of counts; where these are too few, they are 0.5, 1,
1.5. An unseen context gives p(w); an unseen token has n(w) = 0. An empty training set gives every token 1.

Counting. Tasks count pairs of about FLUSH tokens at a time and send them as arrays, one row per bucket, so the
shuffle carries few and large rows. Buckets are ranges of the context's hash, about BUCKET_BYTES of text each; the
pairs of contexts that are frequent in a sample of the texts are dealt out by pair instead, so no bucket is hot. (The
sample decides only that.) A bucket's pairs are merged and written by one task; contexts per token, and the parts
of frequent contexts, are merged in a second shuffle. The driver sees counts of counts only.

Null texts are empty: one token, the end. Equal rows count each. A null id is hashed as the empty text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.session import new_path
from .passing import with_text
from .shared import mapped, put
from .tokens import Texts, mix, pair, slices

FLUSH = 1_000_000
BUCKET_BYTES = 16 << 20
SAMPLE = 128
HOT_SHARE = 0.003
HOT_MOST = 1024
BEGIN, END = mix(np.array([1, 2], dtype=np.uint64) << np.uint64(60))


def held_out(doc_id: Column, folds: int = 10, fold: int = 0) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == fold


def sequence(x: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context, token and text of every token of a slice."""
    size = len(x.hashes) + x.count
    token, doc = np.empty(size, dtype=np.uint64), np.empty(size, dtype=np.int64)
    ends = x.bounds[1:] + np.arange(x.count)
    inner = np.ones(size, dtype=bool)
    inner[ends] = False
    token[inner], token[ends] = x.hashes, END
    doc[inner], doc[ends] = x.doc, np.arange(x.count)
    context = np.empty(size, dtype=np.uint64)
    context[1:] = token[:-1]
    context[x.bounds[:-1] + np.arange(x.count)] = BEGIN
    return context, token, doc


def _bucket(spread: np.ndarray, buckets: int) -> np.ndarray:
    return ((spread >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal numbers begins."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)


def _sum(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else values[:0]


def _cells(column: pa.ChunkedArray, dtype: str) -> np.ndarray:
    parts = [np.frombuffer(v.as_buffer(), dtype=dtype) for v in column if v.is_valid]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=dtype)


# ---- counting -----------------------------------------------------------------------------------

def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of text (kind 0), tokens of the sampled texts (1), their frequent contexts (2)."""
    size, held = 0, []
    for batch in batches:
        size += pc.sum(batch.column(0)).as_py() or 0
        held += [sequence(x)[0] for x in slices(batch.column(1).drop_null())]
        if sum(map(len, held)) > FLUSH:
            yield _frequent(held)
            held = []
    yield _frequent(held)
    yield pa.RecordBatch.from_pydict({"kind": pa.array([0], pa.int32()), "word": pa.array([0], pa.int64()), "n": pa.array([size], pa.int64())})


def _frequent(held: list[np.ndarray]) -> pa.RecordBatch:
    words, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
    often = n > n.sum() * HOT_SHARE / 4
    return pa.RecordBatch.from_pydict({
        "kind": pa.array([1] + [2] * int(often.sum()), pa.int32()),
        "word": pa.array(np.append(np.int64(0), words[often].view(np.int64)), pa.int64()),
        "n": pa.array(np.append(n.sum(), n[often]), pa.int64())})


def _pairs(buckets: int, hot: np.ndarray):
    def flush(held: list) -> pa.RecordBatch:
        context, token = (np.concatenate([h[i] for h in held]) for i in (0, 1))
        key = pair(context, token)
        order = np.argsort(key)
        first = _runs(key[order])
        n = np.diff(np.append(first, len(key))).astype(np.uint32)
        at = order[first]
        context, token, key = context[at], token[at], key[at]
        spread = np.where(np.isin(context, hot), key, context)
        order = np.lexsort((spread, context)) if len(hot) else np.argsort(context)
        part = _bucket(spread[order], buckets)
        if len(hot):
            order = order[np.argsort(part, kind="stable")]
            part = np.sort(part)
        bounds = np.append(_runs(part), len(part))
        rows = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            own = context[order[a:b]]
            runs = _runs(own)
            rows.append((int(part[a]), own[runs].tobytes(), np.diff(np.append(runs, b - a)).astype("<u4").tobytes(),
                         token[order[a:b]].tobytes(), n[order[a:b]].tobytes()))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[i] for r in rows], pa.binary()) for i in range(1, 5))],
            names=["bucket", "contexts", "runs", "tokens", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for x in slices(batch.column(0)):
                held.append(sequence(x)[:2])
                size += len(held[-1][0])
                if size >= FLUSH:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return run


def _of_counts(n: np.ndarray) -> list[int]:
    return [int(np.count_nonzero(n == k)) for k in (1, 2, 3, 4)]


_MERGED = "part INT, kind INT, words BINARY, a BINARY, b BINARY, c BINARY, d BINARY, stats ARRAY<BIGINT>"
_MERGED_ARROW = pa.schema([("part", pa.int32()), ("kind", pa.int32()), *((c, pa.binary()) for c in ("words", "a", "b", "c", "d")),
                           ("stats", pa.list_(pa.int64()))])


def _rows(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_pylist([dict(zip(_MERGED_ARROW.names, r)) for r in rows], schema=_MERGED_ARROW)


def _merge_pairs(folder: str, buckets: int, hot: np.ndarray):
    """Writes one bucket's pairs and contexts; passes on what each token and each frequent context got here."""

    def contexts(words, n):
        order = np.argsort(words, kind="stable")
        starts = _runs(words[order])
        n = n[order]
        return words[order][starts], [_sum(x, starts) for x in (n, *(((n == 1), (n == 2), (n >= 3))))]

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        context = np.repeat(_cells(table.column("contexts"), "<u8"), _cells(table.column("runs"), "<u4"))
        token = _cells(table.column("tokens"), "<u8")
        n = _cells(table.column("counts"), "<u4").astype(np.uint64)
        key = pair(context, token)
        order = np.argsort(key)
        first = _runs(key[order])
        n = _sum(n[order], first)
        key, context, token = (v[order][first] for v in (key, context, token))
        many = n >= 255
        put(f"{folder}/pair-{bucket}", key.tobytes())
        put(f"{folder}/count-{bucket}", np.where(many, 255, n).astype(np.uint8).tobytes())
        put(f"{folder}/many-{bucket}", n[many].tobytes())
        put(f"{folder}/place-{bucket}", np.flatnonzero(many).tobytes())
        common = np.isin(context, hot)
        words, (c, n1, n2, n3) = contexts(context[~common], n[~common])
        put(f"{folder}/context-{bucket}", words.tobytes())
        put(f"{folder}/stats-{bucket}", np.stack([c.astype("<u8"), *(v.astype("<u8") for v in (n1, n2, n3))], 1).tobytes())
        rows = [(-1, 0, None, None, None, None, None, _of_counts(n))]
        words, (c, n1, n2, n3) = contexts(context[common], n[common])
        for kind, words, values in (
                (1, words, [c, n1, n2, n3]), (2, *_by_token(token, n))):
            part = _bucket(words, buckets)
            bounds = np.append(_runs(part), len(part))
            for a, b in zip(bounds[:-1], bounds[1:]):
                rows.append((int(part[a]), kind, words[a:b].tobytes(),
                             *(v[a:b].astype("<u8" if i == 0 else "<u4").tobytes() for i, v in enumerate(values)),
                             *[None] * (4 - len(values)), None))
        return _rows(rows)

    return run


def _by_token(token: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    order = np.argsort(token)
    starts = _runs(token[order])
    return token[order][starts], [_sum(n[order], starts), np.diff(np.append(starts, len(token)))]


def _merge_tokens(folder: str):
    """Writes one range of tokens (count, number of contexts) and of frequent contexts; returns counts of counts."""

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        if part < 0:
            return table
        for kind, names in ((1, "abcd"), (2, "ab")):
            own = table.filter(pc.equal(table.column("kind"), kind))
            words = _cells(own.column("words"), "<u8")
            order = np.argsort(words, kind="stable")
            starts = _runs(words[order])
            values = [_sum(_cells(own.column(c), "<u8" if c == "a" else "<u4").astype("<u8")[order], starts) for c in names]
            words = words[order][starts]
            put(f"{folder}/{'hot' if kind == 1 else 'token'}-{part}", words.tobytes())
            put(f"{folder}/{'hotstats' if kind == 1 else 'tokenstats'}-{part}", np.stack(values, 1).astype("<u8").tobytes())
        count, contexts = values
        return _rows([(part, 2, None, None, None, None, None, [len(words), int(count.sum()), int(contexts.sum()), *_of_counts(contexts),
                                                              int(np.count_nonzero(contexts >= 3))])])

    return run


def _discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    if not (n1 and n2 and n3):
        return np.array([0, 0.5, 1, 1.5])
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0, *(min(max(d, 0.0), k) for k, d in zip((1, 2, 3), found))])


@dataclass
class Model:
    """Where the arrays are, and the few numbers that hold for all of them."""

    folder: str
    buckets: int
    hot: np.ndarray
    tokens: int = 0
    distinct: int = 0
    contexts: int = 0
    spread: float = 0.0  # mass that p(w) shares out evenly
    pair_discounts: np.ndarray | None = None
    token_discounts: np.ndarray | None = None


def train(texts: DataFrame, text: str = "text", key: str = "doc_id", folder: str | None = None) -> Model:
    """Counts all rows of `texts` and writes the model below `folder` (default: a new one in the shared folder)."""
    spark = texts.sparkSession
    folder = folder or new_path(spark, "lm")
    sampled = F.when(F.pmod(F.xxhash64(key), F.lit(SAMPLE)) == 0, F.col(text))
    seen = (texts.select(F.octet_length(text).cast("long").alias("size"), sampled.alias("text"))
            .mapInArrow(_survey, "kind INT, word BIGINT, n BIGINT").groupBy("kind", "word").agg(F.sum("n").alias("n"))
            .orderBy("kind", F.desc("n")).limit(HOT_MOST).collect())
    total = {k: sum(r.n for r in seen if r.kind == k) for k in (0, 1)}
    hot = np.array([r.word for r in seen if r.kind == 2 and r.n > HOT_SHARE * total[1]], dtype=np.int64).view(np.uint64)
    buckets = 1 + total[0] // BUCKET_BYTES
    counted = (texts.select(text)
               .mapInArrow(_pairs(buckets, hot), "bucket INT, contexts BINARY, runs BINARY, tokens BINARY, counts BINARY")
               .groupBy("bucket").applyInArrow(_merge_pairs(folder, buckets, hot), _MERGED))
    stats = (counted.groupBy("part").applyInArrow(_merge_tokens(folder), _MERGED).select("part", "kind", "stats").collect())
    pairs = np.array([r.stats for r in stats if r.kind == 0], dtype=np.int64).reshape(-1, 4).sum(0)
    own = np.array([r.stats for r in stats if r.kind == 2], dtype=np.int64).reshape(-1, 8).sum(0)
    model = Model(folder, buckets, hot, int(own[1]), int(own[0]), int(own[2]))
    model.pair_discounts, model.token_discounts = _discounts(*map(int, pairs)), _discounts(*map(int, own[3:7]))
    if model.contexts:
        model.spread = float(model.token_discounts[1:] @ np.array([own[3], own[4], own[7]])) / model.contexts
    return model


# ---- scoring ------------------------------------------------------------------------------------

class _Arrays:
    """The model's arrays in one worker process, mapped when first needed."""

    def __init__(self, model: Model):
        self.model, self.open = model, {}

    def get(self, name: str, dtype: str) -> np.ndarray:
        if name not in self.open:
            try:
                self.open[name] = mapped(f"{self.model.folder}/{name}", dtype)
            except FileNotFoundError:  # no token fell into this range
                self.open[name] = np.zeros(0, dtype=dtype)
        return self.open[name]

    def find(self, kind: str, stats: str, width: int, words: np.ndarray) -> np.ndarray:
        """Rows of `stats` for sorted words; zeros where a word is not there."""
        out = np.zeros((len(words), width), dtype=np.uint64)
        part = _bucket(words, self.model.buckets)
        bounds = np.append(_runs(part), len(part))
        for a, b in zip(bounds[:-1], bounds[1:]):
            known = self.get(f"{kind}-{part[a]}", "<u8")
            if len(known):
                at = np.minimum(np.searchsorted(known, words[a:b]), len(known) - 1)
                hit = known[at] == words[a:b]
                out[a:b][hit] = self.get(f"{stats}-{part[a]}", "<u8").reshape(-1, width)[at[hit]]
        return out

    def pairs(self, context: np.ndarray, token: np.ndarray, common: np.ndarray) -> np.ndarray:
        key = pair(context, token)
        part = _bucket(np.where(common, key, context), self.model.buckets).astype(np.uint32)
        order = np.argsort(part, kind="stable")
        bounds = np.append(_runs(part[order]), len(part))
        out = np.zeros(len(key), dtype=np.int64)
        for a, b in zip(bounds[:-1], bounds[1:]):
            bucket, own = part[order[a]], order[a:b]
            known = self.get(f"pair-{bucket}", "<u8")
            if not len(known):
                continue
            at = np.minimum(np.searchsorted(known, key[own]), len(known) - 1)
            hit = known[at] == key[own]
            n = self.get(f"count-{bucket}", "u1")[at].astype(np.int64)
            many = n == 255
            if many.any():
                place = np.searchsorted(self.get(f"place-{bucket}", "<i8"), at[many])
                real = self.get(f"many-{bucket}", "<u8")
                n[many] = real[np.minimum(place, len(real) - 1)]
            out[own] = np.where(hit, n, 0)
        return out


_arrays: dict[str, _Arrays] = {}


def _score(model: Model, keep: int, at: int):
    d, dt = model.pair_discounts, model.token_discounts
    unseen = 1.0 / (model.distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = _arrays.setdefault(model.folder, _Arrays(model))
        for batch in batches:
            size = batch.num_rows
            tokens, known = np.zeros(size, np.int64), np.zeros(size, np.int64)
            base, score = np.zeros(size), np.zeros(size)
            for x in slices(batch.column(at)):
                context, token, doc = sequence(x)
                words, back = np.unique(token, return_inverse=True)
                count, kinds = arrays.find("token", "tokenstats", 2, words).astype(np.float64).T
                low = unseen
                if model.contexts:
                    low = (kinds - dt[np.minimum(kinds, 3).astype(int)]) / model.contexts + model.spread * unseen
                low = np.broadcast_to(low, len(words))[back]
                plain = np.log10((count + 0.1) / (model.tokens + 0.1 * (model.distinct + 1)))
                heads, of = np.unique(context, return_inverse=True)
                common = np.isin(heads, model.hot)
                stats = np.where(common[:, None], arrays.find("hot", "hotstats", 4, heads), arrays.find("context", "stats", 4, heads)).astype(np.float64)
                total = np.maximum(stats[:, 0], 1)
                rest = np.where(stats[:, 0] > 0, stats[:, 1:] @ d[1:] / total, 1.0)
                n = arrays.pairs(context, token, common[of])
                p = np.maximum(n - d[np.minimum(n, 3)], 0) / total[of] + rest[of] * low
                to = slice(x.first, x.first + x.count)
                tokens[to] = np.bincount(doc, minlength=x.count)
                known[to] = np.bincount(doc, weights=(count > 0)[back], minlength=x.count).astype(np.int64)
                base[to] = np.bincount(doc, weights=plain[back], minlength=x.count)
                score[to] = np.bincount(doc, weights=np.log10(p), minlength=x.count)
            columns = list(batch.columns[:keep])
            names = list(batch.schema.names[:keep])
            more = {"n_tokens": tokens, "n_known": known, "train_tokens": np.full(size, model.tokens), "base_score": base, "score": score,
                    "perplexity": 10 ** np.minimum(-score / tokens, 300)}
            yield pa.RecordBatch.from_arrays(columns + [pa.array(v) for v in more.values()], names=names + list(more))

    return run


def score(texts: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """Columns `keep`, then n_tokens, n_known, train_tokens, base_score, score, perplexity of every row's text."""
    rows, at, kept = with_text(texts, keep, text)
    return rows.mapInArrow(_score(model, len(keep), at), f"{kept}, n_tokens BIGINT, n_known BIGINT, train_tokens BIGINT, "
                                                          "base_score DOUBLE, score DOUBLE, perplexity DOUBLE")

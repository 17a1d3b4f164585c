"""Benchmark decontamination: every passage of every document queries a BM25 index of the test items.

Words are runs of letters and digits, ASCII letters in lower case. Documents are cut into overlapping passages in which
any occurrence of an item lies whole in at least one. An item's BM25 score for a passage, over the passage's different
words, is divided by its score for itself; items of at least SCORE are retrieved. The search is block-max WAND, done
for many passages at once and exact:

* pivot: an item's rare words are looked up first; where those found in the passage, plus the weight of all the others,
  stay below SCORE, the item is out;
* block: items stand in blocks of BLOCK; a block whose largest weights, summed over the passage's words, stay below
  SCORE is out;
* score: the items of what is left are scored in full.

A retrieved item is verified by its distinct runs of GRAM words (fewer in shorter texts): `overlap` is the share of
those of the whole item that the passage holds, `question_overlap` and `answer_overlap` that of its parts. It is a leak
if `overlap` is at least OVERLAP. Without columns of its own, an item's answer is its last line, or in a single line its
last sentence.

Items are worked on in groups of at most ITEMS, each broadcast with the job that scans the documents; word frequencies
are those of all items. Null or wordless items are skipped, null documents are empty, equal items are each reported,
and empty tables give no leaks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .passing import quoted, with_text
from .shared import store
from .tokens import PLAIN, Texts, pair, slices

GRAM, OVERLAP = 5, 0.8
SCORE = 0.5
K1, B = 1.2, 0.75
BLOCK = 16
ITEMS = 20_000
RARE_MASS = 0.8  # share of an item's own score that its pivot words make up
LEAK = "STRUCT<item_id: BIGINT, score: DOUBLE, overlap: DOUBLE, question_overlap: DOUBLE, answer_overlap: DOUBLE>"
LEAKS = f"ARRAY<{LEAK}>"


def grams(words: np.ndarray) -> np.ndarray:
    """Distinct hashes of the runs of GRAM words, or of all words if they are fewer."""
    size = min(GRAM, len(words))
    if not size:
        return words
    run = words[:len(words) - size + 1]
    for step in range(1, size):
        run = pair(run, words[step:len(words) - size + 1 + step])
    return np.unique(run)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, question, answer) -> item_id, words of both, how many are the question's."""
    for batch in batches:
        words: list[np.ndarray] = [np.zeros(0, np.uint64)] * batch.num_rows
        split = [0] * batch.num_rows
        for x in slices(batch.column(1), PLAIN):
            for i in range(x.count):
                words[x.first + i] = x.hashes[x.bounds[i]:x.bounds[i + 1]]
                split[x.first + i] = len(words[x.first + i])
        for x in slices(batch.column(2), PLAIN):
            for i in range(x.count):
                words[x.first + i] = np.concatenate([words[x.first + i], x.hashes[x.bounds[i]:x.bounds[i + 1]]])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([w.view(np.int64) for w in words], pa.list_(pa.int64())), pa.array(split, pa.int32())],
            names=["item_id", "words", "question_words"])


@dataclass
class Index:
    """One group of items. Postings are by word; `weight` is the normalized impact."""

    ids: list[int]
    words: list[np.ndarray]
    split: list[int]
    vocabulary: np.ndarray  # sorted hashes
    starts: np.ndarray  # postings of word t: starts[t]:starts[t + 1]
    item: np.ndarray
    weight: np.ndarray
    pivot: np.ndarray  # is the posting one of its item's pivot words
    need: np.ndarray  # least weight of pivot words for each item
    longest: int

    def __post_init__(self):
        self.top = np.zeros((len(self.vocabulary), -(-len(self.ids) // BLOCK)))
        word = np.repeat(np.arange(len(self.vocabulary)), np.diff(self.starts))
        np.maximum.at(self.top, (word, self.item // BLOCK), self.weight)
        counts = np.concatenate([[0], np.cumsum(self.pivot)])
        self.pivot_starts = counts[self.starts]
        self.pivot_item, self.pivot_weight = self.item[self.pivot], self.weight[self.pivot]


def _group(rows: list, frequency: dict[int, int], total: int, mean: float) -> Index:
    rows = sorted(rows, key=lambda r: (r.item_id is None, r.item_id, r.words))
    words = [np.array(r.words, dtype=np.int64).view(np.uint64) for r in rows]
    # neighbours in a block share words: items are ordered by their most frequent ones
    order = sorted(range(len(rows)), key=lambda i: (sorted(set(rows[i].words), key=lambda w: (-frequency[w], w))[:3], i))
    rows, words = [rows[i] for i in order], [words[i] for i in order]
    term, item, weight, pivot, need = [], [], [], [], []
    for i, own in enumerate(words):
        distinct, tf = np.unique(own, return_counts=True)
        df = np.array([frequency[int(w)] for w in distinct.view(np.int64)])
        impact = np.log(1 + (total - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(own) / mean))
        impact = impact / impact.sum()
        rare = np.lexsort((distinct, -impact, df))
        mass = np.cumsum(impact[rare])
        chosen = np.zeros(len(distinct), dtype=bool)
        chosen[rare[:int(np.searchsorted(mass, RARE_MASS)) + 1]] = True
        term.append(distinct)
        item.append(np.full(len(distinct), i))
        weight.append(impact)
        pivot.append(chosen)
        need.append(SCORE - impact[~chosen].sum())
    term, item, weight, pivot = map(np.concatenate, (term, item, weight, pivot))
    vocabulary, back = np.unique(term, return_inverse=True)
    order = np.lexsort((item, back))
    starts = np.searchsorted(back[order], np.arange(len(vocabulary) + 1))
    return Index([r.item_id for r in rows], words, [r.question_words for r in rows], vocabulary, starts,
                 item[order], weight[order], pivot[order], np.array(need), max(map(len, words)))


def build(items: DataFrame, item_id: str = "item_id", text: str = "text", question: str | None = None,
          answer: str | None = None) -> list[Index]:
    """Indexes of all items, in groups of about ITEMS at most."""
    last = rf"(?s)^(.*)\n([^\n]*\S[^\n]*)\s*$"  # noqa: F541
    sentence = r"(?s)^(.*?[.?!])\s+([^.?!]*[^.?!\s][^.?!]*[.?!]*)\s*$"
    if question:
        parts = [F.col(question), F.col(answer)]
    else:
        rule = F.when(F.col(text).rlike(last), F.lit(0)).when(F.col(text).rlike(sentence), F.lit(1))
        parts = [F.when(rule == 0, F.regexp_extract(text, last, n)).when(rule == 1, F.regexp_extract(text, sentence, n))
                 .otherwise(F.col(text) if n == 1 else F.lit("")) for n in (1, 2)]
    rows = items.select(F.col(item_id).cast("long").alias("item_id"), parts[0].alias("question"), parts[1].alias("answer"))
    rows = store(rows.mapInArrow(_terms, "item_id BIGINT, words ARRAY<BIGINT>, question_words INT").where(F.size("words") > 0), "leak-items")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("words")).alias("mean")).first()
    groups = -(-size.n // ITEMS)
    rows = rows.withColumn("group", F.pmod(F.xxhash64("item_id", "words"), F.lit(max(groups, 1))))
    word = rows.select("group", F.explode(F.array_distinct("words")).alias("word"))
    often = store(word.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "leak-words")
    out = []
    for g in range(groups):
        own = word.where(F.col("group") == g).select("word").distinct()
        frequency = {r.word: r.n for r in often.join(own, "word").collect()}
        members = rows.where(F.col("group") == g).collect()
        if members:
            out.append(_group(members, frequency, size.n, size.mean))
    return out


def _find(index: Index, x: Texts) -> Iterator[tuple[int, int, float, int, int]]:
    """(text, item, score, first and end word of the passage) of all retrieved items of a slice."""
    if not len(x.hashes):
        return
    at = np.minimum(np.searchsorted(index.vocabulary, x.hashes), len(index.vocabulary) - 1)
    known = np.flatnonzero(index.vocabulary[at] == x.hashes)
    term, doc = at[known], x.doc[known]
    step, width = index.longest, 2 * index.longest + GRAM
    place = known - x.bounds[doc]  # within its text
    per = -(-np.maximum(np.diff(x.bounds), 1) // step)
    base = np.concatenate([[0], np.cumsum(per)])
    # a word lies in the passages that begin at most `width` words before it
    back = -(-width // step)
    last = place // step
    passage, word = [], []
    for shift in range(back):
        inside = (last >= shift) & (place - (last - shift) * step < width)
        passage.append((base[doc] + last - shift)[inside])
        word.append(term[inside])
    passage, word = np.concatenate(passage), np.concatenate(word)
    key = np.unique(passage * len(index.vocabulary) + word)
    passage, word = key // len(index.vocabulary), key % len(index.vocabulary)
    count = index.pivot_starts[word + 1] - index.pivot_starts[word]
    posting = np.repeat(index.pivot_starts[word] - np.cumsum(count) + count, count) + np.arange(count.sum())
    pairs, of = np.unique(np.repeat(passage, count) * len(index.ids) + index.pivot_item[posting], return_inverse=True)
    found = np.bincount(of, weights=index.pivot_weight[posting], minlength=len(pairs))
    alive = pairs[found >= index.need[pairs % len(index.ids)] - 1e-9]
    blocks = np.unique(alive // len(index.ids) * index.top.shape[1] + alive % len(index.ids) // BLOCK)
    bounds = np.searchsorted(passage, np.arange(base[-1] + 1))
    for cell in blocks:
        p, block = divmod(int(cell), index.top.shape[1])
        own = word[bounds[p]:bounds[p + 1]]
        if index.top[own, block].sum() < SCORE - 1e-9:
            continue
        score = np.zeros(BLOCK)
        for t in own[index.top[own, block] > 0]:
            a, b = index.starts[t], index.starts[t + 1]
            a, b = a + np.searchsorted(index.item[a:b], [block * BLOCK, (block + 1) * BLOCK])
            score[index.item[a:b] - block * BLOCK] += index.weight[a:b]
        text = int(np.searchsorted(base, p, side="right")) - 1
        first = int(x.bounds[text] + (p - base[text]) * step)
        for i in np.flatnonzero(score >= SCORE - 1e-9):
            yield text, block * BLOCK + int(i), float(score[i]), first, min(first + width, int(x.bounds[text + 1]))


def _scan(index: Index, at: int):
    def share(part: np.ndarray, seen: np.ndarray, words: np.ndarray) -> float:
        if not len(part):
            return 1.0
        if len(part) < GRAM:  # a short part is looked for at its own length
            run = words[:max(len(words) - len(part) + 1, 0)]
            for step in range(1, len(part)):
                run = pair(run, words[step:step + len(run)])
            return float(np.isin(grams(part), run).mean())
        return float(np.isin(grams(part), seen).mean())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best: list[dict] = [{} for _ in range(batch.num_rows)]
            for x in slices(batch.column(at), PLAIN):
                for text, item, score, first, end in _find(index, x):
                    words = x.hashes[first:end]
                    own, cut = index.words[item], index.split[item]
                    seen = grams(words)
                    whole = share(own, seen, words)
                    if whole >= OVERLAP:
                        got = (whole, score, share(own[:cut], seen, words), share(own[cut:], seen, words))
                        best[x.first + text][item] = max(best[x.first + text].get(item, got), got)
            leaks = [[{"item_id": index.ids[i], "score": g[1], "overlap": g[0], "question_overlap": g[2], "answer_overlap": g[3]}
                      for i, g in sorted(b.items())] for b in best]
            kind = pa.list_(pa.struct([("item_id", pa.int64()), *((c, pa.float64()) for c in ("score", "overlap", "question_overlap", "answer_overlap"))]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaks, kind)], names=[*batch.schema.names, "__leaks"])

    return run


def scan(documents: DataFrame, groups: list[Index], keep: tuple[str, ...] = ("doc_id",), text: str = "text", leaks: str = "leaks") -> DataFrame:
    """Columns `keep` of every document, then `leaks`: its verified items (see LEAK), empty if there are none."""
    out, at, _ = with_text(documents, keep, text)
    out = out.withColumn("__found", F.array().cast(LEAKS))
    for index in groups:
        kinds = ", ".join("`" + f.name.replace("`", "``") + f"` {f.dataType.simpleString()}" for f in out.schema.fields)
        out = (out.mapInArrow(_scan(index, at), f"{kinds}, __leaks {LEAKS}")
               .withColumn("__found", F.concat("__found", "__leaks")).drop("__leaks"))
    return out.select(*map(quoted, keep), F.col("__found").alias(leaks))

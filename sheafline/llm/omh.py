"""Near-duplicate documents by order min-hash, checked by banded alignment.

Texts are sequences of words (see `tokens`); equal sequences are one node of a graph. An order min-hash takes, under one
hash function, the PICK smallest of a text's K-word runs (each labelled with how often it occurred before, so repeats
count) and keeps the order in which they stand. SKETCHES of them give a text as many keys. Texts that share a key are
candidates. Texts of at most SHORT words, where a few edits leave less than PICK runs, get SHORT_SKETCHES further keys
from runs of SHORT_K words. The numbers of keys follow from RECALL, see `_sketches`. Two texts are linked if 1 - edit distance / longer length is at least SIMILARITY, the edit
distance being over words; classes are connected components.

Large groups do not become all pairs. In each key's group, members are aligned with one leader (the first in hashed
order, the same one in most of a group's keys). Those that resemble it are linked and done with; those that do not go
through another round with another leader. What ROUNDS rounds leave are the pairs of different classes in a group, the
classes being those that the leaders' links make. They are not formed as rows: a group is cut into blocks of about BLOCK
texts, large classes into blocks of their own, and a task takes two blocks and compares their texts by length and by
counts of words by hash, which bound the edit distance from below. Only pairs that these allow are aligned, each once,
at its smallest key. So every candidate pair is either compared, or in one class already, or excluded by a bound.

Null texts and texts without words are copies of each other. Repeated rows are copies. A class is named by its
smallest non-null doc_id (null if it has none). Empty tables give empty results. Nodes are 64-bit hashes, and
alignments compare 32-bit hashes of words.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import store
from .tokens import Texts, mix, pair, slices

SIMILARITY = 0.8
RECALL = 0.99  # of pairs at exactly SIMILARITY, whatever their length


def _sketches(k: int, lengths: range) -> int:
    """How many keys from runs of k words give RECALL to pairs of such lengths, with as many replaced words as SIMILARITY
    allows, as far apart as they can be (which breaks the most runs)."""
    need = 0
    for words in lengths:
        edits = math.floor((1 - SIMILARITY) * words + 1e-9)
        common, union = words - k + 1 - k * edits, words - k + 1 + k * edits
        found = math.prod((common - i) / (union - i) for i in range(PICK))  # the PICK smallest of both are the same
        need = max(need, math.ceil(math.log(1 - RECALL) / math.log(1 - found)))
    return need


K, PICK = 2, 3
SHORT, SHORT_K = 40, 1
SKETCHES = _sketches(K, range(SHORT + 1, 10 * SHORT))  # 65; longer texts need fewer
SHORT_SKETCHES = _sketches(SHORT_K, range(5, SHORT + 1))  # 21; texts of less than 5 words resemble equal ones only
ROUNDS = 3
BITS = 1 << 25
BAG = 1024  # words of a text are counted by hash in so many cells
BLOCK = 512  # texts of one key that a task compares with as many others at once
_FACTORS = mix(np.arange(101, 101 + SKETCHES + SHORT_SKETCHES, dtype=np.uint64)) | np.uint64(1)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def labelled_grams(words: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of k words of each text, each with its number of occurrence, and the bounds by text.
    A text of fewer words has one shorter run; an empty one has none."""
    size = np.diff(bounds)
    count = np.where(size > 0, np.maximum(size - k + 1, 1), 0)
    to = np.concatenate([[0], np.cumsum(count)])
    at = np.arange(to[-1]) - np.repeat(to[:-1] - bounds[:-1], count)
    left = np.repeat(bounds[1:], count) - at
    gram = words[at]
    for step in range(1, k):
        inside = left > step
        gram[inside] = pair(gram[inside], words[at[inside] + step])
    doc = np.repeat(np.arange(len(size)), count)
    order = np.lexsort((gram, doc))
    same = np.zeros(len(gram), dtype=bool)
    same[1:] = (gram[order][1:] == gram[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    place = np.arange(len(gram))
    run = place - np.maximum.accumulate(np.where(same, 0, place))
    label = np.empty(len(gram), dtype=np.uint64)
    label[order] = run
    return mix(gram + label * np.uint64(0x9E3779B97F4A7C15)), to


def sketch(gram: np.ndarray, to: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """One row per text, one order min-hash per factor: the PICK smallest runs, hashed in their order in the text."""
    out = np.full((len(to) - 1, len(factors)), _NONE)
    full = np.flatnonzero(np.diff(to))
    if not len(full):
        return out
    starts, count = to[:-1][full], np.diff(to)[full]
    where = np.arange(len(gram), dtype=np.int64)
    for j, factor in enumerate(factors):
        value = gram * factor
        value ^= value >> np.uint64(29)
        places = []
        for _ in range(PICK):
            least = np.minimum.reduceat(value, starts)
            place = np.minimum.reduceat(np.where(value == np.repeat(least, count), where, len(gram)), starts)
            gone = least == _NONE
            places.append(np.where(gone, len(gram), place))
            value[place[~gone]] = _NONE
        found = np.zeros(len(full), dtype=np.uint64)
        for place in np.sort(np.stack(places), axis=0):
            there = place < len(gram)
            found[there] = pair(found[there], gram[place[there]])
        out[full, j] = mix(found + np.uint64(j))
    return out


# ---- alignment ----------------------------------------------------------------------------------

def aligned(a: list[int], b: list[int], band: int) -> int:
    """Edit distance of two word sequences by alignments that stay within `band` of the diagonal; exact where it is at
    most `band`, else larger than `band`.

    Bit-parallel: a whole column of the band is two integers, whose bits say where the cost of one row exceeds the row
    above by 1 (`more`) or falls below it by 1 (`less`). Cells outside the band count as reached by steps along its
    edge, which are real alignments, so no cost is too small.
    """
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > band:
        return band + 1
    band += 1
    places: dict[int, int] = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    low, width = 0, min(len(a), band)
    more, less, top = (1 << width) - 1, 0, 0
    for j, word in enumerate(b, 1):
        if low + width < min(len(a), j + band):
            more |= 1 << width
            width += 1
        full = (1 << width) - 1
        equal = (places.get(word, 0) >> low) & full
        across = (((equal & more) + more) ^ more) | equal
        down = equal | less
        up = (less | ~(across | more)) << 1 | 1
        sunk = (more & across) << 1
        more, less = (sunk | ~(down | up)) & full, up & down & full
        top += 1
        if j - band > low:
            top += (more & 1) - (less & 1)
            more, less, low, width = more >> 1, less >> 1, low + 1, width - 1
    return top + more.bit_count() - less.bit_count()


def distance(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """As `aligned`, after cheaper tests: equal ends are cut off, and words without a partner are counted."""
    size = min(len(a), len(b))
    differ = np.flatnonzero(a[:size] != b[:size])
    head = int(differ[0]) if len(differ) else size
    a, b = a[head:], b[head:]
    size = min(len(a), len(b))
    if size:
        differ = np.flatnonzero(a[::-1][:size] != b[::-1][:size])
        tail = int(differ[0]) if len(differ) else size
        a, b = a[:len(a) - tail], b[:len(b) - tail]
    if not len(a) or not len(b):
        return max(len(a), len(b))
    words, n = np.unique(a, return_counts=True)
    other, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(words, other, assume_unique=True, return_indices=True)
    least = max(len(a), len(b)) - int(np.minimum(n[i], m[j]).sum())
    if least > band:
        return least
    return min(aligned(a.tolist(), b.tolist(), band), band + 1)  # beyond the band only that much is sure


# ---- the operator -------------------------------------------------------------------------------

def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text_key, text) -> doc_id, text_key, node, words, order min-hashes."""
    for batch in batches:
        nodes, sizes, keys = [], [], []
        for x in slices(batch.column(2)):
            size = np.diff(x.bounds)
            nodes.append(_nodes(x))
            sizes.append(size)
            keys += _keys(x)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(np.concatenate(nodes)), pa.array(np.concatenate(sizes).astype(np.int32)),
             pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "text_key", "node", "words", "keys"])


def _keys(x: Texts) -> list[np.ndarray]:
    long = sketch(*labelled_grams(x.hashes, x.bounds, K), _FACTORS[:SKETCHES])
    short = sketch(*_short_grams(x, np.diff(x.bounds)), _FACTORS[SKETCHES:])
    both = np.concatenate([long, short], axis=1)
    return [row[k].view(np.int64) for row, k in zip(both, both != _NONE)]


def _nodes(x: Texts) -> np.ndarray:
    data = [hashlib.blake2b(x.hashes[a:b].tobytes(), digest_size=8).digest() for a, b in zip(x.bounds[:-1], x.bounds[1:])]
    return np.frombuffer(b"".join(data), dtype="<i8")


def _short_grams(x: Texts, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own = (size <= SHORT) & (size > 0)
    bounds = np.concatenate([[0], np.cumsum(np.where(own, size, 0))])
    return labelled_grams(x.hashes[own[x.doc]], bounds, SHORT_K)


def _words_of(bits: np.ndarray):
    """(text) -> node, tokens of the texts whose node may be wanted, each once per batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[int, bytes] = {}
            for x in slices(batch.column(0)):
                nodes = _nodes(x)
                place = nodes.view(np.uint64) % np.uint64(len(bits) * 64)
                want = (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)
                for i in np.flatnonzero(want):
                    found[int(nodes[i])] = (x.hashes[x.bounds[i]:x.bounds[i + 1]] >> np.uint64(32)).astype("<u4").tobytes()
            yield pa.RecordBatch.from_pydict({"node": pa.array(list(found), pa.int64()), "tokens": pa.array(list(found.values()), pa.binary())})
    return run


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        near = []
        for a, b in zip(batch.column(2), batch.column(3)):
            a, b = (np.frombuffer(v.as_buffer(), "<u4") for v in (a, b))
            most = int(_most(max(len(a), len(b))))
            near.append(distance(a, b, most) <= most)
        near = pa.array(near, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(near), batch.column(1).filter(near)], names=["a", "b"])


def _most(words):
    """The largest edit distance of a link, of texts whose longer one has so many words."""
    return (1 - SIMILARITY + 1e-9) * words


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, tokens) -> node, bag: how many words fall into each of BAG cells, 255 at most. A replaced word changes
    two counts by one, a new or lost word one count and the length: the sum of all differences is at most twice the edits."""
    for batch in batches:
        bags = [np.minimum(np.bincount(np.frombuffer(v.as_buffer(), "<u4") % BAG, minlength=BAG), 255).astype(np.uint8).tobytes()
                for v in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bags, pa.binary())], names=["node", "bag"])


def _candidates(table: pa.Table) -> pa.Table:
    """The pairs of one cell that may be linked: of different classes, sharing no key smaller than the cell's, and
    allowed by their lengths and counts. A cell is a block with itself (left and right are true) or two blocks."""
    key = table.column("key")[0].as_py()
    node, of, words = (table.column(c).to_numpy() for c in ("node", "of", "words"))
    left, right = (np.flatnonzero(table.column(c).to_numpy()) for c in ("left", "right"))
    alone = len(left) == len(node) == len(right)  # then each pair would stand twice
    lists = table.column("keys").combine_chunks()
    row = np.repeat(np.arange(len(node)), np.diff(lists.offsets.to_numpy()))
    own = lists.flatten().to_numpy()
    row, own = row[own < key], own[own < key]
    order = np.argsort(own, kind="stable")
    earlier = np.zeros((len(node), len(node)), dtype=bool)
    for rows in np.split(row[order], np.flatnonzero(np.diff(own[order])) + 1):
        earlier[np.ix_(rows, rows)] = True
    bag = np.stack([np.frombuffer(v.as_buffer(), np.uint8) for c in table.column("bag").chunks for v in c])
    a, b = [node[:0]], [node[:0]]  # a block may have no texts
    for i in left:
        longer = np.maximum(words[right], words[i])
        ok = (of[right] != of[i]) & (np.minimum(words[right], words[i]) >= SIMILARITY * longer) & (right > i if alone else True)
        at = right[ok]
        at = at[~earlier[i, at]]
        unlike = np.abs(bag[at].astype(np.int16) - bag[i]).sum(axis=1, dtype=np.int64) + np.abs(words[at] - words[i])
        at = at[unlike <= 2 * _most(np.maximum(words[at], words[i]))]
        a.append(np.full(len(at), node[i]))
        b.append(node[at])
    return pa.table({"leader": pa.array(np.concatenate(a), pa.int64()), "node": pa.array(np.concatenate(b), pa.int64())})


def _bits(nodes: DataFrame) -> np.ndarray:
    """A bit per hash of the wanted nodes; BITS in all, whatever their number. It only spares work."""
    place = F.pmod("node", F.lit(BITS))
    rows = (nodes.select(place.alias("place")).select(F.shiftright("place", 6).alias("slot"),
                                                      F.expr("shiftleft(1L, cast(place % 64 as int))").alias("bit"))
            .groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow())
    bits = np.zeros(BITS // 64, dtype=np.uint64)
    bits[rows.column("slot").to_numpy()] = rows.column("bits").to_numpy().astype(np.int64).view(np.uint64)
    return bits


def classes(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `documents`: doc_id, text_key (a hash of its text), class_id, first (a struct: the key of the
    class's first row by doc_id, null last, and text_key), node (equal for equal word sequences), words."""
    docs = documents.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))
    described = store(docs.mapInArrow(_describe, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_key BIGINT, "
                                                 "node BIGINT, words INT, keys ARRAY<BIGINT>"), "omh-sketches")
    texts = described.groupBy("node").agg(F.min(_row_key()).alias("first"), F.min("words").alias("words"), F.min("keys").alias("keys"))
    bands = texts.select(F.explode("keys").alias("key"), "node", "words")
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("key")
    whole = store(bands.join(store(shared, "omh-keys"), "key"), "omh-bands")
    tokens = store(docs.select("text").mapInArrow(_words_of(_bits(whole.select("node").distinct())), "node BIGINT, tokens BINARY")
                   .groupBy("node").agg(F.min("tokens").alias("tokens")), "omh-tokens")

    def linked(pairs: DataFrame) -> DataFrame:
        """Those of the given pairs (leader, node) that resemble each other, as a, b."""
        one = pairs.join(tokens, "node")
        both = one.join(tokens.select(F.col("node").alias("leader"), F.col("tokens").alias("leading")), "leader")
        return both.select("leader", "node", "leading", "tokens").mapInArrow(_check, "a BIGINT, b BIGINT")

    links = []
    active = whole.withColumn("turn", F.xxhash64("node"))
    for _ in range(ROUNDS):
        first = active.groupBy("key").agg(F.min(F.struct("turn", "node", "words")).alias("first"))
        led = store(active.join(first, "key").where("node <> first.node")
                    .select("key", "node", "words", "turn", F.col("first.node").alias("leader"), F.col("first.words").alias("leader_words")), "omh-led")
        alike = F.least("words", "leader_words") >= SIMILARITY * F.greatest("words", "leader_words")
        links.append(store(linked(led.where(alike).select("leader", "node").distinct()), "omh-near"))
        active = led.join(links[-1].select(F.col("a").alias("leader"), F.col("b").alias("node")), ["leader", "node"], "left_anti").select(
            "key", "node", "words", "turn")
    edges = whole.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    for more in links:
        edges = edges.unionByName(more)
    edges = store(edges.distinct(), "omh-links")
    # each text keeps the link to its smallest leader, which is linked with the text's other leaders
    least = edges.groupBy("b").agg(F.min("a").alias("least"))
    leaders = edges.join(least, "b").where("a <> least").select(F.col("least").alias("a"), F.col("a").alias("b")).distinct()
    group = components(least.select(F.col("least").alias("a"), "b").unionByName(leaders)).withColumnRenamed("component", "of")
    found = linked(_rest(whole, group, tokens))
    for end in ("a", "b"):  # links between classes, which are far fewer than those between texts
        own = group.select(F.col("node").alias(end), "of")
        found = found.join(own, end, "left").withColumn(end, F.coalesce("of", end)).drop("of")
    joined = components(found).withColumnRenamed("node", "of")
    alone = joined.join(group, joined["of"] == group["node"], "left_anti").withColumn("node", F.col("of"))  # texts without links before
    group = group.unionByName(alone.select("node", "of")).join(joined, "of", "left").select("node", F.coalesce("component", "of").alias("component"))
    named = texts.select("node", "first").join(group, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("first").alias("first"))
    named = store(named.drop("first").join(least, "component").select("node", "first"), "omh-classes")
    return (described.select("doc_id", "text_key", "node", "words").join(named, "node")
            .select("doc_id", "text_key", F.col("first.doc_id").alias("class_id"), "first", "node", "words"))


def _rest(bands: DataFrame, group: DataFrame, tokens: DataFrame) -> DataFrame:
    """leader, node: the pairs that share a key, are in different classes (`of`, by `group`) and may be linked."""
    members = bands.join(group, "node", "left").withColumn("of", F.coalesce("of", "node"))
    several = members.groupBy("key").agg(F.min("of").alias("low"), F.max("of").alias("high")).where("low <> high").select("key")
    members = store(members.join(several, "key", "left_semi"), "omh-several")
    keys = members.groupBy("node").agg(F.collect_list("key").alias("keys"))
    bags = tokens.join(keys, "node").select("node", "tokens").mapInArrow(_bags, "node BIGINT, bag BINARY")
    about = store(keys.join(bags, "node"), "omh-bags")
    # blocks: of one large class (its name in `only`), or of many small ones
    sizes = members.groupBy("key", "of").agg(F.count(F.lit(1)).alias("n")).withColumn("only", F.expr(f"if(n >= {BLOCK}, of, null)"))
    counts = store(sizes.groupBy("key", "only").agg(F.ceil(F.sum("n") / BLOCK).alias("blocks")), "omh-blocks")
    blocks = counts.select("key", "only", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    other = blocks.select("key", F.col("only").alias("only2"), F.col("block").alias("block2"))
    first, second = F.struct(F.col("only").isNull(), "only", "block"), F.struct(F.col("only2").isNull(), F.col("only2"), F.col("block2"))
    cells = (blocks.join(other, "key").where((first <= second) & ~F.coalesce(F.col("only") == F.col("only2"), F.lit(False)))
             .withColumn("cell", F.xxhash64("only", "block", "only2", "block2")).withColumn("same", first == second))
    left = cells.select("key", "cell", "only", "block", F.lit(True).alias("left"), F.col("same").alias("right"))
    right = cells.where("NOT same").select("key", "cell", F.col("only2").alias("only"), F.col("block2").alias("block"),
                                           F.lit(False).alias("left"), F.lit(True).alias("right"))
    large = counts.where("only IS NOT NULL").select("key", F.col("only").alias("of"), F.col("blocks").alias("own"))
    small = counts.where("only IS NULL").select("key", F.col("blocks").alias("shared"))
    # a small class stays in one block
    placed = (members.join(large, ["key", "of"], "left").join(small, "key", "left")
              .withColumn("only", F.expr("if(own IS NULL, null, of)"))
              .withColumn("block", F.expr("pmod(if(own IS NULL, xxhash64(of), xxhash64(node)), coalesce(own, shared))")))
    sides = left.unionByName(right)
    dealt = placed.join(sides, (placed["key"] == sides["key"]) & placed["only"].eqNullSafe(sides["only"]) & (placed["block"] == sides["block"]))
    dealt = dealt.select(placed["key"], "cell", "left", "right", "node", "of", "words").join(about, "node")
    return store(dealt.groupBy("key", "cell").applyInArrow(_candidates, "leader BIGINT, node BIGINT"), "omh-rest")


def _row_key():
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")


def deduplicated(documents: DataFrame) -> DataFrame:
    """The rows of `documents` (doc_id, text, ..) that stay: the first of each class by doc_id, null last. Of rows with
    this id and text one stays, the smallest by its columns."""
    found = store(classes(documents).withColumn("stays", _row_key() == F.col("first")), "omh-found")
    gone = found.where("NOT stays").select("doc_id", "text_key").distinct()
    again = found.where("stays").groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    apart = store(gone.withColumn("again", F.lit(False)).unionByName(again.withColumn("again", F.lit(True))), "omh-apart")

    def same(keys: DataFrame):
        return documents["doc_id"].eqNullSafe(keys["doc_id"]) & (F.xxhash64(documents["text"]) == keys["text_key"])

    kept = documents.join(apart, same(apart), "left_anti")
    several = apart.where("again")
    one = (documents.join(several, same(several), "left_semi").groupBy("doc_id", F.xxhash64("text"))
           .agg(F.min(F.struct(*documents.columns)).alias("row")).select("row.*"))
    return kept.unionByName(one)

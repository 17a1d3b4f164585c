"""Near-duplicate embeddings by an inverted multi-index.

Vectors are scaled to unit length; equal ones are one node with a count. Both halves of the vectors have a codebook of
their own, so the two nearest centroids of a vector name a cell of a product grid with about CELL nodes each. A node
looks into the cells nearest to it, in the order of the sum of both halves' squared distances (the multi-sequence
order). What is found is verified by cosine in double precision; a pair counts for both its nodes when either visits the
other's cell.

How many cells a node visits is measured, not guessed, in two ways, and the larger number counts. Hardest case: PROBED nodes
each get a partner at exactly the threshold in a random direction, and TARGET of these pairs must be found. Real links: the
other nodes that PROBED nodes link with are found by brute force over all nodes; each probe that has any counts the same,
and on average TARGET of a probe's links must be found by its own visits alone. So neither equal vectors, which are one node,
nor a dense cluster can hide what sparse links need.

Codebooks are fitted on at most SAMPLE nodes; all nodes are indexed, and all are queries. Nodes of a cell and the queries
to it are dealt out in blocks of at most about SIDE each, so a crowded cell is many tasks; a block returns sums per node
and a spanning forest of its links, never its pairs.

A vector that is null or zero, or holds a null or non-finite component, links with nothing and is its own component.
Vectors link only with vectors of the same length. Repeated rows are vectors of their own. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import store

THRESHOLD = 0.9
CELL = 64
MOST_CENTROIDS = 1024
SAMPLE = 20_000
ROUNDS = 12
PROBED = 512
TARGET = 0.95
LEAST_CELLS = 4
SIDE = 4096
CHUNK = 512


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, embedding) -> vec_id, node (null if it links with nothing), unit vector."""
    for batch in batches:
        nodes, units = [], []
        for row in batch.column(1):
            values = row.values if row.is_valid else None
            unit = None
            if values is not None and len(values) and not values.null_count:
                v = values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(v).all() and v.any():
                    v = v / np.abs(v).max()
                    unit = (v / np.sqrt(v @ v) + 0.0).tobytes()  # + 0.0: no negative zeros
            units.append(unit)
            nodes.append(None if unit is None else int.from_bytes(hashlib.blake2b(unit, digest_size=8).digest(), "little", signed=True))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes, pa.int64()), pa.array(units, pa.binary())],
                                         names=["vec_id", "node", "unit"])


# ---- the index ----------------------------------------------------------------------------------

def _means(points: np.ndarray, size: int) -> np.ndarray:
    """Centroids by Lloyd's rounds from spread-out beginnings; always the same for the same points."""
    rng = np.random.default_rng(0)
    centres = points[rng.choice(len(points), size, replace=False)]
    for _ in range(ROUNDS):
        near = np.argmin(_squares(points, centres), axis=1)
        count = np.bincount(near, minlength=size)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        full = count > 0
        centres[full] = sums[full] / count[full, None]
    return centres


def _squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((points ** 2).sum(1)[:, None] - 2 * points @ centres.T + (centres ** 2).sum(1)[None, :], 0)


@dataclass
class Grid:
    """Codebooks of both halves for vectors of one length."""

    first: np.ndarray
    second: np.ndarray

    def cells(self, units: np.ndarray, count: int) -> np.ndarray:
        """The `count` nearest cells of every vector, nearest first: the start of the multi-sequence."""
        half, out = self.first.shape[1], []
        size = min(count, len(self.first) * len(self.second))
        for at in range(0, len(units), CHUNK):
            a, b = _squares(units[at:at + CHUNK, :half], self.first), _squares(units[at:at + CHUNK, half:], self.second)
            i, j = np.argsort(a, axis=1, kind="stable"), np.argsort(b, axis=1, kind="stable")
            # the n nearest pairs have ranks (r, s) with (r + 1) (s + 1) <= n
            r, s = np.array([(r, s) for r in range(min(size, a.shape[1])) for s in range(min(size // (r + 1), b.shape[1]))]).T
            rows = np.arange(len(a))[:, None]
            total = a[rows, i[:, r]] + b[rows, j[:, s]]
            best = np.argsort(total, axis=1, kind="stable")[:, :size]
            out.append(i[rows, r[best]].astype(np.int64) * len(self.second) + j[rows, s[best]])
        return np.concatenate(out) if out else np.zeros((0, size), np.int64)


@dataclass
class Index:
    grids: dict[int, Grid]  # by vector length
    visits: int = LEAST_CELLS

    def cells(self, units: list[bytes], count: int) -> list[np.ndarray]:
        """For each vector its nearest cells, as numbers that differ between lengths."""
        out: list = [None] * len(units)
        sizes = np.array([len(u) // 8 for u in units])
        for size in np.unique(sizes):
            own = np.flatnonzero(sizes == size)
            grid = self.grids.get(int(size))
            if grid is None:  # no vector of this length was in the sample: one cell for all of them
                cells = np.zeros((len(own), 1), np.int64)
            else:
                cells = grid.cells(np.frombuffer(b"".join(units[i] for i in own)).reshape(len(own), size), count)
            for i, c in zip(own, cells + (int(size) << 32)):
                out[i] = c
        return out


def _links_of(queries: list[tuple[int, bytes]], index: Index):
    """(node, unit) -> query, cell of every other node that a query links with."""
    asked = np.array([n for n, _ in queries], dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrices = {}
        for size in {len(u) for _, u in queries}:
            own = [i for i, (_, u) in enumerate(queries) if len(u) == size]
            matrices[size] = (np.array(own), np.frombuffer(b"".join(queries[i][1] for i in own)).reshape(len(own), size // 8))
        for batch in batches:
            for at in range(0, batch.num_rows, SIDE):
                part = batch.slice(at, SIDE)
                units = part.column(1).to_pylist()
                nodes = part.column(0).to_numpy()
                cells = index.cells(units, 1)
                found_q, found_c = [], []
                for size, (own, matrix) in matrices.items():
                    rows = [i for i, u in enumerate(units) if len(u) == size]
                    if rows:
                        points = np.frombuffer(b"".join(units[i] for i in rows)).reshape(len(rows), size // 8)
                        q, p = np.nonzero((matrix @ points.T >= THRESHOLD) & (asked[own][:, None] != nodes[rows][None, :]))
                        found_q += own[q].tolist()
                        found_c += [int(cells[rows[i]][0]) for i in p]
                yield pa.RecordBatch.from_pydict({"query": pa.array(found_q, pa.int32()), "cell": pa.array(found_c, pa.int64())})
    return run


def build(nodes: DataFrame) -> Index:
    """Codebooks from a sample of `nodes` (node, unit), and the number of cells to visit from measured recall."""
    total = nodes.count()
    sample = nodes.orderBy("node").limit(SAMPLE).collect()  # nodes are hashes, so their order is a random one
    grids = {}
    for size in {len(r.unit) for r in sample}:
        points = np.array([np.frombuffer(r.unit) for r in sample if len(r.unit) == size])
        centroids = int(np.clip(np.ceil(np.sqrt(total / CELL)), 1, min(MOST_CENTROIDS, len(points))))
        half = points.shape[1] // 2
        grids[size // 8] = Grid(_means(points[:, :half], centroids), _means(points[:, half:], centroids))
    index = Index(grids)
    queries = [(r.node, bytes(r.unit)) for r in sample[:PROBED]]
    if not queries:
        return index
    rows = (nodes.select("node", "unit").mapInArrow(_links_of(queries, index), "query INT, cell BIGINT")
            .groupBy("query", "cell").agg(F.count(F.lit(1)).alias("n")).collect())
    most = min(max(len(g.first) * len(g.second) for g in grids.values()), 4096)
    order = index.cells([u for _, u in queries], most)
    share: dict[int, np.ndarray] = {}  # of a probe's links, by the rank of their cells
    for r in rows:
        place = np.flatnonzero(order[r.query] == r.cell)
        share.setdefault(r.query, np.zeros(most + 1))[int(place[0]) if len(place) else most] += r.n
    found = [np.cumsum(s) / s.sum() for s in share.values()]
    real = int(np.searchsorted(np.mean(found, axis=0), TARGET)) + 1 if found else 0
    ranks = _hardest(index, [np.frombuffer(u) for _, u in queries], order, most)
    hard = int(np.quantile(ranks, TARGET, method="higher")) + 1 if len(ranks) else 0
    index.visits = max(LEAST_CELLS, min(most, max(real, hard)))
    return index


def _hardest(index: Index, units: list[np.ndarray], order: list[np.ndarray], most: int) -> np.ndarray:
    """For each vector and a partner at the threshold: the rank at which one first visits the other's cell."""
    rng, out = np.random.default_rng(0), []
    for unit, own in zip(units, order):
        away = rng.normal(size=len(unit))
        away -= (away @ unit) * unit
        length = np.sqrt(away @ away)
        if length < 1e-9:
            continue  # of one dimension: nothing lies at the threshold
        partner = THRESHOLD * unit + np.sqrt(1 - THRESHOLD ** 2) * away / length
        other = index.cells([partner.tobytes()], most)[0]
        places = [np.flatnonzero(a == b) for a, b in ((other, own[0]), (own, other[0]))]
        out.append(min(int(p[0]) if len(p) else most for p in places))
    return np.array(out)


# ---- links --------------------------------------------------------------------------------------

def _visited(index: Index):
    """(node, copies, unit) -> the same with the node's own cell and all cells that it visits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SIDE):
                part = batch.slice(at, SIDE)
                cells = index.cells(part.column(2).to_pylist(), index.visits)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([int(c[0]) for c in cells], pa.int64()),
                                                  pa.array(cells, pa.list_(pa.int64()))], names=["node", "copies", "unit", "cell", "visits"])
    return run


def _block(table: pa.Table) -> pa.Table:
    """Links between the members and the queries of a block: how many vectors each node gained, and edges that connect
    what the links connect."""
    is_member = table.column("member").to_numpy(zero_copy_only=False)
    members, queries = table.filter(pa.array(is_member)), table.filter(pa.array(~is_member))
    if not members.num_rows or not queries.num_rows:
        return _answer([], [], [], [])
    unit = [np.array([np.frombuffer(u.as_buffer()) for u in t.column("unit")]) for t in (members, queries)]
    m_node, q_node = (t.column("node").to_numpy() for t in (members, queries))
    m_copies, q_copies = (t.column("copies").to_numpy() for t in (members, queries))
    q_home = queries.column("home").to_numpy()
    visits = np.array(members.column("visits").to_pylist())
    m_gain, q_gain = np.zeros(len(m_node), np.int64), np.zeros(len(q_node), np.int64)
    m_label, edges = m_node.copy(), []
    largest = np.iinfo(np.int64).max
    for at in range(0, len(q_node), CHUNK):
        here = slice(at, at + CHUNK)
        linked = unit[1][here] @ unit[0].T >= THRESHOLD
        linked &= q_node[here][:, None] != m_node[None, :]
        q, m = np.nonzero(linked)
        if not len(q):
            continue
        np.add.at(q_gain, q + at, m_copies[m])
        for a in range(0, len(q), 1 << 18):  # the member gains too, unless it visits the query's cell itself
            b = slice(a, a + (1 << 18))
            alone = ~(visits[m[b]] == q_home[here][q[b]][:, None]).any(axis=1)
            np.add.at(m_gain, m[b][alone], q_copies[here][q[b]][alone])
        q_label = q_node[here].copy()
        while True:
            new_q = np.minimum(q_label, np.where(linked, m_label[None, :], largest).min(axis=1))
            new_m = np.minimum(m_label, np.where(linked, new_q[:, None], largest).min(axis=0))
            for node, old, new in ((q_node[here], q_label, new_q), (m_node, m_label, new_m)):
                moved = old != new
                edges.append(np.stack([node[moved], new[moved]], 1))
                edges.append(np.stack([old[moved], new[moved]], 1))
            done = (new_q == q_label).all() and (new_m == m_label).all()
            q_label, m_label = new_q, new_m
            if done:
                break
    pairs = np.unique(np.concatenate(edges), axis=0) if edges else np.zeros((0, 2), np.int64)
    pairs = pairs[pairs[:, 0] != pairs[:, 1]]
    node, gain = np.concatenate([m_node, q_node]), np.concatenate([m_gain, q_gain])
    return _answer(node[gain > 0], gain[gain > 0], pairs[:, 0], pairs[:, 1])


def _answer(node, gain, a, b) -> pa.Table:
    """Rows of gains (other null) and of edges (gain null)."""
    none_a, none_g = [None] * len(node), [None] * len(a)
    return pa.table({"node": pa.array([*node, *a], pa.int64()), "gain": pa.array([*gain, *none_g], pa.int64()),
                     "other": pa.array([*none_a, *b], pa.int64())})


def links(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", index: Index | None = None) -> DataFrame:
    """One row per row of `vectors`: vec_id, n_links, component_id, kept."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
    rows = store(rows.mapInArrow(_unit, "vec_id BIGINT, node BIGINT, unit BINARY"), "vectors")
    nodes = store(rows.where("node IS NOT NULL").groupBy("node").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"),
                                                                     F.min("unit").alias("unit")), "vector-nodes")
    index = index or build(nodes)
    placed = store(nodes.select("node", "copies", "unit").mapInArrow(
        _visited(index), "node BIGINT, copies BIGINT, unit BINARY, cell BIGINT, visits ARRAY<BIGINT>"), "vector-cells")
    asked = placed.select("node", "copies", "unit", F.col("cell").alias("home"), F.explode("visits").alias("cell"))
    size = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    # every cell is cut into blocks of members times blocks of queries
    cut = store(size.join(asked.groupBy("cell").agg(F.count(F.lit(1)).alias("q")), "cell")
                .select("cell", F.ceil(F.col("n") / SIDE).cast("int").alias("member_blocks"), F.ceil(F.col("q") / SIDE).cast("int").alias("query_blocks")),
                "vector-blocks")

    def block(of: str, other: str):
        own = F.pmod(F.xxhash64("node"), F.col(f"{of}_blocks")).cast("int")
        return own.alias(f"{of}_block"), F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)).alias(f"{other}_block")

    members = placed.join(cut, "cell").select("cell", "node", "copies", "unit", "visits", F.lit(None).cast("long").alias("home"),
                                              F.lit(True).alias("member"), *block("member", "query"))
    queries = asked.join(cut, "cell").select("cell", "node", "copies", "unit", F.lit(None).cast("array<long>").alias("visits"), "home",
                                             F.lit(False).alias("member"), *block("query", "member"))
    found = store(members.unionByName(queries).groupBy("cell", "member_block", "query_block")
                  .applyInArrow(_block, "node BIGINT, gain BIGINT, other BIGINT"), "vector-links")
    gains = found.where("other IS NULL").groupBy("node").agg(F.sum("gain").alias("gain"))
    group = components(found.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = (nodes.select("node", "vec_id", "copies").join(gains, "node", "left").join(group, "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    least = named.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    named = store(named.join(least, "component").select(
        "node", "component_id", (F.coalesce("gain", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "vector-components")
    out = rows.select("vec_id", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))

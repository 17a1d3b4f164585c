"""Compressing vectors to short codes: a codebook per part of the vector, learnt by Ball k-means.

Components become integers floor(SCALE * x), so every distance, sum and mean below is exact and the same on any number
of tasks. A vector is cut into PARTS equal parts. The codebook of a part position begins as that part of the ENTRIES
smallest ids. A round assigns every part to the nearest entry of its codebook (ties to the lower index) and moves every
entry to the componentwise floor of its parts' mean; an entry without parts stays. After the rounds the parts are
assigned once more.

Assigning, from the second time on, is that of Ball k-means. The parts of an entry form a ball around it, whose radius is
that of the farthest. For an entry at distance D of another, a part within D / 2 of its own entry cannot be nearer to the
other; so only entries with D / 2 up to the radius are neighbours, a part nearer than half of the least D is in the stable
core and keeps its entry without any distance computed, and sorted by D the neighbours cut the rest of the ball into
annular rings: a part in the k-th ring is compared with the first k neighbours alone. Radii are those of the parts a task
holds in hand, which makes the balls only smaller. All comparisons are of squared integers, so none is lost to rounding.

A task sends one row per part position and entry, so a round shuffles the codebooks' size per task. Only codebooks (ENTRIES
times a vector's length) reach the driver.

Rows whose vector is null, empty, or holds a null or non-finite component are dropped; so are those whose vector is not as
long as that of the smallest remaining id, or all if that length is no multiple of PARTS. Beyond 2**26 integers are held
at that bound, so that all sums fit 64 bits. Of rows with one id, the one with the smaller integers comes first. With fewer
rows than ENTRIES the codebooks are that much smaller. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .passing import quoted
from .shared import store

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
HOLD = 1 << 26
HOT = 1000  # a label is hot above this share (1 / HOT) of the rows; there are at most HOT of them
CHUNK = 8192  # vectors assigned at a time


def _integers(at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Replaces the vector by its integers, null where it is dropped."""
        for batch in batches:
            out = []
            for row in batch.column(at):
                values = row.values if row.is_valid else None
                whole = None
                if values is not None and len(values) and not values.null_count:
                    v = values.to_numpy(zero_copy_only=False).astype(np.float64)
                    if np.isfinite(v).all():
                        whole = np.clip(np.floor(np.clip(v, -HOLD, HOLD) * SCALE), -HOLD, HOLD).astype(np.int64)
                out.append(whole)
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            names = [n for i, n in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.list_(pa.int64()))], names=[*names, "__whole"])

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equally long integer vectors."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _bytes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def squares(points: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Squared distances, row by row."""
    apart = points - entry
    return np.einsum("ij,ij->i", apart, apart)


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of every point and its squared distance, by comparing with all."""
    best, code = squares(points, entries[0]), np.zeros(len(points), dtype=np.int64)
    for j in range(1, len(entries)):
        d = squares(points, entries[j])
        closer = d < best
        best[closer], code[closer] = d[closer], j
    return code, best


@dataclass
class Balls:
    """The entries of one part position, and for each the others by distance."""

    entries: np.ndarray

    def __post_init__(self):
        apart = self.entries[:, None, :] - self.entries[None, :, :]
        square = (apart * apart).sum(axis=2)
        np.fill_diagonal(square, -1)  # an entry itself comes first and is left out
        self.order = np.argsort(square, axis=1, kind="stable")[:, 1:]
        self.square = np.take_along_axis(square, self.order, axis=1)

    def assign(self, points: np.ndarray, was: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The nearest entry of every point and its squared distance, from the entries they `was` in; and how many
        distances to other entries that took."""
        code, best, looked = was.copy(), squares(points, self.entries[was]), 0
        for j in np.unique(was):
            own = np.flatnonzero(was == j)
            reach = 4 * best[own]
            neighbours = int(np.searchsorted(self.square[j], reach.max(), side="right"))
            if not neighbours:
                continue
            ring = np.searchsorted(self.square[j, :neighbours], reach, side="right")  # 0: the stable core
            for k in range(neighbours):
                inside = own[ring > k]
                other = self.order[j, k]
                d = squares(points[inside], self.entries[other])
                looked += len(inside)
                closer = (d < best[inside]) | ((d == best[inside]) & (other < code[inside]))
                best[inside[closer]], code[inside[closer]] = d[closer], other
        return code, best, looked


def assign(books: np.ndarray, rows: np.ndarray, was: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes and errors of whole vectors, one column per part. books: part, entry, component."""
    code = np.zeros((len(rows), len(books)), dtype=np.int64)
    error = np.zeros_like(code)
    width = books.shape[2]
    for p, entries in enumerate(books):
        points = rows[:, p * width:(p + 1) * width]
        if was is None:
            code[:, p], error[:, p] = nearest(points, entries)
        else:
            code[:, p], error[:, p], _ = Balls(entries).assign(points, was[:, p].astype(np.int64))
    return code, error


def _assign(books: np.ndarray, first: bool):
    """Adds code (a byte per part) and error; `__code` of an earlier round goes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                rows = _matrix(batch.column("__whole"))
                was = None if first else _bytes(batch.column("__code"))
                code, error = assign(books, rows, was)
                names = [n for n in batch.schema.names if n not in ("__code", "__error")]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(n) for n in names), pa.array([bytes(c) for c in code.astype(np.uint8)], pa.binary()), pa.array(error.sum(axis=1), pa.int64())],
                    names=[*names, "__code", "__error"])

    return run


def _sums(parts: int, entries: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per part position, entry and component that occurs in the task: sum and count."""
        sums = np.zeros((parts, entries, width), dtype=np.int64)
        count = np.zeros((parts, entries), dtype=np.int64)
        for batch in batches:
            rows = _matrix(batch.column("__whole"))
            code = _bytes(batch.column("__code"))
            for p in range(parts):
                np.add.at(sums[p], code[:, p], rows[:, p * width:(p + 1) * width])
                count[p] += np.bincount(code[:, p], minlength=entries)
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(p * entries + e, width), pa.int64()), pa.array(np.tile(np.arange(width), len(p)), pa.int64()),
             pa.array(sums[p, e].ravel(), pa.int64()), pa.array(np.repeat(count[p, e], width), pa.int64())],
            names=["cell", "component", "total", "n"])

    return run


def moved(assigned: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after a round: floors of the means of what is assigned to each entry."""
    parts, entries, width = books.shape
    rows = (assigned.select("__whole", "__code").mapInArrow(_sums(parts, entries, width), "cell BIGINT, component BIGINT, total BIGINT, n BIGINT")
            .groupBy("cell", "component").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect())
    out = books.copy()
    for r in rows:  # one row per component of the codebooks
        out[r.cell // entries, r.cell % entries, r.component] = r.total // r.n
    return out


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", keep: tuple[str, ...] = ("vec_id",),
             code: str = "code", error: str = "error", rounds: int = ROUNDS, parts: int = PARTS, entries: int = ENTRIES) -> tuple[DataFrame, np.ndarray]:
    """Columns `keep` of every kept row with its code (two hex digits a part) and error (sum of squared distances), and
    the codebooks (part, entry, component)."""
    own = vectors.select(*[quoted(c).alias(f"__{i}") for i, c in enumerate(keep)], quoted(vec_id).alias("__id"), quoted(embedding).alias("__vector"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own.schema.fields if f.name != "__vector")
    whole = own.mapInArrow(_integers(len(keep) + 1), f"{kinds}, __whole ARRAY<BIGINT>").where("__whole IS NOT NULL")
    now = store(whole, "codes-integers")
    order = F.col("__id").asc_nulls_last(), "__whole"
    first = now.orderBy(*order).select("__whole").first()
    size = len(first[0]) if first else 0
    now = now.where(F.size("__whole") == (size if size % parts == 0 else -1))
    seeds = now.orderBy(*order).limit(entries).select("__whole").collect()
    shape = (parts, max(len(seeds), 1), size // parts)
    books = np.zeros(shape, dtype=np.int64)
    for e, r in enumerate(seeds):
        books[:, e, :] = np.array(r["__whole"]).reshape(parts, -1)
    if not seeds:
        books = books[:, :0]
    held = f"{kinds}, __whole ARRAY<BIGINT>, __code BINARY, __error BIGINT"
    for r in range(rounds + 1 if seeds else 0):
        now = store(now.mapInArrow(_assign(books, r == 0), held), "codes-assigned")
        if r < rounds:
            books = moved(now, books)
    if not seeds:
        now = now.withColumn("__code", F.lit(None).cast("binary")).withColumn("__error", F.lit(None).cast("bigint"))
    return now.select(*[F.col(f"__{i}").alias(c) for i, c in enumerate(keep)], F.lower(F.hex("__code")).alias(code), F.col("__error").alias(error)), books


def grouped_error(coded: DataFrame, label: str = "label", error: str = "error", out: str = "label_error") -> DataFrame:
    """Adds the sum of `error` over equal labels, nulls together. Hot labels are joined by a broadcast of at most HOT rows;
    no other label has more than 1 / HOT of the rows."""
    sums = store(coded.groupBy(quoted(label).alias("__label")).agg(F.sum(error).alias("__sum"), F.count(F.lit(1)).alias("__n")), "codes-labels")
    rows = sums.agg(F.sum("__n")).first()[0] or 0
    hot = sums.where(F.col("__n") * HOT > rows)
    same = quoted(label).eqNullSafe(F.col("__label"))
    first = coded.join(F.broadcast(hot), same, "left").drop("__label")
    done = first.where("__n IS NOT NULL").drop("__n").withColumnRenamed("__sum", out)
    rest = first.where("__n IS NULL").drop("__n", "__sum").join(sums.where(F.col("__n") * HOT <= rows), same).drop("__label", "__n").withColumnRenamed("__sum", out)
    return done.unionByName(rest)

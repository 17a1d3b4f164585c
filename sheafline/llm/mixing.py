"""Mixing sources to target weights by a low-discrepancy schedule.

Every source is a stream of its documents in hashed order, cut into blocks of equal length in words (the last may
be shorter). The mix is a list of slots. Slot i takes the i-th van der Corput point (the bits of i mirrored),
laid over the sources' numbers of blocks side by side, so any stretch of the schedule holds every source in its share, and
a source gets its target to within one block. The k-th slot of a source takes its k-th block, beginning anew after
the last one, twice at most.

All sources have blocks of one length, but for small ones: a block is never longer than a share 1 / LEAST_SLOTS of its
source's target, so the smallest source comes as near to its target as the largest, whatever the corpus.

All work is DataFrame functions. Running sums over a source are taken in two steps (per hashed range, then within
it), so a hot source is many tasks; the schedule has at most SLOTS slots plus LEAST_SLOTS for every source.

Null texts are empty. Null sources are one source, sorted last. Equal rows are counted each. A document of no words
is never taken. Empty tables give empty results. Only the named columns are read. The documents are numbered by
hashed order of (doc_id, size, text); rows equal in all of these are interchangeable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import store

SLOTS = 1 << 20
LEAST_SLOTS = 256
RANGES = 4096
BUCKETS = 1 << 10
EPOCHS = 2
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float) -> DataFrame:
    """One row per source of `sizes` (source, size): source_size, weight, target, and the stream's block length.

    Sources in code point order, null last, get `weights` in turn and share `share` times all words by weight. A
    target stops at EPOCHS times its source; the excess is shared anew. That is the level at which sources fill up
    in the order of limit / weight, so it needs one pass over the sorted sources, not rounds. (One row per source.)
    """
    last = F.col("source").isNull()
    total = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
             .withColumn("place", F.row_number().over(Window.orderBy(last, "source")) - 1))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    total = (total.withColumn("weight", weight).withColumn("limit", F.col("source_size") * float(EPOCHS))
             .withColumn("goal", F.sum("source_size").over(Window.partitionBy()) * float(share)))
    fill = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    before, after = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    level = (F.col("goal") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    total = total.withColumn("level", level).withColumn("water", F.min_by(
        F.when(F.col("level") <= F.col("limit") / F.col("weight"), F.col("level")),
        F.when(F.col("level") <= F.col("limit") / F.col("weight"), F.struct(F.col("limit") / F.col("weight"), "place")))
        .over(Window.partitionBy()))
    total = total.withColumn("target", F.coalesce(F.least(F.col("water") * F.col("weight"), "limit"), "limit"))
    side = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    block = F.greatest(F.lit(1), F.least(F.ceil(F.col("goal") / SLOTS), F.floor(F.col("target") / LEAST_SLOTS))).cast("long")
    return (total.withColumn("block_words", block).withColumn("width", F.col("target") / F.col("block_words"))
            .withColumn("to", F.sum("width").over(side))
            .select("source", "place", "source_size", "target", "block_words",
                    F.ceil(F.col("to") - F.col("width")).alias("first_point"), F.ceil("to").alias("end_point"),
                    F.ceil(F.col("source_size") / F.col("block_words")).alias("blocks")))


def schedule(sources: DataFrame) -> DataFrame:
    """The mix in order: slot, place (of the source), epoch, block. `sources` comes from `targets`."""
    spark = sources.sparkSession
    points = sources.agg(F.max("end_point")).first()[0] or 0
    bits = max(int(points) - 1, BUCKETS - 1).bit_length()
    width = (1 << bits) // BUCKETS
    points = spark.range(1 << bits).select(F.col("id").alias("point"), F.floor(F.col("id") / width).alias("bucket"))
    spans = (sources.where("end_point > first_point")
             .withColumn("bucket", F.explode(F.sequence(F.floor(F.col("first_point") / width),
                                                        F.floor((F.col("end_point") - 1) / width)))))
    mirrored = F.conv(F.reverse(F.lpad(F.bin("point"), bits, "0")), 2, 10).cast("long")
    slots = (points.join(spans, "bucket").where("point >= first_point AND point < end_point")
             .select(mirrored.alias("slot"), "place", "blocks")
             .withColumn("stretch", F.floor(F.col("slot") / width)))
    slots = store(slots, "mix-slots")
    before = (slots.groupBy("place", "stretch").agg(F.count(F.lit(1)).alias("n"))
              .select("place", "stretch", (F.sum("n").over(Window.partitionBy("place").orderBy("stretch")) - F.col("n")).alias("before")))
    rank = F.row_number().over(Window.partitionBy("place", "stretch").orderBy("slot")) - 1 + F.col("before")
    return (slots.join(before, ["place", "stretch"]).withColumn("rank", rank)
            .where(F.col("rank") < EPOCHS * F.col("blocks"))
            .select("slot", "place", F.floor(F.col("rank") / F.col("blocks")).alias("epoch"),
                    (F.col("rank") % F.col("blocks")).alias("block")))


def streams(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds place and the words [start, end) that each document takes in its source's stream.

    docs: doc_id, source, size, tie (orders rows of one doc_id)."""
    docs = (docs.join(sources.select(F.col("source").alias("of"), "place", "source_size", "target", "block_words"),
                      F.col("source").eqNullSafe(F.col("of"))).drop("of")
            .withColumn("order", F.xxhash64(F.lit("mix"), "doc_id"))
            .withColumn("range", F.shiftrightunsigned("order", 64 - RANGES.bit_length() + 1)))
    before = (docs.groupBy("place", "range").agg(F.sum("size").alias("n"))
              .select("place", "range", (F.sum("n").over(Window.partitionBy("place").orderBy("range")) - F.col("n")).alias("before")))
    within = Window.partitionBy("place", "range").orderBy("order", "doc_id", "size", "tie").rowsBetween(Window.unboundedPreceding, 0)
    return (docs.join(before, ["place", "range"])
            .withColumn("end", F.sum("size").over(within) + F.col("before"))
            .withColumn("start", F.col("end") - F.col("size")).drop("range", "order", "before"))


def mix(documents: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5) -> dict[str, DataFrame]:
    """The mix of `documents` (doc_id, text, source):

    `sources`: see `targets`. `schedule`: see `schedule`. `pieces`: doc_id, place, block and the words [start, end) of
    the document that lie in that block. `documents`: doc_id, size, source, source_size, target, taken, one row each.
    """
    docs = store(documents.select("doc_id", "source", words(F.col("text")).alias("size"), F.xxhash64("text").alias("tie")), "mix-sizes")
    sources = store(targets(docs, weights, share), "mix-sources")
    slots = schedule(sources)
    placed = store(streams(docs, sources), "mix-streams")
    length = F.col("block_words")
    cut = (placed.where("size > 0")
           .withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / length), F.floor((F.col("end") - 1) / length))))
           .withColumn("piece_start", F.greatest("start", F.col("block") * length))
           .withColumn("piece_end", F.least("end", (F.col("block") + 1) * length)))
    times = slots.groupBy("place", "block").agg(F.count(F.lit(1)).alias("times"))
    row = ["doc_id", "source", "size", "source_size", "target", "place", "start"]
    used = (cut.join(times, ["place", "block"], "left")
            .groupBy(*row).agg(F.sum((F.col("piece_end") - F.col("piece_start")) * F.coalesce("times", F.lit(0))).alias("taken")))
    whole = used.unionByName(placed.where("size = 0").select(*row, F.lit(0).cast("long").alias("taken")))
    return {
        "sources": sources, "schedule": slots,
        "pieces": cut.select("doc_id", "place", "block", (F.col("piece_start") - F.col("start")).alias("start"),
                             (F.col("piece_end") - F.col("start")).alias("end")),
        "documents": whole.select("doc_id", "size", "source", "source_size", "target", "taken"),
    }

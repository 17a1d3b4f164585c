"""Connected components of a graph of links, by smallest labels and shortcuts, in joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import store


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node in `links` (a, b BIGINT).

    A round gives every node the smallest label among itself, its neighbours and the label's own label; paths thus
    halve, and stars settle in two rounds. Rounds are written to the shared folder. Loops and repeated links do no harm.
    """
    links = links.select("a", "b").where("a <> b")
    both = store(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    known = store(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = (both.join(known.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
                .withColumnRenamed("a", "node"))
        first = known.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = known.select(F.col("node").alias("label"), F.col("label").alias("up"))
        known = store(first.join(up, "label", "left").select("node", "old", F.least("label", F.coalesce("up", "label")).alias("label")), "labels")
        if known.where("label <> old").isEmpty():
            return known.select("node", F.col("label").alias("component"))
        known = known.select("node", "label")

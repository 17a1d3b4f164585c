"""URL rules by a sort-merge range join.

A rule (host, path, verdict) fits its host and all subdomains where the path starts with the rule's. With the
host's labels reversed, a rule's key `com.example./en/` is a prefix of the keys it covers, hence the interval
[key, key + 0xFF). Prefix intervals nest or are apart, so a sweep over the sorted bounds and URLs needs only the
top of a stack: a start puts its rule on top, an end brings back the rule around it.

A URL enters the sweep once per host suffix (as many labels as the longest rule host has, no more can fit), and
the longest rule found wins: by host, then by path. The sweep is split by key ranges; each range starts with the
stack top left by the ranges before it. Equal keys are spread by a hash, and equal URLs are judged once.

Nulls and texts without `://` have an empty host and path. A rule listed twice with two verdicts blocks. Rules
with a null host or path are ignored. Empty tables give empty results (no rules: the default verdict for all).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import store

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.concat_ws(".", labels), F.lit("."), path).cast("binary")


def _bounds(rules: DataFrame) -> DataFrame:
    """Start and end of every rule's interval, with the rule that is on top of the stack from there on."""
    rules = (rules.select("host", "path", "verdict").where("host IS NOT NULL AND path IS NOT NULL")
             .withColumn("host", F.translate("host", UPPER, LOWER))
             .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
             .withColumn("key", _key(_labels(F.col("host")), F.col("path"))))
    top = F.struct(F.length("host").alias("host_chars"), F.length("path").alias("path_chars"),
                   F.concat("host", "path").alias("rule"), "verdict")
    rules = rules.select("key", top.alias("top"))
    outer = rules.select(F.col("key").alias("start"), F.col("top").alias("outer"))
    around = (rules.select("key", F.explode(F.sequence(F.lit(0), F.length("key") - 1)).alias("n"))
              .select("key", F.substring("key", 1, F.col("n")).alias("start")).join(outer, "start")
              .groupBy("key").agg(F.max_by("outer", F.length("start")).alias("outer")))
    ends = rules.join(around, "key", "left").select(F.concat("key", F.lit(b"\xff")).alias("key"), F.col("outer").alias("top"))
    return rules.unionByName(ends)


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", keep: tuple[str, ...] = ("page_id",),
          default: str = "allow") -> DataFrame:
    """Columns `keep` of `pages`, then host, path, rule (null if none fits), verdict. One row per row of `pages`.

    rules: host STRING, path STRING, verdict STRING (allow or block).
    """
    spark = pages.sparkSession
    pages = pages.select(*keep, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    deepest = F.coalesce(rules.select(F.max(F.size(F.split("host", r"\.")))).scalar(), F.lit(1))
    places = (pages.select("host", "path").distinct().withColumn("host_labels", _labels(F.col("host")))
              .withColumn("n", F.explode(F.sequence(F.lit(1), F.least(F.size("host_labels"), deepest))))
              .select(_key(F.slice("host_labels", 1, F.col("n")), F.col("path")).alias("key"), "host", "path"))
    bounds = _bounds(rules).withColumn("kind", F.lit(0))
    events = (bounds.unionByName(places.withColumn("kind", F.lit(1)), allowMissingColumns=True)
              .withColumn("spread", F.xxhash64("host", "path"))
              .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "key", "kind", "spread")
              .withColumn("part", F.spark_partition_id()))
    events = store(events, "url-sweep")
    bound = F.when(F.col("kind") == 0, F.struct("top"))
    # One row per range: the top that it hands on is that of its last bound, or else what it was handed.
    left = events.where("kind = 0").groupBy("part").agg(F.max_by(F.struct("top"), "key").alias("last"))
    handed = (events.select("part").distinct().join(left, "part", "left")
              .select("part", F.last("last", ignorenulls=True).over(
                  Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("handed")))
    sweep = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    found = (events.withColumn("own", F.last(bound, ignorenulls=True).over(sweep)).where("kind = 1")
             .join(handed, "part", "left").withColumn("top", F.coalesce("own", "handed")["top"]).where("top IS NOT NULL")
             .groupBy("host", "path").agg(F.max("top").alias("top")))
    found = store(found, "url-verdicts")
    return (pages.join(found.hint("merge"), ["host", "path"], "left")
            .select(*keep, "host", "path", F.col("top.rule").alias("rule"),
                    F.coalesce("top.verdict", F.lit(default)).alias("verdict")))

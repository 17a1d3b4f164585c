"""Resolving column names to standards: exact, case-insensitive, fuzzy, standard's own name.

Tables: `columns(dataset_id, col_pos, name)`, `variations(std_pos, standard, var_pos, variation)`.

The fuzzy step never compares every name with every variation. If two names of given lengths score at least `m`, they share
at least o characters, counted with repeats. With the counted characters of every name in one order, the rarest first, the two
then share two of them among their first length - o + 2 (a prefix filter with two matches, as in AdaptJoin, Wang et al. 2012).
So names meet in an equi-join over pairs of rare characters; pairs with too few characters in common are dropped inside
it, and only the rest is scored. Neither filter loses a pair that reaches the threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import defaults
from ..functions import similarity as sim
from ..functions import text
from ..functions.bind import bind
from ..functions.session import materialize


def _slack(min_score: int) -> int:
    """Per-mille of len a + len b that the distance may reach at a rounded score of `min_score`."""
    return 1005 - 10 * min_score


def _div(a: Column, b) -> Column:
    return F.floor(a / b).cast("int")


SHORT_PAIR = 80  # characters of two names together up to which they must share two counted characters, not one


def counted_characters(name: Column) -> Column:
    """ARRAY<STRING>: every character with how often it has occurred so far, so repeats differ. An empty name has one of its own."""
    def counted(chars: Column) -> Column:
        return F.transform(chars, lambda c, i: F.concat(c, F.size(F.filter(F.slice(chars, F.lit(1), i + 1), lambda x: x == c)).cast("string")))

    return F.when(name == "", F.array(F.lit(""))).otherwise(bind(F.regexp_extract_all(name, F.lit("(?s)."), F.lit(0)), counted))


def _rarest_first(names: DataFrame, name: str, often: DataFrame, *carry: str) -> DataFrame:
    """Rows (name, carry, chars): the counted characters in the order of (frequency, character)."""
    long = names.select(name, *carry, F.explode(counted_characters(F.col(name))).alias("char")).join(often, "char")
    return long.groupBy(name, *carry).agg(F.transform(F.sort_array(F.collect_list(F.struct("n", "char"))), lambda t: t["char"]).alias("chars"))


def _probes(ranked: DataFrame, name: str, own: str, other: str, min_score: int, *carry: str) -> DataFrame:
    """Rows (name, carry, own length, other length, key): what a name and one of the other length must have in common."""
    slack = _slack(min_score)
    size = F.length(name)
    lengths = F.sequence(F.ceil(size * (1000 - slack) / (1000 + slack)).cast("int"), _div(size * (1000 + slack), 1000 - slack))
    pairs = ranked.select(name, *carry, "chars", size.alias(own), F.explode(lengths).alias(other))
    total = F.col(own) + F.col(other)
    shared = F.ceil((total - _div(total * slack, 1000)) / 2).cast("int")
    pairs = pairs.withColumn("shared", shared).withColumn("two", (total <= SHORT_PAIR) & (F.col("shared") >= 2))
    first = F.slice("chars", F.lit(1), F.greatest(F.col(own) - F.col("shared") + F.when(F.col("two"), 2).otherwise(1), F.lit(0)))
    couples = F.flatten(F.transform("first", lambda x, i: F.transform(
        F.slice("first", i + 2, F.size("first")), lambda y: F.concat(x, F.lit("\x00"), y))))
    pairs = pairs.withColumn("first", first)
    return pairs.select(name, *carry, own, other, F.explode(F.when(F.col("two"), couples).otherwise(F.col("first"))).alias("key"))


def candidate_pairs(left: DataFrame, right: DataFrame, min_score: int) -> DataFrame:
    """Distinct pairs (a, b) of distinct names `a` and distinct names `b` that may reach the score."""
    left = left.select("a", sim.letter_bits(F.col("a")).alias("a_bits"))
    right = right.select("b", sim.letter_bits(F.col("b")).alias("b_bits"))
    every = left.select(F.col("a").alias("c")).unionByName(right.select(F.col("b").alias("c")))
    often = every.select(F.explode(counted_characters(F.col("c"))).alias("char")).groupBy("char").agg(F.count(F.lit(1)).alias("n"))
    probes = _probes(_rarest_first(left, "a", often, "a_bits"), "a", "la", "lb", min_score, "a_bits")
    parts = _probes(_rarest_first(right, "b", often, "b_bits"), "b", "lb", "la", min_score, "b_bits")
    # Unfolding multiplies the rows many times, which size estimates do not see: never broadcast.
    met = probes.join(parts.hint("merge"), ["la", "lb", "key"])
    met = met.where(sim.may_reach(min_score, F.col("a"), F.col("a_bits"), F.col("b"), F.col("b_bits"))).select("a", "b")
    # A pair is a few bytes but costs a scoring loop: a fixed number of partitions keeps the scoring
    # spread out, where merging partitions by size would put it into one task.
    spark = left.sparkSession
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return met.repartition(width, "a", "b").distinct()


def similar_pairs(left: DataFrame, right: DataFrame, min_score: int) -> DataFrame:
    """All pairs (a, b, score) with score >= `min_score`, for distinct names `a` and `b`."""
    masks = left.select("a", sim.char_masks(F.col("a")).alias("masks"))  # once per name, not per pair
    pairs = candidate_pairs(left, right, min_score).join(masks, "a")
    scored = pairs.select("a", "b", sim.similarity(F.col("a"), F.col("b"), F.col("masks")).alias("score"))
    return scored.where(F.col("score") >= min_score)


def nearest(names: DataFrame, targets: DataFrame, min_score: int) -> DataFrame:
    """Best similar target per name: lowest tier, then highest score, then smallest position.

    `names(a)` distinct; `targets(b, tier, std_pos, var_pos, standard)`. Returns
    (a, standard, std_pos, score, tier). The best per name is an aggregate with map-side combine, so
    no name's candidates have to meet in one sorted group.
    """
    first = targets.groupBy("b", "tier").agg(F.min_by(
        F.struct("std_pos", "standard", "var_pos"), F.struct("std_pos", "var_pos")).alias("t"))
    pairs = similar_pairs(names, targets.select("b").distinct(), min_score).join(first, "b")
    return pairs.groupBy("a").agg(F.max_by(
        F.struct("t.standard", "t.std_pos", "score", "tier"),
        F.struct(-F.col("tier"), "score", -F.col("t.std_pos"), -F.col("t.var_pos"))).alias("m")).select("a", "m.*")


def best_match(names: DataFrame, targets: DataFrame, min_score: int) -> DataFrame:
    """`nearest` over targets of one tier, with equal names settled by a hash join first."""
    equal = targets.groupBy(F.col("b").alias("a")).agg(F.min_by(
        F.struct("standard", "std_pos"), F.struct("std_pos", "var_pos")).alias("t"))
    same = names.join(equal, "a").select("a", "t.standard", "t.std_pos", F.lit(100).alias("score"))
    near = nearest(names.join(equal, "a", "left_anti"), targets.withColumn("tier", F.lit(0)), min_score)
    return same.unionByName(near.drop("tier"))


# ---- strategies on distinct original names ------------------------------------------------------

def match_exact(names: DataFrame, variations: DataFrame) -> DataFrame:
    """(name, standard, std_pos): names that occur in a variation list; the first standard wins."""
    v = variations.select(F.col("variation").alias("name"), "standard", "std_pos")
    return _first_standard(names.join(v, "name"))


def match_ignoring_case(names: DataFrame, variations: DataFrame) -> DataFrame:
    v = variations.select(F.lower("variation").alias("k"), "standard", "std_pos")
    return _first_standard(names.withColumn("k", text.lower_strip(F.col("name"))).join(v, "k"))


def _first_standard(hits: DataFrame) -> DataFrame:
    return hits.groupBy("name").agg(F.min_by("standard", "std_pos").alias("standard"),
                                    F.min("std_pos").alias("std_pos"))


def match_fuzzy(names: DataFrame, variations: DataFrame, min_score: int = defaults.RESOLVE_SCORE) -> DataFrame:
    """(name, standard, std_pos, score) by normalised similarity to any variation."""
    keyed = materialize(names.withColumn("a", text.normal_name(F.col("name"))))
    best = best_match(keyed.select("a").distinct(), _targets(variations, "variation"), min_score)
    return keyed.join(best, "a").select("name", "standard", "std_pos", "score")


def match_standard_name(names: DataFrame, variations: DataFrame,
                        min_score: int = defaults.RESOLVE_SCORE) -> DataFrame:
    """Like `match_fuzzy`, against the standards' own names."""
    return match_fuzzy(names, _own_names(variations), min_score)


def _own_names(variations: DataFrame) -> DataFrame:
    return variations.groupBy("std_pos", "standard").agg(
        F.lit(0).cast("bigint").alias("var_pos"), F.first("standard").alias("variation"))


def _targets(variations: DataFrame, column: str, tier: int = 0) -> DataFrame:
    return variations.select(text.normal_name(F.col(column)).alias("b"), F.lit(tier).alias("tier"),
                             "std_pos", "var_pos", "standard")


def _keys(table: DataFrame, name: str, ignoring_case: Column, *rest: str) -> DataFrame:
    """Three spellings per name, by rank: as it is, without regard to case, normalised."""
    spellings = F.array(F.col(name), ignoring_case, text.normal_name(F.col(name)))
    return table.select(*rest, F.posexplode(spellings).alias("rank", "key"))


def resolve_names(names: DataFrame, variations: DataFrame,
                  min_score: int = defaults.RESOLVE_SCORE) -> DataFrame:
    """(name, standard, std_pos, strategy, score) for every name that some strategy resolves.

    A name-list hit (exact or ignoring case) in the earliest standard wins; fuzzy is tried only for
    names without such a hit, and the standards' own names only after that. One hash join settles
    the exact, case-insensitive and equal-when-normalised names; the rest go to the fuzzy join.
    """
    names = materialize(names)  # headers only, used three times; their source may be a scan of everything
    left = _keys(names, "name", text.lower_strip(F.col("name")), "name")
    right = _keys(variations, "variation", F.lower("variation"), "std_pos", "var_pos", "standard")
    order = F.struct(F.col("rank") == 2, "std_pos", "rank", "var_pos")
    equal = left.join(right, ["rank", "key"]).groupBy("name").agg(
        F.min_by(F.struct("standard", "std_pos", "rank"), order).alias("m")).select("name", "m.*")
    listed = equal.select("name", "standard", "std_pos", F.element_at(
        F.lit(["exact", "case_insensitive", "fuzzy"]), F.col("rank") + 1).alias("strategy"), F.lit(100).alias("score"))

    keyed = names.join(listed.select("name"), "name", "left_anti").withColumn("a", text.normal_name(F.col("name")))
    # One fuzzy join serves both lists: any hit on a variation outranks a hit on a standard's name.
    targets = _targets(variations, "variation").unionByName(_targets(_own_names(variations), "standard", 1))
    near = keyed.join(nearest(keyed.select("a").distinct(), targets, min_score), "a")
    strategy = F.when(F.col("tier") == 0, F.lit("fuzzy")).otherwise(F.lit("standard_name"))
    return listed.unionByName(near.select("name", "standard", "std_pos", strategy.alias("strategy"), "score"))


def resolve_columns(columns: DataFrame, variations: DataFrame,
                    min_score: int = defaults.RESOLVE_SCORE) -> DataFrame:
    """The `mappings` table: one row per dataset column that resolves to a standard."""
    resolved = resolve_names(columns.select("name").distinct(), variations, min_score)
    return columns.join(resolved, "name").select(
        "dataset_id", "col_pos", F.col("name").alias("original"), "standard", "std_pos", "strategy", "score")


def mapping_log(mappings: DataFrame) -> DataFrame:
    """One row per dataset: its mapping original -> standard in column order."""
    return mappings.groupBy("dataset_id").agg(F.map_from_entries(F.transform(
        F.sort_array(F.collect_list(F.struct("col_pos", "original", "standard"))),
        lambda m: F.struct(m["original"], m["standard"]))).alias("transformations_applied"))

"""Dataset names from titles: slug, skip rules, collisions, pairing with data files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.session import materialize


def title_slugs(records: DataFrame, title: str = "title") -> DataFrame:
    """Adds `slug` and `status`: `ok`, `no title` or `invalid title`."""
    has_title = F.coalesce(F.col(title) != "", F.lit(False))
    slugged = records.withColumn("_slug", text.slug(F.col(title)))
    return slugged.withColumn("slug", F.when(F.col("_slug") != "", F.col("_slug"))).withColumn(
        "status", F.when(~has_title, F.lit("no title")).when(F.col("slug").isNull(), F.lit("invalid title"))
        .otherwise(F.lit("ok"))).drop("_slug")


def rank_in_group(df: DataFrame, group: str, order: str, rank: str = "rank") -> DataFrame:
    """Exact 1-based rank of `order` within `group`, without one task per group.

    Rows are range-partitioned by (group, order), so a hot group is spread over many partitions;
    ranks inside a partition are shifted by the rows of the same group in earlier partitions. The
    partition numbers are written to the shared folder first, as both uses must see the same ones.
    """
    spread = materialize(df.repartitionByRange(group, order).withColumn("_part", F.spark_partition_id()))
    chunks = spread.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = chunks.select(group, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part", group).orderBy(order))
    return (spread.withColumn("_inside", inside).join(offsets, [group, "_part"])
            .withColumn(rank, (F.col("_inside") + F.col("_before")).cast("bigint"))
            .drop("_part", "_inside", "_before"))


def _numbered(base: Column, k: Column) -> Column:
    return F.when(k == 0, base).otherwise(F.concat_ws("_", base, k.cast("string")))


def free_names(items: DataFrame, slug: str = "slug", order: str = "dataset_id",
               taken: DataFrame | None = None, name: str = "name") -> DataFrame:
    """Adds `name`: the slug, or the slug with the first free suffix `_1`, `_2`, …, in `order`.

    Equal slugs are numbered by rank. Only slugs that could meet a numbered one (`x` next to `x_1`)
    go through rounds in which the later claimant of a name, and all that follow it in its slug,
    move on by one; the result is that of serving all items one by one in order. `taken(name)` lists
    names that exist already.
    """
    ranked = rank_in_group(items, slug, order, "_rank")
    ranked = materialize(ranked.withColumn("_k", F.col("_rank") - 1))
    bases = ranked.select(F.col(slug).alias("base")).distinct()
    if taken is not None:
        bases = bases.unionByName(taken.select(F.col("name").alias("base"))).distinct()
    # `x` and `x_7` are relatives: only such slugs can clash.
    stem = F.regexp_extract("base", r"^(.+)_[0-9]+$", 1)
    parents = bases.withColumn("stem", stem).where("stem <> ''").join(
        bases.select(F.col("base").alias("stem")), "stem")
    related = parents.select(F.col("stem").alias(slug)).union(parents.select(F.col("base").alias(slug)))
    if taken is not None:
        related = related.union(taken.select(F.col("name").alias(slug)))
    related = materialize(related.distinct())
    calm = ranked.join(related, slug, "left_anti")
    tense = ranked.join(related, slug, "left_semi").select(slug, order, "_k", "_rank")
    tense = materialize(tense)
    while not tense.isEmpty():
        claims = tense.select(_numbered(F.col(slug), F.col("_k")).alias("claim"), slug, order, "_rank")
        contested = claims.groupBy("claim").agg(F.min(order).alias("winner"), F.count(F.lit(1)).alias("n"))
        losers = claims.join(contested.where("n > 1"), "claim").where(F.col(order) != F.col("winner"))
        if taken is not None:
            blocked = claims.join(taken.select(F.col("name").alias("claim")), "claim", "left_semi")
            losers = losers.select(slug, "_rank").unionByName(blocked.select(slug, "_rank"))
        move = losers.groupBy(slug).agg(F.min("_rank").alias("_from"))
        moved = materialize(tense.join(move, slug, "left").withColumn(
            "_k", F.col("_k") + F.when(F.col("_rank") >= F.col("_from"), 1).otherwise(0)))
        tense, settled = moved.drop("_from"), moved.where("_from IS NOT NULL").isEmpty()
        if settled:
            break
    final = calm.unionByName(ranked.drop("_k").join(tense.select(slug, order, "_k"), [slug, order])
                             .select(*calm.columns))
    return final.withColumn(name, _numbered(F.col(slug), F.col("_k"))).drop("_k", "_rank")


def stable_names(items: DataFrame, ledger: DataFrame | None = None, slug: str = "slug", order: str = "dataset_id") -> DataFrame:
    """Names that stay between runs: (`order`, slug, name, fate) of every item and of every dataset of the ledger.

    `ledger(order, slug, name)` is the outcome of the run before. An item whose slug is the ledger's keeps its name (`kept`).
    Other items are named in `order` by the first free suffix (`new`, or `renamed` if the ledger had another slug), where names
    kept in this run and names of datasets not in it (`absent`) are taken, and the old name of a renamed dataset is free.

    Slugs that no other slug or name can meet need no rounds: their j-th item gets the j-th number that is free.
    """
    items = materialize(items.select(order, slug))
    if ledger is None:
        return free_names(items, slug, order).select(order, slug, "name", F.lit("new").alias("fate"))
    old = ledger.select(F.col(order).alias("_order"), F.col(slug).alias("_slug"), F.col("name").alias("_name"))
    met = materialize(items.join(old, F.col(order) == F.col("_order"), "full"))
    same = F.col(slug) == F.col("_slug")
    kept = met.where(same).select(order, slug, F.col("_name").alias("name"), F.lit("kept").alias("fate"))
    absent = met.where(F.col(order).isNull()).select(F.col("_order").alias(order), F.col("_slug").alias(slug), F.col("_name").alias("name"), F.lit("absent").alias("fate"))
    stay = kept.unionByName(absent)
    open_ = met.where(F.col(order).isNotNull() & ~F.coalesce(same, F.lit(False))).select(
        order, slug, F.when(F.col("_order").isNull(), F.lit("new")).otherwise(F.lit("renamed")).alias("fate"))
    named = _first_free(open_.select(order, slug), stay.select("name"), slug, order)
    return stay.unionByName(open_.join(named, [order, slug]).select(order, slug, "name", "fate"))


def _first_free(items: DataFrame, taken: DataFrame, slug: str, order: str) -> DataFrame:
    """(order, slug, name): the first free suffix in order. Slugs with relatives go through `free_names`."""
    slugs = items.select(slug).distinct()
    # A taken name belongs to the slug that it is, or that it numbers: those are the two ways to meet it.
    number = F.regexp_extract("name", r"_([1-9][0-9]{0,17})$", 1)
    taken = taken.select("name", number.alias("_digits"))
    stem = F.expr("substring(name, 1, length(name) - length(_digits) - 1)")
    used = taken.select(F.col("name").alias(slug), F.lit(0).cast("bigint").alias("k")).unionByName(
        taken.where("_digits <> ''").select(stem.alias(slug), F.col("_digits").cast("bigint").alias("k"))).distinct()
    numbered = slugs.withColumn("stem", F.regexp_extract(slug, r"^(.+)_[0-9]+$", 1)).where("stem <> ''")
    parents = numbered.join(slugs.select(F.col(slug).alias("stem")), "stem")
    related = materialize(parents.select(slug).union(parents.select("stem")).distinct())
    calm = items.join(related, slug, "left_anti")
    used = materialize(used.join(calm.select(slug).distinct(), slug, "left_semi"))
    size = (calm.groupBy(slug).agg(F.count(F.lit(1)).alias("n"))
            .join(used.groupBy(slug).agg(F.count(F.lit(1)).alias("gone")), slug, "left"))
    numbers_ = size.select(slug, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") + F.coalesce("gone", F.lit(0)) - 1)).alias("k"))
    free = rank_in_group(numbers_.join(used, [slug, "k"], "left_anti"), slug, "k", "_rank")
    placed = rank_in_group(calm, slug, order, "_rank").join(free, [slug, "_rank"])
    out = placed.select(order, slug, _numbered(F.col(slug), F.col("k")).alias("name"))
    tense = items.join(related, slug, "left_semi")
    if tense.isEmpty():
        return out
    return out.unionByName(free_names(tense, slug, order, taken.select("name")).select(order, slug, "name"))


def pair_files(metadata: DataFrame, files: DataFrame) -> DataFrame:
    """Pair each metadata stem with `<base>.csv`, else `<base>_harmonized.csv`; unpaired ones skip.

    `metadata(stem)`, `files(file)`; the base is the stem without any `_metadata`.
    """
    based = metadata.withColumn("base", F.replace("stem", F.lit("_metadata"), F.lit("")))
    wanted = based.select("*", F.posexplode(F.array(
        F.concat("base", F.lit(".csv")), F.concat("base", F.lit("_harmonized.csv")))).alias("_try", "file"))
    hits = wanted.join(files.select("file").distinct(), "file", "left_semi").groupBy("stem").agg(
        F.min_by("file", "_try").alias("file"))
    return based.join(hits, "stem", "left").withColumn(
        "status", F.when(F.col("file").isNull(), F.lit("no data file")).otherwise(F.lit("ok")))

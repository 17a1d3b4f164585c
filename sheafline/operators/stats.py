"""Statistics of cleaned tables: size, years, places, completeness.

`table_stats` reads everything but the places from the cleaning profile, so a dataset is scanned
once. `profile_long` and the `*_by_dataset` forms do the same for any number of datasets at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import defaults
from ..functions import numbers
from ..functions.names import col
from .clean import TableProfile

# One statistics record as a DDL string.
STATS_SCHEMA = """
  row_count BIGINT, col_count BIGINT,
  temporal STRUCT<min_year: BIGINT, max_year: BIGINT, range_str: STRING>,
  spatial STRUCT<states: ARRAY<STRING>, districts: ARRAY<STRING>, granularity: STRING>,
  quality STRUCT<completeness_score: DOUBLE, missing_cells: BIGINT, total_rows: BIGINT>
"""


def spatial_columns(columns: list[str]) -> tuple[str | None, str | None]:
    """The (state, district) columns by name; the first that fits."""
    def first(test):
        return next((c for c in columns if test(c.lower())), None)

    return (first(lambda n: "state" in n and "name" in n) or first(lambda n: n == "state"),
            first(lambda n: "district" in n) or first(lambda n: n == "dist"))


def granularity(columns: list[str]) -> str:
    state, district = spatial_columns(columns)
    return "District" if district else "State" if state else "Unknown"


def range_text(low: Column, high: Column) -> Column:
    return (F.when(low.isNull(), F.lit("Unknown"))
            .when(low == high, low.cast("string"))
            .otherwise(F.concat_ws("-", low.cast("string"), high.cast("string"))))


def completeness_score(missing: Column, cells: Column) -> Column:
    return F.when(cells > 0, numbers.half_even(F.lit(1.0) - missing / cells)).otherwise(F.lit(0.0))


def temporal_range(df: DataFrame) -> DataFrame:
    """One row: smallest and largest believable year over all columns named like a year."""
    fields = [f for f in df.schema.fields if "year" in f.name.lower()]
    if not fields:
        low = high = F.lit(None).cast("bigint")
        one = df.sparkSession.range(1)
    else:
        cells = df.select(*[numbers.coerce_double(col(f.name), f.dataType).alias(f"y{i}")
                            for i, f in enumerate(fields)])
        believed = [F.when((F.col(c) > defaults.YEAR_ABOVE) & (F.col(c) < defaults.YEAR_BELOW), F.col(c))
                    for c in cells.columns]
        pad = [F.lit(None).cast("double")] * 2  # least/greatest need two arguments
        one = cells.agg(F.least(*[F.min(y) for y in believed], *pad).cast("bigint").alias("lo"),
                        F.greatest(*[F.max(y) for y in believed], *pad).cast("bigint").alias("hi"))
        low, high = F.col("lo"), F.col("hi")
    return one.select(low.alias("min_year"), high.alias("max_year"), range_text(low, high).alias("range_str"))


def top_locations(df: DataFrame, column: str, k: int = defaults.TOP_LOCATIONS) -> DataFrame:
    """The first `k` distinct place names in code-point order, totals and single letters left out.

    Unwanted names become NULL and sort last, rather than being filtered: a filter would move below
    the cleaning of the column and repeat it.
    """
    place = df.select(numbers.as_text(col(column), df.schema[column].dataType).alias("location"))
    wanted = F.when((F.lower("location") != "total") & (F.length("location") > 1), F.col("location"))
    return (place.select(wanted.alias("location")).distinct().orderBy(F.col("location").asc_nulls_last())
            .limit(k).where("location IS NOT NULL"))


def spatial_summary(df: DataFrame, k: int = defaults.TOP_LOCATIONS) -> DataFrame:
    """Rows (kind, rank, location) for the state and district columns."""
    out = None
    for kind, column in zip(("state", "district"), spatial_columns(df.columns)):
        if column is None:
            continue
        top = top_locations(df, column, k).agg(F.sort_array(F.collect_list("location")).alias("found"))
        ranked = top.select(F.lit(kind).alias("kind"), F.posexplode("found").alias("pos", "location")).select(
            "kind", (F.col("pos") + 1).cast("bigint").alias("rank"), "location")
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        return df.sparkSession.createDataFrame([], "kind string, rank bigint, location string")
    return out


def completeness(df: DataFrame, ids: tuple[str, ...] = ()) -> DataFrame:
    """One row: rows, cells, missing cells, completeness."""
    data = [c for c in df.columns if c not in ids]
    one = df.agg(F.count(F.lit(1)).alias("total_rows"),
                 *[F.count(col(c)).alias(f"c{i}") for i, c in enumerate(data)])
    counts = F.array(*[F.col(f"c{i}") for i in range(len(data))]).cast("array<bigint>")
    filled = F.aggregate(counts, F.lit(0).cast("bigint"), lambda n, c: n + c)
    cells = F.col("total_rows") * len(data)
    return one.select("total_rows", (cells - filled).alias("missing_cells"),
                      completeness_score(cells - filled, cells).alias("completeness_score"))


def table_facts(df: DataFrame, prof: TableProfile) -> tuple:
    """The facts of one cleaned table, as a row for `stats_table`.

    Only the place columns of `df` are read; everything else is in the profile.
    """
    wanted = [c for c in spatial_columns([c.name for c in prof.kept]) if c]
    # at most TOP_LOCATIONS values come back
    return profile_facts(prof, {c: [r.location for r in top_locations(df, c).collect()] for c in wanted})


def profile_facts(prof: TableProfile, places: dict[str, list[str]]) -> tuple:
    """The facts of one cleaned table from its profile and the first names of its place columns."""
    kept = prof.kept
    rows, cells = prof.rows, prof.rows * len(kept)
    missing = cells - sum(c.values for c in kept)
    lows = [c.years[0] for c in kept if c.years[0] is not None]
    highs = [c.years[1] for c in kept if c.years[1] is not None]
    low, high = (int(min(lows)), int(max(highs))) if lows else (None, None)
    names = [c.name for c in kept]
    states, districts = [places.get(c, []) if c else [] for c in spatial_columns(names)]
    return (rows, len(kept), low, high, states, districts, granularity(names), missing, cells)


def stats_table(spark: SparkSession, facts: dict[str, tuple]) -> DataFrame:
    """(dataset_id, columns of `STATS_SCHEMA`): one statistics record per dataset."""
    many = spark.createDataFrame([(name, *fact) for name, fact in facts.items()], """
        dataset_id STRING, row_count BIGINT, col_count BIGINT, lo BIGINT, hi BIGINT, states ARRAY<STRING>,
        districts ARRAY<STRING>, granularity STRING, missing BIGINT, cells BIGINT""")
    empty = F.col("cells") == 0
    return many.select(
        "dataset_id", "row_count", "col_count",
        F.struct(F.col("lo").alias("min_year"), F.col("hi").alias("max_year"),
                 range_text(F.col("lo"), F.col("hi")).alias("range_str")).alias("temporal"),
        F.struct("states", "districts", "granularity").alias("spatial"),
        F.struct(completeness_score(F.col("missing"), F.col("cells")).alias("completeness_score"),
                 F.when(~empty, F.col("missing")).alias("missing_cells"),
                 F.when(~empty, F.col("row_count")).alias("total_rows")).alias("quality"))


def table_stats(df: DataFrame, prof: TableProfile) -> DataFrame:
    """The statistics record of one cleaned table as a one-row DataFrame of `STATS_SCHEMA`."""
    return stats_table(df.sparkSession, {"": table_facts(df, prof)}).drop("dataset_id")


# ---- many datasets at once ----------------------------------------------------------------------

def to_long(df: DataFrame, ids: tuple[str, ...], columns: list[str] | None = None) -> DataFrame:
    """Cells of a wide table as rows: ids + (col_pos, column, value text)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    columns = [c for c in df.columns if c not in ids] if columns is None else columns
    cells = F.array(*[
        F.struct(F.lit(i).cast("bigint").alias("col_pos"), F.lit(c).alias("column"),
                 numbers.as_text(col(c), types[c]).alias("value")) for i, c in enumerate(columns)])
    return df.select(*[col(c) for c in ids], F.explode(cells).alias("cell")).select(
        *[col(c) for c in ids], "cell.*")


def profile_long(cells: DataFrame, dataset: str = "dataset_id") -> DataFrame:
    """Per dataset and column: cells, values, number-like values, integers, floats, year bounds.

    One hash aggregate with map-side combine: a dataset with a third of all cells sends only one
    partial row per task and column.
    """
    v = F.col("value")
    year = numbers.coerce_double(v, T.StringType())
    year = F.when(F.contains(F.lower("column"), F.lit("year")) & (year > defaults.YEAR_ABOVE)
                  & (year < defaults.YEAR_BELOW), year)
    return cells.groupBy(dataset, "column").agg(
        F.min("col_pos").alias("col_pos"),
        F.count(F.lit(1)).alias("n_cells"), F.count(v).alias("n_values"),
        F.count_if(numbers.looks_numeric(v)).alias("n_numeric"),
        F.count(numbers.extract_int(v)).alias("n_int"),
        F.count(numbers.extract_float(v)).alias("n_float"),
        F.min(year).cast("bigint").alias("min_year"), F.max(year).cast("bigint").alias("max_year"))


def stats_by_dataset(profiled: DataFrame, dataset: str = "dataset_id") -> DataFrame:
    """Roll a long profile up to one row per dataset (empty columns must be gone already)."""
    name = F.lower("column")
    has_state = F.bool_or((F.contains(name, F.lit("state")) & F.contains(name, F.lit("name"))) | (name == "state"))
    has_district = F.bool_or(F.contains(name, F.lit("district")) | (name == "dist"))
    rolled = profiled.groupBy(dataset).agg(
        F.max("n_cells").alias("row_count"), F.count(F.lit(1)).alias("col_count"),
        F.sum(F.col("n_cells") - F.col("n_values")).alias("missing_cells"),
        F.sum("n_cells").alias("cells"),
        F.min("min_year").alias("min_year"), F.max("max_year").alias("max_year"),
        has_district.alias("d"), has_state.alias("s"))
    return rolled.select(
        dataset, "row_count", "col_count", "min_year", "max_year",
        range_text(F.col("min_year"), F.col("max_year")).alias("range_str"),
        F.when(F.col("d"), F.lit("District")).when(F.col("s"), F.lit("State"))
        .otherwise(F.lit("Unknown")).alias("granularity"),
        "missing_cells",
        completeness_score(F.col("missing_cells"), F.col("cells")).alias("completeness_score"))


def locations_by_dataset(places: DataFrame, dataset: str = "dataset_id", value: str = "location",
                         k: int = defaults.TOP_LOCATIONS) -> DataFrame:
    """Top-`k` distinct places per dataset; each task keeps `k` per dataset before the shuffle."""
    wanted = places.where((F.lower(value) != "total") & (F.length(value) > 1)).select(dataset, value).distinct()
    rank = F.row_number().over(Window.partitionBy(dataset).orderBy(value))
    return wanted.withColumn("rank", rank.cast("bigint")).where(F.col("rank") <= k)

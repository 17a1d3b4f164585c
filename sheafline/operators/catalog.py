"""Metadata records and the catalog: facts first, then page context, then proposals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import defaults
from .unify import parse_proposals

# The proposed part of a metadata record as a DDL string.
PROPOSAL_TYPE = """
  catalog_info STRUCT<title: STRING, description: STRING, sector: STRING, keywords: ARRAY<STRING>,
                      language: STRING, update_frequency: STRING>,
  provenance STRUCT<source: STRING, publisher: STRING, jurisdiction: STRING, data_owner: STRING>,
  spatial_temporal STRUCT<temporal_coverage: STRING, spatial_coverage: STRING, granularity: STRING>,
  usage STRUCT<license: STRING, use_cases: ARRAY<STRING>, target_audience: ARRAY<STRING>>
"""


def technical_record(datasets: DataFrame, stats: DataFrame, mapping_log: DataFrame) -> DataFrame:
    """(dataset_id, technical_metadata) from the facts of each dataset.

    `datasets(dataset_id, row_count, columns)`; `stats(dataset_id, quality STRUCT)`;
    `mapping_log(dataset_id, transformations_applied)`.
    """
    facts = datasets.join(stats.select("dataset_id", "quality"), "dataset_id", "left").join(
        mapping_log, "dataset_id", "left")
    no_map = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return facts.select("dataset_id", F.struct(
        F.lit("CSV").alias("format"), F.col("dataset_id").alias("original_filename"), "row_count",
        F.size("columns").alias("column_count"), "columns",
        F.struct(F.lit(True).alias("standardized"), F.lit(True).alias("ai_ready"),
                 "quality.completeness_score", "quality.missing_cells", "quality.total_rows").alias("data_quality"),
        F.coalesce("transformations_applied", no_map).alias("transformations_applied"),
    ).alias("technical_metadata"))


def _known(fact: Column) -> Column:
    return F.nullif(fact, F.lit("Unknown"))


def precedence_merge(records: DataFrame) -> DataFrame:
    """Overrides proposals by facts.

    Needs columns `document` (`PROPOSAL_TYPE`, may be NULL), `ministry`, `range_str`, `granularity`.
    """
    d = F.col("document")
    ministry = F.nullif(F.col("ministry"), F.lit(""))
    provenance = F.struct(
        F.coalesce(ministry, d["provenance"]["source"]).alias("source"),
        F.when(ministry.isNotNull(), F.lit(defaults.PORTAL_PUBLISHER))
        .otherwise(d["provenance"]["publisher"]).alias("publisher"),
        d["provenance"]["jurisdiction"].alias("jurisdiction"),
        d["provenance"]["data_owner"].alias("data_owner"))
    where_when = F.struct(
        F.coalesce(_known(F.col("range_str")), d["spatial_temporal"]["temporal_coverage"]).alias("temporal_coverage"),
        d["spatial_temporal"]["spatial_coverage"].alias("spatial_coverage"),
        F.coalesce(_known(F.col("granularity")), d["spatial_temporal"]["granularity"]).alias("granularity"))
    kept = [c for c in records.columns if c not in ("document", "ministry", "range_str", "granularity")]
    return records.select(*kept, d["catalog_info"].alias("catalog_info"), provenance.alias("provenance"),
                          where_when.alias("spatial_temporal"), d["usage"].alias("usage"))


def fallback_record(dataset_id: Column, row_count: Column) -> Column:
    """The `catalog_info` of a dataset for which no proposal could be had."""
    nothing = F.lit(None)
    return F.struct(
        F.concat(F.lit("Government Dataset - "), dataset_id).alias("title"),
        F.concat(F.lit("Harmonized dataset with "), row_count.cast("string"), F.lit(" records.")).alias("description"),
        F.lit("Unknown").alias("sector"), nothing.cast("array<string>").alias("keywords"),
        nothing.cast("string").alias("language"), nothing.cast("string").alias("update_frequency"))


def page_context(datasets: DataFrame, scraped: DataFrame | None, fields: list[str]) -> DataFrame:
    """Adds the page record: by dataset when it has a `dataset_id`, else one record for all."""
    if scraped is None:
        return datasets.select("*", *[F.lit(None).cast("string").alias(f) for f in fields])
    if "dataset_id" in scraped.columns:
        return datasets.join(scraped.select("dataset_id", *fields), "dataset_id", "left")
    one = scraped.agg(F.first(F.struct(*fields))).scalar()
    return datasets.withColumn("_page", one).select(
        *[F.col(c) for c in datasets.columns], *[F.col("_page")[f].alias(f) for f in fields])


def catalog(datasets: DataFrame, stats: DataFrame, mapping_log: DataFrame,
            responses: DataFrame | None = None, scraped: DataFrame | None = None) -> DataFrame:
    """One metadata record per dataset.

    `responses(dataset_id, response)` are the texts of an external writer. No response, or JSON that
    is no object: the fallback record, without technical part. An unreadable response: facts only.
    """
    if responses is None:
        base = datasets.withColumn("response", F.lit(None).cast("string"))
    else:
        base = datasets.join(responses, "dataset_id", "left")
    parsed = parse_proposals(base, "response", PROPOSAL_TYPE).drop("parsed")
    facts = stats.select("dataset_id", F.col("temporal.range_str").alias("range_str"),
                         F.col("spatial.granularity").alias("granularity"))
    joined = page_context(parsed.join(facts, "dataset_id", "left"), scraped, ["ministry"])
    failed = F.col("response").isNull() | F.col("other")
    merged = precedence_merge(joined.withColumn("failed", failed).drop("other")).join(
        technical_record(datasets, stats, mapping_log), "dataset_id", "left")

    def unless_failed(name: str) -> Column:
        return F.when(~F.col("failed"), F.col(name)).alias(name)

    return merged.select(
        "dataset_id",
        F.when(F.col("failed"), fallback_record(F.col("dataset_id"), F.col("row_count")))
        .otherwise(F.col("catalog_info")).alias("catalog_info"),
        unless_failed("provenance"), unless_failed("spatial_temporal"), unless_failed("usage"),
        unless_failed("technical_metadata"))


def fact_sheet(datasets: DataFrame, stats: DataFrame, scraped: DataFrame | None = None) -> DataFrame:
    """(dataset_id, facts JSON): everything an external writer may rely on.

    `datasets(dataset_id, columns, sample)`; the first two sample rows are shown.
    """
    context = page_context(datasets, scraped, ["title", "description", "ministry", "sector"])
    known = context.join(stats, "dataset_id", "left")
    return known.select("dataset_id", F.to_json(F.struct(
        F.col("dataset_id").alias("original_filename"),
        F.struct("title", "description", "ministry", "sector").alias("official_context"),
        F.col("temporal.range_str").alias("temporal_range"),
        F.col("spatial.granularity").alias("granularity"),
        F.concat("spatial.districts", "spatial.states").alias("sample_locations"),
        "columns", F.slice("sample", 1, 2).alias("sample_rows"))).alias("facts"))

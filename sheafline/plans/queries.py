"""The registered queries: one per operator, each over whole tables.

Every query is a function (spark, sf_dir) -> DataFrame; outputs are flat columns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import similarity, text
from ..functions.session import materialize, new_path
from ..operators import catalog as cat
from ..operators import clean, conform, infer, match, merge, naming, pages, stats, unify
from ..operators.unify import UnifiedSchema
from ..sources import csv, ledger, sinks
from ..streaming.incremental import conform_stream
from . import inputs
from .harmonize import harmonize as run_harmonize
from .harmonize import harmonize_folder as run_folder

ROW = ("row_id",)


def _joined(c: str) -> Column:
    return F.concat_ws(",", c).alias(c)


# ---- reading and typing -----------------------------------------------------------------------

def read_csv_tolerant(spark: SparkSession, sf: str) -> DataFrame:
    """Writes orders as CSV with long, short, quoted and empty rows, then reads them back."""
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    line = (F.when(k % 10 == 0, F.concat_ws(",", k, c, c, F.lit("x"), F.lit("note"), F.lit("extra")))
            .when(k % 10 == 1, F.concat_ws(",", k, c))
            .when(k % 10 == 2, F.concat_ws(",", k, c, c, F.lit(""), F.lit('"a, ""b"""')))
            .when(k % 10 == 3, F.lit(",,,,"))
            .otherwise(F.concat_ws(",", k, c, c, F.lit("NA"), F.col("o_orderpriority"))))
    folder = new_path(spark, "csv")
    # One raw column and no quoting: the lines reach the files as they are, below a header line.
    (inputs.table(spark, sf, "orders").select(line.alias("Order ID,Cust,cust,,Note")).write
     .option("header", True).option("sep", "\x01").option("quote", "\x00").csv(folder))
    found = csv.open_folder(spark, folder)
    raw = reduce(DataFrame.unionByName, found.tables())
    typed = infer.infer_and_type(raw.drop(csv.DATASET))
    rows = clean.drop_null_rows(typed)
    return rows.select(F.col("`Order ID`").alias("order_id"), F.col("Cust").alias("cust"),
                       F.col("cust_1").alias("cust_again"), F.col("`Unnamed: 3`").alias("blank"),
                       F.col("Note").alias("note"))


def infer_types(spark: SparkSession, sf: str) -> DataFrame:
    orders = inputs.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("row_id"), F.col("o_totalprice").cast("string").alias("price"),
        F.expr("CASE WHEN o_orderkey % 2 = 0 THEN 'True' WHEN o_orderkey % 3 = 0 THEN 'NA' ELSE 'false' END").alias("flag"),
        F.lit("#N/A").alias("empty"))
    wide = inputs.messy_table(spark, sf).join(orders, "row_id").withColumn("row_id", F.col("row_id").cast("string"))
    return infer.infer_types(wide)


def file_profile(spark: SparkSession, sf: str) -> DataFrame:
    found = [
        csv.file_profile(inputs.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), "customer", "c_custkey",
                         columns=["c_custkey", "c_name", "c_mktsegment"]),
        csv.file_profile(inputs.table(spark, sf, "part").select("p_partkey", "p_name", "p_size"), "part", "p_partkey",
                         columns=["p_partkey", "p_name", "p_size"]),
        csv.file_profile(inputs.table(spark, sf, "supplier").select("s_suppkey", "s_name"), "supplier", "s_suppkey",
                         columns=["s_suppkey", "s_name"])]
    return reduce(DataFrame.unionByName, found).select(
        "dataset_id", "row_count", F.size("columns").cast("bigint").alias("n_columns"),
        F.concat_ws(",", "columns").alias("columns"),
        csv.sample_text(F.col("sample")).alias("sample"))


# ---- cleaning ----------------------------------------------------------------------------------

def _gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Dirty rows with every 19th row empty and a column without values."""
    m = inputs.messy_table(spark, sf)
    cells = [F.when(F.col("row_id") % 19 != 0, F.col(c)).alias(c) for c in m.columns if c != "row_id"]
    return m.select("row_id", *cells, F.lit(None).cast("string").alias("remarks"))


def drop_null_rows(spark: SparkSession, sf: str) -> DataFrame:
    return clean.drop_null_rows(_gaps(spark, sf), ROW)


def drop_null_columns(spark: SparkSession, sf: str) -> DataFrame:
    return clean.drop_null_columns(_gaps(spark, sf), ROW)


def clean_names(spark: SparkSession, sf: str) -> DataFrame:
    """Parts under untidy names, two of which are the same when tidied."""
    part = inputs.table(spark, sf, "part").select("p_partkey", "p_name", "p_size", "p_brand")
    return clean.clean_names(part.toDF("p_partkey ", " part\t name", "part size\n", "part   size"))


def clean_cells(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_cells(inputs.messy_table(spark, sf), ROW)


def clean_documents(spark: SparkSession, sf: str) -> DataFrame:
    cell = text.clean_cell(F.col("text"))
    return inputs.table(spark, sf, "documents").select(
        "doc_id", F.length(cell).cast("bigint").alias("n_clean"), F.md5(cell).alias("clean_md5"))


def null_flags(spark: SparkSession, sf: str) -> DataFrame:
    return clean.null_flags(clean.clean_cells(inputs.messy_table(spark, sf), ROW), ROW)


def numeric_likeness(spark: SparkSession, sf: str) -> DataFrame:
    return clean.numeric_likeness(inputs.messy_table(spark, sf), ROW)


def extract_numbers(spark: SparkSession, sf: str) -> DataFrame:
    cells = clean.null_flags(clean.clean_cells(inputs.messy_table(spark, sf).select("row_id", "amount_raw"), ROW), ROW)
    return cells.select("row_id", clean.extract_numbers(F.col("amount_raw")).alias("amount"))


def clean_table(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean(_gaps(spark, sf), ROW)


def clean_quality(spark: SparkSession, sf: str) -> DataFrame:
    cells = clean.null_flags(clean.clean_cells(inputs.messy_table(spark, sf), ROW), ROW)
    return stats.completeness(cells, ROW)


# ---- schema unification --------------------------------------------------------------------------

def column_union(spark: SparkSession, sf: str) -> DataFrame:
    return unify.column_union(inputs.headers(spark, sf))


def unmapped_names(spark: SparkSession, sf: str) -> DataFrame:
    return unify.unmapped_names(inputs.header_names(spark, sf), inputs.part_variations(spark, sf))


def coverage(spark: SparkSession, sf: str) -> DataFrame:
    return unify.coverage(inputs.header_names(spark, sf), inputs.part_variations(spark, sf))


def auto_assign(spark: SparkSession, sf: str) -> DataFrame:
    missing = unify.unmapped_names(inputs.header_names(spark, sf), inputs.part_variations(spark, sf))
    return unify.assign_unmapped(missing, inputs.part_standards(spark, sf)).select(
        "name", "standard", F.col("score").cast("bigint").alias("score"), "is_new")


def fallback_schema(spark: SparkSession, sf: str) -> DataFrame:
    return unify.fallback_schema(inputs.header_names(spark, sf))


def fallback_types(spark: SparkSession, sf: str) -> DataFrame:
    mapped = unify.effective_fallback(unify.fallback_schema(inputs.header_names(spark, sf)))
    return mapped.select("name", "standard", "type")


def parse_proposals(spark: SparkSession, sf: str) -> DataFrame:
    parsed = unify.parse_proposals(inputs.schema_responses(spark, sf))
    return parsed.select("c_custkey", "parsed", "document.domain",
                         F.size(F.map_keys("document.column_mappings")).cast("bigint").alias("n_standards"))


def schema_document(spark: SparkSession, sf: str) -> DataFrame:
    """Schema documents written as JSON, read back and exploded to their variations."""
    folder = new_path(spark, "schema")
    ready = unify.parse_proposals(inputs.schema_responses(spark, sf)).where("parsed")
    ready.select(F.to_json("document").alias("value")).write.text(folder)
    _, variations = unify.explode_schema(sinks.read_schema(spark, folder, lines=True))
    return variations.groupBy("std_pos", "standard", "var_pos", "variation").agg(F.count(F.lit(1)).alias("n_documents"))


# ---- matching --------------------------------------------------------------------------------------

def normalize_names(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.header_names(spark, sf).select("name", text.normal_name(F.col("name")).alias("normal"))


def normalize_documents(spark: SparkSession, sf: str) -> DataFrame:
    normal = text.normal_name(F.col("text"))
    return inputs.table(spark, sf, "documents").select(
        "doc_id", F.length(normal).cast("bigint").alias("n_normal"), F.md5(normal).alias("normal_md5"))


def similarity_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """Every header name against the name of each part that bears it."""
    line = inputs.table(spark, sf, "lineitem").select("l_partkey", "l_suppkey")
    part = inputs.table(spark, sf, "part").withColumnRenamed("p_partkey", "l_partkey")
    pairs = line.join(part, "l_partkey").select(F.expr(inputs.HEADER_NAME).alias("name"), "p_name").distinct()
    a, b = text.normal_name(F.col("name")), text.normal_name(F.col("p_name"))
    return pairs.select("name", "p_name", similarity.similarity(a, b).cast("bigint").alias("score"))


def resolve_exact(spark: SparkSession, sf: str) -> DataFrame:
    return match.match_exact(inputs.header_names(spark, sf), inputs.part_variations(spark, sf))


def resolve_ci(spark: SparkSession, sf: str) -> DataFrame:
    return match.match_ignoring_case(inputs.header_names(spark, sf), inputs.part_variations(spark, sf))


def resolve_fuzzy(spark: SparkSession, sf: str) -> DataFrame:
    found = match.match_fuzzy(inputs.header_names(spark, sf), inputs.part_variations(spark, sf))
    return found.withColumn("score", F.col("score").cast("bigint"))


def resolve_standard_name(spark: SparkSession, sf: str) -> DataFrame:
    found = match.match_standard_name(inputs.header_names(spark, sf), inputs.part_variations(spark, sf))
    return found.withColumn("score", F.col("score").cast("bigint"))


def resolve_columns(spark: SparkSession, sf: str) -> DataFrame:
    found = match.resolve_columns(inputs.headers(spark, sf), inputs.part_variations(spark, sf))
    return found.withColumn("score", F.col("score").cast("bigint"))


def mapping_log(spark: SparkSession, sf: str) -> DataFrame:
    mapped = match.mapping_log(match.resolve_columns(inputs.headers(spark, sf), inputs.part_variations(spark, sf)))
    shown = F.transform(F.map_entries("transformations_applied"), lambda e: F.concat(e["key"], F.lit("->"), e["value"]))
    return mapped.select("dataset_id", F.size("transformations_applied").cast("bigint").alias("n_mapped"),
                         F.array_join(F.array_sort(shown), ";").alias("log"))


def missing_required(spark: SparkSession, sf: str) -> DataFrame:
    headers = inputs.headers(spark, sf)
    mapped = match.resolve_columns(headers, inputs.part_variations(spark, sf))
    report = unify.missing_required(headers, mapped, ["red_ring", "old_bolt", "cold_gizmo"])
    return report.select("dataset_id", F.concat_ws(",", "missing_required").alias("missing_required"))


# ---- conforming --------------------------------------------------------------------------------------

MAPPING = {"priority_raw": "priority", "amount_raw": "amount", "census_year": "year", "district_raw": "district"}


def _typed(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned dirty rows next to a price with fractions and a flag."""
    orders = inputs.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("row_id"), F.col("o_totalprice").alias("price"),
        F.floor("o_totalprice").cast("double").alias("whole"), (F.col("o_orderstatus") == "F").alias("final"))
    return clean.clean(inputs.messy_table(spark, sf), ROW).join(orders, "row_id")


def rename_project(spark: SparkSession, sf: str) -> DataFrame:
    collide = {**MAPPING, "district_raw": "priority"}
    return conform.rename_project(inputs.messy_table(spark, sf), collide, ids=ROW)


def rename_coalesce(spark: SparkSession, sf: str) -> DataFrame:
    collide = {**MAPPING, "district_raw": "priority"}
    return conform.rename_project(inputs.messy_table(spark, sf), collide, "coalesce", ROW)


def cast_integer(spark: SparkSession, sf: str) -> DataFrame:
    df = _typed(spark, sf).select("row_id", "census_year", "amount_raw", "price", "whole", "final")
    done, _ = conform.cast_types(df, dict.fromkeys(df.columns[1:], "integer"))
    return done


def cast_float(spark: SparkSession, sf: str) -> DataFrame:
    df = _typed(spark, sf).select("row_id", "census_year", "amount_raw", "priority_raw", "price")
    done, _ = conform.cast_types(df, dict.fromkeys(df.columns[1:], "float"))
    return done


def cast_string(spark: SparkSession, sf: str) -> DataFrame:
    df = _typed(spark, sf).select("row_id", "census_year", "price", "whole", "final", "priority_raw")
    done, _ = conform.cast_types(df, dict.fromkeys(df.columns[1:], "string"), null_as_text="nan")
    return done


CONFORM_SCHEMA = UnifiedSchema(
    {"district": ["district_raw"], "year": ["Census_Year"], "amount": ["amountraw"], "priority": ["priority raw."]},
    {"district": "string", "year": "integer", "amount": "float", "priority": "string"})


def conform_table(spark: SparkSession, sf: str) -> DataFrame:
    raw = inputs.messy_table(spark, sf)
    prof = clean.profile(raw, ROW)
    cleaned = clean.apply_profile(raw, prof, ROW)
    mapping = conform.resolve_table(cleaned, CONFORM_SCHEMA, ROW)
    return conform.conform(cleaned, CONFORM_SCHEMA, mapping, ROW, failing=conform.failing_by_profile(prof, mapping)).df


def conform_stream_table(spark: SparkSession, sf: str) -> DataFrame:
    """The same result from a stream over the written rows, with profile and mapping known."""
    raw = inputs.messy_table(spark, sf)
    prof = clean.profile(raw, ROW)
    source, sink, state = (new_path(spark, label) for label in ("stream-in", "stream-out", "stream-state"))
    raw.write.parquet(source)
    stream = spark.readStream.schema(raw.schema).parquet(source)
    mapping = conform.resolve_table(clean.apply_profile(raw, prof, ROW), CONFORM_SCHEMA, ROW)
    out = conform_stream(stream, prof, CONFORM_SCHEMA, mapping, ROW)
    query = (out.writeStream.format("parquet").option("checkpointLocation", state)
             .trigger(availableNow=True).start(sink))
    query.awaitTermination()
    return spark.read.parquet(sink)


# ---- statistics ----------------------------------------------------------------------------------------

def temporal_range(spark: SparkSession, sf: str) -> DataFrame:
    return stats.temporal_range(clean.clean(inputs.messy_table(spark, sf), ROW))


def spatial_top5(spark: SparkSession, sf: str) -> DataFrame:
    cells = clean.null_flags(clean.clean_cells(inputs.messy_table(spark, sf), ROW), ROW)
    nation = inputs.table(spark, sf, "nation")
    supplier = inputs.table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("state_name"))
    return stats.spatial_summary(cells).unionByName(stats.spatial_summary(supplier))


def completeness(spark: SparkSession, sf: str) -> DataFrame:
    dirty = inputs.table(spark, sf, "events").select(
        F.when(F.col("event_id") % 9 != 0, F.col("user_id")).alias("user_id"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type"),
        F.when(F.col("value") > 5, F.col("value")).alias("value"))
    return stats.completeness(dirty)


def dataset_stats(spark: SparkSession, sf: str) -> DataFrame:
    """The full statistics record of the dirty table, from one profiling job."""
    raw = _gaps(spark, sf)
    prof = clean.profile(raw, ROW)
    record = stats.table_stats(clean.apply_profile(raw, prof, only=["district_raw"]), prof)
    return record.select(
        "row_count", "col_count", "temporal.min_year", "temporal.max_year", "temporal.range_str",
        F.concat_ws(",", "spatial.states").alias("states"), F.concat_ws(",", "spatial.districts").alias("districts"),
        "spatial.granularity", "quality.completeness_score", "quality.missing_cells", "quality.total_rows")


def _customer_cells(spark: SparkSession, sf: str) -> DataFrame:
    ids = ("dataset_id", "row_id")
    cells = clean.null_flags(clean.clean_cells(inputs.messy_by_customer(spark, sf), ids), ids)
    return stats.to_long(cells, ids)


def profile_long(spark: SparkSession, sf: str) -> DataFrame:
    return stats.profile_long(_customer_cells(spark, sf))


def _customer_stats(spark: SparkSession, sf: str) -> DataFrame:
    return stats.stats_by_dataset(stats.profile_long(_customer_cells(spark, sf)))


def stats_by_dataset(spark: SparkSession, sf: str) -> DataFrame:
    return _customer_stats(spark, sf)


def locations_by_dataset(spark: SparkSession, sf: str) -> DataFrame:
    cells = _customer_cells(spark, sf).where("column = 'district_raw'")
    region = inputs.table(spark, sf, "customer").select(
        F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("dataset_id"), F.col("c_name").alias("location"))
    places = cells.select("dataset_id", F.col("value").alias("location")).unionByName(region)
    return stats.locations_by_dataset(places)


# ---- metadata and catalog ----------------------------------------------------------------------------------

def _customer_datasets(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(datasets, stats, mapping log) of the per-customer datasets."""
    profiled = materialize(stats.profile_long(_customer_cells(spark, sf)))  # one row per column, used four times
    facts = stats.stats_by_dataset(profiled)
    columns = profiled.groupBy("dataset_id").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("col_pos", "column"))), lambda c: c["column"]).alias("columns"))
    datasets = facts.select("dataset_id", "row_count").join(columns, "dataset_id")
    records = facts.select(
        "dataset_id", F.struct("min_year", "max_year", "range_str").alias("temporal"),
        F.struct(F.array().cast("array<string>").alias("states"), F.array().cast("array<string>").alias("districts"),
                 "granularity").alias("spatial"),
        F.struct("completeness_score", "missing_cells", F.col("row_count").alias("total_rows")).alias("quality"))
    listed = profiled.select("dataset_id", "col_pos", F.col("column").alias("name"))
    mappings = match.resolve_columns(listed, CONFORM_SCHEMA.variations(spark))
    return datasets, records, match.mapping_log(mappings)


def _map_text(c: str) -> Column:
    entries = F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("->"), e["value"]))
    return F.array_join(F.array_sort(entries), ";")


def technical_record(spark: SparkSession, sf: str) -> DataFrame:
    t = cat.technical_record(*_customer_datasets(spark, sf)).select("dataset_id", "technical_metadata.*")
    return t.select("dataset_id", "format", "original_filename", "row_count", F.col("column_count").cast("bigint").alias("column_count"),
                    _joined("columns"), "data_quality.standardized", "data_quality.ai_ready",
                    "data_quality.completeness_score", "data_quality.missing_cells", "data_quality.total_rows",
                    _map_text("transformations_applied").alias("transformations"))


def precedence_merge(spark: SparkSession, sf: str) -> DataFrame:
    facts = _customer_stats(spark, sf).select("dataset_id", "range_str", "granularity")
    parsed = unify.parse_proposals(inputs.record_responses(spark, sf), "response", cat.PROPOSAL_TYPE)
    known = cat.page_context(facts.join(parsed.select("dataset_id", "document"), "dataset_id", "left"),
                             inputs.page_context(spark, sf), ["ministry"])
    return cat.precedence_merge(known).select(
        "dataset_id", "catalog_info.title", "provenance.source", "provenance.publisher",
        "spatial_temporal.temporal_coverage", "spatial_temporal.granularity")


def fallback_record(spark: SparkSession, sf: str) -> DataFrame:
    counted = inputs.messy_by_customer(spark, sf).groupBy("dataset_id").agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select("dataset_id", cat.fallback_record(F.col("dataset_id"), F.col("row_count")).alias("r")).select(
        "dataset_id", "r.title", "r.description", "r.sector")


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    records = cat.catalog(*_customer_datasets(spark, sf), inputs.record_responses(spark, sf), inputs.page_context(spark, sf))
    return records.select(
        "dataset_id", "catalog_info.title", "catalog_info.sector", "provenance.source", "provenance.publisher",
        "spatial_temporal.temporal_coverage", "spatial_temporal.granularity", "technical_metadata.row_count",
        "technical_metadata.data_quality.completeness_score")


def fact_sheet(spark: SparkSession, sf: str) -> DataFrame:
    datasets, records, _ = _customer_datasets(spark, sf)
    shown = F.to_json(F.struct("row_id", "priority_raw"))
    first = inputs.messy_by_customer(spark, sf).groupBy("dataset_id").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("row_id", shown.alias("shown")))), lambda r: r["shown"]).alias("sample"))
    number = F.regexp_extract("dataset_id", "[0-9]+", 0)
    placed = records.withColumn("spatial", F.struct(
        F.array(F.concat(F.lit("State of "), number)).alias("states"), F.array(F.concat(F.lit("District "), number)).alias("districts"),
        F.col("spatial.granularity").alias("granularity")))
    sheet = cat.fact_sheet(datasets.join(first, "dataset_id"), placed, inputs.page_context(spark, sf))

    def fact(path: str) -> Column:
        return F.get_json_object("facts", f"$.{path}")

    return sheet.select(
        "dataset_id", fact("original_filename").alias("original_filename"), fact("official_context.ministry").alias("ministry"),
        fact("official_context.title").alias("title"), fact("temporal_range").alias("temporal_range"),
        fact("granularity").alias("granularity"), fact("sample_rows[0]").alias("first_row"), fact("sample_rows[1]").alias("second_row"),
        fact("columns").alias("columns"), fact("sample_locations").alias("locations"))


def page_context(spark: SparkSession, sf: str) -> DataFrame:
    """Both forms of page records: one per dataset, and one for all."""
    nation, region = inputs.table(spark, sf, "nation"), inputs.table(spark, sf, "region")
    datasets = nation.select(F.col("n_name").alias("dataset_id"), "n_nationkey")
    per_dataset = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("dataset_id"), F.col("r_name").alias("ministry"), F.lit(None).cast("string").alias("title"))
    single = region.where("r_name = 'AFRICA'").select(F.col("r_name").alias("ministry"), F.lit("All of them").alias("title"))
    both = [cat.page_context(datasets, scraped, ["ministry", "title"]) for scraped in (per_dataset, single)]
    return both[0].unionByName(both[1]).select("n_nationkey", F.col("dataset_id").alias("n_name"), "ministry", "title")


# ---- consistency, union, sinks --------------------------------------------------------------------------------

def schema_consistency(spark: SparkSession, sf: str) -> DataFrame:
    listed = inputs.headers(spark, sf).groupBy("dataset_id").agg(F.transform(
        F.sort_array(F.collect_list(F.struct("col_pos", "name"))), lambda c: c["name"]).alias("columns"))
    return merge.schema_consistency(listed).select(
        "dataset_id", "consistent", F.size("lacks").cast("bigint").alias("n_lacks"), F.size("extra").cast("bigint").alias("n_extra"))


MERGE_SCHEMA = UnifiedSchema(
    {"customer_id": ["cust id", "CustomerKey"], "name": ["Customer Name"], "balance": ["Account Balance", "acctbal"]},
    {"customer_id": "integer", "name": "string", "balance": "float"})


def _parts(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Customers by market segment, each part with its own spelling and column order."""
    customer = inputs.table(spark, sf, "customer")
    key, name, balance = F.col("c_custkey"), F.col("c_name"), F.col("c_acctbal")
    spellings = {
        "AUTOMOBILE": [key.alias("Cust ID"), name.alias("customer name"), balance.alias("Acctbal")],
        "BUILDING": [balance.alias("Account_Balance"), key.alias("Cust_ID"), name.alias("CUSTOMER NAME")],
        "FURNITURE": [name.alias("Customer-Name"), key.cast("string").alias("CustomerKey"), balance.alias("acct bal")],
        "HOUSEHOLD": [key.alias("customer key"), balance.cast("string").alias("account balance"), name.alias("customername")],
        "MACHINERY": [key.alias("custid"), name.alias("Customer Names"), balance.alias("AcctBal.")]}
    return {s.lower() + ".csv": customer.where(F.col("c_mktsegment") == s).select(*cols) for s, cols in spellings.items()}


def _conformed_parts(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    parts = _parts(spark, sf)
    columns = spark.createDataFrame([(d, i, c) for d, df in parts.items() for i, c in enumerate(df.columns)],
                                    "dataset_id STRING, col_pos BIGINT, name STRING")
    found: dict[str, dict[str, str]] = {}
    for m in match.resolve_columns(columns, MERGE_SCHEMA.variations(spark)).collect():  # one row per column
        found.setdefault(m.dataset_id, {})[m.original] = m.standard
    return {d: conform.conform(df, MERGE_SCHEMA, found[d]).df for d, df in parts.items()}


def merge_union(spark: SparkSession, sf: str) -> DataFrame:
    return merge.merge_union(_conformed_parts(spark, sf))


def merge_total(spark: SparkSession, sf: str) -> DataFrame:
    return merge.merge_total(merge.merge_union(_conformed_parts(spark, sf)))


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    datasets = inputs.table(spark, sf, "supplier").select(
        F.when(F.col("s_acctbal") > 0, F.lit("ok")).otherwise(F.lit("skipped: not UTF-8")).alias("status"))
    return merge.run_summary(datasets)


def run_list(spark: SparkSession, sf: str) -> DataFrame:
    listed = inputs.headers(spark, sf).groupBy("dataset_id").agg(F.count(F.lit(1)).alias("n"))
    datasets = listed.withColumn("status", F.when(F.col("n") % 5 > 0, F.lit("ok")).otherwise(F.lit("skipped: no rows")))
    outputs = listed.select("dataset_id", F.concat(F.regexp_replace("dataset_id", r"\.csv$", ""), F.lit("_harmonized")).alias("harmonized"),
                            F.col("n").alias("columns"))
    return merge.runs(datasets, outputs)


def write_datasets(spark: SparkSession, sf: str) -> DataFrame:
    """Writes every part as its own dataset, half of them as CSV, and reads all of them back."""
    parts = _conformed_parts(spark, sf)
    folder = new_path(spark, "datasets")
    as_csv = {d: df for i, (d, df) in enumerate(parts.items()) if i % 2}
    rest = {d: df for d, df in parts.items() if d not in as_csv}
    sinks.write_datasets(rest, folder)
    sinks.write_datasets(as_csv, folder, fmt="csv")
    schema = next(iter(parts.values())).schema
    back = {d: spark.read.schema(schema).option("header", True).csv(f"{folder}/{d}") if d in as_csv
            else spark.read.parquet(f"{folder}/{d}") for d in parts}
    return merge.merge_union(back)


def write_sidecars(spark: SparkSession, sf: str) -> DataFrame:
    """One record file per dataset, all written by one job and read back by the manifest."""
    folder = new_path(spark, "sidecars")
    sinks.write_sidecars(cat.technical_record(*_customer_datasets(spark, sf)), folder)
    kind = "technical_metadata STRUCT<original_filename: STRING, row_count: BIGINT, column_count: BIGINT>"
    return sinks.read_sidecars(spark, folder).select("dataset_id", F.from_json("record", kind).alias("r")).select("dataset_id", "r.technical_metadata.*")


def write_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Two hundred datasets, each below its own folder, written by one job; all files read back."""
    folder = new_path(spark, "tables")
    rows = inputs.messy(spark, sf).withColumn("dataset_id", F.concat(F.lit("group_"), (F.col("o_custkey") % 200).cast("string"), F.lit(".csv"))).drop("o_custkey")
    manifest = sinks.write_tables(rows, folder, order="row_id")
    back = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").schema(
        "priority_raw STRING, amount_raw STRING, census_year STRING, district_raw STRING").parquet(*[f"{folder}/{r.dataset_id}" for r in manifest.select("dataset_id").distinct().collect()])
    listed = manifest.groupBy("dataset_id").agg(F.sum("row_count").alias("row_count"))
    found = back.groupBy(F.regexp_extract("_metadata.file_path", "(group_[0-9]+.csv)/", 1).alias("dataset_id")).agg(
        F.count("priority_raw").alias("n_priority"), F.count("district_raw").alias("n_district"), F.max("amount_raw").alias("amount"))
    return listed.join(found, "dataset_id")


def write_merged(spark: SparkSession, sf: str) -> DataFrame:
    """The merged table written and read back."""
    folder = new_path(spark, "merged")
    merged = merge.merge_union(_conformed_parts(spark, sf))
    sinks.write_merged(merged, folder)
    return spark.read.schema(merged.schema).parquet(folder)


def write_records(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_path(spark, "records")
    records = cat.technical_record(*_customer_datasets(spark, sf))
    sinks.write_records(records, folder)
    back = spark.read.schema("technical_metadata STRUCT<original_filename: STRING, row_count: BIGINT, column_count: BIGINT>").json(folder)
    return back.select("technical_metadata.*")


# ---- naming --------------------------------------------------------------------------------------------------

def title_slug(spark: SparkSession, sf: str) -> DataFrame:
    titles = inputs.table(spark, sf, "pages").select("page_id", pages.title(F.col("html")).alias("title"))
    noted = inputs.table(spark, sf, "documents").select(F.col("doc_id").alias("page_id"), F.col("text").alias("title"))
    return naming.title_slugs(titles.unionByName(noted)).select("page_id", "slug", "status")


def _titled_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Parts titled by name: few titles, many parts; some titles look like numbered names."""
    title = F.expr("CASE WHEN p_partkey % 37 = 5 THEN concat(p_name, ' ', CAST(p_partkey % 4 AS STRING)) ELSE p_name END")
    return inputs.table(spark, sf, "part").select(F.col("p_partkey").alias("dataset_id"), title.alias("title"))


def slug_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    named = naming.free_names(naming.title_slugs(_titled_parts(spark, sf)).where("status = 'ok'"))
    return named.select("dataset_id", "slug", "name")


def stable_names(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs with a ledger: the second has new parts, others renamed and some gone; all other names stay."""
    folder = new_path(spark, "ledger")
    part = inputs.table(spark, sf, "part").select(F.col("p_partkey").alias("k"), "p_name")
    dataset = F.format_string("part_%09d", "k").alias("dataset_id")
    first = naming.title_slugs(part.where("k % 2 = 0").select(dataset, F.col("p_name").alias("title")))
    ledger.write(naming.stable_names(first.where("status = 'ok'"), ledger.read(spark, folder)), folder)
    title = F.when(F.col("k") % 10 == 0, F.concat(F.lit("renamed "), "p_name")).otherwise(F.col("p_name"))
    second = naming.title_slugs(part.where("k % 14 <> 2").select(dataset, title.alias("title")))
    ledger.write(naming.stable_names(second.where("status = 'ok'"), ledger.read(spark, folder)), folder)
    return ledger.read(spark, folder)


def dataset_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The pages of files named as downloads are, of files named as links are, and of others."""
    portal = inputs.portal_pages(spark, sf)
    downloads = pages.page_resources(portal).where("link_no = 1").select(F.concat(F.lit("dl/"), "file_name").alias("dataset_id")).distinct()
    linked = portal.select(F.concat(F.lit("in/"), F.col("page_id").cast("string"), F.lit(".csv")).alias("dataset_id"))
    region = inputs.table(spark, sf, "region").where("r_regionkey < 3").select(
        F.element_at(F.array(F.lit("a.csv"), F.lit("B.csv"), F.lit("zzz.csv")), F.col("r_regionkey").cast("int") + 1).alias("dataset_id"))
    return pages.dataset_pages(downloads.unionByName(linked).unionByName(region), portal)


def pair_files(spark: SparkSession, sf: str) -> DataFrame:
    part = inputs.table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("k"), (F.col("p_partkey") % 5).alias("m"))
    metadata = part.select(F.concat(F.lit("part_"), "k", F.lit("_metadata")).alias("stem"))
    plain = part.where("m IN (0, 1)").select(F.concat(F.lit("part_"), "k", F.lit(".csv")).alias("file"))
    conformed = part.where("m IN (1, 2, 3)").select(F.concat(F.lit("part_"), "k", F.lit("_harmonized.csv")).alias("file"))
    return naming.pair_files(metadata, plain.unionByName(conformed))


# ---- pages ---------------------------------------------------------------------------------------------------

def page_title(spark: SparkSession, sf: str) -> DataFrame:
    shown = pages.title(F.col("html"))
    real = inputs.table(spark, sf, "pages").select("page_id", F.lit("plain").alias("kind"), shown.alias("title"))
    return real.unionByName(inputs.portal_pages(spark, sf).select("page_id", F.lit("portal").alias("kind"), shown.alias("title")))


def page_description(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.portal_pages(spark, sf).select("page_id", pages.description(F.col("html")).alias("description"))


def page_label(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.portal_pages(spark, sf).select(
        "page_id", pages.ministry(F.col("html")).alias("ministry"), pages.sector(F.col("html")).alias("sector"))


def page_links(spark: SparkSession, sf: str) -> DataFrame:
    """Links that mention `th` on the pages as they are, and `csv` links of the portal form."""
    real = pages.page_links(inputs.table(spark, sf, "pages"), "th", "https://site.example")
    return real.unionByName(pages.page_links(inputs.portal_pages(spark, sf)))


def page_resources(spark: SparkSession, sf: str) -> DataFrame:
    return pages.page_resources(inputs.portal_pages(spark, sf))


def page_metadata(spark: SparkSession, sf: str) -> DataFrame:
    return pages.page_metadata(inputs.portal_pages(spark, sf)).drop("scraped_timestamp")


# ---- end to end ------------------------------------------------------------------------------------------------

def harmonize(spark: SparkSession, sf: str) -> DataFrame:
    """Three raw tables through the whole run; one row per dataset."""
    done = run_harmonize(inputs.raw_tables(spark, sf), inputs.HARMONIZE_SCHEMA.to_json())
    facts = done.stats.select("dataset_id", "temporal.range_str", "spatial.granularity",
                              F.concat_ws(",", "spatial.states", "spatial.districts").alias("places"),
                              "quality.completeness_score", "quality.missing_cells")
    logged = match.mapping_log(done.mappings).select("dataset_id", _map_text("transformations_applied").alias("transformations"))
    return (done.datasets.select("dataset_id", "row_count", _joined("columns"), "status").join(facts, "dataset_id")
            .join(logged, "dataset_id"))


def harmonize_folder(spark: SparkSession, sf: str) -> DataFrame:
    """A folder of CSV files through the run, one status row per file: two files share their header and have line breaks
    inside quotes, one has a header only, one only empty rows, and all have the same base names."""
    customer, supplier = inputs.table(spark, sf, "customer"), inputs.table(spark, sf, "supplier")
    region = inputs.table(spark, sf, "region").where("r_regionkey = 0")
    row = F.format_string('%d,%s,"first line\nsecond, ""quoted"" line"', "c_custkey", "c_name")
    file = F.when(F.col("c_custkey") % 3 == 0, "north").when(F.col("c_custkey") % 3 == 1, "south")
    rows = customer.select(file.alias("file"), F.col("c_custkey").alias("pos"), row.alias("value")).where("file IS NOT NULL")
    rows = rows.unionByName(supplier.select(F.lit("suppliers").alias("file"), F.col("s_suppkey").alias("pos"),
                                            F.format_string("%d,%s", "s_suppkey", "s_name").alias("value")))
    rows = rows.unionByName(customer.select(F.lit("void").alias("file"), F.col("c_custkey").alias("pos"), F.lit(",,").alias("value")))
    heads = F.array(*[F.struct(F.lit(f).alias("file"), F.lit(-1).cast("bigint").alias("pos"), F.lit(h).alias("value")) for f, h in
                      (("north", "id,name,note"), ("south", "id,name,note"), ("suppliers", "id,name"), ("bare", "a,b"), ("void", "x,y,z"))])
    lines = rows.unionByName(region.select(F.inline(heads)))
    folder = new_path(spark, "uploads")
    lines.repartition("file").sortWithinPartitions("file", "pos").select("file", "value").write.partitionBy("file").text(folder)
    done = run_folder(spark, folder, pattern="*.txt", recursive=True)
    return done.datasets.select(F.regexp_extract("dataset_id", "file=([^/]*)/", 1).alias("file"), "row_count", "status",
                                F.when(F.col("columns").isNotNull(), _joined("columns")).alias("columns"))


def _segment_files(spark: SparkSession, sf: str, folder: str, regions: list[int]) -> None:
    """Customers of some nations as CSV files, one per nation and market segment; each segment has its own header."""
    customer = inputs.table(spark, sf, "customer").where(F.pmod("c_nationkey", F.lit(5)).isin(regions))
    key, name, balance = F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_acctbal").cast("string")
    layouts = {"AUTOMOBILE": ("Cust ID,customer name,Acctbal", [key, name, balance]), "BUILDING": ("Account_Balance,Cust_ID,CUSTOMER NAME", [balance, key, name]),
               "FURNITURE": ("Customer-Name,CustomerKey,acct bal", [name, key, balance]), "HOUSEHOLD": ("customer key,account balance,customername", [key, balance, name]),
               "MACHINERY": ("custid,Customer Names,AcctBal.", [key, name, balance])}
    line = reduce(lambda c, s: c.when(F.col("c_mktsegment") == s, F.concat_ws(",", *layouts[s][1])), layouts, F.when(F.lit(False), F.lit("")))
    head = reduce(lambda c, s: c.when(F.col("c_mktsegment") == s, F.lit(layouts[s][0])), layouts, F.when(F.lit(False), F.lit("")))
    where = [F.lower("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")]
    rows = customer.select(*where, F.col("c_custkey").alias("pos"), line.alias("value"))
    heads = customer.select(*where, F.lit(-1).cast("bigint").alias("pos"), head.alias("value")).distinct()
    (rows.unionByName(heads).repartition("segment", "nation").sortWithinPartitions("segment", "nation", "pos")
     .select("segment", "nation", "value").write.mode("append").partitionBy("segment", "nation").text(folder))


SEGMENT_SCHEMA = UnifiedSchema(
    {"customer_id": ["Cust ID", "Cust_ID", "CustomerKey", "customer key", "custid"],
     "name": ["customer name", "CUSTOMER NAME", "Customer-Name", "customername", "Customer Names"],
     "balance": ["Acctbal", "Account_Balance", "acct bal", "account balance", "AcctBal."]}, MERGE_SCHEMA.column_types)


def _segment(c: str) -> list[Column]:
    return [F.regexp_extract(c, "segment=([^/]*)/", 1).alias("segment"), F.regexp_extract(c, "nation=([^/]*)/", 1).cast("bigint").alias("nation")]


def merge_folder(spark: SparkSession, sf: str) -> DataFrame:
    """125 files with five headers, conformed and merged by one scan."""
    folder = new_path(spark, "segments")
    _segment_files(spark, sf, folder, [0, 1, 2, 3, 4])
    done = run_folder(spark, folder, pattern="*.txt", recursive=True, proposal=SEGMENT_SCHEMA.to_json())
    return done.merged().select("customer_id", "name", "balance", *_segment("dataset_id"))


def incremental_folder(spark: SparkSession, sf: str) -> DataFrame:
    """A run, more files, and a second run that profiles only those: the datasets of all files."""
    folder, state = new_path(spark, "segments"), new_path(spark, "state")
    options = {"pattern": "*.txt", "recursive": True, "proposal": SEGMENT_SCHEMA.to_json()}
    _segment_files(spark, sf, folder, [0, 1, 2])
    run_folder(spark, folder, state=state, **options)
    _segment_files(spark, sf, folder, [3, 4])
    done = run_folder(spark, folder, since=state, **options)
    facts = done.stats.select("dataset_id", "quality.completeness_score", "quality.missing_cells")
    return (done.datasets.join(facts, "dataset_id").select(*_segment("dataset_id"), "row_count", _joined("columns"), "status", "completeness_score", "missing_cells"))


def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """What a folder run keeps of dirty order files, and what it refuses, by reason."""
    k, price = F.col("o_orderkey"), F.col("o_totalprice").cast("string")
    line = (F.when(k % 10 == 0, F.concat_ws(",", k, price, F.lit("x"), F.lit("surplus"))).when(k % 10 == 1, F.lit(" ,-,NA"))
            .when(k % 10 == 2, F.concat_ws(",", k, F.concat(F.lit("about "), price), F.lit("x")))
            .when(k % 10 == 3, F.concat_ws(",", F.concat(F.lit("no. "), k), price, F.lit("x"), F.lit("")))
            .otherwise(F.concat_ws(",", k, price, F.col("o_orderpriority"))))
    folder = new_path(spark, "orders")
    (inputs.table(spark, sf, "orders").select(line.alias("Order ID,Total,Note")).write
     .option("header", True).option("sep", "\x01").option("quote", "\x00").csv(folder))
    schema = UnifiedSchema({"id": ["Order ID"], "total": ["Total"], "note": ["Note"]}, {"id": "integer", "total": "float", "note": "string"})
    kept, refused = run_folder(spark, folder, proposal=schema.to_json()).quarantine()
    counted = kept.agg(F.lit("kept").alias("reason"), F.lit(None).cast("string").alias("column"), F.count(F.lit(1)).alias("n"), F.round(F.sum("total"), 2).alias("total"))
    why = refused.groupBy("reason", "column").agg(F.count(F.lit(1)).alias("n"), F.lit(None).cast("double").alias("total"))
    return counted.unionByName(why.select("reason", "column", "n", "total"))


def harmonized_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The conformed rows of the dirty table from the same run."""
    done = run_harmonize(inputs.raw_tables(spark, sf), inputs.HARMONIZE_SCHEMA.to_json())
    return done.frames["orders.csv"]


QUERIES = {f.__name__: f for f in (
    clean_quality, read_csv_tolerant, infer_types, file_profile, drop_null_rows, drop_null_columns, clean_names,
    clean_cells, clean_documents, null_flags, numeric_likeness, extract_numbers, clean_table,
    column_union, unmapped_names, coverage, auto_assign, fallback_schema, fallback_types, parse_proposals, schema_document,
    normalize_names, normalize_documents, similarity_ratio, resolve_exact, resolve_ci, resolve_fuzzy,
    resolve_standard_name, resolve_columns, mapping_log, missing_required, rename_project, rename_coalesce,
    cast_integer, cast_float, cast_string, conform_table, conform_stream_table,
    temporal_range, spatial_top5, completeness, dataset_stats, profile_long, stats_by_dataset, locations_by_dataset,
    technical_record, precedence_merge, fallback_record, catalog, page_context, fact_sheet,
    schema_consistency, merge_union, merge_total, run_summary, run_list, write_datasets, write_sidecars, write_tables, write_records, write_merged,
    title_slug, slug_dedupe, stable_names, pair_files,
    page_title, page_description, page_label, page_links, page_resources, page_metadata, dataset_pages,
    harmonize, harmonize_folder, harmonized_orders, merge_folder, incremental_folder, quarantine)}

"""Dirty inputs derived from the test tables, one row of dirt per source row.

Expressions given as text read the same in Spark SQL and in the checking engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.unify import UnifiedSchema


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ---- dirty orders -------------------------------------------------------------------------------

PRIORITY = """CASE k % 7 WHEN 0 THEN concat('  ', p, '   ') WHEN 1 THEN 'N/A' WHEN 2 THEN '-'
    WHEN 3 THEN replace(p, '-', '  -  ') WHEN 4 THEN NULL ELSE p END"""
AMOUNT = """CASE k % 11 WHEN 0 THEN 'Missing' WHEN 1 THEN 'unknown' WHEN 2 THEN concat('$', n)
    WHEN 3 THEN concat('₹ ', n) ELSE n END"""
YEAR = "CASE k % 13 WHEN 0 THEN 'n/a' WHEN 1 THEN '0' WHEN 2 THEN '3000' ELSE CAST(year(d) AS STRING) END"
DISTRICT = """CASE k % 17 WHEN 0 THEN 'Total' WHEN 1 THEN 'x' WHEN 2 THEN NULL
    ELSE concat('District ', CAST(c AS STRING)) END"""


def messy(spark: SparkSession, sf: str) -> DataFrame:
    """One dirty row per order: row_id and four text columns, plus the clean keys for grouping."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("p"), F.col("o_orderdate").alias("d"),
        F.format_number(F.floor("o_totalprice"), 0).alias("n"), "o_custkey")
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("c"))
    return orders.join(customer, "o_custkey").select(
        F.col("k").alias("row_id"), F.expr(PRIORITY).alias("priority_raw"), F.expr(AMOUNT).alias("amount_raw"),
        F.expr(YEAR).alias("census_year"), F.expr(DISTRICT).alias("district_raw"), "o_custkey")


def messy_table(spark: SparkSession, sf: str) -> DataFrame:
    return messy(spark, sf).drop("o_custkey")


def messy_by_customer(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows as many datasets, one per customer."""
    return messy(spark, sf).select(
        F.concat(F.lit("customer_"), F.col("o_custkey").cast("string"), F.lit(".csv")).alias("dataset_id"),
        "row_id", "priority_raw", "amount_raw", "census_year", "district_raw")


# ---- headers: the column names of one dataset per supplier ---------------------------------------

HEADER_NAME = """CASE (l_partkey + l_suppkey) % 8
    WHEN 0 THEN p_name
    WHEN 1 THEN replace(p_name, ' ', '_')
    WHEN 2 THEN upper(p_name)
    WHEN 3 THEN concat(upper(substr(p_name, 1, 1)), substr(replace(p_name, ' ', ''), 2))
    WHEN 4 THEN concat(substr(p_name, 1, 2), substr(p_name, 4))
    WHEN 5 THEN concat(p_name, ' ', CAST(p_size % 10 AS STRING))
    WHEN 6 THEN concat(replace(p_name, ' ', '-'), '!')
    ELSE CASE p_size % 8
        WHEN 0 THEN concat('Dist ', p_name)
        WHEN 1 THEN concat('State_', p_name)
        WHEN 2 THEN concat(p_name, ' cattle')
        WHEN 3 THEN concat('census_year_', p_name)
        WHEN 4 THEN concat('total ', p_name)
        ELSE concat(lower(p_type), '_', replace(p_brand, '#', ''))
    END END"""


def headers(spark: SparkSession, sf: str) -> DataFrame:
    """`columns(dataset_id, col_pos, name)`: the names a supplier's parts go by, in order of first use."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_size", "p_type", "p_brand")
    named = lines.join(part, "l_partkey").select(
        "l_suppkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("at"), F.expr(HEADER_NAME).alias("name"))
    return named.groupBy("l_suppkey", "name").agg(F.min("at").alias("col_pos")).select(
        F.concat(F.lit("supplier_"), F.col("l_suppkey").cast("string"), F.lit(".csv")).alias("dataset_id"),
        "col_pos", "name")


def header_names(spark: SparkSession, sf: str) -> DataFrame:
    return headers(spark, sf).select("name").distinct()


def part_standards(spark: SparkSession, sf: str) -> DataFrame:
    """`standards`: one per part name, placed by its first part."""
    return table(spark, sf, "part").groupBy("p_name").agg(
        F.min("p_partkey").alias("std_pos"), F.min("p_size").alias("size")).select(
        "std_pos", F.replace("p_name", F.lit(" "), F.lit("_")).alias("standard"),
        F.expr("CASE size % 3 WHEN 0 THEN 'integer' WHEN 1 THEN 'float' ELSE 'string' END").alias("type"))


def part_variations(spark: SparkSession, sf: str) -> DataFrame:
    """`variations`: the part name itself, and its words joined by a hyphen."""
    names = table(spark, sf, "part").groupBy("p_name").agg(F.min("p_partkey").alias("std_pos"))
    spelled = F.array(F.col("p_name"), F.replace("p_name", F.lit(" "), F.lit("-")))
    return names.select("std_pos", F.replace("p_name", F.lit(" "), F.lit("_")).alias("standard"),
                        F.posexplode(spelled).alias("var_pos", "variation")).withColumn(
        "var_pos", F.col("var_pos").cast("bigint"))


# ---- responses of an external writer, one per customer -------------------------------------------

SCHEMA_BODY = """concat('{"domain": "', lower(c_mktsegment), '", "column_mappings": {"customer_id": ["c',
    CAST(c_custkey % 10 AS STRING), '", "Cust ID"], "balance": ["bal"]}, "column_types": {"customer_id": "integer"}}')"""
RECORD_BODY = """concat('{"catalog_info": {"title": "Orders of ', c_name, '", "sector": "', c_mktsegment,
    '"}, "provenance": {"source": "proposed", "publisher": "someone"}, "spatial_temporal": ',
    '{"temporal_coverage": "guess", "granularity": "Block"}}')"""
FENCED = """CASE c_custkey % 6
    WHEN 0 THEN body
    WHEN 1 THEN concat('Here it is: ```json ', body, ' ``` Done.')
    WHEN 2 THEN concat('``` ', body, ' ```')
    WHEN 3 THEN concat('Sorry, no: ', c_name)
    WHEN 4 THEN concat('[', body, ']')
    ELSE NULL END"""


def schema_responses(spark: SparkSession, sf: str) -> DataFrame:
    return _responses(spark, sf, SCHEMA_BODY).select("c_custkey", "response")


def record_responses(spark: SparkSession, sf: str) -> DataFrame:
    """(dataset_id, response) for the datasets of `messy_by_customer`."""
    return _responses(spark, sf, RECORD_BODY).select(
        F.concat(F.lit("customer_"), F.col("c_custkey").cast("string"), F.lit(".csv")).alias("dataset_id"), "response")


def _responses(spark: SparkSession, sf: str, body: str) -> DataFrame:
    return table(spark, sf, "customer").withColumn("body", F.expr(body)).withColumn("response", F.expr(FENCED))


def page_context(spark: SparkSession, sf: str) -> DataFrame:
    """(dataset_id, title, description, ministry, sector) known from pages for every third customer."""
    customer = table(spark, sf, "customer").where("c_custkey % 3 = 0").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return customer.join(nation, "c_nationkey").select(
        F.concat(F.lit("customer_"), F.col("c_custkey").cast("string"), F.lit(".csv")).alias("dataset_id"),
        F.concat(F.lit("Orders from "), F.col("n_name")).alias("title"), F.lit("").alias("description"),
        F.when(F.col("c_nationkey") > 0, F.concat(F.lit("Ministry of "), F.col("n_name"))).otherwise(F.lit("")).alias("ministry"),
        F.col("c_mktsegment").alias("sector"))


# ---- portal pages: the given pages with portal markup in front of their text -----------------------

PORTAL_BLOCK = """concat(
    '<!-- <h1 id="title">Old</h1><a href="/old.csv">old csv</a><div class="notes">Old</div> -->',
    CASE page_id % 6
        WHEN 0 THEN concat('<h1 class="page" id="title"> Data &amp; Facts <b>', id, '</b></h1>')
        WHEN 1 THEN concat('<h1 class="big node-title">Node ', id, '</h1>')
        WHEN 2 THEN concat('<h1 class="title">Plain ', id, '</h1>')
        WHEN 3 THEN concat('<meta property="og:title" content="Graph &quot;', id, '&quot; ">')
        ELSE '' END,
    CASE page_id % 5
        WHEN 0 THEN concat('<div class="field-name-body"><div class="label">Body:</div><div class="items">of <i>', id, '</i> all</div> end</div>')
        WHEN 1 THEN concat('<div class="x notes">Notes ', id, '</div>')
        WHEN 2 THEN concat('<meta property="og:description" content="About ', id, '">')
        WHEN 3 THEN concat('<meta name="description" content="Meta ', id, '">')
        ELSE '' END,
    CASE page_id % 7
        WHEN 0 THEN concat('<div class="og-group-ref"> <div>Org</div> ', id, ' </div>')
        WHEN 1 THEN concat('<table><tr><th>Ministry/Department</th> <td>Health ', id, '</td></tr></table>')
        WHEN 2 THEN concat('<div><label>Department:</label> <span>Roads ', id, '</span></div>')
        WHEN 3 THEN concat('<li><span>Source:</span> Survey ', id, '</li>')
        ELSE '' END,
    CASE page_id % 4
        WHEN 0 THEN concat('<table><tr><th>Sector</th><td>Farm ', id, '</td></tr></table>')
        WHEN 1 THEN concat('<div><span>', repeat('<i>', 30), 'Category', repeat('</i>', 30), '</span><b>Cat <b>', id, '</b></b></div>')
        ELSE '' END,
    CASE page_id % 3
        WHEN 0 THEN concat('<a class="r" href="/files/', id, '.CSV">get</a><a href="/files/', id, '.CSV">again</a>',
                           '<a href="http://x.example/', id, '">as csv</a><a href="//cdn.example/a.csv?x=1&amp;y=2">cdn</a>',
                           '<a href="data/', id, '/b.csv">b</a><a href="/none">none</a>')
        WHEN 1 THEN concat('<a href="/one/', id, '.csv">one</a>')
        ELSE '' END)"""


def portal_pages(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").withColumn("id", F.col("page_id").cast("string"))
    return pages.select("page_id", "url", F.expr(f"replace(html, '<article>', concat('<article>', {PORTAL_BLOCK}))").alias("html"))


# ---- four raw tables for the end-to-end run --------------------------------------------------------

def raw_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("Cust_ID"), F.concat(F.lit(" "), F.col("c_name"), F.lit("  ")).alias("cust name"),
        F.when(F.col("c_custkey") % 9 == 0, F.lit("-")).otherwise(F.concat(F.lit("$"), F.format_number("c_acctbal", 2))).alias("Balance"),
        F.lit(None).cast("string").alias("Remarks"))
    supplier = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("supplierid"), F.col("s_name").alias("Supplier  Name"),
        F.col("s_acctbal").alias("BALANCE"),
        F.when(F.col("s_suppkey") % 4 == 0, F.lit("Total")).otherwise(F.concat(F.lit("State "), F.col("s_nationkey").cast("string"))).alias("state"))
    return {"customers.csv": customer, "orders.csv": messy_table(spark, sf), "suppliers.csv": supplier}


HARMONIZE_SCHEMA = UnifiedSchema(
    {"id": ["row_id", "supplier id"], "name": ["cust name", "supplier name"], "district": ["district_raw"],
     "state": ["state"], "year": ["census_year"], "amount": ["amount_raw", "balance"]},
    {"id": "integer", "name": "string", "district": "string", "state": "string", "year": "integer", "amount": "float"},
    domain="orders")

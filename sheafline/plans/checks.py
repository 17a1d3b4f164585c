"""Plain SQL for the registered queries, written for DuckDB over the same tables.

The SQL states each result independently: brute-force loops over pairs, correlated positions and
recursive steps where the Spark side uses filters, aggregates and joins.
"""

from __future__ import annotations

from . import inputs

# ---- shared pieces --------------------------------------------------------------------------------

SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER = r"^[+-]?[0-9]+$"


def quoted(items) -> str:
    return ", ".join("'" + i.replace("'", "''") + "'" for i in items)


# Fixed values, as in the parameter tables.
NULL_FLAGS = quoted(["NA", "na", "N/A", "n/a", "-", "Null", "NULL", "null", ".", "None", "none", "", " ", "  ",
                     "NaN", "nan", "#N/A", "#NA", "Missing", "missing"])
READ_NULLS = quoted(["", "NA", "N/A", "n/a", "null", "NULL", "nan", "NaN", "None", "#N/A", "#NA", "<NA>", "-NaN",
                     "-nan", "1.#IND", "1.#QNAN", "-1.#IND", "-1.#QNAN", "#N/A N/A"])
CELLS = ["priority_raw", "amount_raw", "census_year", "district_raw"]


def sql_text(expr: str) -> str:
    return expr.replace("AS STRING", "AS VARCHAR")


def squeeze(c: str) -> str:
    return f"trim(regexp_replace({c}, '{SPACE}+', ' ', 'g'))"


def clean_cell(c: str) -> str:
    return f"nullif({squeeze(c)}, '')"


def flagged(c: str) -> str:
    return f"CASE WHEN {clean_cell(c)} IN ({NULL_FLAGS}) THEN NULL ELSE {clean_cell(c)} END"


def looks_numeric(c: str) -> str:
    return f"regexp_matches(trim(translate({c}, ',$₹', '')), '{NUMBER}')"


def bare(c: str) -> str:
    return f"translate({c}, ',$₹ ', '')"


def as_int(c: str) -> str:
    return f"CASE WHEN regexp_matches({bare(c)}, '{INTEGER}') THEN try_cast({bare(c)} AS BIGINT) END"


def as_double(c: str) -> str:
    return f"CASE WHEN regexp_matches(trim({c}), '{NUMBER}') THEN try_cast(trim({c}) AS DOUBLE) END"


def score(missing: str, cells: str) -> str:
    return f"round_even((1 - ({missing}) / ({cells})::DOUBLE) * 100, 0) / 100"


def normal(c: str) -> str:
    stripped = f"regexp_replace(lower({c}), '^{SPACE}+|{SPACE}+$', '', 'g')"
    keep = SPACE[1:-1]
    return f"regexp_replace({stripped}, '[^\\p{{L}}\\p{{N}}_{keep}]|[ _]', '', 'g')"


def squeezed(c: str) -> str:
    return f"replace(replace(lower({c}), '_', ''), ' ', '')"


def similarity(a: str, b: str) -> str:
    """Row-by-row longest common subsequence, as a ratio."""
    lcs = (f"list_reduce(range(1, length({a}) + 1), lambda prev, i: list_reduce(range(1, length({b}) + 1), "
           f"lambda cur, j: list_append(cur, CASE WHEN substr({b}, j, 1) = substr({a}, i, 1) THEN prev[j] + 1 "
           f"ELSE greatest(prev[j + 1], cur[j]) END), [0::BIGINT]), "
           f"list_resize([0::BIGINT], length({b}) + 1, 0::BIGINT))[-1]")
    total = f"(length({a}) + length({b}))"
    return (f"CASE WHEN {a} = {b} THEN 100 WHEN length({a}) = 0 OR length({b}) = 0 THEN 0 "
            f"ELSE round_even(100.0 * (1.0 - ({total} - 2 * {lcs})::DOUBLE / {total}), 0)::BIGINT END")


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ", ".join(ctes) + " "


MESSY = f"""messy AS (
  SELECT k AS row_id, {sql_text(inputs.PRIORITY)} AS priority_raw, {sql_text(inputs.AMOUNT)} AS amount_raw,
         {sql_text(inputs.YEAR)} AS census_year, {sql_text(inputs.DISTRICT)} AS district_raw, o_custkey
  FROM (SELECT o_orderkey AS k, o_orderpriority AS p, o_orderdate AS d, o_custkey, c_nationkey AS c,
               format('{{:,}}', CAST(floor(o_totalprice) AS BIGINT)) AS n
        FROM orders JOIN customer ON o_custkey = c_custkey))"""
CLEANED = "cleaned AS (SELECT row_id, o_custkey, " + ", ".join(f"{flagged(c)} AS {c}" for c in CELLS) + " FROM messy)"
GAPS = ("gaps AS (SELECT row_id, " + ", ".join(f"CASE WHEN row_id % 19 <> 0 THEN {c} END AS {c}" for c in CELLS)
        + " FROM messy)")
CLEAN_GAPS = ("clean_gaps AS (SELECT * FROM (SELECT row_id, " + ", ".join(f"{flagged(c)} AS {c}" for c in CELLS)
              + " FROM gaps) WHERE coalesce(" + ", ".join(CELLS) + ") IS NOT NULL)")
# In the dirty table every year cell converts and some amounts do not.
AMOUNT_TEXT = f"coalesce(CAST({as_int('amount_raw')} AS VARCHAR), amount_raw)"
YEAR_NUMBER = as_int("census_year")
FINAL = f"""final AS (SELECT row_id, o_custkey, priority_raw, {AMOUNT_TEXT} AS amount_raw, {YEAR_NUMBER} AS census_year,
  district_raw FROM cleaned WHERE coalesce({', '.join(CELLS)}) IS NOT NULL)"""

HEADERS = f"""headers AS (
  SELECT 'supplier_' || l_suppkey || '.csv' AS dataset_id, min(l_orderkey * 10 + l_linenumber) AS col_pos, name
  FROM (SELECT l_suppkey, l_orderkey, l_linenumber, {sql_text(inputs.HEADER_NAME)} AS name
        FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY l_suppkey, name)"""
NAMES = "names AS (SELECT DISTINCT name FROM headers)"
STANDARDS = """standards AS (SELECT min(p_partkey) AS std_pos, replace(p_name, ' ', '_') AS standard FROM part GROUP BY p_name)"""
VARIATIONS = """variations AS (
  SELECT std_pos, standard, var_pos, variation FROM (
    SELECT min(p_partkey) AS std_pos, replace(p_name, ' ', '_') AS standard, 0 AS var_pos, p_name AS variation FROM part GROUP BY p_name
    UNION ALL
    SELECT min(p_partkey), replace(p_name, ' ', '_'), 1, replace(p_name, ' ', '-') FROM part GROUP BY p_name))"""
EXACT = """exact AS (SELECT name, min(std_pos) AS std_pos, min_by(standard, std_pos) AS standard
  FROM names JOIN variations ON name = variation GROUP BY name)"""
CI = """ci AS (SELECT name, min(std_pos) AS std_pos, min_by(standard, std_pos) AS standard
  FROM names JOIN variations ON lower(trim(name)) = lower(variation) GROUP BY name)"""
LISTED = """listed AS (SELECT name, std_pos, standard,
    CASE WHEN hit = 0 THEN 'exact' ELSE 'case_insensitive' END AS strategy FROM (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY std_pos, hit) AS r FROM (
    SELECT name, std_pos, standard, 0 AS hit FROM exact UNION ALL SELECT name, std_pos, standard, 1 FROM ci)) WHERE r = 1)"""
NAME_FORMS = f"name_forms AS (SELECT name, {normal('name')} AS a FROM names)"


def scored(name: str, targets: str, label: str) -> str:
    """All pairs of distinct forms, scored; best target per form at 85 or more."""
    return f"""{label}_targets AS (SELECT std_pos, standard, var_pos, {normal(targets)} AS b FROM variations),
  {label}_pairs AS (SELECT a, b, {similarity('a', 'b')} AS score
    FROM (SELECT DISTINCT a FROM name_forms), (SELECT DISTINCT b FROM {label}_targets)),
  {label} AS (SELECT name, standard, std_pos, score FROM name_forms JOIN (
    SELECT a, standard, std_pos, score, row_number() OVER (PARTITION BY a ORDER BY score DESC, std_pos, var_pos) AS r
    FROM {label}_pairs JOIN {label}_targets USING (b) WHERE score >= 85) USING (a) WHERE r = 1)"""


FUZZY = scored("name", "variation", "fuzzy")
OWN = scored("name", "standard", "own")
RESOLVED = """resolved AS (
  SELECT name, standard, std_pos, strategy, 100 AS score FROM listed
  UNION ALL SELECT name, standard, std_pos, 'fuzzy', score FROM fuzzy WHERE name NOT IN (SELECT name FROM listed)
  UNION ALL SELECT name, standard, std_pos, 'standard_name', score FROM own
    WHERE name NOT IN (SELECT name FROM listed) AND name NOT IN (SELECT name FROM fuzzy))"""
RESOLVE = ", ".join([HEADERS, NAMES, VARIATIONS, EXACT, CI, LISTED, NAME_FORMS, FUZZY, OWN, RESOLVED])

LONG = "long AS (" + " UNION ALL ".join(
    f"SELECT 'customer_' || o_custkey || '.csv' AS dataset_id, row_id, {i} AS col_pos, '{c}' AS \"column\", {c} AS value FROM cleaned"
    for i, c in enumerate(CELLS)) + ")"
PROFILE = f"""profile AS (SELECT dataset_id, "column", min(col_pos)::BIGINT AS col_pos, count(*) AS n_cells, count(value) AS n_values,
  count(*) FILTER ({looks_numeric('value')}) AS n_numeric, count({as_int('value')}) AS n_int,
  count(*) FILTER (contains({bare('value')}, '.') AND regexp_matches({bare('value')}, '{NUMBER}')) AS n_float,
  min(y)::BIGINT AS min_year, max(y)::BIGINT AS max_year
  FROM (SELECT *, CASE WHEN contains("column", 'year') AND y0 > 1900 AND y0 < 2030 THEN y0 END AS y
        FROM (SELECT *, {as_double('value')} AS y0 FROM long)) GROUP BY ALL)"""
STATS = f"""stats AS (SELECT dataset_id, max(n_cells) AS row_count, count(*) AS col_count, min(min_year) AS min_year,
  max(max_year) AS max_year,
  CASE WHEN min(min_year) IS NULL THEN 'Unknown' WHEN min(min_year) = max(max_year) THEN min(min_year)::VARCHAR
       ELSE min(min_year) || '-' || max(max_year) END AS range_str,
  'District' AS granularity, sum(n_cells - n_values)::BIGINT AS missing_cells,
  {score('sum(n_cells - n_values)', 'sum(n_cells)')} AS completeness_score FROM profile GROUP BY dataset_id)"""
CUSTOMERS = ", ".join([MESSY, CLEANED, LONG, PROFILE, STATS])
Q = '","'
LOG = "amount_raw->amount;census_year->year;district_raw->district;priority_raw->priority"

SCHEMA_RESPONSES = f"""responses AS (SELECT *, {sql_text(inputs.FENCED)} AS response FROM (
  SELECT *, {sql_text(inputs.SCHEMA_BODY)} AS body FROM customer))"""
RECORD_RESPONSES = f"""responses AS (SELECT 'customer_' || c_custkey || '.csv' AS dataset_id, c_custkey, c_name, c_mktsegment,
  {sql_text(inputs.FENCED)} AS response FROM (SELECT *, {sql_text(inputs.RECORD_BODY)} AS body FROM customer))"""
CONTEXT = """context AS (SELECT 'customer_' || c_custkey || '.csv' AS dataset_id, 'Orders from ' || n_name AS title,
  CASE WHEN c_nationkey > 0 THEN 'Ministry of ' || n_name ELSE '' END AS ministry
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 3 = 0)"""

PORTAL = f"""portal AS (SELECT page_id, url, id, replace(html, '<article>', concat('<article>', {inputs.PORTAL_BLOCK})) AS html
  FROM (SELECT *, page_id::VARCHAR AS id FROM pages))"""


def inner(html: str, pattern: str) -> str:
    return f"regexp_extract({html}, '(?is){pattern}', 1)"


def decode(c: str) -> str:
    for entity, char in (("&quot", '"'), ("&copy", "©"), ("&middot", "·"), ("&lt", "<"), ("&gt", ">"), ("&amp", "&")):
        c = f"regexp_replace({c}, '{entity};?', '{char}', 'g')"
    return c


def visible(c: str) -> str:
    return f"trim({decode(f'''regexp_replace({c}, '<[^>]+>', '', 'g')''')}, E' \\n\\t')"


PAGE_TITLE = visible(inner("html", "<title[^>]*>(.*?)</title>"))
PORTAL_TITLE = f"""CASE page_id % 6 WHEN 0 THEN 'Data & Facts ' || id WHEN 1 THEN 'Node ' || id WHEN 2 THEN 'Plain ' || id
  WHEN 3 THEN 'Graph "' || id || '"' ELSE trim(split_part({decode(inner('html', '<title[^>]*>(.*?)</title>'))}, '|', 1)) END"""
PORTAL_DESCRIPTION = f"""CASE page_id % 5 WHEN 0 THEN 'Body:of ' || id || ' all end' WHEN 1 THEN 'Notes ' || id WHEN 2 THEN 'About ' || id
  WHEN 3 THEN 'Meta ' || id ELSE '' END"""
PORTAL_MINISTRY = """CASE page_id % 7 WHEN 0 THEN 'Org ' || id WHEN 1 THEN 'Health ' || id WHEN 2 THEN 'Roads ' || id
  WHEN 3 THEN 'Survey ' || id END"""
PORTAL_SECTOR = "CASE page_id % 4 WHEN 0 THEN 'Farm ' || id WHEN 1 THEN 'Cat ' || id END"
PORTAL_LINKS = """portal_links AS (
  SELECT page_id, unnest(CASE page_id % 3
    WHEN 0 THEN ['https://data.gov.in/files/' || page_id || '.CSV', 'http://x.example/' || page_id,
                 'https://cdn.example/a.csv?x=1&y=2', 'https://data.gov.in/data/' || page_id || '/b.csv']
    WHEN 1 THEN ['https://data.gov.in/one/' || page_id || '.csv'] ELSE [] END) AS url FROM pages)"""
SAFE = r"substr(lower(replace(trim(regexp_replace({t}, '[^\p{{L}}\p{{N}} _-]', '', 'g')), ' ', '_')), 1, 50)"

SLUG = f"""CASE WHEN length(s) > 100 THEN regexp_replace(substr(s, 1, 100), '_[^_]*$', '') ELSE s END"""
SLUG_STEM = f"trim(regexp_replace(regexp_replace(lower(title), '[^a-z0-9{SPACE[1:-1]}]', '', 'g'), '{SPACE}+', '_', 'g'), '_')"

PARTS = """parts AS (SELECT c_custkey AS customer_id, c_name AS name, c_acctbal AS balance,
  lower(c_mktsegment) || '.csv' AS dataset_id FROM customer)"""


def harmonized() -> str:
    """The expected end-to-end rows, with the statistics computed from the tables."""
    customers = f"""SELECT 'customers.csv' AS dataset_id, count(*) AS row_count, 'name,amount,cust_id' AS columns, 'ok' AS status,
      'Unknown' AS range_str, 'Unknown' AS granularity, '' AS places,
      {score('count(*) FILTER (c_custkey % 9 = 0)', 'count(*) * 3')} AS completeness_score,
      count(*) FILTER (c_custkey % 9 = 0) AS missing_cells, 'Balance->amount;Cust_ID->cust_id;cust name->name' AS transformations FROM customer"""
    gone = " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in CELLS)
    orders = f"""SELECT 'orders.csv', count(*), 'id,district,year,amount,priority_raw', 'ok',
      min(census_year) FILTER (census_year > 1900 AND census_year < 2030) || '-' || max(census_year) FILTER (census_year > 1900 AND census_year < 2030),
      'District', (SELECT string_agg(district_raw, ',' ORDER BY district_raw) FROM (SELECT DISTINCT district_raw FROM cleaned
        WHERE lower(district_raw) <> 'total' AND length(district_raw) > 1 ORDER BY 1 LIMIT 5)),
      {score(gone, 'count(*) * 5')}, {gone},
      'amount_raw->amount;census_year->year;district_raw->district;priority_raw->priority_raw;row_id->id' FROM finals"""
    # `supplierid` is 73 similar to the standard that `Supplier  Name` founds, and joins its list.
    suppliers = """SELECT 'suppliers.csv', count(*), 'name,state,amount,supplier_name', 'ok', 'Unknown', 'State',
      (SELECT string_agg(s, ',' ORDER BY s) FROM (SELECT DISTINCT 'State ' || s_nationkey AS s FROM supplier WHERE s_suppkey % 4 <> 0 ORDER BY 1 LIMIT 5)),
      1.0, 0, 'BALANCE->amount;Supplier Name->name;state->state;supplierid->supplier_name' FROM supplier"""
    finals = f"finals AS (SELECT row_id, priority_raw, amount_raw, {YEAR_NUMBER} AS census_year, district_raw FROM cleaned)"
    return with_(MESSY, CLEANED, finals) + f"{customers} UNION ALL {orders} UNION ALL {suppliers}"


_GAP_ROWS = f"coalesce({', '.join(CELLS)}) IS NOT NULL"
_FOUNDERS = f"""
  open AS (SELECT name, {squeezed('name')} AS a FROM names WHERE name NOT IN (SELECT variation FROM variations)),
  forms AS (SELECT a, min(name) AS head FROM open GROUP BY a),
  given AS (SELECT a, standard, std_pos, score FROM (
    SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, std_pos) AS r FROM (
      SELECT a, standard, std_pos, {similarity('a', 'b')} AS score
      FROM forms, (SELECT standard, std_pos, replace(lower(standard), '_', '') AS b FROM standards))
    WHERE score > 70) WHERE r = 1),
  homeless AS (SELECT a, head, row_number() OVER (ORDER BY head) AS i FROM forms WHERE a NOT IN (SELECT a FROM given)),
  near AS (SELECT * FROM (SELECT x.a AS a, x.head AS head, y.a AS b, {similarity('x.a', 'y.a')} AS score
    FROM homeless x, forms y WHERE x.a <> y.a) WHERE score > 70),
  earlier AS (SELECT h.i, h.a, coalesce(list(n.a) FILTER (n.head < h.head), []) AS reach
    FROM homeless h LEFT JOIN near n ON n.b = h.a GROUP BY h.i, h.a),
  steps(i, founders) AS (SELECT 0::BIGINT, []::VARCHAR[] UNION ALL
    SELECT e.i, CASE WHEN list_has_any(e.reach, s.founders) THEN s.founders ELSE list_append(s.founders, e.a) END
    FROM steps s JOIN earlier e ON e.i = s.i + 1),
  founders AS (SELECT h.a, h.head FROM homeless h WHERE h.a IN (
    SELECT unnest(founders) FROM (SELECT founders FROM steps ORDER BY i DESC LIMIT 1))),
  offers AS (SELECT name, f.head AS founder, f.std_pos AS std_pos, score FROM open JOIN (
      SELECT n.b AS a, n.head, NULL::BIGINT AS std_pos, score FROM near n WHERE n.a IN (SELECT a FROM founders)
      UNION ALL SELECT a, head, NULL, 100 FROM founders) f ON f.a = open.a WHERE f.head <= name),
  choice AS (SELECT name, standard, score, is_new FROM (
    SELECT *, row_number() OVER (PARTITION BY name ORDER BY score DESC, is_new, place, founder) AS r FROM (
      SELECT name, standard, score, false AS is_new, std_pos AS place, '' AS founder FROM open JOIN given USING (a)
      UNION ALL SELECT name, replace(lower(founder), ' ', '_'), CASE WHEN founder = name THEN NULL ELSE score END, true, 0, founder
      FROM offers)
    ) WHERE r = 1)"""
# A founder's own offer carries no score but must win over weaker ones, so it is ranked as 100.
_FOUNDERS = _FOUNDERS.replace("PARTITION BY name ORDER BY score DESC", "PARTITION BY name ORDER BY coalesce(score, 100) DESC")

_PATTERNS = " UNION ALL ".join(
    f"SELECT {i} AS std_pos, '{s}' AS standard, '{'|'.join(p)}' AS pattern" for i, (s, p) in enumerate([
        ("district", ["district", "dist", "zilla", "jilla", "location"]),
        ("state", ["state", "rajya", "region"]),
        ("cattle_count", ["cattle", "gau", "bovine.*cattle", "cat"]),
        ("buffalo_count", ["buffalo", "bhains", "bovine.*buffalo", "buf"]),
        ("goat_count", ["goat", "bakri", "ruminant.*goat", "gt"]),
        ("sheep_count", ["sheep", "bhed", "ruminant.*sheep", "shp"]),
        ("year", ["year", "yr", "varsh", "data.*year", "census.*year", "survey.*year"])]))
FALLBACK = f"""patterns AS ({_PATTERNS}),
  hits AS (SELECT name, std_pos, standard, CASE WHEN contains(standard, 'count') OR standard = 'year' THEN 'integer' ELSE 'string' END AS type
    FROM names JOIN patterns ON regexp_matches({squeezed('name')}, pattern)),
  fallback AS (SELECT name, std_pos::BIGINT AS std_pos, standard, type FROM hits UNION ALL
    SELECT name, NULL, replace(lower(name), ' ', '_'), 'string' FROM names WHERE name NOT IN (SELECT name FROM hits))"""

_INFER = ", ".join([
    "src AS (SELECT messy.row_id::VARCHAR AS row_id, priority_raw, amount_raw, census_year, district_raw, "
    "o_totalprice::VARCHAR AS price, CASE WHEN o_orderkey % 2 = 0 THEN 'True' WHEN o_orderkey % 3 = 0 THEN 'NA' ELSE 'false' END AS flag, "
    "'#N/A' AS empty FROM messy JOIN orders ON o_orderkey = messy.row_id)",
    "cells AS (" + " UNION ALL ".join(
        f"SELECT {i} AS col_pos, '{c}' AS \"column\", CASE WHEN {c} IN ({READ_NULLS}) THEN NULL ELSE {c} END AS v FROM src"
        for i, c in enumerate(["row_id", *CELLS, "price", "flag", "empty"])) + ")"])

SQL = {
    "clean_quality": with_(MESSY, CLEANED) + f"""SELECT count(*) AS total_rows, sum(gone)::BIGINT AS missing_cells,
      {score('sum(gone)', 'count(*) * 4')} AS completeness_score
      FROM (SELECT {' + '.join(f'({c} IS NULL)::INT' for c in CELLS)} AS gone FROM cleaned)""",
    "read_csv_tolerant": """SELECT o_orderkey AS order_id, o_custkey AS cust,
      CASE WHEN o_orderkey % 10 = 1 THEN NULL ELSE o_custkey END AS cust_again, NULL::DOUBLE AS blank,
      CASE WHEN o_orderkey % 10 = 1 THEN NULL WHEN o_orderkey % 10 = 2 THEN 'a, "b"' ELSE o_orderpriority END AS note
      FROM orders WHERE o_orderkey % 10 NOT IN (0, 3)""",
    "infer_types": with_(MESSY, _INFER) + f"""SELECT col_pos::BIGINT AS col_pos, "column", count(v) AS n_values,
      CASE WHEN count(v) = 0 THEN 'double' WHEN bool_and(regexp_matches(v, '{INTEGER}')) THEN 'bigint'
           WHEN bool_and(regexp_matches(v, '{NUMBER}')) THEN 'double'
           WHEN bool_and(v IN ('True', 'TRUE', 'true', 'False', 'FALSE', 'false')) THEN 'boolean' ELSE 'string' END AS inferred_type
      FROM cells GROUP BY ALL""",
    "file_profile": " UNION ALL ".join(
        f"""SELECT '{t}' AS dataset_id, (SELECT count(*) FROM {t}) AS row_count, {len(cols)}::BIGINT AS n_columns, '{",".join(cols)}' AS columns,
        substr(string_agg(j, ' ' ORDER BY k), 1, 500) AS sample FROM (SELECT {cols[0]} AS k, to_json({{{", ".join(f"'{c}': {c}" for c in cols)}}})::VARCHAR AS j
        FROM {t} ORDER BY {cols[0]} LIMIT 3)""" for t, cols in {
            "customer": ["c_custkey", "c_name", "c_mktsegment"], "part": ["p_partkey", "p_name", "p_size"],
            "supplier": ["s_suppkey", "s_name"]}.items()),
    "drop_null_rows": with_(MESSY, GAPS) + f"SELECT *, NULL::VARCHAR AS remarks FROM gaps WHERE {_GAP_ROWS}",
    "drop_null_columns": with_(MESSY, GAPS) + "SELECT * FROM gaps",
    "clean_names": "SELECT p_partkey, p_name AS \"part name\", p_size AS \"part size\", p_brand AS \"part size_1\" FROM part",
    "clean_cells": with_(MESSY) + "SELECT row_id, " + ", ".join(f"{clean_cell(c)} AS {c}" for c in CELLS) + " FROM messy",
    "clean_documents": f"SELECT doc_id, length({clean_cell('text')}) AS n_clean, md5({clean_cell('text')}) AS clean_md5 FROM documents",
    "null_flags": with_(MESSY, CLEANED) + f"SELECT row_id, {', '.join(CELLS)} FROM cleaned",
    "numeric_likeness": with_(MESSY, CLEANED) + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS n_values, count(*) FILTER ({looks_numeric(c)}) AS n_numeric,
        count(*) FILTER ({looks_numeric(c)}) / count({c})::DOUBLE AS ratio,
        count(*) FILTER ({looks_numeric(c)}) >= count({c}) * 0.7 AS is_numeric FROM cleaned""" for c in CELLS),
    "extract_numbers": with_(MESSY, CLEANED) + f"SELECT row_id, {AMOUNT_TEXT} AS amount FROM cleaned",
    "clean_table": with_(MESSY, GAPS, CLEAN_GAPS) + f"""SELECT row_id, priority_raw, {AMOUNT_TEXT} AS amount_raw,
      {YEAR_NUMBER} AS census_year, district_raw FROM clean_gaps""",
    "column_union": with_(HEADERS, NAMES) + "SELECT name FROM names",
    "unmapped_names": with_(HEADERS, NAMES, VARIATIONS) + "SELECT name FROM names WHERE name NOT IN (SELECT variation FROM variations)",
    "coverage": with_(HEADERS, NAMES, VARIATIONS) + """SELECT bool_and(hit) AS valid, count(*) FILTER (hit) AS mapped_count, count(*) AS total_count
      FROM (SELECT name IN (SELECT variation FROM variations) AS hit FROM names)""",
    "auto_assign": with_(HEADERS, NAMES, VARIATIONS, STANDARDS, _FOUNDERS) + "SELECT name, standard, score, is_new FROM choice",
    "fallback_schema": with_(HEADERS, NAMES, FALLBACK) + "SELECT name, std_pos, standard, type FROM fallback",
    "fallback_types": with_(HEADERS, NAMES, FALLBACK) + """SELECT name, standard, type FROM (
      SELECT *, row_number() OVER (PARTITION BY name ORDER BY std_pos) AS r FROM fallback) WHERE r = 1""",
    "parse_proposals": with_(SCHEMA_RESPONSES) + """SELECT c_custkey, c_custkey % 6 < 3 AS parsed,
      CASE WHEN c_custkey % 6 < 3 THEN json_extract_string(body, '$.domain') END AS domain,
      CASE WHEN c_custkey % 6 < 3 THEN len(json_keys(body, '$.column_mappings')) END::BIGINT AS n_standards FROM responses""",
    "schema_document": with_(SCHEMA_RESPONSES) + """SELECT std_pos, standard, var_pos, variation, count(*) AS n_documents FROM (
      SELECT std_pos, standard, generate_subscripts(vs, 1) - 1 AS var_pos, unnest(vs) AS variation FROM (
        SELECT i AS std_pos, json_keys(body, '$.column_mappings')[i + 1] AS standard,
          from_json(json_extract(body, '$.column_mappings.' || json_keys(body, '$.column_mappings')[i + 1]), '["VARCHAR"]') AS vs
        FROM (SELECT body, unnest(range(0, len(json_keys(body, '$.column_mappings')))) AS i FROM responses WHERE c_custkey % 6 < 3)))
      GROUP BY ALL""",
    "normalize_names": with_(HEADERS, NAMES) + f"SELECT name, {normal('name')} AS normal FROM names",
    "normalize_documents": f"SELECT doc_id, length(t) AS n_normal, md5(t) AS normal_md5 FROM (SELECT doc_id, {normal('text')} AS t FROM documents)",
    "similarity_ratio": f"""SELECT name, p_name, {similarity('a', 'b')} AS score FROM (
      SELECT DISTINCT name, p_name, {normal('name')} AS a, {normal('p_name')} AS b FROM (
        SELECT {sql_text(inputs.HEADER_NAME)} AS name, p_name FROM lineitem JOIN part ON l_partkey = p_partkey))""",
    "resolve_exact": with_(HEADERS, NAMES, VARIATIONS, EXACT) + "SELECT name, standard, std_pos FROM exact",
    "resolve_ci": with_(HEADERS, NAMES, VARIATIONS, CI) + "SELECT name, standard, std_pos FROM ci",
    "resolve_fuzzy": with_(HEADERS, NAMES, VARIATIONS, NAME_FORMS, FUZZY) + "SELECT name, standard, std_pos, score FROM fuzzy",
    "resolve_standard_name": with_(HEADERS, NAMES, VARIATIONS, NAME_FORMS, OWN) + "SELECT name, standard, std_pos, score FROM own",
    "resolve_columns": with_(RESOLVE) + """SELECT dataset_id, col_pos, name AS original, standard, std_pos, strategy, score
      FROM headers JOIN resolved USING (name)""",
    "mapping_log": with_(RESOLVE) + """SELECT dataset_id, count(*) AS n_mapped,
      string_agg(name || '->' || standard, ';' ORDER BY name || '->' || standard) AS log FROM headers JOIN resolved USING (name) GROUP BY dataset_id""",
    "missing_required": with_(RESOLVE) + """SELECT dataset_id, concat_ws(',', """ + ", ".join(
        f"CASE WHEN NOT coalesce(bool_or(standard = '{s}'), false) THEN '{s}' END" for s in ("red_ring", "old_bolt", "cold_gizmo"))
        + ") AS missing_required FROM headers LEFT JOIN resolved USING (name) GROUP BY dataset_id",
    "rename_project": with_(MESSY) + """SELECT row_id, priority_raw AS priority, amount_raw AS amount, census_year AS year,
      district_raw AS priority_1 FROM messy""",
    "rename_coalesce": with_(MESSY) + """SELECT row_id, coalesce(priority_raw, district_raw) AS priority, amount_raw AS amount,
      census_year AS year FROM messy""",
    "cast_integer": with_(MESSY, CLEANED, FINAL) + f"""SELECT row_id, census_year, {as_int('amount_raw')} AS amount_raw, o_totalprice AS price,
      floor(o_totalprice)::BIGINT AS whole, (o_orderstatus = 'F')::BIGINT AS final FROM final JOIN orders ON row_id = o_orderkey""",
    "cast_float": with_(MESSY, CLEANED, FINAL) + f"""SELECT row_id, census_year::DOUBLE AS census_year, {as_double('amount_raw')} AS amount_raw,
      NULL::DOUBLE AS priority_raw, o_totalprice AS price FROM final JOIN orders ON row_id = o_orderkey""",
    "cast_string": with_(MESSY, CLEANED, FINAL) + """SELECT row_id, coalesce(census_year::VARCHAR, 'nan') AS census_year, o_totalprice::VARCHAR AS price,
      floor(o_totalprice)::DOUBLE::VARCHAR AS whole, CASE WHEN o_orderstatus = 'F' THEN 'True' ELSE 'False' END AS final,
      coalesce(priority_raw, 'nan') AS priority_raw FROM final JOIN orders ON row_id = o_orderkey""",
    "conform_table": with_(MESSY, CLEANED, FINAL) + f"""SELECT row_id, district_raw AS district, census_year AS year,
      {as_double('amount_raw')} AS amount, priority_raw AS priority FROM final""",
    "temporal_range": with_(MESSY, CLEANED, FINAL) + """SELECT min(census_year) AS min_year, max(census_year) AS max_year,
      min(census_year) || '-' || max(census_year) AS range_str FROM final WHERE census_year > 1900 AND census_year < 2030""",
    "spatial_top5": with_(MESSY, CLEANED) + """SELECT kind, row_number() OVER (PARTITION BY kind ORDER BY location) AS rank, location FROM (
      SELECT DISTINCT 'district' AS kind, district_raw AS location FROM cleaned UNION
      SELECT DISTINCT 'state', n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey)
      WHERE lower(location) <> 'total' AND length(location) > 1 QUALIFY rank <= 5""",
    "completeness": f"""SELECT count(*) AS total_rows, sum(gone)::BIGINT AS missing_cells, {score('sum(gone)', 'count(*) * 3')} AS completeness_score FROM (
      SELECT (event_id % 9 = 0)::INT + (event_type = 'error')::INT + (NOT value > 5)::INT AS gone FROM events)""",
    "dataset_stats": with_(MESSY, GAPS, CLEAN_GAPS) + f"""SELECT count(*) AS row_count, 4::BIGINT AS col_count, min(y) AS min_year, max(y) AS max_year,
      min(y) || '-' || max(y) AS range_str, '' AS states,
      (SELECT string_agg(d, ',' ORDER BY d) FROM (SELECT DISTINCT district_raw AS d FROM clean_gaps WHERE lower(district_raw) <> 'total'
        AND length(district_raw) > 1 ORDER BY 1 LIMIT 5)) AS districts, 'District' AS granularity,
      {score('sum(gone)', 'count(*) * 4')} AS completeness_score, sum(gone)::BIGINT AS missing_cells, count(*) AS total_rows
      FROM (SELECT {' + '.join(f'({c} IS NULL)::INT' for c in CELLS)} AS gone,
        CASE WHEN {YEAR_NUMBER} > 1900 AND {YEAR_NUMBER} < 2030 THEN {YEAR_NUMBER} END AS y FROM clean_gaps)""",
    "profile_long": with_(CUSTOMERS) + "SELECT * FROM profile",
    "stats_by_dataset": with_(CUSTOMERS) + "SELECT * FROM stats",
    "locations_by_dataset": with_(MESSY, CLEANED, LONG) + """SELECT dataset_id, location, row_number() OVER (PARTITION BY dataset_id ORDER BY location) AS rank
      FROM (SELECT dataset_id, value AS location FROM long WHERE "column" = 'district_raw' UNION
            SELECT 'nation_' || c_nationkey, c_name FROM customer)
      WHERE lower(location) <> 'total' AND length(location) > 1 QUALIFY rank <= 5""",
    "technical_record": with_(CUSTOMERS) + f"""SELECT dataset_id, 'CSV' AS format, dataset_id AS original_filename, row_count, 4::BIGINT AS column_count,
      '{",".join(CELLS)}' AS columns, true AS standardized, true AS ai_ready, completeness_score, missing_cells, row_count AS total_rows,
      '{LOG}' AS transformations FROM stats""",
    "precedence_merge": with_(CUSTOMERS, RECORD_RESPONSES, CONTEXT) + """SELECT dataset_id,
      CASE WHEN c_custkey % 6 < 3 THEN 'Orders of ' || c_name END AS title,
      coalesce(nullif(ministry, ''), CASE WHEN c_custkey % 6 < 3 THEN 'proposed' END) AS source,
      CASE WHEN ministry <> '' THEN 'Government of India (via data.gov.in)' WHEN c_custkey % 6 < 3 THEN 'someone' END AS publisher,
      coalesce(nullif(range_str, 'Unknown'), CASE WHEN c_custkey % 6 < 3 THEN 'guess' END) AS temporal_coverage,
      granularity FROM stats JOIN responses USING (dataset_id) LEFT JOIN context USING (dataset_id)""",
    "fallback_record": with_(MESSY) + """SELECT dataset_id, 'Government Dataset - ' || dataset_id AS title,
      'Harmonized dataset with ' || count(*) || ' records.' AS description, 'Unknown' AS sector
      FROM (SELECT 'customer_' || o_custkey || '.csv' AS dataset_id FROM messy) GROUP BY dataset_id""",
    "catalog": with_(CUSTOMERS, RECORD_RESPONSES, CONTEXT) + """SELECT dataset_id,
      CASE WHEN failed THEN 'Government Dataset - ' || dataset_id ELSE doc->'catalog_info'->>'title' END AS title,
      CASE WHEN failed THEN 'Unknown' ELSE doc->'catalog_info'->>'sector' END AS sector,
      CASE WHEN NOT failed THEN coalesce(nullif(ministry, ''), doc->'provenance'->>'source') END AS source,
      CASE WHEN NOT failed THEN CASE WHEN ministry <> '' THEN 'Government of India (via data.gov.in)' ELSE doc->'provenance'->>'publisher' END END AS publisher,
      CASE WHEN NOT failed THEN coalesce(nullif(range_str, 'Unknown'), doc->'spatial_temporal'->>'temporal_coverage') END AS temporal_coverage,
      CASE WHEN NOT failed THEN granularity END AS granularity, CASE WHEN NOT failed THEN row_count END AS row_count,
      CASE WHEN NOT failed THEN completeness_score END AS completeness_score
      FROM (SELECT *, response IS NULL OR coalesce(json_type(doc) <> 'OBJECT', false) AS failed
        FROM (SELECT *, try_cast(answer AS JSON) AS doc FROM (SELECT *, trim(CASE WHEN contains(response, '```json') THEN split_part(split_part(response, '```json', 2), '```', 1)
              WHEN contains(response, '```') THEN split_part(response, '```', 2) ELSE response END) AS answer
          FROM stats JOIN responses USING (dataset_id) LEFT JOIN context USING (dataset_id))))""",
    "fact_sheet": with_(CUSTOMERS, CONTEXT) + f"""SELECT dataset_id, dataset_id AS original_filename, ministry, title, range_str AS temporal_range, granularity,
      shown[1] AS first_row, shown[2] AS second_row, '["{Q.join(CELLS)}"]' AS columns,
      '["' || 'District ' || o_custkey || '","State of ' || o_custkey || '"]' AS locations
      FROM stats LEFT JOIN context USING (dataset_id) JOIN (
        SELECT 'customer_' || o_custkey || '.csv' AS dataset_id, o_custkey, list(CASE WHEN priority_raw IS NULL THEN '{{"row_id":' || row_id || '}}'
          ELSE '{{"row_id":' || row_id || ',"priority_raw":"' || priority_raw || '"}}' END ORDER BY row_id) AS shown FROM messy GROUP BY o_custkey) USING (dataset_id)""",
    "schema_consistency": with_(HEADERS) + """, listed AS (SELECT dataset_id, list(name ORDER BY col_pos, name) AS cols FROM headers GROUP BY dataset_id),
      first AS (SELECT cols AS first_cols FROM listed ORDER BY dataset_id LIMIT 1)
      SELECT dataset_id, cols = first_cols AS consistent, len(list_filter(first_cols, lambda x: NOT list_contains(cols, x)))::BIGINT AS n_lacks,
        len(list_filter(cols, lambda x: NOT list_contains(first_cols, x)))::BIGINT AS n_extra FROM listed, first""",
    "merge_union": with_(PARTS) + "SELECT customer_id, name, balance, dataset_id FROM parts",
    "merge_total": "SELECT count(*) AS total_rows FROM customer",
    "run_summary": "SELECT count(*) FILTER (s_acctbal > 0) AS processed, count(*) AS found FROM supplier",
    "run_list": with_(HEADERS) + """SELECT dataset_id AS original, replace(dataset_id, '.csv', '') || '_harmonized' AS harmonized, count(*) AS columns
      FROM headers GROUP BY dataset_id HAVING count(*) % 5 > 0""",
    "write_sidecars": with_(CUSTOMERS) + "SELECT dataset_id, dataset_id AS original_filename, row_count, 4::BIGINT AS column_count FROM stats",
    "write_records": with_(CUSTOMERS) + "SELECT dataset_id AS original_filename, row_count, 4::BIGINT AS column_count FROM stats",
    "write_merged": with_(PARTS) + "SELECT customer_id, name, balance, dataset_id FROM parts",
    "harmonize_folder": """WITH c AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN 'north' WHEN c_custkey % 3 = 1 THEN 'south' END AS file FROM customer)
      SELECT file, count(*) AS row_count, 'ok' AS status, 'id,name,note' AS columns FROM c WHERE file IS NOT NULL GROUP BY file
      UNION ALL SELECT 'suppliers', count(*), 'ok', 'id,name' FROM supplier
      UNION ALL SELECT 'bare', NULL, 'skipped: no rows', NULL UNION ALL SELECT 'void', NULL, 'skipped: no data', NULL""",
    "page_context": """SELECT n_nationkey, n_name, r_name AS ministry, NULL::VARCHAR AS title FROM nation JOIN region ON n_regionkey = r_regionkey
      UNION ALL SELECT n_nationkey, n_name, 'AFRICA', 'All of them' FROM nation""",
    "title_slug": f"""SELECT page_id, nullif({SLUG}, '') AS slug, CASE WHEN coalesce(title, '') = '' THEN 'no title'
      WHEN nullif({SLUG}, '') IS NULL THEN 'invalid title' ELSE 'ok' END AS status FROM (SELECT *, {SLUG_STEM} AS s FROM (
        SELECT page_id, trim(split_part({decode(inner('html', '<title[^>]*>(.*?)</title>'))}, '|', 1)) AS title FROM pages
        UNION ALL SELECT doc_id, text FROM documents))""",
    "slug_dedupe": """WITH RECURSIVE items AS (
        SELECT p_partkey AS dataset_id, replace(CASE WHEN p_partkey % 37 = 5 THEN p_name || ' ' || (p_partkey % 4) ELSE p_name END, ' ', '_') AS slug,
          p_name AS family FROM part),
      ordered AS (SELECT *, row_number() OVER (PARTITION BY family ORDER BY dataset_id) AS i FROM items),
      steps AS (SELECT family, 0::BIGINT AS i, []::VARCHAR[] AS taken, NULL::BIGINT AS dataset_id, NULL::VARCHAR AS slug, NULL::VARCHAR AS name FROM (SELECT DISTINCT family FROM items)
        UNION ALL
        SELECT family, i, list_append(taken, name), dataset_id, slug, name FROM (
          SELECT o.family, o.i, s.taken, o.dataset_id, o.slug,
            CASE WHEN NOT list_contains(s.taken, o.slug) THEN o.slug ELSE o.slug || '_' ||
              list_filter(range(1, len(s.taken) + 2), lambda k: NOT list_contains(s.taken, o.slug || '_' || k))[1] END AS name
          FROM steps s JOIN ordered o ON o.family = s.family AND o.i = s.i + 1))
      SELECT dataset_id, slug, name FROM steps WHERE i > 0""",
    "pair_files": """SELECT 'part_' || p_partkey || '_metadata' AS stem, 'part_' || p_partkey AS base,
      CASE WHEN p_partkey % 5 IN (0, 1) THEN 'part_' || p_partkey || '.csv' WHEN p_partkey % 5 IN (2, 3) THEN 'part_' || p_partkey || '_harmonized.csv' END AS file,
      CASE WHEN p_partkey % 5 = 4 THEN 'no data file' ELSE 'ok' END AS status FROM part""",
    "page_title": with_(PORTAL) + f"""SELECT page_id, 'plain' AS kind, trim(split_part({decode(inner('html', '<title[^>]*>(.*?)</title>'))}, '|', 1)) AS title FROM pages
      UNION ALL SELECT page_id, 'portal', {PORTAL_TITLE} FROM portal""",
    "page_description": with_(PORTAL) + f"SELECT page_id, {PORTAL_DESCRIPTION} AS description FROM portal",
    "page_label": with_(PORTAL) + f"SELECT page_id, {PORTAL_MINISTRY} AS ministry, {PORTAL_SECTOR} AS sector FROM portal",
    "page_links": with_(PORTAL_LINKS) + f"""SELECT DISTINCT page_id, CASE WHEN href LIKE 'http%' THEN href WHEN href LIKE '/%' THEN 'https://site.example' || href
        ELSE 'https://site.example/' || href END AS url FROM (
        SELECT page_id, {decode("regexp_extract(a, 'href=\"([^\"]*)\"', 1)")} AS href, {visible('a')} AS t FROM (
          SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\\b[^>]*href="[^"]*"[^>]*>.*?</a>')) AS a FROM pages))
      WHERE contains(lower(href), 'th') OR contains(lower(t), 'th') UNION ALL SELECT page_id, url FROM portal_links""",
    "page_resources": with_(PORTAL, PORTAL_LINKS) + f"""SELECT page_id, link_no, url, {SAFE.format(t='title')} || '_' || link_no || '.csv' AS file_name FROM (
      SELECT page_id, url, row_number() OVER (PARTITION BY page_id ORDER BY url) AS link_no FROM portal_links)
      JOIN (SELECT page_id, {PORTAL_TITLE} AS title FROM portal) USING (page_id) WHERE link_no <= 3""",
    "page_metadata": with_(PORTAL) + f"""SELECT page_id, url AS scraped_url, 'data.gov.in' AS source_portal, {PORTAL_TITLE} AS title,
      {PORTAL_DESCRIPTION} AS description, {PORTAL_MINISTRY} AS ministry, {PORTAL_SECTOR} AS sector FROM portal""",
    "harmonize": harmonized(),
    "harmonized_orders": with_(MESSY, CLEANED) + f"""SELECT row_id AS id, district_raw AS district, {YEAR_NUMBER} AS year,
      {as_double(bare('amount_raw'))} AS amount, priority_raw FROM cleaned""",
}
SQL["stable_names"] = """WITH p AS (SELECT p_partkey AS k, format('part_{:09d}', p_partkey) AS dataset_id, replace(p_name, ' ', '_') AS base FROM part),
  first AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY k) - 1 AS n FROM p WHERE k % 2 = 0),
  stay AS (SELECT k, dataset_id, base AS slug, n FROM first WHERE k % 14 = 2 OR k % 10 <> 0),
  fresh AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY dataset_id) AS r FROM (
    SELECT dataset_id, CASE WHEN k % 10 = 0 THEN 'renamed_' || base ELSE base END AS slug FROM p WHERE k % 14 <> 2 AND (k % 2 = 1 OR k % 10 = 0))),
  free AS (SELECT slug, n, row_number() OVER (PARTITION BY slug ORDER BY n) AS r FROM (
    SELECT slug, unnest(range(0, count(*) + (SELECT count(*) FROM stay WHERE stay.slug = f.slug))) AS n FROM fresh f GROUP BY slug) x
    WHERE NOT EXISTS (SELECT 1 FROM stay WHERE stay.slug = x.slug AND stay.n = x.n))
  SELECT dataset_id, slug, CASE WHEN n = 0 THEN slug ELSE slug || '_' || n END AS name FROM (
    SELECT dataset_id, slug, n FROM stay UNION ALL SELECT dataset_id, slug, n FROM fresh JOIN free USING (slug, r))"""
SQL["dataset_pages"] = with_(PORTAL, PORTAL_LINKS) + f""", res AS (SELECT page_id, url, link_no, lower({SAFE.format(t='title')} || '_' || link_no || '.csv') AS file_name FROM (
    SELECT page_id, url, row_number() OVER (PARTITION BY page_id ORDER BY url) AS link_no FROM portal_links)
    JOIN (SELECT page_id, {PORTAL_TITLE} AS title FROM portal) USING (page_id)),
  d AS (SELECT DISTINCT 'dl/' || {SAFE.format(t='title')} || '_1.csv' AS dataset_id FROM (SELECT page_id, {PORTAL_TITLE} AS title FROM portal) WHERE page_id IN (SELECT page_id FROM portal_links)
    UNION ALL SELECT 'in/' || page_id || '.csv' FROM pages UNION ALL SELECT unnest(['a.csv', 'B.csv', 'zzz.csv'])),
  hit AS (SELECT dataset_id, 0 AS level, page_id FROM d JOIN res ON lower(split_part(dataset_id, '/', -1)) = file_name
    UNION ALL SELECT dataset_id, 1, page_id FROM d JOIN res ON lower(split_part(dataset_id, '/', -1)) = lower(regexp_extract(split_part(split_part(url, '#', 1), '?', 1), '[^/]*$')))
  SELECT dataset_id, CASE WHEN min(page_id) = max(page_id) THEN min(page_id) END AS page_id,
    CASE any_value(level) WHEN 0 THEN 'file_name' WHEN 1 THEN 'url' END AS how,
    CASE WHEN any_value(level) IS NULL THEN 'no page' WHEN min(page_id) = max(page_id) THEN 'matched' ELSE 'ambiguous' END AS status
  FROM d LEFT JOIN (SELECT * FROM hit h WHERE level = (SELECT min(level) FROM hit WHERE hit.dataset_id = h.dataset_id)) USING (dataset_id) GROUP BY dataset_id"""
SQL["write_tables"] = with_(MESSY) + """SELECT 'group_' || (o_custkey % 200) || '.csv' AS dataset_id, count(*) AS row_count,
  count(priority_raw) AS n_priority, count(district_raw) AS n_district, max(amount_raw) AS amount FROM messy GROUP BY o_custkey % 200"""
SQL["merge_folder"] = """SELECT c_custkey AS customer_id, c_name AS name, c_acctbal AS balance, lower(c_mktsegment) AS segment,
  c_nationkey::BIGINT AS nation FROM customer"""
SQL["incremental_folder"] = """SELECT lower(c_mktsegment) AS segment, c_nationkey::BIGINT AS nation, count(*) AS row_count, 'customer_id,name,balance' AS columns,
  'ok' AS status, 1.0::DOUBLE AS completeness_score, 0::BIGINT AS missing_cells FROM customer GROUP BY ALL"""
SQL["quarantine"] = """WITH o AS (SELECT o_orderkey % 10 AS k, o_totalprice AS p FROM orders)
  SELECT 'kept' AS reason, NULL::VARCHAR AS "column", count(*) AS n, round(sum(CASE WHEN k <> 2 THEN p END), 2) AS total FROM o WHERE k > 1
  UNION ALL SELECT CASE k WHEN 0 THEN 'too many fields' WHEN 1 THEN 'no values' WHEN 2 THEN 'not a number' ELSE 'not an integer' END,
    CASE k WHEN 2 THEN 'total' WHEN 3 THEN 'id' END, count(*), NULL FROM o WHERE k < 4 GROUP BY k"""
SQL["conform_stream_table"] = SQL["conform_table"]
SQL["write_datasets"] = SQL["merge_union"]

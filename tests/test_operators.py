"""Operators on small fixtures, against plain re-statements of their rules."""

import random

import brute
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafline.operators import catalog, clean, conform, infer, match, merge, naming, pages, stats, unify
from sheafline.operators.clean import CleanOptions
from sheafline.operators.unify import UnifiedSchema


def rows(df):
    return [tuple(r) for r in df.collect()]


def text_table(spark, columns, data):
    return spark.createDataFrame(data, T.StructType([T.StructField(c, T.StringType()) for c in columns]))


# ---- cleaning ----------------------------------------------------------------------------------

def test_clean_composite(spark):
    raw = text_table(spark, [" id ", "Amount  (Rs)", "note", "gone", "flags"], [
        ("1", "1,200", " a  b ", None, "-"), ("2", "₹ 3", "NA", None, "NA"), ("3", "x", "", None, "."), ("-", "NA", " ", None, "NA")])
    done = clean.clean(raw)
    assert done.columns == ["id", "Amount (Rs)", "note", "flags"]
    assert dict(done.dtypes) == {"id": "bigint", "Amount (Rs)": "string", "note": "string", "flags": "string"}
    assert sorted(rows(done)) == [(1, "1,200", "a b", None), (2, "₹ 3", None, None), (3, "x", None, None)]


def test_number_columns(spark):
    raw = text_table(spark, ["ints", "floats", "mixed", "exp", "text"], [
        ("1,000", "1", "7", "1e5", "a"), ("2", "2.5", "007", "2e5", "1"), (None, "$3", "1.50", "3", "b"), ("4", "4", "many", "4", "c")])
    done = clean.clean(raw)
    assert dict(done.dtypes) == {"ints": "bigint", "floats": "double", "mixed": "string", "exp": "string", "text": "string"}
    got = done.collect()
    assert [r.mixed for r in got] == ["7", "7", "1.5", "many"]
    assert [r.exp for r in got] == ["1e5", "2e5", "3", "4"]
    assert [r.floats for r in got] == [1.0, 2.5, 3.0, 4.0]


def test_clean_is_idempotent(spark):
    rnd = random.Random(7)
    data = [tuple(rnd.choice(["1", " 2,0", "x  y", "NA", "", None, "3.5", "a\tb"]) for _ in range(3)) for _ in range(60)]
    once = clean.clean(text_table(spark, ["a", "b", "c"], data))
    twice = clean.clean(once)
    assert once.dtypes == twice.dtypes and sorted(rows(once), key=repr) == sorted(rows(twice), key=repr)


def test_sampled_numeric_verdict(spark):
    data = [(str(i), str(i) if i < 10 else "text") for i in range(40)]
    raw = text_table(spark, ["n", "v"], data).withColumn("i", F.col("n").cast("int"))
    whole = clean.profile(raw, ("i",))
    head = clean.profile(raw, ("i",), CleanOptions(sample_size=10, order_by="i"))
    assert [c.numeric for c in whole.columns] == [True, False]
    assert [c.numeric for c in head.columns] == [True, True]


def test_colliding_names_get_suffixes(spark):
    raw = text_table(spark, ["a  b", "a b", "A B"], [("x", "y", "z")])
    done = clean.clean(raw)
    assert [c.lower() for c in done.columns] == ["a b", "a b_1", "a b_2"] and rows(done) == [("x", "y", "z")]
    with pytest.raises(ValueError):
        clean.clean(raw, options=CleanOptions(on_collision="error"))


def test_typed_columns_pass_through_and_nan_is_null(spark):
    raw = spark.createDataFrame([(1, float("nan"), True, "5"), (2, 2.5, None, "6")], "i INT, d DOUBLE, b BOOLEAN, s STRING")
    done = clean.clean(raw)
    assert dict(done.dtypes) == {"i": "int", "d": "double", "b": "boolean", "s": "bigint"}
    assert sorted(rows(done)) == [(1, None, True, 5), (2, 2.5, None, 6)]


def test_empty_table(spark):
    raw = text_table(spark, ["a", "b"], [(None, None), (None, None)])
    done = clean.clean(raw)
    assert done.columns == [] and done.count() == 0
    record = stats.table_stats(done, clean.profile(raw)).first()
    assert record.quality.completeness_score == 0.0 and record.quality.missing_cells is None


def test_grouped_profile_equals_single_profiles(spark):
    rnd = random.Random(11)
    data = [(rnd.choice("pqr"), rnd.choice(["1", "2.5", "x", None, "NA", "1999"]), rnd.choice([None, "a", " 7 "])) for _ in range(200)]
    raw = text_table(spark, ["ds", "year", "b"], data)
    for opts in (CleanOptions(), CleanOptions(infer=True, nullable_ints=False)):
        each = clean.profile_each(raw, "ds", options=opts)
        for name in "pqr":
            assert each[name] == clean.profile(raw.where(F.col("ds") == name), ("ds",), opts)


def test_inference(spark):
    raw = text_table(spark, ["i", "f", "b", "t", "none", "code"], [
        ("1", "1.5", "True", "x", "NA", "007"), (" 2", "2", "false", "1", "", "008"), ("NA", "1e3", "N/A", "2", None, "009")])
    kinds = {r.column: r.inferred_type for r in infer.infer_types(raw, keep_text=("code",)).collect()}
    assert kinds == {"i": "bigint", "f": "double", "b": "boolean", "t": "string", "none": "double", "code": "string"}
    typed = infer.infer_and_type(raw, keep_text=("code",)).collect()
    assert [r.i for r in typed] == [1, 2, None] and [r.b for r in typed] == [True, False, None]
    prof = clean.profile(raw, options=CleanOptions(infer=True, nullable_ints=False))
    assert [c.dtype.simpleString() for c in prof.columns][:3] == ["double", "double", "boolean"]


# ---- matching -----------------------------------------------------------------------------------

NAMES = ["Dist", "district name", "DISTRICT", "Distrct", "Bed_Capacity", "bedcapacty", "Opd Visits", "IPD_Visits", "year", "Yr",
         "grievancesWithOKRating", "grievanceswithgoodrating", "categoryHindi", "category", "zilla", "!!!", "M_Count", "F_Count",
         "Time Period", "time-period", "row id", "RowID", "Sys_Cod", "state name", "temperature"]
MAPPINGS = {"district": ["Dist", "district"], "bed_capacity": ["Bed_Capacity"], "opd_visits": ["OPD_Visits"], "year": ["Year"],
            "good_rating": ["grievancesWithGoodRating"], "ok_rating": ["grievancesWithOKRating"], "category": ["category", "category_hindi"],
            "m_count": ["M_Count"], "time_period": ["Time_Period"], "row_id": ["Row_ID"], "sys_code": ["X"], "empty": ["???"], "late": ["DISTRICT"]}


def names_table(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name STRING")


def test_resolution_follows_the_rules(spark):
    schema = UnifiedSchema(MAPPINGS)
    got = {r.name: (r.standard, r.strategy) for r in match.resolve_names(names_table(spark, NAMES), schema.variations(spark)).collect()}
    want = {n: brute.resolve(n, MAPPINGS) for n in NAMES}
    assert got == {n: w for n, w in want.items() if w}
    assert got["DISTRICT"] == ("district", "case_insensitive")   # earlier standard beats a later exact hit
    assert got["Sys_Cod"] == ("sys_code", "standard_name")


@pytest.mark.parametrize("low", [60, 71, 85, 86, 95, 100])
def test_candidate_filter_loses_no_pair(spark, low):
    rnd = random.Random(low)
    base = ["".join(rnd.choice("abc") for _ in range(rnd.randint(0, 14))) for _ in range(60)]
    near = []
    for b in base:
        c = list(b)
        for _ in range(rnd.randint(0, 4)):
            at = rnd.randint(0, len(c))
            if rnd.random() < .5 and c:
                c.pop(min(at, len(c) - 1))
            else:
                c.insert(at, rnd.choice("abcd"))
        near.append("".join(c))
    left, right = sorted(set(base)), sorted(set(near))
    a = spark.createDataFrame([(x,) for x in left], "a STRING")
    b = spark.createDataFrame([(x,) for x in right], "b STRING")
    got = {(r.a, r.b, r.score) for r in match.similar_pairs(a, b, low).collect()}
    assert got == {(x, y, brute.similarity(x, y)) for x in left for y in right if brute.similarity(x, y) >= low}


def test_resolution_on_random_names(spark):
    rnd = random.Random(2)
    words = ["total", "count", "male", "female", "district", "code", "name", "year", "rate"]
    mappings = {f"s{i}": [rnd.choice(words) + rnd.choice(["_", " ", ""]) + rnd.choice(words) for _ in range(2)] for i in range(15)}
    names = sorted({rnd.choice(words) + rnd.choice("_ -") + rnd.choice(words)[:rnd.randint(2, 8)] for _ in range(80)})
    got = {r.name: (r.standard, r.strategy) for r in match.resolve_names(names_table(spark, names), UnifiedSchema(mappings).variations(spark)).collect()}
    assert got == {n: w for n in names if (w := brute.resolve(n, mappings))}


# ---- schema --------------------------------------------------------------------------------------

def test_assignment_equals_the_sequential_rule(spark):
    rnd = random.Random(4)
    words = ["total", "count", "male", "female", "code", "name", "rate", "beds", "visits"]
    for seed in range(3):
        names = sorted({rnd.choice(words) + rnd.choice("_ -") + rnd.choice(words) + rnd.choice(["", "s", "X", "_1"]) for _ in range(60)})
        standards = ["total_count", "bed_rate"]
        table = spark.createDataFrame([(i, s) for i, s in enumerate(standards)], "std_pos BIGINT, standard STRING")
        got = {r.name: r.standard for r in unify.assign_unmapped(names_table(spark, names), table).collect()}
        assert got == brute.assign(names, standards), seed


def test_assignment_of_nothing(spark):
    table = spark.createDataFrame([(0, "a")], "std_pos BIGINT, standard STRING")
    assert unify.assign_unmapped(names_table(spark, ["x"]).limit(0), table).count() == 0


def test_coverage(spark):
    schema = UnifiedSchema({"a": ["x", "y"], "b": ["x"]})
    assert rows(unify.coverage(names_table(spark, ["x", "z"]), schema.variations(spark))) == [(False, 1, 2)]
    assert rows(unify.coverage(names_table(spark, ["x", "y"]), schema.variations(spark))) == [(True, 2, 2)]


def test_fallback_keeps_false_hits(spark):
    names = ["category", "length_km", "Distance", "Estate", "Census Year", "Zilla", "Pass_Rate", "pass rate", "location state"]
    doc = unify.fallback_document(names_table(spark, names))
    assert doc.column_mappings == {
        "district": ["Distance", "Zilla", "location state"], "state": ["Estate", "location state"],
        "cattle_count": ["category", "location state"],
        "goat_count": ["length_km"], "year": ["Census Year"], "pass_rate": ["Pass_Rate", "pass rate"]}
    assert doc.column_types == {"district": "string", "state": "string", "cattle_count": "integer", "goat_count": "integer",
                                "year": "integer", "pass_rate": "string"}
    one = {r.name: r.standard for r in unify.effective_fallback(unify.fallback_schema(names_table(spark, names))).collect()}
    assert one["location state"] == "district"


def test_proposals(spark):
    body = '{"column_mappings": {"b": ["y"], "a": ["x", "z"]}, "column_types": {"b": "integer"}}'
    texts = [body, f"text ```json\n{body}\n``` more", f"```\n{body}\n```", "```json\nbroken", "no", "[1]", None, "", f"``` x ``` ```json {body}```"]
    df = spark.createDataFrame(list(enumerate(texts)), "i INT, response STRING")
    got = unify.parse_proposals(df).orderBy("i")
    assert [r.parsed for r in got.collect()] == [True, True, True, False, False, False, False, False, True]
    standards, variations = unify.explode_schema(got.where("i = 1").select("document.*"))
    assert rows(standards.orderBy("std_pos")) == [(0, "b", "integer"), (1, "a", None)]
    assert UnifiedSchema.from_tables(standards, variations).column_mappings == {"b": ["y"], "a": ["x", "z"]}


# ---- conforming -----------------------------------------------------------------------------------

def test_integer_rule_is_whole_column(spark):
    df = text_table(spark, ["frac", "bad", "exp", "big"], [("1", "1", "1e3", "9007199254740993"), ("2.5", "x", "4", "1")])
    done, issues = conform.cast_types(df, dict.fromkeys(df.columns, "integer"))
    assert issues == [("frac", "integer")]
    assert rows(done) == [("1", 1, 1000, 9007199254740993), ("2.5", None, 4, 1)]


def test_other_casts(spark):
    df = spark.createDataFrame([(1.0, True, "1d", 7), (None, None, "2.5", None)], "d DOUBLE, b BOOLEAN, t STRING, i INT")
    done, _ = conform.cast_types(df, {"d": "string", "b": "string", "t": "float", "i": "date"}, null_as_text="nan")
    assert rows(done) == [("1.0", "True", None, 7), ("nan", "nan", 2.5, None)]


def test_conform_orders_renames_and_separates_duplicates(spark):
    schema = UnifiedSchema({"year": ["Yr"], "category": ["categoryEnglish", "categoryHindi"]}, {"year": "integer", "category": "string"})
    df = spark.createDataFrame([("e", "z", "h", 2020.0)], "categoryEnglish STRING, extra STRING, categoryHindi STRING, yr DOUBLE")
    done = conform.conform(df, schema)
    assert done.df.columns == ["year", "category", "extra", "category_1"]
    assert rows(done.df) == [(2020, "e", "z", "h")]
    assert done.mapping == {"categoryEnglish": "category", "categoryHindi": "category", "yr": "year"}
    merged = conform.conform(df, schema, done.mapping, on_collision="coalesce").df
    assert merged.columns == ["year", "category", "extra"]


def test_profile_knows_which_integers_fail(spark):
    raw = text_table(spark, ["whole", "frac", "mixed", "years"], [("1,0", "1.5", "1.5", "2001"), ("2", "2", "x", "1,999"), ("3", "3", "y", "z")])
    prof = clean.profile(raw)
    done = clean.apply_profile(raw, prof)
    assert conform.failing_by_profile(prof, {}) == conform.failing_integers(done, done.columns)


# ---- statistics ------------------------------------------------------------------------------------

def test_year_range(spark):
    df = text_table(spark, ["Census_Year", "year2", "other"], [("1900", "2030", "1800"), ("1901", "2029.9", "x"), ("n", "12", "x")])
    assert rows(stats.temporal_range(df)) == [(1901, 2029, "1901-2029")]
    assert rows(stats.temporal_range(df.select("other"))) == [(None, None, "Unknown")]
    same = text_table(spark, ["year"], [("2001",), ("2001",)])
    assert rows(stats.temporal_range(same)) == [(2001, 2001, "2001")]


def test_profile_years_agree_with_the_cleaned_column(spark):
    raw = text_table(spark, ["year a", "year b"], [("1,999", "2001"), ("2003", "about 1990"), ("x", "some"), ("2010", "text"), ("5", "2,004")])
    prof = clean.profile(raw)
    done = clean.apply_profile(raw, prof)
    record = stats.table_stats(done, prof).first()
    assert (record.temporal.min_year, record.temporal.max_year) == rows(stats.temporal_range(done))[0][:2]


def test_spatial_columns():
    assert stats.spatial_columns(["x", "State Name", "state", "Dist", "Sub_District"]) == ("State Name", "Sub_District")
    assert stats.spatial_columns(["STATE", "DIST"]) == ("STATE", "DIST")
    assert stats.spatial_columns(["estate", "distance"]) == (None, None)
    assert [stats.granularity(c) for c in (["dist"], ["state"], ["x"])] == ["District", "State", "Unknown"]


def test_top_locations(spark):
    df = text_table(spark, ["district"], [(v,) for v in ["b", "Total", "TOTAL", "zz", "aa", "aa", None, "cc", "dd", "ee", "Bb", "x"]])
    assert [r.location for r in stats.top_locations(df, "district").collect()] == ["Bb", "aa", "cc", "dd", "ee"]


@pytest.mark.parametrize("rows_, cols, missing, score", [(1644, 24, 113, 1.0), (260, 9, 437, 0.81), (172, 6, 19, 0.98), (10, 4, 5, 0.88), (10, 7, 3, 0.96)])
def test_completeness_values(spark, rows_, cols, missing, score):
    got = spark.range(1).select(stats.completeness_score(F.lit(missing), F.lit(rows_ * cols)).alias("s")).first().s
    assert got == score


# ---- catalog ---------------------------------------------------------------------------------------

def test_catalog_precedence(spark):
    datasets = spark.createDataFrame([("a.csv", 3, ["x"]), ("b.csv", 4, ["y"]), ("c.csv", 5, ["z"])],
                                     "dataset_id STRING, row_count BIGINT, columns ARRAY<STRING>")
    record = "dataset_id STRING, " + stats.STATS_SCHEMA
    facts = spark.createDataFrame([(d, n, 1, (2001, 2002, r), ([], [], g), (1.0, 0, n)) for d, n, r, g in [
        ("a.csv", 3, "2001-2002", "District"), ("b.csv", 4, "Unknown", "Unknown"), ("c.csv", 5, "Unknown", "State")]], record)
    log = spark.createDataFrame([("a.csv", {"X": "x"})], "dataset_id STRING, transformations_applied MAP<STRING, STRING>")
    full = ('{"catalog_info": {"title": "T"}, "provenance": {"source": "s", "publisher": "p"}, '
            '"spatial_temporal": {"temporal_coverage": "guess", "granularity": "Block"}}')
    responses = spark.createDataFrame([("a.csv", full), ("b.csv", full), ("c.csv", "not json")], "dataset_id STRING, response STRING")
    page = spark.createDataFrame([("Ministry of X",)], "ministry STRING")
    got = {r.dataset_id: r for r in catalog.catalog(datasets, facts, log, responses, page).collect()}
    assert got["a.csv"].spatial_temporal.temporal_coverage == "2001-2002" and got["a.csv"].spatial_temporal.granularity == "District"
    assert got["b.csv"].spatial_temporal.temporal_coverage == "guess" and got["b.csv"].spatial_temporal.granularity == "Block"
    assert got["a.csv"].provenance.source == "Ministry of X" and got["a.csv"].technical_metadata.transformations_applied == {"X": "x"}
    assert got["c.csv"].catalog_info is None and got["c.csv"].technical_metadata.row_count == 5
    bare = {r.dataset_id: r for r in catalog.catalog(datasets, facts, log).collect()}
    assert bare["b.csv"].catalog_info.title.endswith("- b.csv") and bare["b.csv"].technical_metadata is None


# ---- consistency and union --------------------------------------------------------------------------

def test_union(spark):
    a = spark.createDataFrame([(1, "x")], "id BIGINT, v STRING")
    b = spark.createDataFrame([(2.5, 7)], "id DOUBLE, v BIGINT")
    assert sorted(rows(merge.merge_union({"a": a, "b": b}))) == [(1.0, "x", "a"), (2.5, "7", "b")]
    with pytest.raises(ValueError):
        merge.merge_union({"a": a, "b": b.drop("v")})
    assert merge.merge_union({"a": a, "b": b.drop("v")}, allow_missing=True).count() == 2


def test_consistency(spark):
    df = spark.createDataFrame([("a", ["x", "y"]), ("b", ["y", "x"]), ("c", ["x", "y"]), ("d", ["x", "z"])], "dataset_id STRING, columns ARRAY<STRING>")
    got = {r.dataset_id: (r.consistent, r.lacks, r.extra) for r in merge.schema_consistency(df).collect()}
    assert got == {"a": (True, [], []), "b": (False, [], []), "c": (True, [], []), "d": (False, ["y"], ["z"])}


# ---- naming ------------------------------------------------------------------------------------------

def test_free_names_equal_the_sequential_rule(spark):
    rnd = random.Random(9)
    for taken in ([], ["x", "y_1", "x_3"]):
        items = [(i, rnd.choice(["x", "x", "x", "x_1", "x_2", "x_1_1", "y", "z_9"])) for i in range(60)]
        df = spark.createDataFrame(items, "dataset_id BIGINT, slug STRING")
        used = spark.createDataFrame([(t,) for t in taken], "name STRING") if taken else None
        got = {r.dataset_id: r.name for r in naming.free_names(df, taken=used).collect()}
        assert got == brute.free_names(items, taken)
        assert len(set(got.values())) == len(items)


def test_rank_survives_a_hot_group(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 < 2, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("g"), "id")
    ranked = naming.rank_in_group(df, "g", "id").where("g = 'hot'").orderBy("id").collect()
    assert [r["rank"] for r in ranked] == list(range(1, len(ranked) + 1))


def test_skip_rules(spark):
    df = spark.createDataFrame([("Good Title",), ("",), (None,), ("!!!",)], "title STRING")
    assert [r.status for r in naming.title_slugs(df).collect()] == ["ok", "no title", "no title", "invalid title"]


def test_pairing(spark):
    metadata = spark.createDataFrame([("a_metadata",), ("b_metadata",), ("c_metadata_metadata",), ("d_metadata",)], "stem STRING")
    files = spark.createDataFrame([("a.csv",), ("a_harmonized.csv",), ("b_harmonized.csv",), ("c.csv",)], "file STRING")
    got = {r.base: r.file for r in naming.pair_files(metadata, files).collect()}
    assert got == {"a": "a.csv", "b": "b_harmonized.csv", "c": "c.csv", "d": None}


# ---- pages -------------------------------------------------------------------------------------------

def test_title_cascade(one):
    html = ["<h1 class='x'>no</h1><h1 id='title'> A <b>B</b> </h1>", '<h1 class="big node-title">N</h1><title>t</title>', "<h1 class=title>P</h1>",
            "<meta content='og &amp; x' property='og:title'><title>t</title>", "<title> Page | Site </title>", "<p>none</p>",
            '<h1 data-id="title">no</h1><title>yes</title>', "<h1 id=title></h1><title>t</title>"]
    assert one(pages.title, *html) == ["A B", "N", "P", "og & x", "Page", "Unknown Dataset", "yes", ""]
    assert one(pages.title, '<!-- <h1 id="title">Old</h1> --><h1 id="title">New</h1>', "<h1 id='title'>open <b>end") == ["New", "open end"]


def test_description_cascade(one):
    html = ['<div class="notes">n</div><div class="field-name-body">b</div>', '<div class="a notes b">n</div>',
            '<meta name="description" content="m"><meta property="og:description" content="o">', "<meta name=description>", ""]
    assert one(pages.description, *html) == ["b", "n", "o", "", ""]
    nested = ['<div class="field field-name-body"><div class="label">Body:</div><div class="items">Crop <div>x</div>yields</div> all</div><div>no</div>',
              '<script>"<div class=notes>no</div>"</script><div class="notes">yes</div>']
    assert one(pages.description, *nested) == ["Body:Crop xyields all", "yes"]


def test_ministry_and_sector(one):
    html = ["<div class='og-group-ref'><div>Ministry</div> Org</div>", "<table><tr><th>Department</th><td>D</td></tr><tr><th>Ministry</th><td>M</td></tr></table>",
            "<div><label>Source</label><span>S</span></div>", "<p>x</p>"]
    assert one(pages.ministry, *html) == ["Ministry Org", "M", "S", None]
    assert one(pages.sector, "<tr><th>Category</th><td>C</td></tr>", "<p>Sector</p>") == ["C", None]


def test_links_and_resources(spark):
    html = ('<h1 id="title">My Data-Set, 2020!</h1><a href="/c.csv">c</a><a href="/a.CSV">a</a><a href="/a.CSV">a</a><a name="csv">no</a>'
            '<a href="http://h/x">CSV file</a><a href="/d.csv">d</a><a href="/no">no</a>')
    df = spark.createDataFrame([(1, "u", html), (2, "u", "<p>none</p>")], "page_id BIGINT, url STRING, html STRING")
    assert sorted(r.url for r in pages.page_links(df).collect()) == [
        "http://h/x", "https://data.gov.in/a.CSV", "https://data.gov.in/c.csv", "https://data.gov.in/d.csv"]
    got = pages.page_resources(df).orderBy("link_no").collect()
    assert [(r.link_no, r.url, r.file_name) for r in got] == [
        (1, "http://h/x", "my_data-set_2020_1.csv"), (2, "https://data.gov.in/a.CSV", "my_data-set_2020_2.csv"),
        (3, "https://data.gov.in/c.csv", "my_data-set_2020_3.csv")]
    record = pages.page_metadata(df).where("page_id = 1").first()
    assert (record.title, record.source_portal, record.scraped_url) == ("My Data-Set, 2020!", "data.gov.in", "u")


def test_fuzzy_join_of_long_names(spark):
    long = ["a" * 40 + "b" * 90, "ab" * 65, "x" * 200, "the same long column name again and again " * 4]
    near = [n[:60] + n[62:] for n in long]
    a, b = (spark.createDataFrame([(n,) for n in names], f"{c} STRING") for names, c in ((long, "a"), (near, "b")))
    got = {(r.a, r.b, r.score) for r in match.similar_pairs(a, b, 85).collect()}
    assert got == {(x, y, brute.similarity(x, y)) for x in long for y in near if brute.similarity(x, y) >= 85} and len(got) >= 4


def test_row_test_equals_cleaning(spark):
    """The cheap test for rows that keep a value agrees with cleaning the cells."""
    odd = [None, "", "  ", "NA", " NA ", "N\tA", "-", " . ", "\x00", "NA\x00", "NA \x00", "a", "<NA>", " <NA>", "Missing", "missing x", " nan ", "None\n"]
    df = text_table(spark, ["v"], [(v,) for v in odd])
    for opts in (CleanOptions(), CleanOptions(infer=True, keep_text=("v",))):
        prof = clean.profile(df, options=opts)
        assert prof.rows == prof.columns[0].values == clean.apply_profile(df, prof, options=opts).count()


def test_wide_table(spark):
    """Two thousand columns: the plan stays flat."""
    wide = spark.range(3).select(*[F.concat(F.lit(f"{i},"), F.col("id").cast("string")).alias(f"c{i}") for i in range(2000)])
    prof = clean.profile(wide)
    assert prof.rows == 3 and all(c.numeric and c.values == 3 for c in prof.columns)
    assert stats.completeness(wide).first().missing_cells == 0

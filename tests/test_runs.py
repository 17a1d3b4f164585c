"""CSV source, sinks, end-to-end runs, streaming."""

import json

import pytest
from pyspark.sql import functions as F

from sheafline.operators.clean import CleanOptions
from sheafline.operators.unify import UnifiedSchema
from sheafline.operators import clean, conform
from sheafline.plans.harmonize import harmonize, harmonize_folder
from sheafline.sources import csv, sinks
from sheafline.streaming.incremental import conform_stream


@pytest.fixture
def folder(tmp_path):
    def write(**files):
        for name, content in files.items():
            data = content if isinstance(content, bytes) else content.encode()
            (tmp_path / f"{name}.csv").write_bytes(data)
        return str(tmp_path)
    return write


def test_rows_headers_and_bad_files(spark, folder):
    where = folder(
        rows='id,name\n1,"a, ""b"""\n2\n3,x,extra\n\n,\n',
        header="﻿a,a, ,A\n1,2,3,4\n", latin="a,b\n1,é\n".encode("latin-1"), empty="", only_header="x,y\n")
    found = csv.open_folder(spark, where)
    assert {f.dataset_id: f.status for f in found.files} == {
        "rows.csv": "ok", "header.csv": "ok", "latin.csv": "skipped: not UTF-8", "empty.csv": "skipped: no columns", "only_header.csv": "ok"}
    tables = found.datasets(with_order=True)
    got = tables["rows.csv"].orderBy("row_order").drop("row_order").collect()
    assert [tuple(r) for r in got] == [("1", 'a, "b"'), ("2", None), (None, None)]
    assert tables["header.csv"].drop("row_order").columns == ["a", "a_1", "Unnamed: 2", "A_2"]
    bad = csv.read_text_table(spark, [f.path for f in found.files if f.dataset_id == "rows.csv"], ["id", "name"], "quarantine")
    assert [tuple(r) for r in bad.drop("dataset_id").collect()] == [("3", "x")]


def test_quoted_line_breaks(spark, folder):
    where = folder(q='id,note\n1,"two\nlines"\n2,x\n')
    table = csv.open_folder(spark, where).datasets()["q.csv"]  # found by the survey, no option needed
    assert sorted(tuple(r) for r in table.collect()) == [("1", "two\nlines"), ("2", "x")]


def test_one_scan_per_header(spark, folder):
    found = csv.open_folder(spark, folder(a="x,y\n1,2\n", b="x,y\n3,4\n5,6\n", c="z\n1\n"))
    assert sorted((len(g.paths), g.columns) for g in found.groups) == [(1, ["z"]), (2, ["x", "y"])]
    shared = next(t for t in found.tables() if "x" in t.columns)
    assert {r.dataset_id: r["count"] for r in shared.groupBy("dataset_id").count().collect()} == {"a.csv": 1, "b.csv": 2}


def test_no_file_is_lost(spark, tmp_path):
    """Equal base names, rows that are all empty, and headers alone each get a status."""
    for name, text in {"x/a.csv": "id,v\n1,\"p\nq\"\n2,r\n", "y/a.csv": "id,v\n3,s\n", "y/void.csv": "m,n\n,\n,\n", "bare.csv": "k,l\n"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    done = harmonize_folder(spark, str(tmp_path), recursive=True)
    assert {r.dataset_id: (r.row_count, r.status) for r in done.datasets.collect()} == {
        "x/a.csv": (2, "ok"), "y/a.csv": (1, "ok"), "y/void.csv": (None, "skipped: no data"), "bare.csv": (None, "skipped: no rows")}
    assert sorted(map(tuple, done.frames["x/a.csv"].collect())) == [("1", "p q"), ("2", "r")]
    assert tuple(done.summary().first()) == (2, 4)


def test_headers_only(spark, folder):
    done = harmonize_folder(spark, folder(a="x,y\n", b="z\n"))
    assert done.frames == {} and {r.status for r in done.datasets.collect()} == {"skipped: no rows"}
    assert done.catalog.collect() == []


def test_failing_write_raises(spark, tmp_path):
    from pyspark.errors import PySparkException
    from pyspark.sql import functions as F

    from sheafline.sources import sinks
    good = spark.range(2)
    bad = good.select(F.raise_error(F.lit("broken")).alias("x"))
    assert sinks.write_datasets({"a": good}, str(tmp_path)) == {"a": "ok"}
    assert sinks.write_datasets({"a": good}, str(tmp_path)) == {"a": "skipped: exists"}
    with pytest.raises(PySparkException):
        sinks.write_datasets({"b": bad}, str(tmp_path))


def test_answers_that_are_no_objects(spark):
    from pyspark.sql import functions as F

    from sheafline.operators import unify
    answers = ['{"a": 1}', "[1]", "3", "null", '"x"', "no json", None, '```json [1] ```']
    got = unify.parse_proposals(spark.createDataFrame([(i, a) for i, a in enumerate(answers)], "i INT, response STRING")).orderBy("i")
    assert [(r.parsed, r.other) for r in got.select("parsed", F.coalesce("other", F.lit(False)).alias("other")).collect()] == [
        (True, False), (False, True), (False, True), (False, True), (False, True), (False, False), (False, False), (False, True)]


def test_flags_with_blanks_count_the_same_in_profile_and_table(spark):
    from sheafline.operators.clean import apply_profile, profile
    df = spark.createDataFrame([("not   available",), (" x ",)], "a STRING")
    opts = CleanOptions(null_flags=("not available",))
    found = profile(df, (), opts)
    assert found.rows == apply_profile(df, found, (), opts).count() == 1


def test_no_usable_file(spark, folder):
    with pytest.raises(ValueError):
        csv.open_folder(spark, folder(e=""))


def test_file_profile(spark):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(9, -1, -1)], "o INT, v STRING")
    got = csv.file_profile(df, "d.csv", "o").first()
    assert (got.dataset_id, got.columns, got.row_count) == ("d.csv", ["v"], 10)
    assert [json.loads(s) for s in got["sample"]] == [{"v": "v0"}, {"v": "v1"}, {"v": "v2"}]


SCHEMA = UnifiedSchema(
    {"district": ["Dist"], "beds": ["Beds"], "cause": ["Cause"], "deaths": ["Deaths"], "code": ["Code"]},
    {"district": "string", "beds": "float", "cause": "string", "deaths": "integer", "code": "string"})


def test_golden_files(spark, folder):
    """Three small files conform to the text a data-frame writer would give: `nan`, `12.0`, integers."""
    where = folder(
        health="Beds,Dist\n12.0,\n,Kota\n7.5,Jaipur\n", deaths="Cause,Deaths,Code\n,10,X-1\nFamily,20,X-2\n",
        codes="Code,Deaths\n1,5\n2,\n")
    done = harmonize_folder(spark, where, CleanOptions(infer=True, nullable_ints=False), proposal=SCHEMA.to_json(), null_as_text="nan")
    assert done.frames["health.csv"].columns == ["district", "beds"]
    assert sorted(map(tuple, done.frames["health.csv"].collect()), key=repr) == [("Jaipur", 7.5), ("Kota", None), ("nan", 12.0)]
    assert sorted(map(tuple, done.frames["deaths.csv"].collect())) == [("Family", 20, "X-2"), ("nan", 10, "X-1")]
    assert sorted(map(tuple, done.frames["codes.csv"].collect()), key=repr) == [(5, "1"), (None, "2")]
    quality = {r.dataset_id: (r.quality.missing_cells, r.quality.completeness_score) for r in done.stats.collect()}
    assert quality == {"health.csv": (2, 0.67), "deaths.csv": (1, 0.83), "codes.csv": (1, 0.75)}
    assert [r.consistent for r in done.consistency().orderBy("dataset_id").collect()] == [True, False, False]


def test_folder_run_without_proposal(spark, folder):
    where = folder(a="Zilla,Pass Rate\nKota,90%\nPune,80%\n", b="Dist,Census Year\nKota,2001\nPune,2011\n", bad=b"x\n\xff\n")
    done = harmonize_folder(spark, where)
    assert done.schema.column_mappings == {"district": ["Dist", "Zilla"], "year": ["Census Year"], "pass_rate": ["Pass Rate"]}
    assert done.frames["b.csv"].columns == ["district", "year"]
    record = {r.dataset_id: r for r in done.stats.collect()}["b.csv"]
    assert record.temporal.range_str == "2001-2011" and record.spatial.districts == ["Kota", "Pune"]
    sheet = {r.dataset_id: json.loads(r.facts) for r in done.facts().collect()}["b.csv"]
    assert (sheet["columns"], sheet["temporal_range"], sheet["sample_locations"]) == (["district", "year"], "2001-2011", ["Kota", "Pune"])
    assert sorted(json.loads(r)["district"] for r in sheet["sample_rows"]) == ["Kota", "Pune"]
    assert tuple(done.summary().first()) == (2, 3)
    titles = {r.dataset_id: r.name for r in done.names().collect()}
    assert titles == {"a.csv": "government_dataset_acsv", "b.csv": "government_dataset_bcsv"}


def test_identical_layouts_merge(spark):
    a = spark.createDataFrame([("1", "x")], "Id STRING, Name STRING")
    b = spark.createDataFrame([("y", "2"), ("z", "3")], "NAME STRING, ID STRING")
    schema = UnifiedSchema({"id": ["Id"], "name": ["Name"]}, {"id": "integer", "name": "string"})
    done = harmonize({"a": a, "b": b}, schema.to_json())
    assert all(r.consistent for r in done.consistency().collect())
    assert sorted(map(tuple, done.merged().collect())) == [(1, "x", "a"), (2, "y", "b"), (3, "z", "b")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "x, y")], "id BIGINT, v STRING")
    out = str(tmp_path / "out")
    assert sinks.write_datasets({"a": df, "b": df}, out, {"a": "first"}, fmt="csv") == {"a": "ok", "b": "ok"}
    assert sinks.write_datasets({"b": df, "c": df}, out, fmt="csv")["b"].startswith("skipped")
    assert [tuple(r) for r in spark.read.option("header", True).csv(f"{out}/first").collect()] == [("1", "x, y")]
    sinks.write_schema(spark, SCHEMA, str(tmp_path / "schema"))
    standards = sinks.read_schema(spark, str(tmp_path / "schema")).select(F.map_keys("column_mappings").alias("k")).first().k
    assert standards == list(SCHEMA.column_mappings)


def test_stream_equals_batch(spark, tmp_path):
    raw = spark.createDataFrame([("1,0", " Kota "), ("NA", "x"), ("-", ""), ("3", "y")], "Deaths STRING, Dist STRING")
    raw.write.parquet(str(tmp_path / "in"))
    prof = clean.profile(raw)
    batch = conform.conform(clean.apply_profile(raw, prof), SCHEMA)
    stream = conform_stream(spark.readStream.schema(raw.schema).parquet(str(tmp_path / "in")), prof, SCHEMA, batch.mapping)
    query = (stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state"))
             .trigger(availableNow=True).start(str(tmp_path / "out")))
    query.awaitTermination(120)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.columns == batch.df.columns == ["district", "deaths"]
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, batch.df.collect()), key=repr)

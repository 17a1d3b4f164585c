"""Many files in one scan: against the same files one by one."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from sheafline.operators import merge, naming, pages, tables
from sheafline.operators.clean import CleanOptions
from sheafline.operators.unify import UnifiedSchema
from sheafline.plans.harmonize import harmonize_folder
from sheafline.sources import csv, ledger, sinks

SCHEMA = UnifiedSchema(
    {"id": ["ID", "No"], "district": ["Dist", "Zilla"], "amount": ["Amount", "Amt"], "year": ["Census Year"], "flag": ["Flag"], "note": ["Note", "Remark"]},
    {"id": "integer", "district": "string", "amount": "float", "year": "integer", "flag": "string", "note": "string"}).to_json()


def cells(i, k):
    """A dirty row of file i."""
    return [str(10 * i + k), ["Kota", " Pune  City ", "Total", "", "NA", f"District {k}"][k % 6],
            ["$1,200.50", "7", "unknown", "-", "3.25", "₹ 9"][(i + k) % 6], ["2001", "2011", "n/a"][k % 3], ["True", "false"][k % 2],
            ['"a, ""b"""', "x", "  ", "12"][(i * 7 + k) % 4]]


def write(folder, count, extra=False):
    heads = [["ID", "Dist", "Amount", "Census Year", "Flag", "Note"], ["No", "Zilla", "Amt"], ["id", "dist", "amt", "census_year", "FLAG", "remark", "Void"],
             ["Amount", "ID"], ["Dist"], ["Note", "note", "Flag"]]
    for i in range(count):
        head = heads[i % len(heads)]
        order = {"amount": 2, "amt": 2, "id": 0, "no": 0, "dist": 1, "zilla": 1, "census year": 3, "census_year": 3, "flag": 4, "note": 5, "remark": 5}
        rows = [",".join(cells(i, k)[order[h.lower()]] if h.lower() in order else "" for h in head) for k in range(8)]
        if extra:
            rows += [rows[0] + ",", rows[0] + ",surplus", "," * (len(head) - 1), rows[1] + ",,surplus"]
        (folder / f"f{i:03d}.csv").write_text(",".join(head) + "\n" + "\n".join(rows) + "\n")


def jobs(spark, run):
    """What `run` returns, and the number of jobs it starts, whatever thread starts them."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    spark.range(1).count()
    first = max(tracker.getJobIdsForGroup(None) or [0])
    out = run()
    spark.range(1).count()
    return out, max(tracker.getJobIdsForGroup(None)) - first


def test_one_scan_equals_the_files(spark, tmp_path):
    write(tmp_path, 6, extra=True)
    for options in (CleanOptions(infer=True, nullable_ints=False, indic_digits=True), CleanOptions()):
        done = harmonize_folder(spark, str(tmp_path), options, proposal=SCHEMA)
        together = done.merged(allow_missing=True)
        apart = merge.merge_union(dict(done.frames), allow_missing=True)
        assert sorted(together.columns) == sorted(apart.columns) and dict(together.dtypes) == dict(apart.dtypes)
        columns = together.columns
        assert sorted(map(tuple, together.select(columns).collect()), key=repr) == sorted(map(tuple, apart.select(columns).collect()), key=repr)
        with pytest.raises(ValueError):
            done.merged()
        counts = {r.dataset_id: r.row_count for r in done.datasets.collect()}
        assert counts == {name: df.count() for name, df in done.frames.items()}
        sheet = {r.dataset_id: json.loads(r.facts) for r in done.facts().collect()}
        for name, df in done.frames.items():
            rows = {r.j for r in df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("j")).collect()}
            assert len(sheet[name]["sample_rows"]) == 2 and set(sheet[name]["sample_rows"]) <= rows


def test_salted_facts_give_the_same(spark, tmp_path, monkeypatch):
    write(tmp_path, 6)
    want = harmonize_folder(spark, str(tmp_path), proposal=SCHEMA)
    monkeypatch.setattr(tables, "BROADCAST", -1)
    got = harmonize_folder(spark, str(tmp_path), proposal=SCHEMA)
    rows = lambda d: sorted(map(tuple, d.merged(True).collect()), key=repr)
    assert rows(got) == rows(want) and sorted(map(tuple, got.stats.collect())) == sorted(map(tuple, want.stats.collect()))


def test_jobs_and_plan_do_not_grow_with_the_files(spark, tmp_path):
    seen = []
    for count in (6, 300):
        (tmp_path / str(count)).mkdir()
        write(tmp_path / str(count), count)
        begin = time.monotonic()
        done, started = jobs(spark, lambda: harmonize_folder(spark, str(tmp_path / str(count)), proposal=SCHEMA))
        merged = done.merged(allow_missing=True)
        assert len(done.profiles) == count and merged.count() == sum(p.rows for p in done.profiles.values())
        seen.append((started, len(merged._jdf.queryExecution().optimizedPlan().toString().replace("300", "6")), time.monotonic() - begin))
    # a list of more than 32 paths takes a job to look up, and adaptive execution splits joins by size
    assert abs(seen[0][0] - seen[1][0]) <= 4 and abs(seen[0][1] - seen[1][1]) < 200, seen


def test_only_changed_files_are_read_again(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder, 6)
    first = harmonize_folder(spark, str(folder), proposal=SCHEMA, state=str(tmp_path / "s1"))
    write(folder, 7)  # writes all anew: later modification times
    for i in range(5):  # the first five keep their time and size
        old = spark.read.parquet(str(tmp_path / "s1")).where(f"path LIKE '%f{i:03d}.csv'").first().modified
        stamp = round(old.timestamp() * 1000) * 1_000_000
        os.utime(folder / f"f{i:03d}.csv", ns=(stamp, stamp))
    read = []
    plain = csv.Folder.rows
    try:
        csv.Folder.rows = lambda self, only=None: (read.append(set(only)), plain(self, only))[1]
        again = harmonize_folder(spark, str(folder), proposal=SCHEMA, since=str(tmp_path / "s1"), state=str(tmp_path / "s2"))
    finally:
        csv.Folder.rows = plain
    assert read[0] == {"f005.csv", "f006.csv"} and len(first.profiles) == 6
    whole = harmonize_folder(spark, str(folder), proposal=SCHEMA)
    assert again.profiles == whole.profiles
    for part in ("stats", "datasets", "catalog"):
        assert sorted(map(repr, getattr(again, part).collect())) == sorted(map(repr, getattr(whole, part).collect()))
    assert spark.read.parquet(str(tmp_path / "s2")).count() == 7
    other = harmonize_folder(spark, str(folder), CleanOptions(), proposal=SCHEMA, since=str(tmp_path / "s2"))
    assert other.profiles == harmonize_folder(spark, str(folder), CleanOptions(), proposal=SCHEMA).profiles  # other options: nothing is known


def test_refused_rows_and_cells(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ID,Amount,Note\n1,5,x\n2,about 7,y\n3,6,z,surplus\n,,\nx4,8,\nNA,-,--\n5,3.5,w,\n6,1,2,,late\n")
    (tmp_path / "b.csv").write_text("Note\nonly\n")
    done = harmonize_folder(spark, str(tmp_path), CleanOptions(infer=True, numeric_share=0.5), proposal=SCHEMA)
    kept, refused = done.quarantine()
    got = sorted((r.dataset_id, r.pos, r.column, r.raw, r.reason) for r in refused.where("pos >= 0").collect())
    assert got == [("a.csv", 0, "id", "x4", "not an integer"), ("a.csv", 1, "amount", "about 7", "not a number")]
    rows = sorted((r.reason, json.loads(r.raw)) for r in refused.where("pos < 0").collect())
    assert [r for r, _ in rows] == ["no values", "too many fields", "too many fields"] and rows[1][1][:3] == ["3", "6", "z"]
    assert kept.count() + len(rows) == 9 and kept.drop("at").count() == done.merged(True).count()


def test_wide_and_narrow_files(spark, tmp_path):
    (tmp_path / "wide.csv").write_text(",".join(f"h{i}" for i in range(200)) + "\n" + ",".join(str(i) for i in range(200)) + "\n")
    (tmp_path / "narrow.csv").write_text('a,b\n1,"two\nlines"\n')
    (tmp_path / "flat.csv").write_text("a,b\n3,4\n")
    done = harmonize_folder(spark, str(tmp_path))
    rows = {r.dataset_id: r for r in done.merged(allow_missing=True).collect()}
    assert rows["wide.csv"].h199 == "199" and rows["flat.csv"].a == "3" and rows["narrow.csv"].b == "two lines"


def test_everything_is_written(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write(tmp_path / "in", 6)
    done = harmonize_folder(spark, str(tmp_path / "in"), proposal=SCHEMA)
    out = str(tmp_path / "out")
    manifest = done.write(out).collect()
    names = {r.dataset_id: r.name for r in manifest}
    assert {r.status for r in manifest} == {"ok"} and set(names) == set(done.frames)
    for dataset in ("f000.csv", "f003.csv"):
        frame = done.frames[dataset]
        back = spark.read.option("header", True).csv(f"{out}/datasets/{names[dataset]}_harmonized")
        assert back.columns == frame.columns and back.count() == frame.count()
        record = json.loads((tmp_path / "out" / "metadata" / f"{names[dataset]}_metadata.json").read_text())
        assert "catalog_info" in record
    assert spark.read.json(f"{out}/catalog").count() == 6 and not (tmp_path / "out" / "merged").exists()


def test_existing_targets_are_skipped(spark, tmp_path):
    folder = str(tmp_path / "t")
    rows = spark.createDataFrame([("a/b.csv", 1, "x"), ("a/b.csv", 2, None), ("c d.csv", 3, "z")], "dataset_id STRING, n INT, v STRING").repartition(3)
    first = sinks.write_tables(rows, folder, {"c d.csv": "c"})
    assert sorted((r.dataset_id, r.status) for r in first.select("dataset_id", "status").distinct().collect()) == [("a/b.csv", "ok"), ("c d.csv", "ok")]
    assert sorted(map(tuple, spark.read.parquet(f"{folder}/a%2Fb.csv").collect())) == [(1, "x"), (2, None)]
    more = rows.unionByName(spark.createDataFrame([("new", 4, "w")], rows.schema))
    again = sinks.write_tables(more, folder, {"c d.csv": "c"})
    assert sorted((r.dataset_id, r.status) for r in again.select("dataset_id", "status").distinct().collect()) == [
        ("a/b.csv", "ok"), ("a/b.csv", "skipped: exists"), ("c d.csv", "ok"), ("c d.csv", "skipped: exists"), ("new", "ok")]
    assert spark.read.parquet(f"{folder}/c").count() == 1


def test_hot_dataset_is_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("d"), (F.col("id") % 50).cast("string"))).alias("dataset_id"), "id", F.col("id").alias("n"))
    manifest = sinks.write_tables(rows, str(tmp_path / "h"), order="id").collect()
    assert sum(r.row_count for r in manifest) == 20_000 and sum(r.dataset_id == "hot" for r in manifest) > 3
    assert spark.read.parquet(str(tmp_path / "h" / "hot")).distinct().count() == sum(r.row_count for r in manifest if r.dataset_id == "hot")


def test_names_of_related_slugs_stay(spark, tmp_path):
    folder = str(tmp_path / "ledger")
    items = lambda rows: spark.createDataFrame(rows, "dataset_id STRING, slug STRING")
    assert ledger.read(spark, folder) is None
    ledger.write(naming.stable_names(items([("a", "x"), ("b", "x"), ("c", "x_1"), ("d", "y")]), None), folder)
    first = {r.dataset_id: r.name for r in ledger.read(spark, folder).collect()}
    assert first == {"a": "x", "b": "x_1", "c": "x_1_1", "d": "y"}
    again = naming.stable_names(items([("b", "x"), ("c", "z"), ("e", "x"), ("f", "x_1"), ("g", "y"), ("h", "x_1")]), ledger.read(spark, folder))
    assert {r.dataset_id: (r.name, r.fate) for r in again.collect()} == {
        "a": ("x", "absent"), "d": ("y", "absent"), "b": ("x_1", "kept"), "c": ("z", "renamed"), "e": ("x_2", "new"), "f": ("x_1_1", "new"),
        "g": ("y_1", "new"), "h": ("x_1_2", "new")}
    ledger.write(again, folder)
    assert ledger.versions(folder) == [1, 2] and ledger.read(spark, folder, 1).count() == 4


def test_pages_of_datasets(spark):
    page = lambda title, *links: f"<title>{title}</title>" + "".join(f'<a href="{u}">csv</a>' for u in links)
    table = spark.createDataFrame([(1, "u", page("One", "/f/a.csv", "/f/b.csv?x=1")), (2, "u", page("Two", "/g/A.CSV")), (3, "u", None)], "page_id INT, url STRING, html STRING")
    files = spark.createDataFrame([("x/one_2.csv",), ("a.csv",), ("b.csv",), ("none.csv",), ("two_1.csv",)], "dataset_id STRING")
    got = {r.dataset_id: (r.page_id, r.how, r.status) for r in pages.dataset_pages(files, table).collect()}
    assert got == {"x/one_2.csv": (1, "file_name", "matched"), "a.csv": (None, "url", "ambiguous"), "b.csv": (1, "url", "matched"),
                   "none.csv": (None, None, "no page"), "two_1.csv": (2, "file_name", "matched")}
    assert {r.dataset_id: r.title for r in pages.dataset_context(files, table).collect()} == {"x/one_2.csv": "One", "b.csv": "One", "two_1.csv": "Two"}

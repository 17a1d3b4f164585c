"""Expressions: text, numbers, similarity, HTML."""

import random
from urllib.parse import urljoin

import brute
from html import unescape

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafline.functions import html, numbers, similarity, text
from sheafline.functions.bind import bind
from sheafline.functions.names import tidy_name, unique_names


def test_clean_cell(one):
    cells = ["  a \t b c ", " ", "", None, "a\x1cb", "x\r\ny", "\x00", "a\x00b", "plain"]
    assert one(text.clean_cell, *cells) == ["a b c", None, None, None, "a b", "x y", "", "ab", "plain"]


def test_null_flags_are_exact(one):
    assert one(text.flag_nulls, "NA", "Na", "n/a", "-", "--", ".", "missing", "MISSING", "", None) == [
        None, "Na", None, None, "--", None, None, "MISSING", None, None]


def test_normal_name(one):
    assert one(text.normal_name, " District_Name (Total) ", "राज्य", "___", "Temp°C", "a\tb") == [
        "districtnametotal", "रजय", "", "tempc", "a\tb"]


def test_slug(one):
    long = " ".join(["word"] * 40)
    got = one(text.slug, "District-wise Census - 2023", "हिन्दी", "  __x__ ", "a b", long, "x" * 120, None)
    assert got[:4] == ["districtwise_census_2023", "", "x", "a_b"][:2] + ["x", "a_b"]
    assert got[4] == "_".join(["word"] * 20) and got[5] == "x" * 100 and got[6] is None


def test_slug_is_idempotent_and_safe(one):
    rnd = random.Random(3)
    titles = ["".join(rnd.choice("aB9 _-éक%\t") for _ in range(rnd.randint(0, 160))) for _ in range(200)]
    first = one(text.slug, *titles)
    assert all(set(s) <= set("abcdefghijklmnopqrstuvwxyz0123456789_") and len(s) <= 100 for s in first)
    assert one(text.slug, *[s.replace("_", " ") for s in first]) == first


def test_number_grammar(one):
    yes = ["1", "-1.5", "+.5", "1.", "1e5", "1,23,456", "$ 5", "₹7.50"]
    no = ["", "1d", "0x1p3", "1_000", "१२", "inf", "1 2", "a", "."]
    assert one(numbers.looks_numeric, *yes) == [True] * len(yes)
    assert one(numbers.looks_numeric, *no) == [False] * len(no)


def test_extract(one):
    cells = ["1,234", "$ 5", "1e5", "007", "2.50", "1.5e3", "99999999999999999999", "x", None, "1 2"]
    assert one(numbers.extract_int, *cells) == [1234, 5, None, 7, None, None, None, None, None, 12]
    assert one(numbers.extract_float, *cells) == [None, None, None, None, 2.5, 1500.0, None, None, None, None]


def test_parse_cells_agrees_with_single_expressions(spark):
    rnd = random.Random(5)
    cells = ["".join(rnd.choice("01.,$₹ eE+-x") for _ in range(rnd.randint(1, 7))) for _ in range(400)]
    cells = [" ".join(c.split()) or None for c in cells]
    df = spark.createDataFrame([(c,) for c in cells], "v STRING")
    v = F.col("v")
    rows = numbers.parse_cells(df, {"t": "v"}).select(
        "*", numbers.looks_numeric(v).alias("hit"), numbers.extract_int(v).alias("whole"),
        numbers.extract_float(v).alias("point"), numbers.coerce_double(v, T.StringType()).alias("plain")).collect()
    for r in rows:
        assert (r.t_hit, r.t_int, r.t_point, r.t_plain) == (r.hit, r.whole, r.point, r.plain), r.v


def test_float_text_is_shortest_decimal(spark):
    values = [3792.0, 1e7, 1.5e16, 1e16, 123456789012.25, 1e-4, 0.00012345678901234567, 1.5e-5, -2.5, 0.0, 9.99e22, 1e300]
    rows = spark.createDataFrame([(v,) for v in values], "v DOUBLE").select("v", numbers.float_text(F.col("v")).alias("t"))
    assert [(r.v, r.t) for r in rows.collect()] == [(v, repr(v)) for v in values]


def test_half_even(spark):
    values = [0.875, 0.125, 0.375, 0.995, 0.99714, 0.575]
    rows = spark.createDataFrame([(v,) for v in values], "v DOUBLE").select(numbers.half_even(F.col("v")).alias("r"))
    assert [r.r for r in rows.collect()] == [0.88, 0.12, 0.38, 1.0 if round(99.5) == 100 else 0.99, 1.0, 0.57]


def test_similarity_against_plain_table(spark):
    rnd = random.Random(1)
    pairs = [("dist", "district"), ("districtname", "district"), ("mcount", "count"), ("opdvisits", "ipdvisits"),
             ("categoryhindi", "category"), ("year", "yr"), ("zilla", "district"), ("", ""), ("", "a"), ("रजय", "रज")]
    for low, high, letters, n in ((0, 20, "abcd", 400), (55, 80, "ab", 25)):
        pairs += [tuple("".join(rnd.choice(letters) for _ in range(rnd.randint(low, high))) for _ in "ab") for _ in range(n)]
    df = spark.createDataFrame(pairs, "a STRING, b STRING")
    a, b = F.col("a"), F.col("b")
    rows = df.select("a", "b", similarity.similarity(a, b).alias("s"), similarity.similarity(b, a).alias("t"),
                     similarity.similarity(a, b, similarity.char_masks(a)).alias("u")).collect()
    assert all(r.s == r.t == r.u == brute.similarity(r.a, r.b) for r in rows)
    assert [r.s for r in rows[:7]] == [67, 80, 91, 89, 76, 67, 15]


def test_bind_runs_once(spark):
    got = spark.range(50).select(bind(F.rand(), lambda v: v - v).alias("zero")).agg(F.sum(F.abs("zero"))).first()[0]
    assert got == 0


def test_names():
    assert tidy_name("  a \n b ") == "a b"
    assert unique_names(["a", "b", "a", "A", "a_1"]) == ["a", "b", "a_2", "A_3", "a_1"]
    with pytest.raises(ValueError):
        unique_names(["a", "a"], "error")


def test_entities(one):
    cells = ["a &amp;lt; b", "&#2325;&#x915;", "&middot;&copy;", "&unknown; & x", "none", "&vert;", "&#000000065;&#x0000000041;", "&amp B &ampc &notit; &copy",
             "&#0;&#xD800;&#99999999999;&#x110000;", "&", "&am", "&#65 &#x41z", None]
    assert one(html.decode_entities, *cells) == [None if c is None else unescape(c) for c in cells]


def test_absolute_url(one):
    base = "https://data.gov.in"
    links = ["/a/b.csv", "a/b.csv", "//h/x.csv", "?q=1", "#f", "http://x/y", "mailto:a@b", "/a/../b/./c.csv", "/a//b.csv", "dir/", "/x?y=/../z", "a//b.csv", "../c.csv", "./d/..", ""]
    assert one(lambda c: html.absolute_url(c, base), *links) == [urljoin(base, href) for href in links]


def test_labelled_value(one):
    pages = ["<tr><th>Ministry</th><td> Health &amp; <b>Care</b></td></tr>",
             "<div><label>Ministry:</label><span>Roads</span></div>",
             "<li><span>Ministry</span>: Rail</li>",
             "<div><span><b>Ministry</b> name</span> <p>Farms</p></div>",
             "<div>Ministry</div>", "<p>Ministry of nothing</p>", "<div><span>Ministry:</span> ab</div>",
             "<div><span>" + "<i>" * 300 + "Ministry" + "</i>" * 300 + "</span><div>a<div>b</div>c</div></div>",
             "<tr><th>x Ministry</th><td>o<table><tr><td>in</td></tr></table>ut</td></tr>", "<div><span>" + "Ministr " * 20_000 + "Ministry</span><b>v</b></div>"]
    assert one(lambda c: html.labelled_value(c, "Ministry"), *pages) == [
        "Health & Care", "Roads", "Rail", "Farms", None, None, None, "abc", "oinut", "v"]

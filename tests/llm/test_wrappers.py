"""Main text of pages: given tables against their markup, made-up templates against their parts, and corner cases."""

import html
import json
import re

from sheafline.llm import wrappers
from sheafline.llm.markup import decoded, parse
from sheafline.llm.queries import op8_html_extraction


def plain(page):
    """Blocks of the one article of a page of the given tables, by regular expressions."""
    inside = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
    return "\n\n".join(b for b in blocks if b)


def test_query_matches_markup(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = op8_html_extraction(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        assert (r.text, r.url, r.n_chars) == (plain(pages[r.page_id].html), pages[r.page_id].url, len(r.text))


def page(i, paragraphs, menu=3, extra="", comments=2, body="div"):
    items = "".join(f"<li><a href=/{k}>Go {k} {i}</a>" for k in range(menu))
    notes = "".join(f"<div class='comment c{k}'><p>I like {i} {k}</p></div>" for k in range(comments))
    text = "".join(f"<p>{p}" for p in paragraphs)
    return f"""<!doctype html><html><head><title>T{i}</title><script>if (1 < 2) document.write("<p>no</p>")</script></head><body>
      <header><h2>Site</h2><ul>{items}</ul></header><div id="wrap"><div class="cookie-notice">We use cookies</div>
      <{body} class="text"><h1>Title {i}</h1>{extra}{text}<blockquote>Follow us on the site</blockquote></{body}>
      <div class="sidebar"><p>Most read {i}</div><form><p>Mail <input name=x></form><section id=comments>{notes}</section></div>
      <footer>Foot {i}</footer></body></html>"""


def test_wrapper_of_a_template_without_article():
    bodies = [[f"First {i} of <b>many</b> words here &amp; there", f"Second{i}  with\n space<br>and a break"][:1 + i % 2] for i in range(8)]
    pages = [page(i, b, menu=1 + i % 4, comments=i % 3, extra="<p class=promo>Buy now</p>" if i % 2 else "") for i, b in enumerate(bodies)]
    wrapper = wrappers.infer(pages[:6])
    for i in range(8):
        want = [f"Title {i}", f"First {i} of many words here & there", f"Second{i} with space and a break"][:2 + i % 2]
        assert wrappers.main_text(pages[i], wrapper) == "\n\n".join(want), i


def test_inference_generalizes_without_choices():
    wrapper = wrappers.infer(["<div><i>a</i><p>x</p><dl><dt>k<dd>v</dl></div>", "<div><p>y</p><p>z</p><hr><dl><dt>k<dd>w<dt>m<dd>u</dl></div>"])
    (div,) = wrapper["k"]
    assert [(k["l"], k["q"]) for k in div["k"]] == [("#text", "?"), ("p", "+"), ("hr", "?"), ("dl", "1")]
    assert div["k"][1]["k"][0]["t"] is None
    folded = wrappers.infer(["<dl><dt>k<dd>v<dt>k<dd>w</dl>"])["k"][0]["k"]
    assert [(k["l"], k["q"]) for k in folded] == [("dt dd", "+")]


def test_markup_corner_cases():
    assert decoded(" a&nbsp;b &lt;c&gt; &#8364; &amp \n d ") == "a b <c> € & d"
    assert wrappers.main_text('<article><p title="a > b">one<!-- no <p> --><p>two <script>"</p>"</script>&am</article>', None) == "one\n\ntwo &am"
    assert wrappers.main_text("a < b and c <3 d", None) == "a < b and c <3 d"
    assert wrappers.main_text('<p>x<a href="unclosed>y</p><p>z', None) == "xy\n\nz"
    assert wrappers.main_text("<article><header><h1>T</h1></header><p>x</p><footer>f</footer></article><aside>no</aside>", None) == "T\n\nx"
    deep = "<div>" * 20_000 + "in" + "</div>" * 20_000
    assert wrappers.main_text(deep, wrappers.infer([deep])) == "in"
    assert len(parse("<b>" * 5_000 + "<p>" * 5_000).children) == 1


def test_odd_tables(spark):
    long = "<article>" + "<p>word</p>" * 50_000 + "</article>"
    rows = [(1, "http://h/x", None, 1), (2, None, "", 2), (3, "http://h/y", "<article>a</article>", 3), (3, "http://h/y", "<article>a</article>", 3),
            (None, "no host", "<p>b", 4), (4, "http://h/z", long, 5)]
    got = wrappers.extract(spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING, host INT")).collect()
    assert sorted(((r.page_id, r.text[:9], r.n_chars) for r in got), key=repr) == sorted(
        [(1, "", 0), (2, "", 0), (3, "a", 1), (3, "a", 1), (None, "b", 1), (4, "word\n\nwor", 6 * 50_000 - 2)], key=repr)
    assert wrappers.extract(spark.createDataFrame([], "page_id LONG, url STRING, html STRING")).collect() == []


def hosted(spark, pages, host="h"):
    return spark.createDataFrame([(i, f"http://{host}/{i}", p) for i, p in enumerate(pages)], "page_id LONG, url STRING, html STRING")


def items(node):
    yield node
    for k in node.get("k", ()):
        yield from items(k)


def test_every_page_of_a_host_counts(spark):
    same = [f"<article><h1>T{i}</h1><div class=lead>Same words</div><p>Own {i}</article>" for i in range(200)]
    rare = "<article><h1>T</h1><div class=lead>Other words</div><p>Own</p><table><tr><td>x</table></article>"
    wrapper = json.loads(wrappers.infer_wrappers(hosted(spark, [*same, rare, *same[:50], rare])).first().wrapper)
    (article,) = wrapper["k"]
    assert wrapper["n"] == article["n"] == 201 and [(k["l"], k["q"]) for k in article["k"]] == [("h1", "1"), ("div.lead", "1"), ("p", "1"), ("table", "?")]
    got = {r.page_id: r.text for r in wrappers.extract(hosted(spark, [*same, rare])).collect()}
    assert got == {i: f"T{i}\n\nSame words\n\nOwn {i}" for i in range(200)} | {200: "T\n\nOther words\n\nOwn\n\nx"}
    got = {r.page_id: r.text for r in wrappers.extract(hosted(spark, same)).collect()}
    assert got == {i: f"T{i}\n\nOwn {i}" for i in range(200)}


def test_joining_depends_on_pages_alone(spark, monkeypatch):
    pages = [page(i, [f"Text {i} {k}" for k in range(i % 5)], menu=i % 4, comments=i % 3, extra="<hr>" * (i % 7 == 0)) for i in range(60)]
    several = hosted(spark, pages).union(hosted(spark, pages[:30], "www.h")).union(hosted(spark, pages[:1], ""))
    whole = sorted(wrappers.infer_wrappers(several.coalesce(1)).collect())
    monkeypatch.setattr(wrappers, "SHARE_PAGES", 2)
    monkeypatch.setattr(wrappers, "STEP", 2)
    assert sorted(wrappers.infer_wrappers(several.union(several).repartition(7)).collect()) == whole
    assert [(r.host, json.loads(r.wrapper)["n"]) for r in whole] == [("", 1), ("h", 60), ("www.h", 30)]


def test_main_part_at_two_places():
    text, notes = "<div class=text><p>Text {0} with a number of words in it</p></div>", "<div class=tips><p>Tip {0}</p></div>"
    pages = [f"<body>{notes if i % 2 else text}{text if i % 2 else notes}</body>".replace("{0}", str(i)) for i in range(10)]
    wrapper = wrappers.infer(pages)
    assert [wrappers.main_text(p, wrapper) for p in pages] == [f"Text {i} with a number of words in it" for i in range(10)]


def test_repeats_on_one_page_are_not_the_templates():
    rows = "<article><p>Start</p>" + "<div class=row><p>Yes</p></div>" * 5 + "</article>"
    assert wrappers.main_text(rows, wrappers.infer([rows])) == "\n\n".join(["Start"] + ["Yes"] * 5)


def test_long_mixed_children():
    tags = ["p", "h2", "ul", "pre", "dl", "table"]
    pages = []
    for seed in (7, 11, 13):
        order = [tags[(i * i * seed + i // seed) % 6] for i in range(20_000)]
        pages.append("<article><h1>T</h1>" + "".join(f"<{t} class=c{'abcdef'[i % 6]}>w{i}</{t}>" for i, t in enumerate(order)) + "<div class=end>End</div></article>")
    wrapper = wrappers.infer(pages)
    (article,) = wrapper["k"]
    labels = [k["l"] for k in article["k"]]
    assert (labels[0], labels.count("*"), labels[-1], article["n"]) == ("h1", 1, "div.end", 3) and sum(1 for _ in items(wrapper)) < 200
    assert wrappers.main_text(pages[0], wrapper) == "\n\n".join(["T", *(f"w{i}" for i in range(20_000)), "End"])


def test_very_many_labels():
    names = ["".join("abcdefghij"[int(d)] for d in f"{i:04d}") for i in range(3000)]
    pages = [f"<body>{''.join(f'<div class={n}>a</div>' for n in names[i * 100:i * 100 + 100])}<article><p>Text {i}</article></body>" for i in range(30)]
    wrapper = wrappers.infer(pages)
    assert sum(1 for _ in items(wrapper)) < 100
    assert [wrappers.main_text(p, wrapper) for p in pages] == [f"Text {i}" for i in range(30)]


def test_wrapper_stays_small(monkeypatch):
    monkeypatch.setattr(wrappers, "NODES", 60)
    tags = ["p", "h2", "ul", "pre", "dl", "div class=x", "div class=y"]

    def body(i, depth=0):
        inner = [f"<{tags[(i + k * depth) % 7]}>{body(i * 3 + k, depth + 1) if depth < 3 else f'w{i} '}</{tags[(i + k * depth) % 7].split()[0]}>" for k in range(3)]
        return "".join(inner)

    pages = [f"<div class=top>Top</div><div><section>{body(i)}</section></div><div><main><p>{i}</p></main></div>" for i in range(40)]
    own = [json.dumps(wrappers.of_page(p)) for p in pages]
    _, wrapper = wrappers._joined(enumerate(own))
    assert any("s" in k for k in items(wrapper)) and sum(1 for _ in items(wrapper)) < 100 < sum(1 for _ in items(json.loads(own[0])))
    wrappers._mark(wrapper)
    assert [wrappers.main_text(p, wrapper) for p in pages] == [str(i) for i in range(40)]
    whole = [p.partition("<div><main>")[0].replace("<div>", "<div><main>") for p in pages]
    wrapper = wrappers.infer(whole)
    assert [wrappers.main_text(p, wrapper).split() for p in whole] == [wrappers.main_text(p, None).split() for p in whole]


def words(i, k=""):
    return " ".join([f"Text {i}{k}", *[f"with many words {i}"] * 30])


def extracted(spark, pages):
    got = {r.page_id: r.text for r in wrappers.extract(hosted(spark, pages + pages[:3])).collect()}
    assert [got.pop(len(pages) + k) for k in range(3)] == [got[k] for k in range(3)]
    return got


def test_main_part_among_very_many_parts(spark):
    names = ["".join("abcdefghij"[int(d)] for d in f"{i:03d}") for i in range(1000)]

    def one(i, parts):
        around = [f"<div class={n}>Hint {n} {i}</div>" for n in parts]
        text = f"<div class=zz><h1>T{i}</h1><p>{words(i) * 3}</p><div class=note>Same words</div><p>{words(i, 'b') * 3}</p></div>"
        return "<body>" + "".join(around[:40]) + text + "".join(around[40:]) + "</body>"

    want = {i: f"T{i}\n\n{words(i) * 3}\n\n{words(i, 'b') * 3}" for i in range(30)}
    for parts in (lambda i: names[:20], lambda i: names[:120], lambda i: names[i * 30:i * 30 + 50]):
        pages = [one(i, parts(i)) for i in range(30)]
        assert extracted(spark, pages) == want


def test_template_texts_in_long_mixed_articles(spark):
    def one(i):
        mixed = "".join(f"<{t}>{t}{k} {i}</{t}>" for k in range(60) for t in ("p", "h2", "ul", "pre")[:1 + (k * (i + 1)) % 4])
        return f"<article><h1>T{i}</h1>{mixed}<div class=follow>Read us daily</div>{mixed}<div class=row><p>Yes</p></div><div class=row><p>Yes</p></div></article>"

    pages = [one(i) for i in range(12)]
    got = extracted(spark, pages)
    assert got == {i: "\n\n".join(b for b in plain_blocks(p) if b != "Read us daily") for i, p in enumerate(pages)}


def plain_blocks(page):
    return [b for b in re.split(r"(?:<[^>]+>)+", page) if b]


def test_main_part_below_very_many_elements(spark):
    def one(i):
        notes = "<div class=tips><p>Tip {0}</p></div>".replace("{0}", str(i))
        return "<div>" * 90 + f"{notes}<section class=zz><p>{words(i)}</p><blockquote>Same words</blockquote></section>" + "</div>" * 90

    assert extracted(spark, [one(i) for i in range(10)]) == {i: words(i) for i in range(10)}


def test_main_part_in_slots(spark):
    names = ["".join("abcdefghij"[int(d)] for d in f"{i:03d}") for i in range(7)]

    def body(i, depth):
        own = sorted({(i * (k + 3) + depth * k + i // 7) % 7 for k in range(4)})
        return "".join(f"<div class={names[n]}>{body(i * 5 + n * 3 + depth, depth + 1) if depth < 6 else f'x {i}'}</div>" for n in own)

    pages = [f"<div class=top>{body(i, 0)}</div>{'<div class=deep>' * 8}<div class=tips>Tip {i}</div><section class=zz><p>{words(i, 'a') * 300}</p>"
             f"<p class=follow>Read us daily</p><p>{words(i, 'b') * 300}</p></section>{'</div>' * 8}" for i in range(24)]
    wrapper = json.loads(wrappers.infer_wrappers(hosted(spark, pages)).first().wrapper)
    assert any("s" in k for k in items(wrapper))
    assert extracted(spark, pages) == {i: words(i, "a") * 300 + "\n\n" + words(i, "b") * 300 for i in range(24)}


def test_places_agree_with_whole_wrappers(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html")
    bodies = [page(i, [words(i, k) for k in range(1 + i % 3)], menu=i % 4, comments=i % 3, extra="<p class=promo>Buy now</p>" if i % 2 else "") for i in range(40)]
    article = [page(i, [words(i, k) for k in range(i % 3)], comments=i % 3, body="main") for i in range(40)]
    made = hosted(spark, bodies, "a").union(hosted(spark, article, "b")).union(hosted(spark, bodies[:2], ""))
    for pages in (given, made):
        pages = pages.withColumn("host", wrappers.host_of(pages.url))
        found = wrappers.infer_wrappers(pages)
        assert found.where("NOT whole").isEmpty()
        got = wrappers.by_places(pages, found)
        assert sorted(got.collect()) == sorted(wrappers.extract(pages).collect())

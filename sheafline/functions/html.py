"""HTML expressions: elements, attributes, visible text, labelled values, links.

Meant for label/value markup. Comments, scripts and styles are taken out first (`bare`), then the page is cut once into an
index of tags and texts (`indexed`), which all lookups share. An element ends where the tags of its kind balance, so its text
includes nested elements of the same kind.
"""

from __future__ import annotations

from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .bind import bind
from .text import text_strip

_ENTITY = r"(?s)&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);?|[^&]+|&"
# References that need no semicolon; the longest that fits counts.
_BARE_NAMES = "|".join(sorted((name for name in html5 if not name.endswith(";")), key=lambda n: (-len(n), n)))
# All named references in one text, "\x01name\x02character\x01", from the standard library's table.
_NAMED = "\x01" + "\x01".join(f"{name[:-1]}\x02{char}" for name, char in html5.items() if name.endswith(";")) + "\x01"


def decode_entities(c: Column) -> Column:
    """Character references to characters, each read once (`&amp;lt;` becomes `&lt;`)."""
    common = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": "\xa0"}

    def character(number: Column) -> Column:
        """A code point as text; numbers that are none become U+FFFD."""
        valid = (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd"))

    def numeric(digits: Column, base: int) -> Column:
        short = F.regexp_replace(digits, "^0+(?=.)", "")
        return character(F.when(F.length(short) > 8, F.lit(-1).cast("bigint")).otherwise(F.conv(short, base, 10).cast("bigint")))

    def known(name: Column) -> Column:
        """The characters of a name and the length of the name; NULL for other names."""
        key = F.concat(F.lit("\x01"), name, F.lit("\x02"))

        def find(table: Column) -> Column:
            at = F.call_function("instr", table, key)
            tail = F.substring(table, at + F.length(key), F.lit(8))
            return F.when(at > 0, F.struct(F.substring_index(tail, "\x01", 1).alias("char"), F.length(name).alias("size")))

        return F.when(name != "", bind(F.lit(_NAMED), find))

    def named(body: Column, closed: Column, whole: Column) -> Column:
        # a closed name as a whole, else the longest name in front that needs no semicolon
        tried = F.array(F.when(closed, body), F.regexp_extract(body, f"^(?:{_BARE_NAMES})", 0))
        found = F.get(F.filter(F.transform(tried, known), lambda k: k.isNotNull()), F.lit(0))
        return bind(found, lambda k: F.coalesce(F.concat(k["char"], F.when(closed & (k["size"] == F.length(body)), F.lit("")).otherwise(
            F.substring(whole, k["size"] + 2, F.length(whole)))), whole))

    def token(t: Column) -> Column:
        closed = F.endswith(t, F.lit(";"))
        body = F.substring(t, F.lit(2), F.length(t) - F.when(closed, 2).otherwise(1))
        special = F.when(F.length(t) < 3, t)
        for entity, char in common.items():
            special = special.when(t == entity, F.lit(char))
        special = (
            special.when(body.rlike("^#[xX]"), numeric(F.substring(body, F.lit(3), F.length(body)), 16))
            .when(F.startswith(body, F.lit("#")), numeric(F.substring(body, F.lit(2), F.length(body)), 10))
            .otherwise(named(body, closed, t)))
        return F.when(F.startswith(t, F.lit("&")), special).otherwise(t)

    def decoded(v: Column) -> Column:
        tokens = F.regexp_extract_all(v, F.lit(_ENTITY), F.lit(0))
        return F.when(F.contains(v, F.lit("&")), F.array_join(F.transform(tokens, token), "")).otherwise(v)

    return bind(c, decoded)


def bare(html: Column) -> Column:
    """A page without comments, scripts and styles."""
    return F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>", "")


def visible_text(c: Column) -> Column:
    """Text of a piece of markup: comments, scripts and tags removed, references decoded, stripped."""
    return text_strip(decode_entities(F.regexp_replace(bare(c), "<[^>]+>", "")))


def _match(html: Column, pattern: str) -> Column:
    """The first match, NULL when there is none."""
    return bind(F.regexp_extract(html, pattern, 0), lambda m: F.when(m != "", m))


def _value(attr: str, value: str) -> str:
    return rf"""\s{attr}\s*=\s*(?:"{value}"|'{value}'|{value}(?=[\s>/]))"""


# ---- index of a page -----------------------------------------------------------------------------

_HOLDERS = ("th", "label", "div", "span")
_VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
_MARKED = ("h1", "div", "meta")  # kinds that are looked up by an attribute


def indexed(html: Column, use: Callable[[Column], Column]) -> Column:
    """`use(index)` of a page without comments, scripts and styles, which is cut into tags and the texts between them once.

    The index: `html`, `low` (in lower case), `tags` in page order, `texts` (one more than tags: text k stands before tag k),
    `kinds` (`div`, `/div`), `marks` (place, kind and source of the tags that are looked up by an attribute), `holders` (places
    of the tags that hold labels, opening and closing). Lookups work on these arrays; none goes through the page again.
    """
    def kind(tag: Column) -> Column:
        return F.lower(F.regexp_extract(tag, r"^<(/?[A-Za-z][^\s/>]*)", 1))

    def cut(page: Column) -> Column:
        tags = F.regexp_extract_all(page, F.lit("<[^>]+>"), F.lit(0))
        return F.struct(page.alias("html"), F.lower(page).alias("low"), tags.alias("tags"), F.split(page, "<[^>]+>", -1).alias("texts"))

    def known(c: Column) -> Column:
        return F.struct(c["html"].alias("html"), c["low"].alias("low"), c["tags"].alias("tags"), c["texts"].alias("texts"), F.transform(c["tags"], kind).alias("kinds"))

    def listed(c: Column) -> Column:
        placed = F.transform(c["kinds"], lambda k, i: F.struct(i.alias("at"), k.alias("kind")))
        marks = F.transform(F.filter(placed, lambda m: m["kind"].isin(*_MARKED)), lambda m: F.struct(m["at"], m["kind"], F.get(c["tags"], m["at"]).alias("tag")))
        holders = F.transform(F.filter(placed, lambda m: m["kind"].isin(*_HOLDERS, *["/" + h for h in _HOLDERS])), lambda m: m["at"])
        return F.struct(*[c[f] for f in ("html", "low", "tags", "texts", "kinds")], marks.alias("marks"), holders.alias("holders"))

    return bind(bind(bind(bind(bare(html), cut), known), listed), use)


def _joined(page: Column, first: Column, last: Column) -> Column:
    """The texts from number `first` up to `last`."""
    return F.array_join(F.slice(page["texts"], first + 1, F.greatest(last - first + 1, F.lit(0))), "")


def _held(page: Column, at: Column, open_ended: bool) -> Column:
    """Source text, without tags, of the element whose start tag is number `at`: up to the end tag that balances it. Without
    one, all that follows if `open_ended`, else NULL."""
    def read(kind: Column) -> Column:
        later = F.filter(F.sequence(at + 1, F.greatest(F.size(page["tags"]) - 1, at + 1)),
                         lambda j: (F.get(page["kinds"], j) == kind) | (F.get(page["kinds"], j) == F.concat(F.lit("/"), kind)))
        change = lambda j: (F.when(F.startswith(F.get(page["kinds"], j), F.lit("/")), -1)
                            .when(F.endswith(F.get(page["tags"], j), F.lit("/>")), 0).otherwise(1))
        begin = F.struct(F.lit(1).alias("depth"), F.lit(-1).alias("end"))
        found = F.aggregate(later, begin, lambda s, j: F.when(s["depth"] == 0, s).otherwise(F.struct((s["depth"] + change(j)).alias("depth"), j.alias("end"))))

        def cut(f: Column) -> Column:
            last = F.when(f["depth"] == 0, f["end"])
            whole = _joined(page, at + 1, F.size(page["tags"])) if open_ended else F.lit(None).cast("string")
            return F.when(last.isNotNull(), _joined(page, at + 1, last)).otherwise(whole)

        return bind(found, cut)

    return bind(F.get(page["kinds"], at), read)


def _marked(page: Column, kind: str, value: str, pattern: str, read: Callable[[Column], Column]) -> Column:
    """`read` of the first marked tag of a kind that matches; NULL when there is none. Pages that nowhere have the value
    are done at once."""
    found = F.get(F.filter(page["marks"], lambda m: (m["kind"] == kind) & m["tag"].rlike(pattern)), F.lit(0))
    return F.when(F.contains(page["low"], F.lit(value.lower())), bind(found, lambda m: F.when(m.isNotNull(), read(m))))


# The lookups return source text; `read` decodes it. A page's expression holds one decoding for all its lookups, as the table of
# named references makes each one large.

def read(source: Column) -> Column:
    """Source text without tags as visible text."""
    return text_strip(decode_entities(source))


def by_id(page: Column, kind: str, value: str) -> Column:
    """Source text of the first element of this kind with this id; NULL when absent."""
    return _marked(page, kind, value, rf"(?is)^<[^>]*{_value('id', value)}", lambda m: _held(page, m["at"], True))


def by_class(page: Column, kind: str, value: str) -> Column:
    """Source text of the first element of this kind whose class list holds `value`; NULL when absent."""
    quoted = rf"""\sclass\s*=\s*(?:"(?:[^"]*\s)?{value}(?:\s[^"]*)?"|'(?:[^']*\s)?{value}(?:\s[^']*)?'|{value}(?=[\s>]))"""
    return _marked(page, kind, value, rf"(?is)^<[^>]*{quoted}", lambda m: _held(page, m["at"], True))


def meta(page: Column, attr: str, value: str) -> Column:
    """Source of the content of the first `<meta attr="value">`; '' without content, NULL without the tag."""
    return _marked(page, "meta", value, rf"(?is)^<[^>]*{_value(attr, value)}", lambda m: F.coalesce(raw_attribute(m["tag"], "content"), F.lit("")))


def title_of(page: Column) -> Column:
    """Source of the text of `<title>`; NULL without one."""
    found = _match(page["html"], r"(?is)<title\b[^>]*>.*?</title\s*>")
    return F.when(F.contains(page["low"], F.lit("<title")), F.regexp_replace(found, r"(?is)^<title\b[^>]*>|</title\s*>$", ""))


def beside(page: Column, labels: list[str], before: Column | None = None) -> Column:
    """The first value next to one of `labels`, tried in order: next to the first innermost th/label/div/span that holds the
    label text. `before` is the source of a value that comes first if there is one.

    It is the text of the holder's next sibling element or, for a holder without one, the rest of its parent's text when
    that is longer than two characters. NULL when nothing is found.
    """
    def around(j: Column) -> Column:
        """The holder of text number j: places of its start and end tag, NULL if the nearest tags are no such pair."""
        start = F.element_at(F.filter(page["holders"], lambda h: h < j), -1)
        end = F.get(F.filter(page["holders"], lambda h: h >= j), F.lit(0))
        pair = F.get(page["kinds"], end) == F.concat(F.lit("/"), F.get(page["kinds"], start))
        return F.when(pair, F.struct(start.alias("start"), end.alias("end")))

    def sources(h: Column, label: Column) -> Column:
        """STRUCT<parts, label>: the sibling's text, or the three parts of the parent's with the label to take out."""
        following = F.get(page["kinds"], h["end"] + 1)
        element = following.rlike("^[a-z][a-z0-9]*$") & ~following.isin(*_VOID)
        parent = F.get(page["kinds"], F.when(h["start"] > 0, h["start"] - 1)).isin("div", "li") & following.isin("/div", "/li")
        own = F.array(F.get(page["texts"], h["start"]), _joined(page, h["start"] + 1, h["end"]), F.get(page["texts"], h["end"] + 1))
        sibling = F.when(element, F.array(_held(page, h["end"] + 1, False)))
        return F.struct(F.when(element, sibling).when(parent, own).alias("parts"), F.when(~element, label).alias("label"))

    def found(label: Column) -> Column:
        runs = F.filter(F.transform(page["texts"], lambda t, i: F.when(F.contains(t, label), i)), lambda i: i.isNotNull())
        first = F.get(F.filter(F.transform(runs, around), lambda h: h.isNotNull()), F.lit(0))
        return F.when(F.contains(page["html"], label), bind(first, lambda h: F.when(h.isNotNull(), sources(h, label))))

    def value(c: Column) -> Column:
        def rest(whole: Column) -> Column:
            own = text_strip(F.replace(F.replace(whole, c["label"], F.lit("")), F.lit(":"), F.lit("")))
            return F.when(c["label"].isNull(), whole).otherwise(bind(own, lambda o: F.when(F.length(o) > 2, o)))

        whole = F.when(~F.exists(c["parts"], lambda p: p.isNull()), F.array_join(F.transform(c["parts"], read), ""))
        return bind(whole, rest)

    tried = F.transform(F.array(*map(F.lit, labels)), found)
    if before is not None:
        head = F.struct(F.array(before).alias("parts"), F.lit(None).cast("string").alias("label"))
        tried = F.concat(F.array(head), tried)
    return F.get(F.filter(F.transform(tried, value), lambda v: v.isNotNull()), F.lit(0))


def labelled_value(html: Column, label: str) -> Column:
    """`beside` of a single label on a page."""
    return indexed(html, lambda page: beside(page, [label]))


def raw_attribute(tag: Column, name: str) -> Column:
    """Source of an attribute of a single tag; NULL when the tag has no such attribute."""
    found = _match(tag, rf"""(?is)\s{name}\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)""")
    raw = F.regexp_replace(found, rf"(?is)^\s{name}\s*=\s*", "")
    return F.regexp_replace(raw, r"""(?s)^(["'])(.*)\1$""", "$2")


def attribute(tag: Column, name: str) -> Column:
    """Decoded attribute of a single tag's source; NULL when the tag has no such attribute."""
    return decode_entities(raw_attribute(tag, name))


def links(html: Column) -> Column:
    """ARRAY<STRUCT<href, text>> of all anchors with an href."""
    anchors = F.regexp_extract_all(html, F.lit(r"(?is)<a\b[^>]*\shref\s*=[^>]*>.*?</a\s*>"), F.lit(0))
    return F.transform(anchors, lambda a: F.struct(
        attribute(F.regexp_extract(a, r"(?s)^<[^>]*>", 0), "href").alias("href"),
        visible_text(a).alias("text")))


def absolute_url(href: Column, base: str) -> Column:
    """A link as an absolute URL on the site `base` (scheme and host, without a path)."""
    scheme = base.split(":", 1)[0]
    path = F.regexp_extract(href, r"^[^?#]*", 0)
    rest = F.substring(href, F.length(path) + 1, F.length(href))
    rooted = F.startswith(path, F.lit("/"))
    steps = F.split(F.regexp_replace(path, r"^/", ""), "/")
    # Empty steps inside a relative path vanish; a rooted path keeps them.
    named = F.filter(steps, lambda s, i: rooted | (s != "") | (i == F.size(steps) - 1))

    def walk(done: Column, step: Column) -> Column:
        return (F.when(step == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
                .when(step == ".", done).otherwise(F.array_append(done, step)))

    kept = F.aggregate(named, F.array().cast("array<string>"), walk)
    closing = F.when(path.rlike(r"(^|/)\.{1,2}$") & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit(""))
    on_site = F.concat(F.lit(base + "/"), F.array_join(kept, "/"), closing, rest)
    return (F.when(F.startswith(href, F.lit("http")) | href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
            .when(F.startswith(href, F.lit("//")), F.concat(F.lit(scheme + ":"), href))
            .when(path == "", F.concat(F.lit(base), rest))
            .otherwise(on_site))

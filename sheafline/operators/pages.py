"""Metadata and resource links from a table of web pages (`page_id, url, html`)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import defaults
from ..functions import html as h
from ..functions import text
from ..functions.bind import bind


def title(html: Column) -> Column:
    """h1#title, h1.node-title, h1.title, og:title, `<title>` before `|`, else a fixed text."""
    return h.indexed(html, _title)


def _title(page: Column) -> Column:
    heading = F.coalesce(h.by_id(page, "h1", "title"), h.by_class(page, "h1", "node-title"), h.by_class(page, "h1", "title"),
                         h.meta(page, "property", "og:title"))
    source = bind(heading, lambda c: F.struct(F.coalesce(c, h.title_of(page)).alias("text"), c.isNull().alias("plain")))
    shown = bind(source, lambda c: bind(h.decode_entities(c["text"]), lambda t: F.when(c["plain"], F.substring_index(t, "|", 1)).otherwise(t)))
    return F.coalesce(text.text_strip(shown), F.lit(defaults.UNKNOWN_TITLE))


def description(html: Column) -> Column:
    return h.indexed(html, _description)


def _description(page: Column) -> Column:
    return F.coalesce(h.read(F.coalesce(
        h.by_class(page, "div", "field-name-body"), h.by_class(page, "div", "notes"),
        h.meta(page, "property", "og:description"), h.meta(page, "name", "description"))), F.lit(""))


def label_value(html: Column, labels: list[str]) -> Column:
    """The value of the first label that has one."""
    return h.indexed(html, lambda page: h.beside(page, labels))


def ministry(html: Column, labels=None) -> Column:
    return h.indexed(html, lambda page: _ministry(page, labels))


def _ministry(page: Column, labels=None) -> Column:
    return h.beside(page, labels or defaults.MINISTRY_LABELS, h.by_class(page, "div", "og-group-ref"))


def sector(html: Column, labels=None) -> Column:
    return label_value(html, labels or defaults.SECTOR_LABELS)


def page_record(html: Column) -> Column:
    """STRUCT<title, description, ministry, sector>, all read off one index of the page."""
    return h.indexed(html, lambda page: F.struct(_title(page).alias("title"), _description(page).alias("description"), _ministry(page).alias("ministry"),
                                                 h.beside(page, defaults.SECTOR_LABELS).alias("sector")))


def page_metadata(pages: DataFrame, portal: str = defaults.PORTAL_NAME) -> DataFrame:
    """One record per page with its provenance; projections without a shuffle."""
    return pages.select(
        "page_id", F.col("url").alias("scraped_url"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("scraped_timestamp"),
        F.lit(portal).alias("source_portal"), F.inline(F.array(page_record(F.col("html")))))


def page_links(pages: DataFrame, keyword: str = defaults.LINK_KEYWORD,
               base: str = defaults.PORTAL_BASE) -> DataFrame:
    """Distinct (page_id, url) of links that mention the keyword in target or text."""
    return _wanted_links(pages.select("page_id", "html"), keyword, base).select("page_id", "url")


def _wanted_links(pages: DataFrame, keyword: str, base: str) -> DataFrame:
    # Distinct within the page: the array never leaves its row, so nothing is shuffled.
    wanted = F.filter(h.links(h.bare(F.col("html"))), lambda a:
                      F.contains(F.lower(a["href"]), F.lit(keyword)) | F.contains(F.lower(a["text"]), F.lit(keyword)))
    urls = F.array_distinct(F.transform(wanted, lambda a: h.absolute_url(a["href"], base)))
    rest = [c for c in pages.columns if c != "html"]
    return pages.select(*rest, F.posexplode(F.array_sort(urls)).alias("pos", "url"))


def safe_title(c: Column, max_chars: int = defaults.RESOURCE_NAME_CHARS) -> Column:
    kept = F.trim(F.regexp_replace(c, r"[^\p{L}\p{N} _\-]", ""))
    return F.substring(F.lower(F.replace(kept, F.lit(" "), F.lit("_"))), 1, max_chars)


def page_resources(pages: DataFrame, keyword: str = defaults.LINK_KEYWORD,
                   base: str = defaults.PORTAL_BASE, per_page: int = defaults.LINKS_PER_PAGE) -> DataFrame:
    """The first links per page in URL order, with the local file name each would get.

    The links of a page are numbered inside its row; no window over pages is needed.
    """
    named = pages.select("page_id", "html", safe_title(title(F.col("html"))).alias("_name"))
    links = _wanted_links(named, keyword, base).where(F.col("pos") < per_page)
    number = (F.col("pos") + 1).cast("bigint")
    return links.select("page_id", number.alias("link_no"), "url",
                        F.concat("_name", F.lit("_"), number.cast("string"), F.lit(".csv")).alias("file_name"))


def dataset_pages(datasets: DataFrame, pages: DataFrame, keyword: str = defaults.LINK_KEYWORD, base: str = defaults.PORTAL_BASE) -> DataFrame:
    """(dataset_id, page_id, how, status): the page that each file of `datasets(dataset_id)` comes from.

    A file belongs to a page whose resource would get its name (`file_name`, with the link's number), else to one that links to
    a file of its name (`url`); case does not count. Several such pages: `ambiguous`, and none is named. None: `no page`.

    Links are aggregated by key before the join, so a name that a third of all pages link to is one row.
    """
    links = page_resources(pages, keyword, base, 1 << 30)
    linked = F.regexp_extract("url", r"([^/?#]+)(?:[?#].*)?$", 1)
    keys = F.array(F.struct(F.lit(0).alias("level"), F.lower("file_name").alias("key")), F.struct(F.lit(1).alias("level"), F.lower(linked).alias("key")))
    known = links.select("page_id", F.inline(keys)).groupBy("level", "key").agg(F.min("page_id").alias("least"), F.max("page_id").alias("most"))
    named = datasets.select("dataset_id", F.lower(F.regexp_extract("dataset_id", "[^/]*$", 0)).alias("key"))
    best = named.join(known, "key").groupBy("dataset_id").agg(F.min_by(F.struct("level", "least", "most"), "level").alias("m")).select("dataset_id", "m.*")
    one = F.col("least") == F.col("most")
    return datasets.select("dataset_id").join(best, "dataset_id", "left").select(
        "dataset_id", F.when(one, F.col("least")).alias("page_id"),
        F.when(F.col("level") == 0, F.lit("file_name")).when(F.col("level") == 1, F.lit("url")).alias("how"),
        F.when(F.col("level").isNull(), F.lit("no page")).when(one, F.lit("matched")).otherwise(F.lit("ambiguous")).alias("status"))


def dataset_context(datasets: DataFrame, pages: DataFrame, **how) -> DataFrame:
    """(dataset_id, title, description, ministry, sector): the page record of every dataset with a page of its own, as the
    `scraped` table of a run."""
    found = dataset_pages(datasets, pages, **how).where("status = 'matched'").select("dataset_id", "page_id")
    return found.join(page_metadata(pages).select("page_id", "title", "description", "ministry", "sector"), "page_id").drop("page_id")

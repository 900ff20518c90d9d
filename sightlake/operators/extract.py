"""Reports out of stored web pages.

Index pages link to listing pages, listing pages hold one row per report and link to the
report pages. Each step is a narrow pass over the pages it concerns; listing and report
meet in one equi-join. What cannot be read is set aside with a reason, and the rest of the
page goes on.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightlake.functions import html_nodes
from sightlake.functions.dates import parse_link_date
from sightlake.functions.text import strip_ws
from sightlake.functions.urls import host_allowed, link_key, resolve_link
from sightlake.operators.joins import lookup_join

INDEX_PATH = ("tr", "td", "u", "a")
DETAIL_CLASS = "content-area clr"
SKIPPED_TEXTS = 9  # text nodes before the report's own text (fixed value)

# Column by cell number in a listing row; cell 0 holds the link (fixed values).
CELL_COLUMNS = {
    "date_time": 1, "city": 2, "state": 3, "country": 4, "shape": 5, "summary": 6, "posted": 8,
}


@dataclass(frozen=True)
class Site:
    """Where the pages come from: what listing links hang on, what reports are recorded
    under, and the hosts a link may lead to."""

    page_base: str
    report_base: str
    hosts: Sequence[str]


def _bound(day: str | None):
    return None if day is None else datetime.strptime(day, "%m/%d/%Y").date()


def index_rows(pages: DataFrame, path: Sequence[str] = INDEX_PATH) -> DataFrame:
    """One row per link at the path: its page, text and target."""
    # Pages without the innermost but one element have no such link; they are not parsed.
    needed = rf"(?i)<{path[-2]}[\s/>]"
    return (
        pages.where(F.col("html").rlike(needed))
        .select("url", F.explode(html_nodes.link_nodes(F.col("html"), path)).alias("link"))
        .select("url", "link.text", "link.href")
    )


def dated_links(rows: DataFrame, page_base: str) -> DataFrame:
    """Links with their date and URL; ``problem`` says why a row cannot be used."""
    day = parse_link_date(F.col("text"))
    return rows.where(F.col("text").isNotNull()).select(
        "url", "text", "href",
        day.alias("link_date"),
        F.concat(F.lit(page_base), F.col("href")).alias("link_url"),
        F.when(day.isNull(), "bad date").when(F.col("href").isNull(), "no target").alias("problem"),
    )


def in_date_range(
    links: DataFrame, start: str | None = None, stop: str | None = None
) -> DataFrame:
    """Links dated from start up to but not on stop, both ``mm/dd/yyyy`` and optional."""
    first, end = _bound(start), _bound(stop)
    if first is not None:
        links = links.where(F.col("link_date") >= F.lit(first))
    if end is not None:
        links = links.where(F.col("link_date") < F.lit(end))
    return links


def index_links(
    pages: DataFrame, site: Site, start: str | None = None, stop: str | None = None
) -> DataFrame:
    """Listing pages to read: date and URL, within the bounds and on the site's hosts."""
    links = dated_links(index_rows(pages), site.page_base).where(F.col("problem").isNull())
    links = in_date_range(links, start, stop)
    return links.where(host_allowed(F.col("link_url"), site.hosts)).select("link_date", "link_url")


def listing_rows(pages: DataFrame, site: Site) -> DataFrame:
    """One row per table body row that has cells; ``problem`` marks unusable ones.

    ``link_url`` is the page the row links to. Rows of seven cells have no posted date;
    other rows short of nine cells lack a column they should have.
    """
    rows = (
        pages.where(F.col("html").rlike(r"(?i)<tbody[\s/>]"))
        .select("url", F.explode(html_nodes.listing_nodes(F.col("html"))).alias("row"))
        .select("url", "row.href", "row.texts")
        .where(F.size("texts") > 0)
    )
    href, n = F.col("href"), F.size("texts")
    return rows.select(
        "url",
        F.concat(F.lit(site.report_base), href).alias("report_link"),
        resolve_link(F.col("url"), href).alias("link_url"),
        *[F.get("texts", F.lit(i)).alias(name) for name, i in CELL_COLUMNS.items()],
        F.when((n < 7) | (n == 8), "short row").when(href.isNull(), "no target").alias("problem"),
    )


def usable(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("problem").isNull()).drop("problem")


def quarantined(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("problem").isNotNull())


def report_detail(pages: DataFrame, *others: str) -> DataFrame:
    """Text, duration and stats of each report page, with its URL and other columns."""
    nodes = F.col("nodes")
    texts = F.transform(nodes["texts"], strip_ws)
    labels = F.transform(nodes["labels"], lambda label: F.substring_index(label, ":", 1))
    values = F.filter("texts", lambda t: t != "")
    # Paired by position; the longer list is cut, where zipping alone would pad.
    n = F.least(F.size("labels"), F.size("values"))
    pairs = F.zip_with(
        F.slice("labels", 1, n), F.slice("values", 1, n),
        lambda k, v: F.struct(k.alias("k"), v.alias("v")),
    )
    durations = F.filter("pairs", lambda p: p["k"] == "Duration")
    return (
        pages.select(
            "url", *others, html_nodes.detail_texts(F.col("html"), DETAIL_CLASS).alias("nodes"))
        .select("url", *others, texts.alias("texts"), labels.alias("labels"))
        .withColumn("values", values)
        .withColumn("pairs", pairs)
        .select(
            "url", *others,
            F.array_join(
                F.slice("texts", SKIPPED_TEXTS + 1, F.greatest(F.size("texts"), F.lit(1))), " "
            ).alias("text"),
            F.try_element_at(durations, F.lit(-1))["v"].alias("duration"),
            F.array_join(
                F.transform("pairs", lambda p: F.concat(p["k"], F.lit(":"), p["v"])), "|"
            ).alias("stats"),
        )
    )


def holds_report(html: Column) -> Column:
    """Whether a page can hold a report: others give an empty one."""
    return html.contains(DETAIL_CLASS)


def with_pages(listing: DataFrame, chosen: DataFrame, **join_options) -> DataFrame:
    """Listing rows with the key of the page each one links to; ``problem`` marks those without.

    ``chosen`` has one row per stored page (``page_key``) and no page text. Hosts differ between
    recorded and fetched links, so the two meet on path and query.
    """
    keyed = listing.withColumn("page_key", link_key(F.col("link_url")))
    stored = chosen.select("page_key", F.lit(True).alias("stored"))
    return lookup_join(keyed, stored, ["page_key"], "left", **join_options).withColumn(
        "problem", F.when(F.col("stored").isNull(), "no page")).drop("stored")


def assemble_reports(paged: DataFrame, detail: DataFrame, **join_options) -> DataFrame:
    """Usable listing rows, by ``page_key``, with what their pages hold.

    ``detail`` has one row for each page: copies are chosen before they are parsed.
    """
    pages = detail.select("page_key", "text", "duration", "stats")
    # Report texts are never a small table, so their size is not measured.
    options = {"broadcast_limit": 0, **join_options}
    return lookup_join(paged, pages, ["page_key"], "inner", **options).select(
        "text", "duration", "stats", "date_time", "report_link", "city", "state", "country",
        "shape", "summary", "posted",
    )

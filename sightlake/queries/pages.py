"""Page extraction: the given pages, and pages built from orders and customers."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightlake import schemas, session
from sightlake.functions.urls import host_allowed
from sightlake.operators import extract, pages
from sightlake.plans import jobs
from sightlake.queries import Query, table
from sightlake.sources import readers

SITE = extract.Site(
    "https://reports.example", "http://www.reports.example",
    ["www.reports.example", "reports.example"])
HOSTS = ["example.com", "m.ththth.example.net"]
START, STOP = "06/15/1996", "03/01/1999"
INDEX_URL = "https://www.reports.example/ndx/?id=post"

DAY = "cast(cast(o_orderdate AS date) AS string)"
# One link of an index page per order: most dated, some with words, some without a target.
INDEX_HTML = (
    "concat('<html><body><table><tr><td><u><a', CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE "
    f"concat(' href=\"/day?d=', {DAY}, '&amp;n=1\"') END, '>', "
    f"CASE WHEN o_orderkey % 11 = 0 THEN 'undated' ELSE {DAY} END, "
    "'</a></u></td><td><a href=\"/other\">1999-01-01</a></td></tr></table>')"
)
INDEX_GOOD = "o_orderkey % 13 <> 0 AND o_orderkey % 11 <> 0"
# A listing row per order, an empty row, and by order key a short one.
CELLS = (
    "'<tr><td><a href=\"', {link}, '\">Open</a></td><td>', month(o_orderdate), '/', day(o_orderdate), "
    "'/19 21:30</td><td>City &amp; ', o_custkey, '<br>x</td><td>', CASE WHEN o_orderkey % 4 = 0 THEN '' "
    "ELSE o_orderstatus END, '</td><td>USA</td><td><i>?</i>Light</td><td>', o_orderpriority, "
    "'</td><td>ignored</td><td>3/7/19</td></tr>'"
)
LISTING_HTML = (
    "concat('<table><thead><tr><th>When</th></tr></thead><tbody>', " + CELLS + ", '<tr></tr>', "
    "CASE WHEN o_orderkey % 3 = 0 THEN '<tr><td>short</td><td>row</td></tr>' ELSE '' END, "
    "'</tbody></table>')"
)
DETAIL_HTML = (
    "concat('<html><body><div class=\"site content-area clr\"><b>Occurred:</b> ', {key}, '<br/>"
    "<b>Duration:</b> ', {key} % 60, ' min<br/><b>Shape: kind</b> ', {name}, '<br/><b>Last</b>', "
    "repeat('<br/> ', 7), {extra}, '<p>inner</p> more \n<br>end</div><b>out</b></body></html>')"
)


def _shown(spark, sf_dir, name, *columns):
    """Pages built from a table; parsing them is heavy, so small tables are spread first."""
    return session.spread(table(spark, sf_dir, name)).selectExpr(*columns)


def nav_links(spark, sf_dir):
    stored = session.spread(readers.read_pages(spark, f"{sf_dir}/pages.parquet"))
    return extract.index_rows(stored, ("nav", "ul", "li", "a"))


def host_filter(spark, sf_dir):
    stored = table(spark, sf_dir, "pages")
    return stored.where(host_allowed(F.col("url"), HOSTS)).select("page_id", "url")


def index_pages(spark, sf_dir):
    return _shown(spark, sf_dir, "orders", f"'{INDEX_URL}' AS url", f"{INDEX_HTML} AS html")


def index_links(spark, sf_dir):
    return extract.index_links(index_pages(spark, sf_dir), SITE)


def date_range_links(spark, sf_dir):
    return extract.index_links(index_pages(spark, sf_dir), SITE, START, STOP)


def index_quarantine(spark, sf_dir):
    rows = extract.dated_links(extract.index_rows(index_pages(spark, sf_dir)), SITE.page_base)
    return extract.quarantined(rows).select("text", "href", "problem")


def listing_pages(spark, sf_dir, link):
    return _shown(
        spark, sf_dir, "orders", f"concat('https://reports.example/day?d=', {DAY}, '&n=1') AS url",
        f"{LISTING_HTML.format(link=link)} AS html")


def _listing(spark, sf_dir):
    return extract.listing_rows(listing_pages(spark, sf_dir, "concat('/s?id=', o_custkey)"), SITE)


def listing_rows(spark, sf_dir):
    return extract.usable(_listing(spark, sf_dir)).drop("url")


def listing_quarantine(spark, sf_dir):
    return extract.quarantined(_listing(spark, sf_dir)).select("url", "date_time", "problem")


def _details(spark, sf_dir):
    """Two copies of every customer's page, on two hosts and with different texts."""
    customers = session.spread(table(spark, sf_dir, "customer"))
    html = DETAIL_HTML.format(key="c_custkey", name="c_name", extra="copy")
    return customers.selectExpr("*", "explode(array('b', 'a')) AS copy").selectExpr(
        "concat(CASE copy WHEN 'a' THEN 'http://' ELSE 'https://www.' END, 'reports.example/s?id=', "
        "c_custkey) AS url", f"{html} AS html")


def report_detail(spark, sf_dir):
    return extract.report_detail(_details(spark, sf_dir))


def _paged(spark, sf_dir, details):
    """Listing rows with the pages they link to, and what the chosen copies of the pages hold."""
    path = session.staging_path(spark, "pages")
    details.write.parquet(path)
    listing = session.stage(extract.usable(_listing(spark, sf_dir)), "listing")
    places = session.stage(pages.page_places(spark, path), "places")
    chosen = pages.one_copy(spark, path, places, extract.holds_report(F.col("html")))
    paged = session.stage(extract.with_pages(listing, chosen), "paged")
    return paged, extract.report_detail(pages.read_places(spark, path, chosen), "page_key")


def assemble_reports(spark, sf_dir):
    paged, detail = _paged(spark, sf_dir, _details(spark, sf_dir))
    return extract.assemble_reports(extract.usable(paged), detail)


def _copies(spark, sf_dir):
    """By customer: no page, a blank copy before one with the report, two reports, or blanks alone."""
    blank = "concat('<p>Page ', c_custkey, ' has moved.</p>')"
    customers = session.spread(table(spark, sf_dir, "customer")).where("c_custkey % 4 <> 0")
    report = DETAIL_HTML.format(key="c_custkey", name="c_name", extra="copy")
    return customers.selectExpr("*", "explode(array('b', 'a')) AS copy").selectExpr(
        "concat(CASE copy WHEN 'a' THEN 'http://' ELSE 'https://www.' END, 'reports.example/s?id=', "
        "c_custkey) AS url",
        f"CASE WHEN c_custkey % 4 = 3 OR (c_custkey % 4 = 1 AND copy = 'a') THEN {blank} "
        f"ELSE {report} END AS html")


def assemble_copies(spark, sf_dir):
    paged, detail = _paged(spark, sf_dir, _copies(spark, sf_dir))
    return extract.assemble_reports(extract.usable(paged), detail)


def missing_pages(spark, sf_dir):
    """The listing rows whose page is not stored."""
    paged, _ = _paged(spark, sf_dir, _copies(spark, sf_dir))
    return extract.quarantined(paged).select("report_link", "link_url", "summary", "problem")


def _store(path, *tables):
    """Index, listing and report pages built from tables with the columns of orders."""
    detail = DETAIL_HTML.format(key="o_orderkey", name="o_orderstatus", extra="o_orderpriority")
    shapes = (
        (f"'{INDEX_URL}' AS url", f"{INDEX_HTML} AS html"),
        (f"concat('https://reports.example/day?d=', {DAY}, '&n=1') AS url",
         f"{LISTING_HTML.format(link="concat('/s?id=', o_orderkey)")} AS html"),
        ("concat('https://reports.example/s?id=', o_orderkey) AS url", f"{detail} AS html"))
    first, *rest = (t.selectExpr(*shape) for t, shape in zip(tables, shapes, strict=True))
    reduce(DataFrame.unionByName, rest, first).write.parquet(path)


def pull_reports(spark, sf_dir):
    """The whole pull from a stored page table: index, listing and report pages."""
    path, out = session.staging_path(spark, "pages"), session.staging_path(spark, "raw")
    orders = session.spread(table(spark, sf_dir, "orders"))
    _store(path, orders, orders, orders)
    jobs.pull_reports(spark, path, SITE, INDEX_URL, out, START, STOP)
    return readers.read_raw_reports(spark, out)


def pulled_customers(spark, sf_dir, counts_path):
    """Path of what is pulled from a page for each customer; a third of the report pages are absent."""
    path, out, bad = (session.staging_path(spark, n) for n in ("pages", "raw", "bad"))
    customers = session.spread(table(spark, sf_dir, "customer")).selectExpr(
        "c_custkey AS o_orderkey", "c_custkey AS o_custkey", "'O' AS o_orderstatus",
        "c_mktsegment AS o_orderpriority",
        "cast(date_add(DATE '1995-01-01', cast(c_custkey % 2000 AS int)) AS timestamp_ntz) AS o_orderdate")
    _store(path, customers, customers, customers.where("o_custkey % 3 <> 0"))
    jobs.pull_reports(
        spark, path, SITE, INDEX_URL, out, quarantine_path=bad, counts_path=counts_path)
    return out


_LISTED = {
    "date_time": "concat(month(o_orderdate), '/', day(o_orderdate), '/19 21:30')",
    "city": "concat('City & ', o_custkey)",
    "state": "CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus END",
    "country": "'USA'", "shape": "'Light'", "summary": "o_orderpriority", "posted": "'3/7/19'",
}
_LISTED_SQL = ", ".join(f"{e} AS {n}" for n, e in _LISTED.items())


# Text nodes: three values, then six blanks, then the extra text (the tenth), two more.
_STATS = (
    "concat({key} % 60, ' min') AS duration, concat('Occurred:', {key}, '|Duration:', {key} % 60, "
    "' min|Shape:', {name}, '|Last:', {extra}) AS stats")
_TEXT = "concat({extra}, ' more end') AS text"
_RANGE = "o_orderdate >= DATE '1996-06-15' AND o_orderdate < DATE '1999-03-01'"
_LINKS = (
    "SELECT CAST(o_orderdate AS DATE) AS link_date, "
    f"concat('https://reports.example/day?d=', {DAY}, '&n=1') AS link_url FROM orders WHERE {INDEX_GOOD}")
_RAW = ", ".join(schemas.RAW_REPORT.names)

QUERIES = {
    "index_links_nav": Query(
        nav_links,
        "SELECT url, t.text AS text, t.href AS href FROM (SELECT url, unnest(list_transform("
        "regexp_extract_all(html, '<li><a href=\"[^\"]*\">[^<]*</a></li>'), lambda x: {"
        "'href': regexp_extract(x, 'href=\"([^\"]*)\"', 1), "
        "'text': nullif(regexp_extract(x, '>([^<>]*)</a>', 1), '')})) AS t FROM pages)"),
    "host_filter": Query(
        host_filter,
        "SELECT page_id, url FROM (SELECT page_id, url, "
        "lower(split_part(split_part(split_part(split_part(url, '://', 2), '/', 1), '?', 1), ':', 1)) AS h "
        "FROM pages) WHERE " + " OR ".join(f"h = '{x}' OR h LIKE '%.{x}'" for x in HOSTS)),
    "index_links": Query(index_links, _LINKS),
    "date_range_links": Query(date_range_links, f"{_LINKS} AND {_RANGE}"),
    "index_quarantine": Query(
        index_quarantine,
        f"SELECT CASE WHEN o_orderkey % 11 = 0 THEN 'undated' ELSE {DAY} END AS text, "
        f"CASE WHEN o_orderkey % 13 <> 0 THEN concat('/day?d=', {DAY}, '&n=1') END AS href, "
        "CASE WHEN o_orderkey % 11 = 0 THEN 'bad date' ELSE 'no target' END AS problem "
        f"FROM orders WHERE NOT ({INDEX_GOOD})"),
    "listing_rows": Query(
        listing_rows,
        "SELECT concat('http://www.reports.example/s?id=', o_custkey) AS report_link, "
        f"concat('https://reports.example/s?id=', o_custkey) AS link_url, {_LISTED_SQL} FROM orders"),
    "listing_quarantine": Query(
        listing_quarantine,
        f"SELECT concat('https://reports.example/day?d=', {DAY}, '&n=1') AS url, 'row' AS date_time, "
        "'short row' AS problem FROM orders WHERE o_orderkey % 3 = 0"),
    "report_detail": Query(
        report_detail,
        "SELECT concat(CASE extra WHEN 'a' THEN 'http://' ELSE 'https://www.' END, "
        "'reports.example/s?id=', c_custkey) AS url, "
        + _TEXT.format(extra="extra") + ", "
        + _STATS.format(key="c_custkey", name="c_name", extra="extra")
        + " FROM customer, (VALUES ('a'), ('b')) v(extra)"),
    "assemble_reports": Query(
        assemble_reports,
        f"SELECT {_RAW} FROM (SELECT 'a more end' AS text, "
        + _STATS.format(key="c_custkey", name="c_name", extra="'a'")
        + ", concat('http://www.reports.example/s?id=', o_custkey) AS report_link, "
        f"{_LISTED_SQL} FROM orders JOIN customer ON c_custkey = o_custkey)"),
    "assemble_copies": Query(
        assemble_copies,
        f"SELECT {_RAW} FROM (SELECT CASE WHEN blank THEN '' ELSE concat(extra, ' more end') END AS text, "
        "CASE WHEN NOT blank THEN duration END AS duration, CASE WHEN blank THEN '' ELSE stats END AS stats, "
        f"report_link, {_LISTED_SQL} FROM (SELECT *, "
        + _STATS.format(key="c_custkey", name="c_name", extra="extra")
        + ", concat('http://www.reports.example/s?id=', o_custkey) AS report_link FROM (SELECT *, "
        "CASE WHEN c_custkey % 4 = 1 THEN 'b' ELSE 'a' END AS extra, c_custkey % 4 = 3 AS blank "
        "FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_custkey % 4 <> 0)))"),
    "missing_pages": Query(
        missing_pages,
        "SELECT concat('http://www.reports.example/s?id=', o_custkey) AS report_link, "
        "concat('https://reports.example/s?id=', o_custkey) AS link_url, o_orderpriority AS summary, "
        "'no page' AS problem FROM orders WHERE o_custkey % 4 = 0 "
        "OR o_custkey NOT IN (SELECT c_custkey FROM customer)"),
    "pull_reports": Query(
        pull_reports,
        f"SELECT {_RAW} FROM (SELECT " + _TEXT.format(extra="o_orderpriority") + ", "
        + _STATS.format(key="o_orderkey", name="o_orderstatus", extra="o_orderpriority")
        + ", concat('http://www.reports.example/s?id=', o_orderkey) AS report_link, "
        f"{_LISTED_SQL} FROM orders WHERE o_orderdate IN "
        f"(SELECT o_orderdate FROM orders WHERE {INDEX_GOOD} AND {_RANGE}))"),
}

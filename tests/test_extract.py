import json
import random

from pyspark.sql import functions as F

from sightlake import session
from sightlake.functions import html_nodes
from sightlake.functions.urls import host_allowed, link_key, resolve_link
from sightlake.operators import extract, pages
from sightlake.plans import jobs
from sightlake.sources import readers

SITE = extract.Site("https://site.test", "http://www.site.test", ["www.site.test", "site.test"])


def pages_of(spark, *pages):
    return spark.createDataFrame(list(pages), "url string, html string")


INDEX = (
    '<table><tr><td><u><a href="/i1">2019-03-05</a></u></td></tr><tr><td><u><a href="/i2"></a></u>'
    '</td></tr><tr><td><u><a href="/i3">2019-04-01</a></u></td></tr>{}</table>'
)
LINK_ROW = '<tr><td><u><a href="{}">{}</a></u></td></tr>'


def test_index_links(spark):
    pages = pages_of(spark, ("https://www.site.test/ndx", INDEX.format("")), ("x", None), ("y", ""))
    got = extract.index_links(pages, SITE, "03/01/2019", "04/01/2019").collect()
    assert [(str(r.link_date), r.link_url) for r in got] == [("2019-03-05", "https://site.test/i1")]
    assert extract.index_links(pages, SITE).count() == 2
    assert extract.index_links(pages, SITE, start="03/06/2019").first().link_url.endswith("/i3")


def test_unusable_index_links_are_set_aside(spark):
    more = LINK_ROW.format("/i4", "March 2019") + "<tr><td><u><a>2019-03-09</a></u></td></tr>"
    pages = pages_of(spark, ("u", INDEX.format(more + LINK_ROW.format("/i5", "2019-03-10"))))
    rows = extract.dated_links(extract.index_rows(pages), SITE.page_base)
    assert sorted(r.problem for r in extract.quarantined(rows).collect()) == ["bad date", "no target"]
    assert {r.href for r in extract.usable(rows).collect()} == {"/i1", "/i3", "/i5"}


def test_links_need_the_whole_path(spark):
    html = ('<table><tr><td><a href="/1">2019-01-01</a></td><td><u><i><a href="/2">2019-01-01</a>'
            '</i></u><U><A HREF="/3?a=1&amp;b=2">2019-01-01<b>x</b>y</A></U></table>')
    rows = extract.index_rows(pages_of(spark, ("u", html))).collect()
    assert [(r.text, r.href) for r in rows] == [("2019-01-01", "/3?a=1&b=2")]


CELLS = ['<a href="/r/1">Open</a>', "3/5/19 21:30", "Waco", "TX", "USA", "Light", "Bright",
         "ignored", "3/7/19"]


def row_of(cells):
    return "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"


def listing(spark, *rows, body="<tbody>"):
    html = f"<table><thead><tr><th>x</th></tr></thead>{body}{''.join(rows)}</table>"
    return extract.listing_rows(pages_of(spark, ("https://www.site.test/l?id=1", html)), SITE)


def test_listing_row(spark):
    (r,) = extract.usable(listing(spark, row_of(CELLS))).collect()
    assert r.asDict() == {
        "url": "https://www.site.test/l?id=1", "report_link": "http://www.site.test/r/1",
        "link_url": "https://www.site.test/r/1", "date_time": "3/5/19 21:30", "city": "Waco",
        "state": "TX", "country": "USA", "shape": "Light", "summary": "Bright", "posted": "3/7/19"}


def test_listing_odd_rows(spark):
    no_state = [*CELLS[:3], "", *CELLS[4:]]
    nested = [*CELLS[:2], "<i>in</i>Wa<b>x</b>co", "<b>TX</b>", *CELLS[4:]]
    rows = listing(
        spark, row_of(no_state), row_of(nested), "<tr></tr>", row_of(CELLS[:1]), row_of(CELLS[:7]),
        row_of(CELLS[:8]), row_of(["none", *CELLS[1:]]), row_of([*CELLS, "tenth"]))
    good = extract.usable(rows).collect()
    assert [(r.city, r.state, r.posted) for r in good] == [
        ("Waco", None, "3/7/19"), ("Wa", None, "3/7/19"), ("Waco", "TX", None),
        ("Waco", "TX", "3/7/19")]
    assert [r.problem for r in extract.quarantined(rows).collect()] == [
        "short row", "short row", "no target"]


def test_listing_needs_a_literal_table_body(spark):
    assert listing(spark, row_of(CELLS), body="").count() == 0


def test_unclosed_cells_and_rows(spark):
    rows = "".join("<tr>" + "".join(f"<td>{c}" for c in CELLS) for _ in range(2))
    assert extract.usable(listing(spark, rows)).count() == 2


def detail_page(*parts, css="x content-area clr y"):
    return f'<html><body><p>outside</p><div class="{css}">{"".join(parts)}</div><b>no</b></body></html>'


def test_detail(spark):
    parts = [f"<b>{k}:</b> v{i} <br/>" for i, k in enumerate(
        ["Occurred", "Reported: at", "Duration", "Shape", "Duration", "Last"], 1)]
    tail = "<br/>".join(["eight ", "nine", " \n ", " ten", "eleven", "\xa0twelve\n"])
    html = detail_page(*parts, "<span><b>Deep</b> not direct</span>", tail)
    got = extract.report_detail(pages_of(spark, ("u", html))).first()
    assert got.duration == "v5"
    assert got.stats == "Occurred:v1|Reported:v2|Duration:v3|Shape:v4|Duration:v5|Last:v6|Deep:eight"
    # Direct nodes: v1..v6 (1-6), eight, nine, blank (7-9), then the text.
    assert got.text == "ten eleven twelve"


def test_detail_blank_nodes_keep_their_separator(spark):
    html = detail_page("<br/>".join(["a"] * 9 + ["b", " ", "c<!-- note -->d"]))
    assert extract.report_detail(pages_of(spark, ("u", html))).first().text == "b  c d"


def test_detail_without_area_or_duration(spark):
    pages = pages_of(
        spark, ("1", detail_page("<b>A:</b>x", css="other")), ("2", detail_page("<b>A:</b> x")),
        ("3", None), ("4", "<![broken"), ("5", detail_page()))
    got = {r.url: (r.text, r.duration, r.stats) for r in extract.report_detail(pages).collect()}
    empty = ("", None, "")
    assert got == {"1": empty, "2": ("", None, "A:x"), "3": empty, "4": empty, "5": empty}


def test_nested_areas_count_once_in_document_order():
    page = html_nodes.parse_page(
        '<div class="content-area clr">a<div class="content-area clr">b<b>L1</b></div>c<b>L2</b></div>')
    assert html_nodes.detail_nodes(page, "content-area clr") == (
        ["a", "b", "c"], ["L1", "L2"])


def test_lenient_parsing():
    page = html_nodes.parse_page("<p><b>x<br><p>y</i>z & &amp; < 3</p></b><script>if (a<b) '</p>'</script>")
    assert ["".join(b.itertext()) for b in page.iter("b")] == ["xyz & & < 3"]
    # A stray end tag neither closes nor splits anything.
    assert list(html_nodes.direct_text(html_nodes.parse_page("<div>a</b>c</div>").find("div"))) == ["ac"]
    assert html_nodes.parse_page("<div><b>x</div>y").find("div/b").text == "x"
    assert html_nodes.parse_page("<table><tr><td><div>x</table>y").find("table").tail == "y"
    deep = html_nodes.parse_page("<div class='content-area clr'>" * 5000 + "x")
    assert html_nodes.detail_nodes(deep, "content-area clr")[0] == ["x"]


def test_links(spark):
    page = "https://www.site.test/a/b?c=1"
    cases = [("/r?id=1", "https://www.site.test/r?id=1"), ("r", "https://www.site.test/a/r"),
             ("?x=2", "https://www.site.test/a/b?x=2"), ("//o.test/x", "https://o.test/x"),
             ("http://o.test/x", "http://o.test/x")]
    df = spark.createDataFrame([(page, h) for h, _ in cases], "p string, h string").coalesce(1)
    got = [r.u for r in df.select(resolve_link(F.col("p"), F.col("h")).alias("u")).collect()]
    assert got == [u for _, u in cases]
    urls = {"http://www.site.test/r?id=1#top": ("/r?id=1", True), "https://site.test": ("/", True),
            "//x.site.test/a": ("/a", False), "http://x.site.test/a": ("/a", True),
            "http://notsite.test/": ("/", False), "http://u@site.test:80?q": ("/?q", True),
            "/r?id=1": ("/r?id=1", False)}
    df = spark.createDataFrame([(u,) for u in urls], "u string").coalesce(1)
    rows = df.select(link_key(F.col("u")).alias("k"), host_allowed(F.col("u"), SITE.hosts).alias("h"))
    assert [tuple(r) for r in rows.collect()] == list(urls.values())


def test_one_copy_of_a_page_is_chosen_and_no_row_lost(spark, tmp_path):
    rows = extract.usable(listing(spark, row_of(CELLS), row_of(CELLS), row_of(["<a href='/r/9'>", *CELLS[1:]])))
    path = str(tmp_path / "my pages")
    pages_of(
        spark, ("https://www.site.test/r/1", detail_page("<b>Duration:</b>z")),
        ("https://site.test/r/1", detail_page("<b>Duration:</b>d")), ("http://site.test/r/1", "moved"),
        ("http://site.test/r/1", None), ("https://site.test/r/1", detail_page("<b>Duration:</b>e")),
        ("http://site.test/r/2", detail_page())).coalesce(1).write.parquet(path)
    places = session.stage(pages.page_places(spark, path), "places")
    chosen = pages.one_copy(spark, path, places, extract.holds_report(F.col("html")))
    assert sorted((r.page_key, r.url) for r in chosen.collect()) == [
        ("/r/1", "https://site.test/r/1"), ("/r/2", "http://site.test/r/2")]
    for options in ({}, {"broadcast_limit": 1 << 20}, {"broadcast_limit": 0, "hot_rows": 1, "salts": 3}):
        paged = session.stage(extract.with_pages(rows, chosen, **options), "paged")
        assert [(r.link_url, r.problem) for r in extract.quarantined(paged).collect()] == [
            ("https://www.site.test/r/9", "no page")]
        detail = extract.report_detail(pages.read_places(spark, path, chosen), "page_key")
        out = extract.assemble_reports(extract.usable(paged), detail, **options)
        assert out.columns == readers.schemas.RAW_REPORT.names
        assert [(r.duration, r.report_link) for r in out.collect()] == [
            ("d", "http://www.site.test/r/1")] * 2


def test_plain_pages_give_the_parsers_tree():
    draw = random.Random(5)
    plain = ["<td>", "</td>", "<tr>", "</TR>", "<table>", "</table>", "<a href=\"/x?y=1\">", "<A HREF=\"\">",
             "</a>", "<p>", "</p>", "<br/>", "<b/>", "<br>", "</br>", "<div class=\"a b\">", "</div>", "</script>",
             "<img src=\"x\"/>", "text ", "&amp;", "&lt", "&#65;", "& ", "\n", "\x00é", ">", "\"", "<li>", "<select>"]
    odd = ["<script>", "<title>", "<a b=c>", "<a b='c'>", "<i x=\"&amp;\">", "< ", "<", "<!-- c -->", "<![x]>",
           "</ a>", "</a b>", "<td a=\"1\" b=\"2\">", "</b/>", "<?pi>", "</>", "<a href=\"", "<é>"]

    def shown(tree):
        return tree if tree is None else [(e.tag, e.attrib, e.text, e.tail) for e in tree.iter()]

    fast = 0
    for i in range(6000):
        parts = draw.choices(plain, k=draw.randint(0, 12)) + draw.choices(odd, k=i % 3 // 2)
        draw.shuffle(parts)
        page = "".join(parts)
        cut = html_nodes.TreeParser().plain_tree(page)
        try:
            whole = html_nodes.TreeParser().tree(page)
        except AssertionError:
            whole = None
        assert shown(html_nodes.parse_page(page)) == shown(whole), page
        fast += cut is not None
    assert fast >= 4000
    page = f"<table><tbody>{row_of(CELLS) * 50}</tbody></table>"
    assert html_nodes.TreeParser().plain_tree(page) is not None


def test_a_scan_looks_rows_up_in_bitmaps(spark, tmp_path):
    path = str(tmp_path / "pages")
    spark.range(70_000, numPartitions=1).selectExpr(
        "concat('http://site.test/p?id=', id) AS url", "concat('x', id) AS html").write.parquet(path)
    places = session.stage(pages.page_places(spark, path), "places")
    for wanted in ("row % 2 = 0", "row IN (0, 7, 8, 32767, 32768, 65535, 69999)", "row = 69999"):
        some = session.stage(places.where(wanted).unionByName(places.where(wanted)), "some")
        read = pages.read_places(spark, path, some)
        assert read.select("row").distinct().count() == read.count() == places.where(wanted).count()
        assert read.where("html <> concat('x', row)").count() == 0
    # Half of all rows: two bytes of five hold what 70,000 rows of file names would.
    size = pages.row_marks(session.stage(places.where("row % 2 = 0"), "some")).agg(
        F.sum(F.length("marks") + F.octet_length("file"))).first()[0]
    assert size < 12_000


def test_pages_are_read_late(spark, tmp_path):
    path = str(tmp_path / "pages {1}")
    spark.range(100).selectExpr("concat('http://site.test/p?id=', id) AS url", "repeat('x', 10 + id) AS html"
                                ).repartitionByRange(5, "url").write.parquet(path.replace("{1}", "1"))
    path = path.replace("{1}", "1")
    places = pages.page_places(spark, path)
    assert "html" not in places._jdf.queryExecution().executedPlan().toString()
    keys = spark.range(0, 100, 7).selectExpr("concat('/p?id=', id) AS page_key")
    found = session.stage(pages.linked_places(places, keys), "found")
    for at_once in (1, 4, 1000):
        read = pages.read_places(spark, path, found, at_once)
        assert sorted(len(r.html) - 10 for r in read.collect()) == list(range(0, 100, 7))
    assert "Exchange hashpartitioning" not in read._jdf.queryExecution().executedPlan().toString()
    none = pages.read_places(spark, path, session.stage(places.limit(0), "none"))
    assert none.columns == read.columns and none.count() == 0


def test_pull_job(spark, tmp_path):
    def listing_page(*ids):
        rows = [row_of([f'<a href="/s?id={i}">Open</a>', *CELLS[1:]]) for i in ids]
        return f"<table><tbody>{''.join(rows)}{row_of(CELLS[:3])}</tbody></table>"

    index = "<table>" + LINK_ROW.format("/day?d=1", "2019-03-05") + LINK_ROW.format(
        "/day?d=2", "2019-03-06") + LINK_ROW.format("/day?d=9", "soon") + "</table>"
    offsite = f'<table><tbody>{row_of(["<a href=http://other.test/s?id=5>", *CELLS[1:]])}</table>'
    pages = pages_of(
        spark, ("https://www.site.test/ndx/?id=post", index),
        ("https://site.test/day?d=1", listing_page(1, 2, 77)), ("https://site.test/day?d=2", listing_page(3)),
        ("https://site.test/day?d=3", listing_page(4)), ("https://site.test/day?d=1", offsite),
        *[(f"https://site.test/s?id={i}", detail_page("<b>Duration:</b>" + f"{i} min")) for i in range(6)])
    pages.write.parquet(str(tmp_path / "pages"))
    args = (spark, str(tmp_path / "pages"), SITE, "https://www.site.test/ndx/?id=post")
    result = jobs.pull_reports(
        *args, str(tmp_path / "raw"), stop="03/06/2019", quarantine_path=str(tmp_path / "bad"))
    assert result == {"reports": 2, "quarantined": 3}
    bad = spark.read.json(str(tmp_path / "bad")).collect()
    assert sorted(r.problem for r in bad) == ["bad date", "no page", "short row"]
    reports = readers.read_raw_reports(spark, str(tmp_path / "raw")).collect()
    assert sorted((r.report_link, r.duration) for r in reports) == [
        ("http://www.site.test/s?id=1", "1 min"), ("http://www.site.test/s?id=2", "2 min")]
    assert jobs.pull_reports(*args, str(tmp_path / "all"))["reports"] == 3
    assert jobs.pull_reports(*args, str(tmp_path / "wide"), broadcast_limit=0)["reports"] == 3
    assert set(json.loads(spark.read.text(str(tmp_path / "raw")).first().value)) == set(
        readers.schemas.RAW_REPORT.names)


def test_only_html_goes_through_python(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    out = extract.index_rows(pages, ("nav", "ul", "li", "a"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "Exchange" not in plan and "page_id" not in plan
    assert out.count() > 0


def test_plain_pages_may_have_references_in_links():
    page = '<table><tr><td><u><a href="/day?d=1&amp;n=1&quot;&#39;">2019-03-05</a>x</b>y</u></td></table>'
    cut, whole = html_nodes.plain_tree(page), html_nodes.TreeParser().tree(page)
    assert cut is not None
    assert [(e.tag, e.attrib, e.text, e.tail) for e in cut.iter()] == [
        (e.tag, e.attrib, e.text, e.tail) for e in whole.iter()]
    assert html_nodes.links_at(cut, ("tr", "td", "u", "a")) == [("2019-03-05", "/day?d=1&n=1\"'")]
    assert all(html_nodes.plain_tree(p) is None for p in ('<a href="&lt">', '<a href="&nbsp;">', "<a", "a<"))


def test_hosts_are_told_by_one_match(spark):
    hosts = ["Kits.test", "site.test", "x.test:80"]
    allowed = ["http://site.test/", "HTTP://u:p@SITE.test:80?q", "https://a.b.site.test#x", "x+y://\u212aits.test",
               "https://.site.test\n/".replace("\n", ""), "http://site.test@kits.test/"]
    refused = ["http://site.test@evil.test/", "http://site.test.evil.test/", "http://site.test:x@evil.test/",
               "http://notsite.test/", "//site.test/", " http://site.test/", "http://x.test:80/",
               "http://site.test\n/", "http:///site.test", None]
    df = spark.createDataFrame([(u,) for u in allowed + refused], "u string").coalesce(1)
    one = host_allowed(F.col("u"), hosts)
    assert [r[0] for r in df.select(one).collect()] == [True] * len(allowed) + [False] * len(refused)
    plan = df.where(one)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("regexp_extract") + plan.lower().count("rlike") == 1
    keys = {"http://s.test/a#b\nc#d": "/a\nc", "/a//b": "/a//b", "//s.test//a": "//a", "a#": "/a", "x:y": "/x:y"}
    df = spark.createDataFrame([(u,) for u in keys], "u string").coalesce(1)
    assert [r[0] for r in df.select(link_key(F.col("u"))).collect()] == list(keys.values())

"""The jobs chained: stored pages to documents, quality tables and the audit."""

import json
from datetime import date, datetime

from sightlake import schemas
from sightlake.plans import jobs
from sightlake.sources import readers
from test_extract import LINK_ROW, SITE, detail_page, pages_of, row_of
from test_gazetteer import BLOCKS, LOCATIONS

INDEX_URL = "https://www.site.test/ndx/?id=post"


def listing_row(i, when, city, state, shape):
    cells = [f'<a href="/s?id={i}">Open</a>', when, city, state, "USA", shape, f"summary {i}", "-"]
    return row_of([*cells, "3/7/19"])


def pull(spark, tmp_path, name, rows, root):
    listing = f"<table><tbody>{''.join(rows)}</tbody></table>"
    pages = pages_of(
        spark, (INDEX_URL, "<table>" + LINK_ROW.format("/day?d=1", "2019-03-05") + "</table>"),
        ("https://site.test/day?d=1", listing),
        *[(f"https://site.test/s?id={i}", detail_page(f"<b>Duration:</b> {name}")) for i in range(9)])
    pages.write.parquet(str(tmp_path / f"pages-{name}"))
    raw = str(tmp_path / f"raw-{name}")
    jobs.pull_reports(spark, str(tmp_path / f"pages-{name}"), SITE, INDEX_URL, raw)
    return jobs.merge_pull_file(spark, raw, root, name)


def test_chain(spark, tmp_path):
    root, folder = str(tmp_path / "held"), lambda n: str(tmp_path / n)
    first = [listing_row(1, "3/5/19 21:30", "Springfield (east)", "mo", "Triangular"),
             listing_row(2, "3/6/19", "Springfield/Peoria", "IL", "Light")]
    second = [listing_row(2, "3/6/19 1:00", "springfield", "il", "Light"),
              listing_row(3, "someday", "Nowhere", "ZZ", "")]
    assert pull(spark, tmp_path, "one", first, root).num_rows == 2
    assert pull(spark, tmp_path, "two", second, root).num_rows == 3

    (tmp_path / "locations.csv").write_text(LOCATIONS)
    (tmp_path / "blocks.csv").write_text(BLOCKS)
    jobs.make_gazetteer(spark, folder("locations.csv"), folder("blocks.csv"), folder("cities"))
    held = jobs.held_reports(spark, root)
    assert held.columns == schemas.RAW_REPORT.names
    assert jobs.enhance_reports(
        spark, held, folder("cities"), folder("csv"), folder("parquet"), "2024-06-01") == 3

    rows = {r.report_link[-1]: r for r in readers.read_enhanced_csv(spark, folder("csv")).collect()}
    assert rows["1"].asDict() == {
        "summary": "summary 1", "country": "USA", "city": "Springfield", "state": "MO",
        "date_time": datetime(2019, 3, 5, 21, 30), "shape": "triangle", "duration": "one",
        "stats": "Duration:one", "report_link": "http://www.site.test/s?id=1", "text": None,
        "posted": datetime(2019, 3, 7), "city_latitude": 50.0, "city_longitude": -100.0}
    assert (rows["2"].city, rows["2"].city_latitude, rows["2"].duration) == ("springfield", 39.5, "two")
    assert (rows["3"].date_time, rows["3"].posted, rows["3"].city_latitude) == (None, None, None)

    parquet = spark.read.parquet(folder("parquet"))
    assert parquet.columns == schemas.ENHANCED_COLUMNS
    assert jobs.audit_geocodes(parquet, folder("audit")) == 1
    docs = jobs.index_documents(
        spark, folder("parquet"), "reports", "report", folder("docs"), folder("refused"))
    assert docs == {"indexed": 3, "refused": 0}
    ids = sorted(json.loads(r.value)["_id"] for r in spark.read.text(folder("docs")).collect())
    assert ids == [0, 1, 2]
    quality = jobs.report_quality(spark, folder("parquet"), folder("qa"), as_of="2019-03-10")
    assert dict(map(tuple, quality["posted_counts"].collect())) == {date(2019, 3, 7): 2}
    assert dict(map(tuple, quality["shape_counts"].collect())) == {
        "triangle": 1, "light": 1, "none": 1}

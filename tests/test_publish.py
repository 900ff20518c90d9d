import csv
import json
from datetime import datetime
from pathlib import Path

from pyspark.sql import functions as F

from conftest import SF_DIR
from sightlake import schemas, session
from sightlake.operators import publish
from sightlake.operators.ordering import totals_before
from sightlake.plans import jobs
from sightlake.sources import readers, writers
from sightlake.sources.counts import read_counts

TYPES = ", ".join(
    f"{c} {schemas.ENHANCED_TYPES.get(c, 'string')}" for c in schemas.ENHANCED_COLUMNS)


def report(link, lat, lon, posted=datetime(2019, 3, 7), text="t"):
    values = {"report_link": link, "city_latitude": lat, "city_longitude": lon, "posted": posted,
              "text": text, "city": "Waco"}
    return tuple(values.get(c) for c in schemas.ENHANCED_COLUMNS)


def test_ids_run_without_gaps_in_file_order(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000, numPartitions=13).write.parquet(path)
    spark.range(0).write.mode("append").parquet(path)
    table = spark.read.parquet(path)
    rows = publish.number_rows(table).collect()
    assert sorted(r._id for r in rows) == list(range(1000))
    assert all(r._id == r.id for r in rows)
    assert publish.number_rows(table).columns == ["_id", "id"]
    plan = publish.number_rows(table)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Sort [id" not in plan


def test_index_job(spark, tmp_path):
    rows = [report("/0", 31.5, -97.1), report("/1", None, -97.1), report("/2", 95.0, 0.0),
            report("/3", 0.0, 0.0, None, "line\n\"quoted\"")]
    path, out = str(tmp_path / "reports"), str(tmp_path / "docs")
    spark.createDataFrame(rows, TYPES).coalesce(1).write.parquet(path)
    for _ in range(2):  # a second run replaces the first
        result = jobs.index_documents(
            spark, path, "reports", "report", out, str(tmp_path / "refused"), str(tmp_path / "bulk"))
        assert result == {"indexed": 3, "refused": 1}
    docs = {d["_id"]: d for d in (json.loads(r.value) for r in spark.read.text(out).collect())}
    assert set(docs) == {0, 1, 3}
    assert {k: docs[0][k] for k in ("_op_type", "_index", "_type")} == {
        "_op_type": "index", "_index": "reports", "_type": "report"}
    source = docs[0]["_source"]
    assert list(source) == ["location", *schemas.ENHANCED_COLUMNS]
    assert source["location"] == {"lat": 31.5, "lon": -97.1}
    assert (source["posted"], source["city_latitude"]) == ("2019-03-07T00:00:00", "31.5")
    assert source["state"] is None and docs[1]["_source"]["location"] is None
    assert docs[3]["_source"]["location"] == {"lat": 0.0, "lon": 0.0}
    refused = json.loads(spark.read.text(str(tmp_path / "refused")).first().value)
    assert (refused["_id"], refused["problem"]) == (2, "city_latitude: 95.0")
    bulk = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "bulk")).collect()]
    assert bulk[0] == {"index": {"_index": "reports", "_type": "report", "_id": 0}}
    assert bulk[1] == source and len(bulk) == 6


def test_index_from_csv(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = [report(f"/{i}", float(i), 1.0, text="two\nlines, \"q\"") for i in range(5)]
    writers.write_enhanced_csv(spark.createDataFrame(rows, TYPES).coalesce(1), path)
    out = str(tmp_path / "docs")
    assert jobs.index_documents(
        spark, path, "r", "r", out, str(tmp_path / "no"), from_csv=True) == {"indexed": 5, "refused": 0}
    docs = [json.loads(r.value) for r in spark.read.text(out).collect()]
    assert sorted((d["_id"], d["_source"]["report_link"]) for d in docs) == [
        (i, f"/{i}") for i in range(5)]
    assert all(d["_source"]["text"] == "two\nlines, \"q\"" for d in docs)


def test_csv_parts_are_numbered_by_name(spark, tmp_path):
    path, number = tmp_path / "csv", 0
    for part, rows in enumerate([2, 40, 9]):
        out = str(tmp_path / f"one-{part}")
        writers.write_enhanced_csv(spark.createDataFrame(
            [report(f"/{number + i}", 1.0, 1.0, text="x" * 50) for i in range(rows)], TYPES).coalesce(1), out)
        path.mkdir(exist_ok=True)
        source = next((tmp_path / f"one-{part}").glob("part-*"))
        (path / f"part-0000{part}.csv").write_text(source.read_text())
        number += rows
    docs = str(tmp_path / "docs")
    jobs.index_documents(spark, str(path), "r", "r", docs, str(tmp_path / "no"), from_csv=True)
    read = [json.loads(r.value) for r in spark.read.text(docs).collect()]
    assert sorted((d["_id"], d["_source"]["report_link"]) for d in read) == [
        (i, f"/{i}") for i in range(number)]


def test_typed_view(spark):
    df = spark.createDataFrame(
        [(0, "2019-03-07T00:00:00", "3/5/19", "1.5", "x", "Waco")],
        "_id long, posted string, date_time string, city_latitude string, city_longitude string, city string")
    docs = publish.to_index_docs(df, "i", "t")
    assert docs.first().problem == "city_longitude: x"
    typed = publish.typed_documents(docs)
    assert dict(typed.dtypes)["posted"] == "timestamp_ntz" and dict(typed.dtypes)["city_latitude"] == "float"
    assert typed.first().asDict() == {
        "_id": 0, "date_time": None, "city": "Waco", "posted": datetime(2019, 3, 7),
        "city_latitude": 1.5, "city_longitude": None, "location": None}


def test_enhanced_csv_round_trip(spark, tmp_path):
    texts = ["plain", " both ends ", "a,b", 'say "hi"', "two\nlines", "cr\r\nlf", "\\back\\", "#no comment",
             '"', "\t", "é ☃", "'", '\\"', "NA", "null", "a\"\"b", ",", "x\n"]
    rows = [report(f"/{i}", 0.1 + i, -1e-7 * i, text=t) for i, t in enumerate(texts)]
    rows += [report("/n", None, None, None, None), report("/e", 1.0, 2.0, None, "")]
    df = spark.createDataFrame(rows, TYPES)
    path = str(tmp_path / "csv")
    writers.write_enhanced_csv(df.withColumn("extra", F.lit(1)), path)
    back = readers.read_enhanced_csv(spark, path)
    assert back.dtypes == df.dtypes
    want = {r.report_link: r.asDict() for r in df.collect()}
    want["/e"]["text"] = None  # empty and missing are one
    assert {r.report_link: r.asDict() for r in back.collect()} == want
    assert "2019-03-07T00:00:00" in {
        r.posted for r in readers.read_string_csv(spark, path).select("posted").collect()}


def test_csv_files_written_elsewhere(spark, tmp_path):
    """CRLF line ends, line breaks and quotes inside cells, as csv.DictWriter writes them."""
    texts = ["one", "two\nlines", 'say "hi", then', "", "cr\r\nlf"]
    with open(tmp_path / "reports.csv", "w", newline="") as f:
        writer = csv.DictWriter(f, schemas.ENHANCED_COLUMNS)
        writer.writeheader()
        for i, t in enumerate(texts):
            writer.writerow({"report_link": f"/{i}", "text": t, "posted": "2019-03-07T01:02:03",
                             "city_latitude": 1.5, "city_longitude": None})
    rows = readers.read_enhanced_csv(spark, str(tmp_path / "reports.csv")).collect()
    # In a CRLF file a line break inside a cell is one line feed, as for Python's text mode.
    assert {r.report_link: r.text for r in rows} == {
        f"/{i}": t.replace("\r\n", "\n") or None for i, t in enumerate(texts)}
    assert {(r.posted, r.city_latitude, r.city_longitude) for r in rows} == {
        (datetime(2019, 3, 7, 1, 2, 3), 1.5, None)}
    with open(tmp_path / "blocks.csv", "w", newline="") as f:
        f.write("network,geoname_id,latitude,longitude\r\na,1,2.5,-3.5\r\nb,,,\r\n")
    blocks = readers.read_blocks(spark, str(tmp_path / "blocks.csv")).collect()
    assert [tuple(r) for r in blocks] == [(1, 2.5, -3.5), (None, None, None)]


def test_running_totals_over_ranges(spark):
    rows = spark.range(2000, numPartitions=7).selectExpr("1999 - id AS at", "id % 5 AS amount", "'x' AS start_")
    found = totals_before(rows, [F.col("at")], F.col("amount"))
    total = 0
    for row in found.orderBy("at").collect():
        assert row["start"] == total
        total += row["amount"]
    assert totals_before(rows.limit(0), [F.col("at")], F.col("amount")).count() == 0


def test_ids_need_no_single_task(spark):
    numbered = publish.number_rows(spark.read.parquet(f"{SF_DIR}/customer.parquet"))
    assert "SinglePartition" not in numbered._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["_id"] for r in numbered.select("_id").collect()) == list(range(numbered.count()))


def test_document_job_leaves_nothing_staged(spark, tmp_path):
    folder = lambda n: str(tmp_path / n)
    spark.createDataFrame(
        [("a", "1.5", "2"), ("b", "91", "2"), ("c", None, None)],
        "report_link string, city_latitude string, city_longitude string").write.parquet(folder("reports"))
    held = Path(session.staging_path(spark, "x").removeprefix("file:")).parent
    before = set(held.iterdir()) if held.is_dir() else set()
    result = jobs.index_documents(
        spark, folder("reports"), "i", "t", folder("good"), folder("bad"), folder("bulk"), counts_path=folder("counts"))
    assert result == {"indexed": 2, "refused": 1}
    assert (set(held.iterdir()) if held.is_dir() else set()) == before
    assert {(r["job"], r["name"], r["num"]) for r in read_counts(spark, folder("counts")).collect()} == {
        ("index", "indexed", 2), ("index", "refused", 1)}
    assert read_counts(spark, folder("none")).count() == 0
    lines = [json.loads(r["value"]) for r in spark.read.text(folder("bulk")).collect()]
    assert len(lines) == 4 and spark.read.text(folder("bad")).count() == 1

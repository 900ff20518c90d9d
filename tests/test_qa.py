from datetime import date, datetime

from pyspark.sql import functions as F

from sightlake.operators import qa
from sightlake.plans import jobs

AS_OF = date(2024, 6, 1)
ROWS = [
    (datetime(2024, 5, 30, 5), datetime(2024, 5, 31), "light", "USA", "TX", 1.0, 2.0, "a"),
    (datetime(2024, 5, 30, 23), datetime(2024, 5, 31), None, "USA", None, 1.0, 2.0, "b"),
    (datetime(2023, 1, 1), None, "light", "Canada", "ON", 1.0, None, "c"),
    (None, datetime(2024, 2, 1), "disk", None, "TX", None, 2.0, "d"),
    (datetime(2024, 7, 1), datetime(2024, 5, 31), "light", "USA", "TX", 3.0, 0.0, "e"),
]
SCHEMA = (
    "date_time timestamp_ntz, posted timestamp_ntz, shape string, country string, state string, "
    "city_latitude double, city_longitude double, report_link string"
)
D = date
EXPECTED = {
    "date_time_counts": {D(2024, 5, 30): 2, D(2023, 1, 1): 1, D(2024, 7, 1): 1},
    "recent_date_time_counts": {D(2024, 5, 30): 2, D(2024, 7, 1): 1},
    "posted_counts": {D(2024, 5, 31): 3, D(2024, 2, 1): 1},
    "recent_posted_counts": {D(2024, 5, 31): 3},
    "shape_counts": {"light": 3, "none": 1, "disk": 1},
    "recent_shape_counts": {"light": 2, "none": 1},
    "country_counts": {"USA": 3},
    "recent_country_counts": {"USA": 3},
    "state_counts": {"TX": 3},
    "recent_state_counts": {"TX": 2},
    "geos": {1.0: 2.0, 3.0: 0.0},
}


def test_qa_job(spark, tmp_path):
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(str(tmp_path / "reports"))
    results = jobs.report_quality(
        spark, str(tmp_path / "reports"), str(tmp_path / "qa"), as_of=AS_OF)
    assert set(results) == {*EXPECTED, "sample", "num_records"}
    for name, want in EXPECTED.items():
        assert dict(map(tuple, results[name].collect())) == want, name
    assert results["num_records"].first().num_records == 5
    # Latest first, ties by link, rows without a date left out.
    sample = qa.sample_latest(spark.read.parquet(str(tmp_path / "reports"))).collect()
    assert [r.report_link for r in sample] == ["a", "b", "e", "d"]
    assert spark.sql("SELECT count(*) AS n FROM reports").first().n == 5


def test_recency_edge(spark):
    rows = [(datetime(2024, 2, 22, 23, 59), "out"), (datetime(2024, 2, 23), "in")]
    df = spark.createDataFrame(rows, "t timestamp_ntz, k string")
    assert [r.k for r in df.where(qa.is_recent(F.col("t"), 100, "2024-06-01")).collect()] == ["in"]
    assert df.where(qa.is_recent(F.col("t"), 100)).count() == 0


def test_display_order(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1)], "k string, num_reports int")
    assert [r.k for r in qa.in_display_order(df, "k").collect()] == ["c", "a", "b"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_prune_and_push_down(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    recent = qa.daily_counts(events, "ts", 10, "2024-01-31")
    assert "GreaterThanOrEqual(ts," in plan_of(recent)
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan_of(recent)
    # The default moment folds to a literal, too.
    assert "GreaterThanOrEqual(ts," in plan_of(qa.daily_counts(events, "ts", 10))
    assert "ReadSchema: struct<event_type:string>" in plan_of(qa.category_counts(events, "event_type"))
    assert "TakeOrderedAndProject" in plan_of(qa.sample_latest(events, "ts", "event_id"))


def test_report_scans_little(spark, tmp_path):
    spark.createDataFrame(ROWS, SCHEMA).withColumn("text", F.lit("long")).write.parquet(str(tmp_path / "r"))
    reports = spark.read.parquet(str(tmp_path / "r"))
    counts = plan_of(qa.shared_counts(reports, 100, AS_OF))
    assert counts.count("FileScan parquet") == 1 and "text" not in counts
    results = qa.qa_report(reports, as_of=AS_OF)
    read = [name for name, df in results.items() if str(tmp_path) in plan_of(df)]
    assert read == ["sample", "geos"]
    assert "text" not in plan_of(results["geos"])
    empty = qa.qa_report(reports.limit(0), as_of=AS_OF)
    assert empty["num_records"].first().num_records == 0 and empty["sample"].count() == 0


def test_sample_of_many_ties(spark):
    rows = spark.range(500).selectExpr(
        "cast(NULL AS string) AS report_link", "timestamp_ntz'2024-01-01 00:00:00.123456' AS posted", "id")
    rows = rows.unionByName(spark.range(3).selectExpr(
        "'b' AS report_link", "timestamp_ntz'2024-01-02' AS posted", "id"))
    got = qa.sample_latest(rows, n=10).collect()
    assert len(got) == 10 and [r.report_link for r in got[:3]] == ["b"] * 3
    rest = sorted(rows.where("report_link IS NULL").withColumn(
        "h", F.xxhash64("report_link", "posted", "id")).collect(), key=lambda r: r.h)[:7]
    assert [r.id for r in got[3:]] == [r.id for r in rest]

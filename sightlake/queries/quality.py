"""Quality queries over events, orders and customers."""

from functools import reduce

from pyspark.sql import functions as F

from sightlake.operators import qa
from sightlake.plans import jobs
from sightlake.queries import Query, table
from sightlake.session import staging_path

AS_OF, DAYS = "2024-01-31", 10
KIND = "nullif(event_type, 'error') AS kind"
USER = "cast(user_id AS string) AS user"
BUYER = "cast(o_custkey AS string) AS buyer"
PLACES = (
    "CASE WHEN c_nationkey <> 0 THEN cast(c_nationkey AS double) - 12.5 END AS lat, "
    "CASE WHEN c_mktsegment <> 'MACHINERY' THEN cast(floor(c_acctbal / 100) AS double) END AS lon"
)
# A report view of the events, alike in both engines.
REPORTS = """
    SELECT CASE WHEN event_id % 9 <> 0 THEN ts END AS date_time,
           CASE WHEN event_type <> 'view' THEN ts END AS posted,
           nullif(event_type, 'error') AS shape,
           CASE WHEN user_id % 4 <> 0 THEN concat('C', user_id % 4) END AS country,
           CASE WHEN user_id > 5 THEN concat('S', user_id) END AS state,
           CASE WHEN user_id % 10 <> 0 THEN cast(user_id AS double) END AS city_latitude,
           CASE WHEN event_type <> 'click' THEN cast(user_id % 30 AS double) END AS city_longitude,
           concat('/r/', event_id) AS report_link
    FROM {events}
"""


def events(spark, sf_dir, *columns):
    return table(spark, sf_dir, "events").selectExpr("*", *columns)


def daily_counts(spark, sf_dir):
    return qa.daily_counts(events(spark, sf_dir), "ts")


def recent_daily_counts(spark, sf_dir):
    return qa.daily_counts(events(spark, sf_dir), "ts", DAYS, AS_OF)


def category_counts(spark, sf_dir):
    return qa.category_counts(events(spark, sf_dir, KIND), "kind")


def category_counts_display(spark, sf_dir):
    return qa.in_display_order(category_counts(spark, sf_dir), "kind")


def category_counts_recent(spark, sf_dir):
    return qa.category_counts(
        events(spark, sf_dir, KIND), "kind", recent_by="ts", days=DAYS, as_of=AS_OF)


def category_counts_having(spark, sf_dir):
    return qa.category_counts(table(spark, sf_dir, "orders").selectExpr(BUYER), "buyer", more_than=1)


def category_counts_recent_having(spark, sf_dir):
    return qa.category_counts(
        events(spark, sf_dir, USER), "user", more_than=20, recent_by="ts", days=DAYS, as_of=AS_OF)


def distinct_pairs(spark, sf_dir):
    return qa.distinct_geos(table(spark, sf_dir, "customer").selectExpr(*_split(PLACES)), "lat", "lon")


def _split(select_list):
    first, second = select_list.split(" AS lat, ")
    return first + " AS lat", second


def record_count(spark, sf_dir):
    return qa.record_count(table(spark, sf_dir, "orders"))


def sample_latest(spark, sf_dir):
    return qa.sample_latest(table(spark, sf_dir, "orders"), "o_orderdate", "o_orderkey")


def _long(results):
    """All quality queries in one long table of (query, item, num)."""
    parts = []
    for name, df in results.items():
        if name == "sample":
            item, num = F.col("report_link"), F.lit(1)
        elif name == "num_records":
            item, num = F.lit("all"), F.col("num_records")
        elif name == "geos":
            item = F.concat_ws(",", F.col("latitude").cast("int"), F.col("longitude").cast("int"))
            num = F.lit(1)
        else:
            item, num = F.col(df.columns[0]).cast("string"), F.col("num_reports")
        parts.append(df.select(
            F.lit(name).alias("query"), item.alias("item"), num.cast("long").alias("num")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _reports(spark, sf_dir):
    table(spark, sf_dir, "events").createOrReplaceTempView("report_events")
    return spark.sql(REPORTS.format(events="report_events"))


def qa_report(spark, sf_dir):
    return _long(qa.qa_report(_reports(spark, sf_dir), DAYS, AS_OF))


def report_quality(spark, sf_dir):
    """The quality job: reports in Parquet to a table for each query, read back."""
    path, out = staging_path(spark, "reports"), staging_path(spark, "quality")
    _reports(spark, sf_dir).write.parquet(path)
    return _long(jobs.report_quality(spark, path, out, DAYS, AS_OF))


RECENT = f"DATE '{AS_OF}' - CAST({{0}} AS DATE) < {DAYS}"


def _counts(select, source="r", where="TRUE", having="TRUE"):
    return f"SELECT {select} AS item, count(*) AS num FROM {source} WHERE {where} GROUP BY 1 HAVING {having}"


_RECENT_DT = "date_time IS NOT NULL AND " + RECENT.format("date_time")
_QA_PARTS = {
    "date_time_counts": _counts("CAST(CAST(date_time AS DATE) AS VARCHAR)", where="date_time IS NOT NULL"),
    "recent_date_time_counts": _counts("CAST(CAST(date_time AS DATE) AS VARCHAR)", where=_RECENT_DT),
    "posted_counts": _counts("CAST(CAST(posted AS DATE) AS VARCHAR)", where="posted IS NOT NULL"),
    "recent_posted_counts": _counts(
        "CAST(CAST(posted AS DATE) AS VARCHAR)",
        where="posted IS NOT NULL AND " + RECENT.format("posted")),
    "geos": (
        "SELECT DISTINCT concat(CAST(city_latitude AS INT), ',', CAST(city_longitude AS INT)) AS item, "
        "1 AS num FROM r WHERE city_latitude IS NOT NULL AND city_longitude IS NOT NULL"),
    "num_records": "SELECT 'all' AS item, count(*) AS num FROM r",
    "sample": (
        "SELECT report_link AS item, 1 AS num FROM (SELECT * FROM r WHERE posted IS NOT NULL "
        "ORDER BY posted DESC, report_link LIMIT 100)"),
}
for _category, _having in (("shape", "TRUE"), ("country", "count(*) > 1"), ("state", "count(*) > 1")):
    _item = f"coalesce({_category}, 'none')"
    _QA_PARTS[f"{_category}_counts"] = _counts(_item, having=_having)
    _QA_PARTS[f"recent_{_category}_counts"] = _counts(_item, where=_RECENT_DT, having=_having)

QA_SQL = f"WITH r AS ({REPORTS.format(events='events')}) " + " UNION ALL ".join(
    f"SELECT '{name}' AS query, item, CAST(num AS BIGINT) AS num FROM ({sql})"
    for name, sql in _QA_PARTS.items()
)

_BY_DAY = "SELECT CAST(ts AS DATE) AS day, count(*) AS num_reports FROM events WHERE ts IS NOT NULL{0} GROUP BY 1"
_BY_KIND = "SELECT coalesce(nullif(event_type, 'error'), 'none') AS kind, count(*) AS num_reports FROM events{0} GROUP BY 1"

QUERIES = {
    "daily_counts": Query(daily_counts, _BY_DAY.format("")),
    "recent_daily_counts": Query(recent_daily_counts, _BY_DAY.format(" AND " + RECENT.format("ts"))),
    "category_counts": Query(category_counts, _BY_KIND.format("")),
    "category_counts_display": Query(
        category_counts_display, _BY_KIND.format("") + " ORDER BY num_reports, kind"),
    "category_counts_recent": Query(
        category_counts_recent, _BY_KIND.format(" WHERE " + RECENT.format("ts"))),
    "category_counts_having": Query(
        category_counts_having,
        "SELECT coalesce(CAST(o_custkey AS VARCHAR), 'none') AS buyer, count(*) AS num_reports "
        "FROM orders GROUP BY 1 HAVING count(*) > 1"),
    "category_counts_recent_having": Query(
        category_counts_recent_having,
        "SELECT CAST(user_id AS VARCHAR) AS user, count(*) AS num_reports FROM events "
        f"WHERE {RECENT.format('ts')} GROUP BY 1 HAVING count(*) > 20"),
    "distinct_pairs": Query(
        distinct_pairs,
        f"SELECT DISTINCT lat AS latitude, lon AS longitude FROM (SELECT {PLACES} FROM customer) "
        "WHERE lat IS NOT NULL AND lon IS NOT NULL"),
    "record_count": Query(record_count, "SELECT count(*) AS num_records FROM orders"),
    "sample_latest": Query(
        sample_latest,
        "SELECT * FROM orders WHERE o_orderdate IS NOT NULL ORDER BY o_orderdate DESC, o_orderkey LIMIT 100"),
    "qa_report": Query(qa_report, QA_SQL),
    "report_quality": Query(report_quality, QA_SQL),
}

"""Index documents from customers and orders."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightlake import session
from sightlake.operators import publish
from sightlake.plans import jobs
from sightlake.queries import Query, table

# Alike in both engines. Some latitudes are beyond 90 degrees, some are missing.
FIELDS = {
    "report_link": "c_name",
    "city": "nullif(c_mktsegment, 'MACHINERY')",
    "posted": "CASE WHEN c_nationkey % 2 = 0 THEN '2019-03-07T12:30:00' ELSE '3/7/19' END",
    "city_latitude": "CASE WHEN c_nationkey <> 3 THEN c_acctbal / 100.0 END",
    "city_longitude": "CASE WHEN c_nationkey <> 4 THEN cast(-c_nationkey AS double) END",
}


def _numbered(spark, sf_dir):
    """Customers in file order, with the report fields as text."""
    rows = publish.number_rows(table(spark, sf_dir, "customer"))
    fields = rows.selectExpr("_id", *[f"{e} AS {n}" for n, e in FIELDS.items()])
    return publish.as_text(fields, keep=["_id"])


def _docs(spark, sf_dir):
    return publish.to_index_docs(_numbered(spark, sf_dir), "reports", "report")


def _number(name):
    return F.col(f"_source.{name}").cast("double").alias(name)


def index_docs(spark, sf_dir):
    return _docs(spark, sf_dir).select(
        "_op_type", "_index", "_type", "_id", "_source.location.lat", "_source.location.lon",
        "_source.report_link", "_source.city", "_source.posted", _number("city_latitude"),
        _number("city_longitude"), "problem")


def index_docs_typed(spark, sf_dir):
    typed = publish.typed_documents(_docs(spark, sf_dir))
    return typed.select(
        "_id", "report_link", "city", "posted",
        F.col("city_latitude").cast("double").alias("city_latitude"),
        F.col("city_longitude").cast("double").alias("city_longitude"), "location.lat", "location.lon")


def _indexed(spark, sf_dir):
    """Paths of what the document job writes: documents, refused ones, and the bulk file."""
    source = table(spark, sf_dir, "customer").selectExpr(*[f"{e} AS {n}" for n, e in FIELDS.items()])
    path, out, refused, bulk = (
        session.staging_path(spark, n) for n in ("reports", "docs", "refused", "bulk"))
    source.write.parquet(path)
    jobs.index_documents(spark, path, "reports", "report", out, refused, bulk)
    return out, refused, bulk


_PLACE = T.StructField("location", T.StructType([
    T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())]))
_SOURCE = T.StructType([_PLACE, *[T.StructField(n, T.StringType()) for n in FIELDS]])
_ENVELOPE = [T.StructField("_index", T.StringType()), T.StructField("_type", T.StringType()),
             T.StructField("_id", T.LongType())]


def index_job(spark, sf_dir):
    """The document job: enhanced reports in Parquet to load files, accepted and refused, read back."""
    out, refused, _ = _indexed(spark, sf_dir)
    doc = T.StructType([
        T.StructField("_op_type", T.StringType()), *_ENVELOPE, T.StructField("_source", _SOURCE),
        T.StructField("problem", T.StringType())])
    docs = spark.read.schema(doc).json([out, refused])
    return docs.select(
        "_op_type", "_index", "_type", "_id", "_source.location.lat", "_source.location.lon",
        "_source.report_link", "_source.city", "_source.posted", _number("city_latitude"),
        _number("city_longitude"), "problem")


def index_bulk(spark, sf_dir):
    """The bulk file's lines by kind: what to do with which id, and the document."""
    lines = spark.read.text(_indexed(spark, sf_dir)[2])
    action = F.from_json("value", T.StructType([T.StructField("index", T.StructType(_ENVELOPE))]))["index"]
    source = F.from_json("value", _SOURCE)
    parsed = lines.select(action.alias("action"), source.alias("_source"))
    return parsed.select(
        "action._index", "action._type", "action._id", "_source.location.lat", "_source.location.lon",
        "_source.report_link", "_source.city", "_source.posted", _number("city_latitude"),
        _number("city_longitude"))


_ROWS = (
    "SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS _id, "
    + ", ".join(f"{e} AS {n}" for n, e in FIELDS.items()) + " FROM customer")
_BOTH = "city_latitude IS NOT NULL AND city_longitude IS NOT NULL"

_FIELDS = (
    f"CASE WHEN {_BOTH} THEN city_latitude END AS lat, CASE WHEN {_BOTH} THEN city_longitude END AS lon, "
    "report_link, city, posted, city_latitude, city_longitude")
_DOCS = (
    f"SELECT 'index' AS _op_type, 'reports' AS _index, 'report' AS _type, _id, {_FIELDS}, "
    "CASE WHEN city_latitude > 90 THEN concat('city_latitude: ', CAST(city_latitude AS VARCHAR)) END "
    f"AS problem FROM ({_ROWS})")

QUERIES = {
    "index_docs": Query(index_docs, _DOCS),
    "index_docs_typed": Query(
        index_docs_typed,
        "SELECT _id, report_link, city, CASE WHEN posted LIKE '2019%' THEN TIMESTAMP '2019-03-07 12:30:00' "
        "END AS posted, CAST(CAST(city_latitude AS FLOAT) AS DOUBLE) AS city_latitude, city_longitude, "
        f"CASE WHEN {_BOTH} THEN city_latitude END AS lat, "
        f"CASE WHEN {_BOTH} THEN city_longitude END AS lon FROM ({_ROWS})"),
    "index_documents_job": Query(index_job, _DOCS),
    "index_documents_bulk": Query(
        index_bulk,
        f"WITH d AS (SELECT _id, {_FIELDS} FROM ({_ROWS}) WHERE city_latitude IS NULL OR city_latitude <= 90) "
        "SELECT 'reports' AS _index, 'report' AS _type, _id, CAST(NULL AS DOUBLE) AS lat, "
        "CAST(NULL AS DOUBLE) AS lon, CAST(NULL AS VARCHAR) AS report_link, CAST(NULL AS VARCHAR) AS city, "
        "CAST(NULL AS VARCHAR) AS posted, CAST(NULL AS DOUBLE) AS city_latitude, "
        "CAST(NULL AS DOUBLE) AS city_longitude FROM d UNION ALL "
        "SELECT NULL, NULL, NULL, lat, lon, report_link, city, posted, city_latitude, city_longitude FROM d"),
}

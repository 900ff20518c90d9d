"""File formats and the enhance job, end to end."""

from sightlake import schemas, session
from sightlake.plans import jobs
from sightlake.queries import Query, cleaning, pages, table
from sightlake.sources import readers, writers
from sightlake.sources.counts import read_counts

# Line breaks, quotes, separators and white space at the ends; alike in both engines.
TRICKY = (
    "concat(' line one', chr(10), 'say \"', o_orderstatus, '\", then', chr(13), chr(10), "
    "'back\\\\slash, ', o_orderpriority, ' ')"
)
ENHANCED = {
    "summary": "CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END",
    "country": "cast(NULL AS string)", "city": "concat('#', o_custkey)", "state": "o_orderstatus",
    "date_time": "CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate END",
    "shape": "'\"'", "duration": "cast(NULL AS string)", "stats": "','",
    "report_link": "concat('/r/', o_orderkey)", "text": TRICKY,
    "posted": "o_orderdate + INTERVAL 90 MINUTE",
    "city_latitude": "CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END",
    "city_longitude": "cast(-o_custkey AS double)",
}
# A gazetteer from the customers: places to find for the cities of the cleaning queries.
PLACES = {
    "country_iso_code": "concat('C', c_nationkey)", "country_name": "c_mktsegment",
    "subdivision_1_iso_code": "lower({state})", "subdivision_1_name": "'s'",
    "city_name": "upper({city})", "latitude": "cast(c_nationkey AS double)",
    "longitude": "cast(-c_custkey AS double)", "num_blocks": "c_custkey % 50",
}


def csv_round_trip(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {n}" for n, e in ENHANCED.items()])
    path = session.staging_path(spark, "enhanced")
    writers.write_enhanced_csv(rows, path)
    return readers.register_reports(readers.read_enhanced_csv(spark, path), "round_trip")


def _places(spark, sf_dir):
    index = f"c_custkey % {len(cleaning.CITIES)}"
    customers = table(spark, sf_dir, "customer").withColumns({
        "city": cleaning.picked(index, [c[2] for c in cleaning.CITIES]),
        "state": cleaning.picked(index, [c[1] for c in cleaning.CITIES])})
    listed = customers.selectExpr(
        *[f"{e.format(city='city', state='state')} AS {n}" for n, e in PLACES.items()])
    return listed.dropna(subset=schemas.PLACE_KEYS)


def enhance_reports(spark, sf_dir):
    """Raw NDJSON and a gazetteer CSV to the enhanced CSV, read back."""
    raw, cities, out, parquet = (
        session.staging_path(spark, n) for n in ("raw", "cities", "enhanced", "enhanced_parquet"))
    writers.write_ndjson(cleaning.raw_reports(spark, sf_dir), raw)
    writers.write_csv(_places(spark, sf_dir), cities)
    jobs.enhance_reports(
        spark, readers.read_raw_reports(spark, raw), cities, out, parquet, cleaning.AS_OF)
    return readers.read_enhanced_csv(spark, out)


def stage_counts(spark, sf_dir):
    """Pull, three merges and the enhance job, and what each of them counted."""
    root, cities, raw, out = (session.staging_path(spark, n) for n in ("held", "cities", "raw", "enhanced"))
    counts = f"{root}/counts"
    pulled = pages.pulled_customers(spark, sf_dir, counts)
    writers.write_ndjson(cleaning.raw_reports(spark, sf_dir), raw)
    for pull, path in (("orders", raw), ("customers", pulled), ("customers again", pulled)):
        jobs.merge_pull_file(spark, path, root, pull)
    writers.write_csv(_places(spark, sf_dir), cities)
    jobs.enhance_reports(
        spark, jobs.held_reports(spark, root), cities, None, out, cleaning.AS_OF, counts_path=counts)
    return read_counts(spark, counts).select("job", "name", "num")


_DUCK_TRICKY = TRICKY.replace("\\\\", "\\")
_STATE = cleaning.STATE_SQL.format(key="{key}")
_COUPLED = cleaning.COUPLED

_ENHANCED_SQL = (
    "WITH places AS (SELECT "
    + ", ".join(f"{e} AS {n}" for n, e in PLACES.items()).format(
        city=cleaning.CITY_SQL.format(key="c_custkey"), state=_STATE.format(key="c_custkey"))
    + " FROM customer), best AS (SELECT upper(subdivision_1_iso_code) AS state_key, "
    "lower(city_name) AS city_key, latitude, longitude FROM places "
    f"WHERE {' AND '.join(k + ' IS NOT NULL' for k in schemas.PLACE_KEYS)} "
    "QUALIFY row_number() OVER (PARTITION BY upper(subdivision_1_iso_code), lower(city_name) "
    f"ORDER BY num_blocks DESC, {', '.join(schemas.PLACE_KEYS)}, latitude, longitude) = 1), "
    "cleaned AS (SELECT o_orderpriority AS summary, 'USA' AS country, "
    f"nullif({cleaning.CITY_SQL.format(key='o_orderkey')}, '') AS city, "
    f"nullif({_STATE.format(key='o_orderkey')}, '') AS state, "
    f"CASE WHEN {_COUPLED} THEN d END AS date_time, "
    f"nullif({cleaning.SHAPE_SQL.format(key='o_orderkey')}, '') AS shape, "
    "CAST(NULL AS VARCHAR) AS duration, "
    "CASE WHEN o_orderkey % 5 <> 0 THEN concat('a:', o_orderstatus) END AS stats, "
    "concat('/r/', o_orderkey) AS report_link, concat('text ', o_orderkey) AS text, "
    f"CASE WHEN {_COUPLED} THEN p END AS posted FROM ({cleaning.PARSED_SQL})) "
    "SELECT cleaned.*, latitude AS city_latitude, longitude AS city_longitude FROM cleaned "
    "LEFT JOIN best ON state = state_key AND lower(city) = city_key")

_COUNTS_SQL = f"""
WITH c AS (SELECT c_custkey AS k, c_custkey % 2000 AS day FROM customer),
good AS (SELECT DISTINCT day FROM c WHERE k % 13 <> 0 AND k % 11 <> 0),
listed AS (SELECT k FROM c WHERE day IN (SELECT day FROM good)),
n AS (
  SELECT (SELECT count(*) FROM listed WHERE k % 3 <> 0) AS pulled,
    (SELECT count(*) FROM c WHERE k % 13 = 0 OR k % 11 = 0) AS undated,
    (SELECT count(*) FROM listed WHERE k % 3 = 0) AS unpaged, (SELECT count(*) FROM orders) AS held,
    (SELECT count(city_latitude) FROM ({_ENHANCED_SQL})) AS found)
SELECT job, name, CAST(num AS BIGINT) AS num FROM n, LATERAL (VALUES
  ('pull', 'reports', pulled), ('pull', 'quarantined', undated + 2 * unpaged),
  ('merge', 'held', 0), ('merge', 'added', held), ('merge', 'rows', held),
  ('merge', 'held', held), ('merge', 'added', pulled), ('merge', 'rows', held + pulled),
  ('merge', 'held', held + pulled), ('merge', 'added', pulled), ('merge', 'rows', held + pulled),
  ('enhance', 'rows', held + pulled), ('enhance', 'geocoded', found)) v(job, name, num)
"""

QUERIES = {
    "csv_round_trip": Query(
        csv_round_trip,
        "SELECT " + ", ".join(
            f"{_DUCK_TRICKY if n == 'text' else e} AS {n}" for n, e in ENHANCED.items()) + " FROM orders"),
    "enhance_reports": Query(enhance_reports, _ENHANCED_SQL),
    "stage_counts": Query(stage_counts, _COUNTS_SQL),
}

"""Gazetteer and geocoding: line items as address blocks, parts as locations."""

from pyspark.sql import functions as F

from sightlake import session
from sightlake.operators import gazetteer
from sightlake.plans import jobs
from sightlake.queries import Query, table
from sightlake.sources import readers, writers

# Alike in both engines. Coordinates are whole numbers, so sums are exact in any order.
BLOCK_COLUMNS = {
    "geoname_id": "CASE WHEN l_linenumber <> 6 THEN l_partkey END",
    "latitude": "CASE WHEN l_linenumber <> 7 THEN cast(l_quantity AS double) END",
    "longitude": "cast(-l_suppkey AS double)",
}
LOCATION_COLUMNS = {
    "geoname_id": "p_partkey",
    "country_iso_code": "CASE WHEN p_brand = 'Brand#13' THEN 'NA' ELSE concat('X', p_size % 3) END",
    "country_name": "p_brand",
    "subdivision_1_iso_code": "lower(p_type)",
    "subdivision_1_name": "p_type",
    "city_name": "CASE WHEN p_size = 1 THEN NULL WHEN p_size % 2 = 0 THEN upper(p_name) ELSE p_name END",
}
COLOURS, THINGS = "blue,cold,hot,large,red,small,grey", "anvil,bolt,gear,gizmo,plate,ring,rod,widget"
KINDS = "ECONOMY,LARGE,MEDIUM,PROMO,SMALL,STANDARD,ZZ"
REPORT_COLUMNS = {
    "c_custkey": "c_custkey",
    "state": f"CASE WHEN c_custkey % 17 = 0 THEN '' ELSE split_part('{KINDS}', ',', cast(1 + c_custkey % 7 AS int)) END",
    "city": (
        "CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE "
        f"concat(upper(split_part('{COLOURS}', ',', cast(1 + c_nationkey % 7 AS int))), ' ', "
        f"split_part('{THINGS}', ',', cast(1 + c_custkey % 8 AS int))) END"
    ),
}
KEYS = ", ".join(gazetteer.KEYS)


def _listed(columns: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in columns.items())


def _selected(df, columns: dict[str, str]):
    return df.select(*[F.expr(e).alias(n) for n, e in columns.items()])


def blocks(spark, sf_dir):
    return _selected(table(spark, sf_dir, "lineitem"), BLOCK_COLUMNS)


def locations(spark, sf_dir):
    raw = _selected(table(spark, sf_dir, "part"), LOCATION_COLUMNS)
    return raw.withColumns({
        k: readers.tokens_to_null(F.col(k), readers.NA_TOKENS) for k in gazetteer.KEYS})


def reports(spark, sf_dir):
    return _selected(table(spark, sf_dir, "customer"), REPORT_COLUMNS)


def _rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in df.columns if c.endswith(("latitude", "longitude"))})


def gazetteer_table(spark, sf_dir):
    return _rounded(gazetteer.build_gazetteer(blocks(spark, sf_dir), locations(spark, sf_dir)))


def gazetteer_from_csv(spark, sf_dir):
    """The gazetteer job, from CSV files to a CSV file."""
    paths = [session.staging_path(spark, n) for n in ("locations", "blocks", "cities")]
    writers.write_csv(_selected(table(spark, sf_dir, "part"), LOCATION_COLUMNS), paths[0])
    writers.write_csv(blocks(spark, sf_dir), paths[1])
    jobs.make_gazetteer(spark, *paths)
    return _rounded(readers.read_cities(spark, paths[2]))


def _best(spark, sf_dir):
    """Best places, written once: their size is measured and then they are joined."""
    cities = gazetteer.build_gazetteer(blocks(spark, sf_dir), locations(spark, sf_dir))
    return session.stage(gazetteer.best_city(cities), "best_city")


def best_city(spark, sf_dir):
    cities = gazetteer.build_gazetteer(blocks(spark, sf_dir), locations(spark, sf_dir))
    return _rounded(gazetteer.best_city(cities))


def geocode(spark, sf_dir):
    return _rounded(gazetteer.geocode(reports(spark, sf_dir), _best(spark, sf_dir)))


def geocode_hot_keys(spark, sf_dir):
    """The same without a broadcast, with every key that repeats spread over several tasks."""
    coded = gazetteer.geocode(
        reports(spark, sf_dir), _best(spark, sf_dir), broadcast_limit=0, hot_rows=3, salts=8)
    return _rounded(coded)


def missing_geocodes(spark, sf_dir):
    coded = gazetteer.geocode(reports(spark, sf_dir), _best(spark, sf_dir))
    return gazetteer.ranked(gazetteer.missing_geocodes(coded))


def missing_geocodes_total(spark, sf_dir):
    return gazetteer.total_missing(missing_geocodes(spark, sf_dir))


def missing_geocodes_csv(spark, sf_dir):
    """The audit job, read back from its CSV file."""
    coded = gazetteer.geocode(reports(spark, sf_dir), _best(spark, sf_dir))
    path = session.staging_path(spark, "bad_cities")
    jobs.audit_geocodes(coded, path)
    audit = readers.read_string_csv(spark, path)
    return audit.select("city", "state", F.col("count").cast("long").alias("count"))


CITIES_SQL = f"""
    WITH joined AS (
        SELECT b.latitude, b.longitude, l.* REPLACE (nullif(country_iso_code, 'NA') AS country_iso_code)
        FROM (SELECT {_listed(BLOCK_COLUMNS)} FROM lineitem) b
        JOIN (SELECT {_listed(LOCATION_COLUMNS)} FROM part) l USING (geoname_id)
    ), cities AS (
        SELECT {KEYS}, avg(latitude) AS latitude, avg(longitude) AS longitude, count(*) AS num_blocks
        FROM joined WHERE {' AND '.join(f'{k} IS NOT NULL' for k in gazetteer.KEYS)} GROUP BY {KEYS}
    ), best AS (
        SELECT upper(subdivision_1_iso_code) AS state_key, lower(city_name) AS city_key,
               latitude, longitude, num_blocks
        FROM cities QUALIFY row_number() OVER (
            PARTITION BY upper(subdivision_1_iso_code), lower(city_name)
            ORDER BY num_blocks DESC, {KEYS}) = 1
    ), coded AS (
        SELECT r.*, round(best.latitude, 6) AS city_latitude, round(best.longitude, 6) AS city_longitude
        FROM (SELECT {_listed(REPORT_COLUMNS)} FROM customer) r
        LEFT JOIN best ON r.state = best.state_key AND lower(r.city) = best.city_key
    )
"""
_CITIES = f"{CITIES_SQL} SELECT {KEYS}, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, num_blocks FROM cities"
_CODED = f"{CITIES_SQL} SELECT * FROM coded"
_MISSING = (
    f"{CITIES_SQL} SELECT city, {{state}} AS state, count(*) AS count FROM coded "
    "WHERE city_latitude IS NULL OR city_longitude IS NULL GROUP BY 1, 2")

QUERIES = {
    "gazetteer": Query(gazetteer_table, _CITIES),
    "gazetteer_from_csv": Query(gazetteer_from_csv, _CITIES),
    "best_city": Query(
        best_city,
        f"{CITIES_SQL} SELECT state_key, city_key, round(latitude, 6) AS latitude, "
        "round(longitude, 6) AS longitude, num_blocks FROM best"),
    "geocode": Query(geocode, _CODED),
    "geocode_hot_keys": Query(geocode_hot_keys, _CODED),
    "missing_geocodes": Query(missing_geocodes, _MISSING.format(state="state")),
    "missing_geocodes_total": Query(
        missing_geocodes_total,
        f"{CITIES_SQL} SELECT count(*) AS total FROM coded WHERE city_latitude IS NULL OR city_longitude IS NULL"),
    "missing_geocodes_csv": Query(missing_geocodes_csv, _MISSING.format(state="nullif(state, '')")),
}

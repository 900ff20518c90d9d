"""Sites from placemarks built on suppliers, and buffers around customers."""

from pyspark.sql import functions as F

from sightlake.functions.geodesy import buffer_ring, ring_to_geojson, with_distance
from sightlake.operators import extract, sites
from sightlake.plans import jobs
from sightlake.queries import Query, table
from sightlake.session import spread, staging_path
from sightlake.sources.readers import parse_placemark, read_string_csv

LON, LAT = "(c_custkey * 37) % 360 - 179.75", "(c_custkey * 13) % 160 - 79.5"
SITE_LON, SITE_LAT = "(s_suppkey * 7) % 180 - 90.5", "s_suppkey % 80 + 0.25"
# Every ninth placemark has a height after its coordinates, every eleventh no link.
PLACEMARK = (
    "concat('<Placemark><name>', s_name, '</name><description><![CDATA[<table><tr><td>', "
    "CASE WHEN s_suppkey % 11 = 0 THEN 'none' ELSE concat('<a href=\"http://l/', s_suppkey, '\">x</a>') END, "
    "'<br></td></tr><tr><td><b>Branch ', s_nationkey, '</b></td></tr></table>]]></description>"
    f"<Point><coordinates>', {SITE_LON}, ',', {SITE_LAT}, "
    "CASE WHEN s_suppkey % 9 = 0 THEN ',0' ELSE '' END, '</coordinates></Point></Placemark>')"
)
POLYGON = "type string, coordinates array<array<array<double>>>"


def _marks(spark, sf_dir):
    return spread(table(spark, sf_dir, "supplier")).selectExpr(f"{PLACEMARK} AS xml")


def _parsed(spark, sf_dir):
    marks = _marks(spark, sf_dir)
    return sites.parse_placemarks(marks.select(parse_placemark(F.col("xml")).alias("p")).select("p.*"))


def placemarks(spark, sf_dir):
    return extract.usable(_parsed(spark, sf_dir))


def placemark_quarantine(spark, sf_dir):
    return extract.quarantined(_parsed(spark, sf_dir)).select("name", "problem")


def _rings(spark, sf_dir):
    ring = buffer_ring("lon", "lat")
    points = spread(table(spark, sf_dir, "customer")).selectExpr(
        "c_custkey", f"cast({LON} AS double) AS lon", f"cast({LAT} AS double) AS lat")
    return points.select("c_custkey", ring.alias("ring"))


def _vertices(df, ring, lon, lat):
    """A row for each vertex of a ring; its numbers go by six decimals."""
    # Outer: else a filter on the ring, which cannot be empty, would work it out twice more.
    return df.select("*", F.posexplode_outer(ring).alias("vertex", "point")).select(
        *df.columns, "vertex", F.round(lon(F.col("point")), 6).alias("lon"),
        F.round(lat(F.col("point")), 6).alias("lat"))


def _polygon(df, text):
    """A row for each vertex of a polygon in GeoJSON, under the ring it is in."""
    parsed = df.withColumn("p", F.from_json(text, POLYGON)).drop(text)
    rings = parsed.select(
        *[c for c in parsed.columns if c != "p"], F.col("p.type").alias("type"),
        F.posexplode("p.coordinates").alias("ring_no", "points"))
    return _vertices(rings, F.col("points"), lambda v: v[0], lambda v: v[1]).drop("points")


def site_buffer(spark, sf_dir):
    rings = _rings(spark, sf_dir)
    return _vertices(rings, F.col("ring"), lambda v: v["lon"], lambda v: v["lat"]).drop("ring")


def site_geojson(spark, sf_dir):
    """Every vertex of each polygon, read back from its GeoJSON text."""
    return _polygon(_rings(spark, sf_dir).select(
        "c_custkey", ring_to_geojson(F.col("ring")).alias("g")), "g")


def site_table(spark, sf_dir):
    """The site table, its polygons vertex by vertex."""
    return _polygon(sites.with_buffer(placemarks(spark, sf_dir)), "buffer_100km_geojson")


# Every degree from pole to pole and across the date line.
ROUND_LON, ROUND_LAT = "(c_custkey * 37) % 360 - 179.75", "c_custkey % 180 - 89.95"


def buffer_distances(spark, sf_dir):
    """How far the vertices of each buffer lie from its centre at least and at most, in decimetres."""
    points = spread(table(spark, sf_dir, "customer")).selectExpr(
        "c_custkey", f"cast({ROUND_LON} AS double) AS lon", f"cast({ROUND_LAT} AS double) AS lat")
    vertices = points.select(
        "*", F.explode_outer(buffer_ring("lon", "lat")).alias("v")).select("*", "v.lon", "v.lat").toDF(
        "c_custkey", "lon", "lat", "v", "to_lon", "to_lat").drop("v")
    apart = with_distance(vertices, "lon", "lat", "to_lon", "to_lat")
    return apart.groupBy("c_custkey").agg(
        F.count("*").alias("vertices"), F.round(10 * F.min("metres")).cast("long").alias("nearest"),
        F.round(10 * F.max("metres")).cast("long").alias("farthest"),
        F.every(F.abs(F.col("metres") - 100_000) < 5).alias("within_5_m"))


def _made_sites(spark, sf_dir):
    """Paths of the site job's CSV and of what it set aside, from placemarks in KML files."""
    kml, out, bad = (staging_path(spark, n) for n in ("kml", "sites", "bad_sites"))
    marks = _marks(spark, sf_dir).select(parse_placemark(F.col("xml")).alias("p")).select("p.*")
    marks.write.format("xml").option("rootTag", "kml").option("rowTag", "Placemark").save(kml)
    jobs.make_sites(spark, kml, out, quarantine_path=bad)
    return out, bad


def make_sites(spark, sf_dir):
    rows = read_string_csv(spark, _made_sites(spark, sf_dir)[0])
    typed = rows.withColumns({c: F.col(c).cast("double") for c in ("latitude", "longitude")})
    return _polygon(typed, "buffer_100km_geojson")


def make_sites_quarantine(spark, sf_dir):
    return spark.read.schema("name string, problem string").json(_made_sites(spark, sf_dir)[1])


# The ellipsoid and the published series, stated here again: flattening, third flattening, radius.
_F = 1 / 298.257223563
_T = 1 / 595.514447126
_A = repr(6378137 / (1 + _T) * (1 + _T * _T / 4 + _T * _T * _T * _T / 64))
_ECC = "sqrt((1 / 298.257223563) * (2 - 1 / 298.257223563))"
_TO_GRID = [
    _T * (1 / 2 + _T * (-2 / 3 + _T * (5 / 16 + _T * 41 / 180))),
    _T**2 * (13 / 48 + _T * (-3 / 5 + _T * 557 / 1440)),
    _T**3 * (61 / 240 - _T * 103 / 140), _T**4 * 49561 / 161280]
_FROM_GRID = [
    _T * (1 / 2 + _T * (-2 / 3 + _T * (37 / 96 - _T / 360))),
    _T**2 * (1 / 48 + _T * (1 / 15 - _T * 437 / 1440)),
    _T**3 * (17 / 480 - _T * 37 / 840), _T**4 * 4397 / 161280]
_TO_LATITUDE = [
    _T * (2 + _T * (-2 / 3 + _T * (-2 + _T * 116 / 45))),
    _T**2 * (7 / 3 + _T * (-8 / 5 - _T * 227 / 45)),
    _T**3 * (56 / 15 - _T * 136 / 35), _T**4 * 4279 / 630]


def _sum(coefficients, term):
    return " + ".join(f"{k!r} * {term.format(j=2 * j)}" for j, k in enumerate(coefficients, 1))


def _buffers(points, keys, digits=6):
    """The published series, stage by stage, one row per point and vertex."""
    return f"""
    WITH pt AS ({points}), p AS (
        SELECT *, radians(latitude) AS phi FROM pt
    ), c AS (
        SELECT *, atanh({_ECC} * sin(phi)) * {_ECC} AS q FROM p
    ), x AS (
        SELECT *, atan(tan(phi) * sqrt(1 + sinh(q) * sinh(q)) - sinh(q) * sqrt(1 + tan(phi) * tan(phi))) AS chi0
        FROM c
    ), v AS (
        SELECT *, chi0 + {_sum(_TO_GRID, 'sin({j} * chi0)')} - 100000 * sin(k * pi() / 32) / {_A} AS xi0,
               100000 * cos(k * pi() / 32) / {_A} AS eta0
        FROM x, unnest(range(0, 65)) AS r(k)
    ), s AS (
        SELECT *, xi0 - ({_sum(_FROM_GRID, 'sin({j} * xi0) * cosh({j} * eta0)')}) AS xi,
               eta0 - ({_sum(_FROM_GRID, 'cos({j} * xi0) * sinh({j} * eta0)')}) AS eta
        FROM v
    ), g AS (
        SELECT *, longitude + degrees(atan2(sinh(eta), cos(xi))) AS east, asin(sin(xi) / cosh(eta)) AS chi
        FROM s
    )
    SELECT {keys}, CAST(k AS INTEGER) AS vertex,
           round(CASE WHEN east > 180 THEN east - 360 WHEN east < -180 THEN east + 360 ELSE east END, {digits}) AS lon,
           round(degrees(chi + {_sum(_TO_LATITUDE, 'sin({j} * chi)')}), {digits}) AS lat
    FROM g"""


def _distances():
    """The published inverse solution over the buffers' vertices, its rounds written out."""
    points = (f"SELECT c_custkey, CAST({ROUND_LON} AS DOUBLE) AS longitude, "
              f"CAST({ROUND_LAT} AS DOUBLE) AS latitude FROM customer")
    first = (
        f"SELECT c_custkey, atan({1 - _F!r} * tan(radians(latitude))) AS u, "
        f"atan({1 - _F!r} * tan(radians(lat))) AS w, radians(lon - longitude) AS l, "
        "radians(lon - longitude) AS x FROM ring")
    sphere = (
        "SELECT c_custkey, u, w, l, x, sqrt(pow(cos(w) * sin(x), 2) "
        "+ pow(cos(u) * sin(w) - sin(u) * cos(w) * cos(x), 2)) AS si, "
        "sin(u) * sin(w) + cos(u) * cos(w) * cos(x) AS co FROM {0}")
    bent = "SELECT *, cos(u) * cos(w) * sin(x) / si AS sa FROM {0}"
    middle = (
        "SELECT *, 1 - sa * sa AS ca, co - 2 * sin(u) * sin(w) / (1 - sa * sa) AS m, "
        f"{_F / 16!r} * (1 - sa * sa) * (4 + {_F!r} * (4 - 3 * (1 - sa * sa))) AS k FROM {{0}}")
    again = (
        f"SELECT *, l + (1 - k) * {_F!r} * sa * (atan2(si, co) + k * si * (m + k * co "
        "* (2 * m * m - 1))) AS y FROM {0}")
    steps, last = [f"ring AS ({_buffers(points, 'c_custkey, longitude, latitude', 15)})", f"s0 AS ({first})"], "s0"
    for i in range(6):
        for j, text in enumerate((sphere, bent, middle, again)):
            steps.append(f"s{i}{j} AS ({text.format(last)})")
            last = f"s{i}{j}"
        steps.append(f"s{i + 1} AS (SELECT c_custkey, u, w, l, y AS x, si, co, ca, m FROM {last})")
        last = f"s{i + 1}"
    minor = 6378137 * (1 - _F)
    return f"""
    WITH {', '.join(steps)}, q AS (
        SELECT *, ca * {6378137**2 / minor**2 - 1!r} AS q FROM {last}
    ), ab AS (
        SELECT *, 1 + q / 16384 * (4096 + q * (-768 + q * (320 - 175 * q))) AS a,
               q / 1024 * (256 + q * (-128 + q * (74 - 47 * q))) AS b FROM q
    ), d AS (
        SELECT c_custkey, {minor!r} * a * (atan2(si, co) - b * si * (m + b / 4 * (co * (2 * m * m - 1)
            - b / 6 * m * (4 * si * si - 3) * (4 * m * m - 3)))) AS metres FROM ab
    )
    SELECT c_custkey, count(*) AS vertices, CAST(round(10 * min(metres)) AS BIGINT) AS nearest,
           CAST(round(10 * max(metres)) AS BIGINT) AS farthest, TRUE AS within_5_m
    FROM d GROUP BY c_custkey"""


_CIRCLED = f"SELECT c_custkey, CAST({LON} AS DOUBLE) AS longitude, CAST({LAT} AS DOUBLE) AS latitude FROM customer"
_POLYGON = "'Polygon' AS type, 0 AS ring_no"
_GOOD = "s_suppkey % 9 <> 0 AND s_suppkey % 11 <> 0"
_SITES = (
    "SELECT s_name AS name, concat('Branch ', s_nationkey) AS branch, concat('http://l/', s_suppkey) AS link, "
    f"CAST({SITE_LAT} AS DOUBLE) AS latitude, CAST({SITE_LON} AS DOUBLE) AS longitude{{more}} "
    f"FROM supplier WHERE {_GOOD}")
_SITE_TABLE = _buffers(
    _SITES.format(more=""), f"name, branch, link, latitude, longitude, {_POLYGON}")
_BAD_SITES = (
    "SELECT s_name AS name, CASE WHEN s_suppkey % 9 = 0 THEN 'bad coordinates' ELSE 'no link' END AS problem "
    f"FROM supplier WHERE NOT ({_GOOD})")

QUERIES = {
    "placemarks": Query(placemarks, _SITES.format(more="")),
    "placemark_quarantine": Query(placemark_quarantine, _BAD_SITES),
    "site_buffer": Query(site_buffer, _buffers(_CIRCLED, "c_custkey")),
    "buffer_distances": Query(buffer_distances, _distances()),
    "site_geojson": Query(site_geojson, _buffers(_CIRCLED, f"c_custkey, {_POLYGON}")),
    "site_table": Query(site_table, _SITE_TABLE),
    "make_sites": Query(make_sites, _SITE_TABLE),
    "make_sites_quarantine": Query(make_sites_quarantine, _BAD_SITES),
}

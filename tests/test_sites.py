import csv
import json
import math
import random

from pyspark.sql import functions as F

from sightlake.functions.geodesy import buffer_ring, ring_to_geojson, with_distance
from sightlake.operators import extract, sites
from sightlake.plans import jobs
from sightlake.sources.readers import parse_placemark, read_placemarks

DESCRIPTION = (
    '<table><tr><td><a href="http://l/1">x</a><br></td></tr><tr><td><b>Navy</b></td></tr></table>')
PLACEMARK = (
    "<Placemark><name>{name}</name><description><![CDATA[{description}]]></description>{point}</Placemark>")
POINT = "<Point><coordinates>{}</coordinates></Point>"


def placemark(name="Alpha", description=DESCRIPTION, at="-97.5,30.25"):
    point = POINT.format(at) if at is not None else ""
    return PLACEMARK.format(name=name, description=description, point=point)


def kml(*placemarks):
    return ('<?xml version="1.0"?><kml xmlns="http://www.opengis.net/kml/2.2"><Document><Folder>'
            + "".join(placemarks) + "</Folder></Document></kml>")


def vincenty(lon1, lat1, lon2, lat2):
    """Geodesic distance in metres, by the published inverse formula."""
    a, f = 6378137.0, 1 / 298.257223563
    b = a * (1 - f)
    u1, u2 = (math.atan((1 - f) * math.tan(math.radians(x))) for x in (lat1, lat2))
    lam = diff = math.radians(lon2 - lon1)
    for _ in range(200):
        s = math.hypot(math.cos(u2) * math.sin(lam),
                       math.cos(u1) * math.sin(u2) - math.sin(u1) * math.cos(u2) * math.cos(lam))
        c = math.sin(u1) * math.sin(u2) + math.cos(u1) * math.cos(u2) * math.cos(lam)
        sigma = math.atan2(s, c)
        sin_alpha = math.cos(u1) * math.cos(u2) * math.sin(lam) / s
        cos2 = 1 - sin_alpha**2
        mid = c - 2 * math.sin(u1) * math.sin(u2) / cos2 if cos2 else 0.0
        k = f / 16 * cos2 * (4 + f * (4 - 3 * cos2))
        new = diff + (1 - k) * f * sin_alpha * (
            sigma + k * s * (mid + k * c * (2 * mid**2 - 1)))
        if abs(new - lam) < 1e-13:
            break
        lam = new
    w = cos2 * (a**2 - b**2) / b**2
    big_a = 1 + w / 16384 * (4096 + w * (-768 + w * (320 - 175 * w)))
    big_b = w / 1024 * (256 + w * (-128 + w * (74 - 47 * w)))
    d = big_b * s * (mid + big_b / 4 * (
        c * (2 * mid**2 - 1) - big_b / 6 * mid * (4 * s**2 - 3) * (4 * mid**2 - 3)))
    return b * big_a * (sigma - d)


def ring_of(spark, lon, lat, *args):
    df = spark.createDataFrame([(lon, lat)], "lon double, lat double")
    return df.select(buffer_ring("lon", "lat", *args).alias("r")).first().r


def test_known_distances(spark):
    ring = ring_of(spark, -97.5, 30.25)
    assert len(ring) == 65 and ring[0] == ring[-1]
    at = [vincenty(-97.5, 30.25, p.lon, p.lat) for p in ring]
    assert abs(at[0] - 99995.89) < 0.01 and abs(at[32] - 99995.89) < 0.01
    assert abs(at[56] - 99997.945) < 0.01 and abs(at[48] - 100000.0) < 0.01
    # Clockwise from east: south comes after a quarter.
    assert ring[0].lon > -97.5 and ring[16].lat < 30.25 < ring[48].lat


def test_rings_keep_their_distance(spark):
    rng = random.Random(7)
    points = [(rng.uniform(-180, 180), rng.uniform(-80, 80)) for _ in range(60)]
    points += [(179.99, 10.0), (-180.0, 0.0), (0.0, 0.0)]
    df = spark.createDataFrame(points, "lon double, lat double")
    for r in df.withColumn("ring", buffer_ring("lon", "lat")).collect():
        for p in r.ring[::4]:
            assert -180 <= p.lon <= 180
            off = min((p.lon - r.lon) % 360, (r.lon - p.lon) % 360)
            assert 99_990 < vincenty(0, r.lat, off, p.lat) < 100_001


def test_ring_options_and_nulls(spark):
    assert len(ring_of(spark, 1.0, 2.0, 5, 4)) == 17
    assert ring_of(spark, None, 2.0) is None and ring_of(spark, 1.0, None) is None
    df = spark.createDataFrame([(1.0, None)], "lon double, lat double")
    out = df.select(ring_to_geojson(buffer_ring("lon", "lat")).alias("g")).first()
    assert out.g is None


def test_sites_job(spark, tmp_path):
    (tmp_path / "sites.kml").write_text(kml(
        placemark(), placemark("Three", at="-97.5,30.25,0"), placemark("None", at=None),
        placemark("Text", at="west,north"), placemark("Pole", at=" 10 , 91"),
        placemark("Bare", description="<table><tr><td>no link</td></tr></table>"),
        placemark("Beta", description="<p>x<table><tr><td><a href='u'>x<td><b>Army<i>!</i></b></table>",
                  at=" 1.5 , -2 ")))
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    jobs.make_sites(spark, str(tmp_path / "sites.kml"), out, quarantine_path=bad)
    rows = []
    for part in (tmp_path / "out").glob("*.csv"):
        rows += csv.DictReader(part.open())
    by_name = {r["name"]: r for r in rows}
    assert set(by_name) == {"Alpha", "Beta"}
    alpha = by_name["Alpha"]
    assert list(alpha) == ["name", "branch", "link", "latitude", "longitude", "buffer_100km_geojson"]
    assert (alpha["branch"], alpha["link"]) == ("Navy", "http://l/1")
    assert (float(alpha["longitude"]), float(alpha["latitude"])) == (-97.5, 30.25)
    polygon = json.loads(alpha["buffer_100km_geojson"])
    assert polygon["type"] == "Polygon" and len(polygon["coordinates"]) == 1
    ring = [(p.lon, p.lat) for p in ring_of(spark, -97.5, 30.25)]
    assert [tuple(p) for p in polygon["coordinates"][0]] == ring
    assert (by_name["Beta"]["branch"], by_name["Beta"]["longitude"]) == ("Army", "1.5")
    problems = {r["name"]: r["problem"] for r in spark.read.json(bad).collect()}
    assert problems == {"Three": "bad coordinates", "None": "bad coordinates",
                        "Text": "bad coordinates", "Pole": "bad coordinates", "Bare": "no branch"}


def test_prefixed_kml(spark, tmp_path):
    text = kml(placemark()).replace("<", "<k:").replace("<k:/", "</k:").replace("<k:?", "<?")
    text = text.replace("<k:![CDATA[", "<![CDATA[").replace("xmlns=", "xmlns:k=")
    inner = text.index("<![CDATA[")
    end = text.index("]]>")
    text = text[:inner] + "<![CDATA[" + DESCRIPTION + text[end:]
    (tmp_path / "p.kml").write_text(text)
    (row,) = sites.parse_placemarks(read_placemarks(spark, str(tmp_path / "p.kml"))).collect()
    assert (row.name, row.branch, row.longitude, row.problem) == ("Alpha", "Navy", -97.5, None)


def test_placemark_in_a_column(spark):
    df = spark.createDataFrame([(placemark(),)], "xml string")
    parsed = sites.parse_placemarks(df.select(parse_placemark(F.col("xml")).alias("p")).select("p.*"))
    assert extract.usable(parsed).first().asDict() == {
        "name": "Alpha", "branch": "Navy", "link": "http://l/1", "latitude": 30.25, "longitude": -97.5}


def test_distances_on_the_ellipsoid(spark):
    # A degree of the meridian at the equator, the equator itself, the quarter meridian, none, none known.
    cases = [(0.0, 0.0, 0.0, 1.0, 110574.389), (0.0, 0.0, 1.0, 0.0, 111319.491), (10.0, 0.0, 10.0, 90.0, 10001965.729),
             (179.5, 0.0, -179.5, 0.0, 111319.491), (5.0, 45.0, 5.0, 45.0, 0.0), (5.0, None, 5.0, 45.0, None)]
    df = spark.createDataFrame([c[:4] for c in cases], "a double, b double, c double, metres double")
    rows = with_distance(df, "a", "b", "c", "metres", "far").collect()
    for row, case in zip(rows, cases, strict=True):
        assert row["far"] is None if case[4] is None else abs(row["far"] - case[4]) < 0.001


def test_buffers_from_pole_to_pole_lie_a_hundred_kilometres_out(spark):
    points = spark.createDataFrame(
        [(float(lon), lat) for lon in (-180, -0.5, 179.9) for lat in (-90.0, -89.99, -60.0, 0.0, 45.0, 89.5, 90.0)],
        "lon double, lat double")
    vertices = points.select("*", F.explode(buffer_ring("lon", "lat")).alias("v")).select(
        "lon", "lat", F.col("v.lon").alias("to_lon"), F.col("v.lat").alias("to_lat"))
    apart = with_distance(vertices, "lon", "lat", "to_lon", "to_lat")
    least, most, n = apart.agg(F.min("metres"), F.max("metres"), F.count("*")).first()
    assert n == 21 * 65 and 99_995 < least and most < 100_000.1

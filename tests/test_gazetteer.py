from pyspark.sql import functions as F

from sightlake.operators import gazetteer
from sightlake.plans import jobs
from sightlake.sources import readers

LOCATIONS = """geoname_id,locale_code,country_iso_code,country_name,subdivision_1_iso_code,subdivision_1_name,city_name
1,en,US,"United States",MO,Missouri,Springfield
2,en,US,"United States",IL,Illinois,Springfield
3,en,NA,Namibia,KH,Khomas,Windhoek
4,en,US,"United States",TX,Texas,
5,en,CA,Canada,MO,Testprovince,springfield
"""
BLOCKS = """network,geoname_id,postal_code,latitude,longitude
a,1,,37.0,-93.0
a,1,,38.0,-94.0
a,1,,,
a,2,,39.5,-89.5
a,3,,-22.5,17.0
a,4,,31.0,-99.0
a,5,,50.0,-100.0
a,5,,50.0,-100.0
a,5,,50.0,-100.0
a,,,1.0,1.0
a,9,,2.0,2.0
"""
CITIES = [
    ("CA", "Canada", "MO", "Testprovince", "springfield", 50.0, -100.0, 3),
    ("US", "United States", "IL", "Illinois", "Springfield", 39.5, -89.5, 1),
    ("US", "United States", "MO", "Missouri", "Springfield", 37.5, -93.5, 3),
]
WINDHOEK = ("NA", "Namibia", "KH", "Khomas", "Windhoek", -22.5, 17.0, 1)


def make(spark, tmp_path, **options):
    (tmp_path / "locations.csv").write_text(LOCATIONS)
    (tmp_path / "blocks.csv").write_text(BLOCKS)
    out = str(tmp_path / "cities")
    jobs.make_gazetteer(
        spark, str(tmp_path / "locations.csv"), str(tmp_path / "blocks.csv"), out, **options)
    return readers.read_cities(spark, out)


def test_gazetteer_job(spark, tmp_path):
    assert sorted(map(tuple, make(spark, tmp_path).collect())) == CITIES


def test_na_tokens_can_be_kept(spark, tmp_path):
    got = sorted(map(tuple, make(spark, tmp_path, na_tokens=[]).collect()))
    assert got == sorted([*CITIES, WINDHOEK])


def test_best_city_and_geocode(spark, tmp_path):
    best = gazetteer.best_city(make(spark, tmp_path))
    reports = spark.createDataFrame(
        [(1, "MO", "Springfield"), (2, "IL", "SPRINGFIELD"), (3, "ZZ", "Nowhere"),
         (4, "ZZ", "Nowhere"), (5, "TX", None), (6, "", "Springfield"), (7, "MO", "")],
        "id int, state string, city string")
    want = {1: (50.0, -100.0), 2: (39.5, -89.5), **{i: (None, None) for i in (3, 4, 5, 6, 7)}}
    broadcast = gazetteer.geocode(reports, best)
    shuffled = gazetteer.geocode(reports, best, broadcast_limit=0)
    salted = gazetteer.geocode(reports, best, broadcast_limit=0, hot_rows=1, salts=4)
    for out in (broadcast, shuffled, salted):
        assert out.columns == ["id", "state", "city", "city_latitude", "city_longitude"]
        assert {r.id: (r.city_latitude, r.city_longitude) for r in out.collect()} == want
    plan = broadcast._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan and "Python" not in plan


def test_null_block_count_never_wins(spark):
    rows = [("US", "U", "TX", "Texas", "Waco", 1.0, 2.0, None),
            ("US", "U", "TX", "Texas", "waco", 3.0, None, 2)]
    cities = spark.createDataFrame(
        rows, ", ".join(f"{k} string" for k in gazetteer.KEYS)
        + ", latitude double, longitude double, num_blocks long")
    assert tuple(gazetteer.best_city(cities).first()) == ("TX", "waco", 3.0, None, 2)


def test_audit(spark, tmp_path):
    reports = spark.createDataFrame(
        [("Nowhere", "ZZ", None, None), ("Nowhere", "ZZ", None, None), (None, "TX", 1.0, None),
         ("Equator", "GA", 0.0, 0.0)],
        "city string, state string, city_latitude double, city_longitude double")
    out = str(tmp_path / "bad_cities")
    assert jobs.audit_geocodes(reports, out) == 3
    rows = [tuple(r) for r in readers.read_string_csv(spark, out).collect()]
    assert rows == [("Nowhere", "ZZ", "2"), (None, "TX", "1")]
    empty = gazetteer.missing_geocodes(reports.where("city = 'Equator'"))
    assert gazetteer.total_missing(empty).first().total == 0


def test_block_means_do_not_depend_on_presummation(spark):
    lineitem = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    blocks = lineitem.select(
        F.col("l_partkey").alias("geoname_id"), F.col("l_quantity").alias("latitude"),
        F.col("l_tax").alias("longitude"))
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    locations = part.select(
        F.col("p_partkey").alias("geoname_id"), F.lit("X").alias("country_iso_code"),
        F.lit("x").alias("country_name"), F.col("p_brand").alias("subdivision_1_iso_code"),
        F.col("p_brand").alias("subdivision_1_name"), F.col("p_name").alias("city_name"))
    got = gazetteer.build_gazetteer(blocks, locations).toPandas().sort_values(gazetteer.KEYS)
    joined = blocks.toPandas().merge(locations.toPandas(), on="geoname_id")
    want = joined.groupby(gazetteer.KEYS).agg(
        latitude=("latitude", "mean"), longitude=("longitude", "mean"),
        num_blocks=("geoname_id", "count")).reset_index()
    assert (got.num_blocks.values == want.num_blocks.values).all()
    assert abs(got.latitude.values - want.latitude.values).max() < 1e-9

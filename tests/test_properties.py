"""Operators against brute force over random small tables."""

import random
from collections import Counter

import pytest

from sightlake import session
from sightlake.operators import gazetteer
from sightlake.operators.merge import merge_reports

OPTIONS = [{}, {"broadcast_limit": 0, "hot_rows": 5, "salts": 4}]


@pytest.mark.parametrize("seed,options", list(enumerate(OPTIONS)))
def test_merge_against_brute_force(spark, seed, options):
    rng = random.Random(seed)

    def pull(name, n):
        # A third of the rows share one link, some have none.
        links = [rng.choice(["hot", None, f"/r/{rng.randint(0, 60)}"]) for _ in range(n)]
        return [(link, f"{name} {rng.randint(0, 9)}") for link in links]

    new, old = pull("new", 40), pull("old", 200)
    new = [r for r in new if r[0] != "hot"] if seed else new
    schema = "report_link string, text string"
    out = merge_reports(
        spark.createDataFrame(new, schema), spark.createDataFrame(old, schema), **options)
    held = {link for link, _ in new}
    want = Counter(new) + Counter(r for r in old if r[0] not in held)
    assert Counter(map(tuple, out.collect())) == want


def test_best_city_against_brute_force(spark):
    rng = random.Random(3)
    rows = sorted({
        (rng.choice("AB"), rng.choice("ab"), rng.choice(["tx", "TX", "Mo"]), rng.choice("st"),
         rng.choice(["Waco", "waco", "Peoria", "ÉVRY", "évry"])): (
            rng.uniform(-90, 90), rng.uniform(-180, 180), rng.randint(1, 3))
        for _ in range(120)
    }.items())
    cities = spark.createDataFrame(
        [key + value for key, value in rows],
        ", ".join(f"{k} string" for k in gazetteer.KEYS)
        + ", latitude double, longitude double, num_blocks long")
    best = {}
    for key, value in rows:  # in key order: the first of the largest wins
        place = (key[2].upper(), key[4].lower())
        if place not in best or value[2] > best[place][2]:
            best[place] = value
    got = {(r[0], r[1]): tuple(r[2:]) for r in gazetteer.best_city(cities).collect()}
    assert got == best


def test_spread_leaves_large_scans_alone(spark):
    many = spark.range(0, 100, 1, 500)
    assert session.spread(many) is many
    assert session.spread(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() >= 4


def test_sizes_are_measured(spark):
    small = spark.createDataFrame([("a" * 1000, 1)] * 50, "s string, n int")
    assert 50 * 1000 < session.measured_bytes(small) < 50 * 1200
    assert session.measured_bytes(small.where("n = 2")) == 0
    assert session.broadcast_if_small(small, 60_000)[1]
    assert not session.broadcast_if_small(small, 40_000)[1]
    nested = small.selectExpr("array(s, s) AS a")
    assert session.measured_bytes(nested) > 50 * 2000


def test_staged_tables_can_be_dropped(spark):
    df = spark.range(5)
    staged = session.stage(df, "test")
    (file, *_) = staged.inputFiles()
    assert staged.dtypes == df.dtypes and staged.count() == 5
    assert session.shared_dir(spark) in file
    session.drop_staged(spark, staged)
    assert not session.path_exists(spark, file)

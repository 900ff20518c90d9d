import json

import pytest
from pyspark.sql import functions as F

from sightlake.operators import joins
from sightlake.operators.joins import lookup_join
from sightlake.operators.merge import merge_reports
from sightlake.plans import jobs
from sightlake.sources import readers, versions, writers
from sightlake.streaming.pulls import merge_landed_pulls

SCHEMA = "report_link string, text string"


def links(spark, values, text):
    return spark.createDataFrame([(v, text) for v in values], SCHEMA)


CASES = [
    (["a", "b", "b"], ["b", "c", "c"], ["a", "b", "b", "c", "c"], ["a", "b", "b", "c"]),
    (["a", None], [None, "d"], ["a", None, "d"], ["a", None, "d"]),
    (["a"], [], ["a"], ["a"]),
    ([], ["a", "a", None, None], ["a", "a", None, None], ["a", None]),
]
JOINS = [{}, {"broadcast_limit": 0}, {"broadcast_limit": 0, "hot_rows": 1, "salts": 3}]


@pytest.mark.parametrize("options", JOINS)
@pytest.mark.parametrize("new,old,default,deduped", CASES)
def test_merge_fixtures(spark, new, old, default, deduped, options):
    new, old = links(spark, new, "new"), links(spark, old, "old")
    key = lambda v: (v is not None, v)
    for dedupe, want in ((False, default), (True, deduped)):
        rows = merge_reports(new, old, dedupe_orig=dedupe, **options).collect()
        assert sorted((r.report_link for r in rows), key=key) == sorted(want, key=key)
        held = {r.report_link for r in new.collect()}
        assert all((r.text == "new") == (r.report_link in held) for r in rows)


def test_dedupe_keeps_whole_rows(spark):
    old = spark.createDataFrame([("c", "z", "1"), ("c", "a", "2")], "report_link string, t string, u string")
    new = spark.createDataFrame([("a", "n", "n")], old.schema)
    rows = merge_reports(new, old, dedupe_orig=True).collect()
    assert sorted(map(tuple, rows)) == [("a", "n", "n"), ("c", "a", "2")]


def test_new_columns_are_kept(spark):
    old = spark.createDataFrame([("c", "x")], "report_link string, extra string")
    out = merge_reports(links(spark, ["a"], "new"), old)
    assert sorted(map(str, map(tuple, out.collect()))) == [
        "('a', 'new', None)", "('c', None, 'x')"]


def test_hot_keys_are_spread_exactly(spark):
    left = spark.range(30_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.lit(None).cast("int"))
        .otherwise((F.col("id") % 500).cast("int")).alias("k"), F.lit("same").alias("copy"))
    right = spark.range(0, 400, 2).select(F.col("id").cast("int").alias("k"), F.col("id").alias("v"))
    right = right.union(spark.createDataFrame([(7, 700), (None, 1)], "k int, v long"))
    for how in ("left", "inner", "left_semi", "left_anti"):
        for null_safe in (False, True):
            condition = left.k.eqNullSafe(right.k) if null_safe else left.k == right.k
            plain = left.join(right, condition, how).drop(right.k)
            salted = lookup_join(left, right, ["k"], how, null_safe, 0, 1000, 5)
            assert salted.columns == plain.columns
            count = lambda df: sorted(map(str, df.groupBy(*df.columns).count().collect()))
            assert count(salted) == count(plain)
    plan = lookup_join(left, right, ["k"], "left", False, 0, 1000, 5)
    assert "__salt" in plan._jdf.queryExecution().optimizedPlan().toString()


def test_hot_key_does_not_land_in_one_task(spark):
    left = spark.range(20_000, numPartitions=8).select(F.lit("hot").alias("k"), "id")
    right = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, v int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_join(left, right, ["k"], "left", False, 0, 1000, 64)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r["count"] for r in sizes) == 20_000
    assert max(r["count"] for r in sizes) < 8_000


def write_pull(folder, name, records):
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text("".join(json.dumps(r) + "\n" for r in records))
    return str(path)


def current(spark, root):
    return lines_of(spark, versions.current_version(spark, root))


def lines_of(spark, version):
    return sorted(json.dumps(json.loads(r.value)) for r in versions.read_version(spark, version).collect())


def test_versioned_merge(spark, tmp_path):
    root = str(tmp_path / "raw")
    first = [{"report_link": "/r/a", "text": "1", "posted": None},
             {"report_link": "/r/b", "text": "1", "more": {"x": [1]}}]
    second = [{"report_link": "/r/b", "text": "2"}, {"report_link": "/r/c", "text": "é"}]
    assert versions.current_version(spark, root) is None
    v1 = jobs.merge_pull_file(spark, write_pull(tmp_path / "in", "1.json", first), root, "one")
    assert (v1.version, v1.num_rows) == (1, 2)
    path = write_pull(tmp_path / "in", "2.json", second)
    v2 = jobs.merge_pull_file(spark, path, root, "two")
    assert (v2.version, v2.num_rows) == (2, 3)
    # Null fields, nested extra fields and removed reports all persist.
    want = sorted(map(json.dumps, [first[0], *second]))
    assert current(spark, root) == want
    assert jobs.merge_pull_file(spark, path, root, "two") == v2
    assert len(lines_of(spark, v1)) == 2
    # Pulling the same thing again under no name is harmless, too.
    assert jobs.merge_pull_file(spark, path, root).num_rows == 3
    assert current(spark, root) == want
    jobs.export_reports(spark, root, str(tmp_path / "out"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(map(json.dumps, lines)) == want
    held = {r.report_link: r for r in jobs.held_reports(spark, root).collect()}
    assert (held["/r/a"].text, held["/r/a"].city, held["/r/c"].text) == ("1", None, "é")


def test_uncommitted_version_is_written_again(spark, tmp_path):
    root = str(tmp_path / "raw")
    path = write_pull(tmp_path / "in", "1.json", [{"report_link": "a"}])
    spark.createDataFrame([("half", 3)], "value string, bucket int").write.partitionBy("bucket").parquet(
        f"{root}/data/v00000001-x")
    assert jobs.merge_pull_file(spark, path, root, "one").version == 1
    assert current(spark, root) == ['{"report_link": "a"}']


def test_malformed_line_stops_the_merge(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"report_link": "a"}\n{"report_link": \n')
    with pytest.raises(Exception, match="MALFORMED"):
        jobs.merge_pull_file(spark, str(tmp_path / "bad.json"), str(tmp_path / "raw"))
    assert versions.current_version(spark, str(tmp_path / "raw")) is None


def test_streamed_pulls(spark, tmp_path):
    root, landing = str(tmp_path / "raw"), tmp_path / "landing"
    checkpoint = str(tmp_path / "checkpoint")
    for i, records in enumerate(
        [[{"report_link": "a", "n": 1}, {"report_link": "b"}], [{"report_link": "a", "n": 2}], []]):
        write_pull(landing, f"{i}.json", records)
        query = merge_landed_pulls(spark, str(landing), root, checkpoint)
        query.awaitTermination()
        assert query.exception() is None
    assert current(spark, root) == ['{"report_link": "a", "n": 2}', '{"report_link": "b"}']


def test_pulls_that_land_together(spark, tmp_path):
    root, landing = str(tmp_path / "raw"), tmp_path / "landing pulls"
    write_pull(landing, "1.json", [{"report_link": "a", "n": 1}, {"report_link": "b"}])
    write_pull(landing / "2", "part-1.json", [{"report_link": "a", "n": 2}])
    write_pull(landing / "2", "part-0.json", [{"report_link": "a", "n": 3}])
    for checkpoint in ("first", "fresh"):
        merge_landed_pulls(spark, str(landing), root, str(tmp_path / checkpoint)).awaitTermination()
        assert current(spark, root) == [
            '{"report_link": "a", "n": 2}', '{"report_link": "a", "n": 3}', '{"report_link": "b"}']
    other = tmp_path / "other"
    write_pull(other, "1.json", [{"report_link": "c"}])
    merge_landed_pulls(spark, str(other), root, str(tmp_path / "third")).awaitTermination()
    assert '{"report_link": "c"}' in current(spark, root) and len(current(spark, root)) == 4


def test_of_two_merges_at_once_one_fails(spark, tmp_path):
    root = str(tmp_path / "raw")
    first = versions.Version(1, ["x"], f"{root}/parts/x", 0, 4)
    versions.commit_version(spark, root, first)
    with pytest.raises(Exception, match="(?i)exist"):
        versions.commit_version(spark, root, first._replace(pulls=["y"]))
    assert versions.current_version(spark, root) == first
    assert versions.version_with(spark, root, "x") == first
    assert versions.version_with(spark, root, "y") is None


def folders(spark, version):
    return {(p.bucket, p.folder) for p in versions.parts_of(spark, version)}


def test_versions_share_what_a_pull_does_not_touch(spark, tmp_path):
    root = str(tmp_path / "raw")
    many = spark.range(300).selectExpr(
        "concat('/r/', id) AS report_link", "concat('{\"report_link\": \"/r/', id, '\"}') AS value")
    one = many.where("report_link = '/r/7'")
    v1 = jobs.merge_pull(spark, many, root, "all", buckets=16)
    v2 = jobs.merge_pull(spark, one, root, "one")
    before, after = folders(spark, v1), folders(spark, v2)
    assert len(before) == len(after) == 16 and len(before & after) == 15 and v2.num_rows == 300
    # What is only added leaves the held files of its bucket, too.
    new = spark.createDataFrame([("/r/new", '{"report_link": "/r/new"}')], "report_link string, value string")
    v3 = jobs.merge_pull(spark, new, root, "new")
    assert after < folders(spark, v3) and v3.num_rows == 301 and len(lines_of(spark, v3)) == 301
    # Nothing of an old version is left but what the last one reads; its pulls stay known.
    (tmp_path / "raw/data/v00000004-next/bucket=1").mkdir(parents=True)
    versions.expire_versions(spark, root, keep=2)
    assert len(lines_of(spark, v2)) == 300 and len(lines_of(spark, v3)) == 301
    versions.expire_versions(spark, root)
    assert len(lines_of(spark, v3)) == 301 and (tmp_path / "raw/data/v00000004-next/bucket=1").exists()
    with pytest.raises(Exception):
        lines_of(spark, v1)
    assert jobs.merge_pull(spark, one, root, "one") == v2
    empty = jobs.merge_pull(spark, one.limit(0), root, "none")
    assert empty.num_rows == 301 and folders(spark, empty) == folders(spark, v3)


def test_a_bucket_of_many_folders_is_written_anew(spark, tmp_path):
    root, schema = str(tmp_path / "raw"), "report_link string, value string"
    for i in range(versions.MAX_FOLDERS + 2):
        line = f'{{"report_link": "/r/{i}"}}'
        last = jobs.merge_pull(spark, spark.createDataFrame([(f"/r/{i}", line)], schema), root, str(i), buckets=1)
    assert last.num_rows == len(lines_of(spark, last)) == versions.MAX_FOLDERS + 2
    assert len(folders(spark, last)) < versions.MAX_FOLDERS


@pytest.mark.parametrize("dedupe", [False, True])
def test_pulls_at_once_and_one_by_one(spark, tmp_path, dedupe):
    pulls = [["a", "b", "b", None], ["b", "c", "c", None, None], ["c", "d", "d", "a"], ["d"]]
    rows = [(k, f'{{"report_link": {json.dumps(k)}, "n": {i}}}', t)
            for t, keys in enumerate(pulls) for i, k in enumerate(keys)]
    lines = spark.createDataFrame(rows, "report_link string, value string, turn int")
    old = spark.createDataFrame([("z", '{"z": 1}'), ("z", '{"z": 2}'), ("d", '{"d": 0}')],
                                "report_link string, value string")
    found = []
    for name, steps in (("apart", [[0], [1], [2], [3]]), ("some", [[0], [1, 2, 3]]), ("once", [[0, 1, 2, 3]])):
        root = str(tmp_path / f"{name}-{dedupe}")
        jobs.merge_pull(spark, old, root, "old", buckets=3)
        for turns in steps:
            own = lines.where(f"turn in ({', '.join(map(str, turns))})").withColumn("turn", F.col("turn") - turns[0])
            jobs.merge_pulls(spark, own, root, [str(t) for t in turns], dedupe_orig=dedupe)
        found.append(current(spark, root))
    assert found[0] == found[1] == found[2] and len(found[0]) == (6 if dedupe else 8)


def test_ndjson_round_trip_keeps_null_fields(spark, tmp_path):
    raw = spark.createDataFrame(
        [("line\none \"q\"", None, "é ☃", "", *[None] * 7)], readers.schemas.RAW_REPORT)
    writers.write_ndjson(raw, str(tmp_path / "out"))
    line = spark.read.text(str(tmp_path / "out")).first().value
    assert set(json.loads(line)) == set(raw.columns)
    assert readers.read_raw_reports(spark, str(tmp_path / "out")).collect() == raw.collect()


def test_empty_report_file_has_the_schema(spark, tmp_path):
    (tmp_path / "empty.json").write_text("")
    empty = readers.read_raw_reports(spark, str(tmp_path / "empty.json"))
    assert empty.schema == readers.schemas.RAW_REPORT and empty.count() == 0


def test_hot_keys_are_counted_in_crowded_slots_only(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 40)
    rows = spark.range(1000).selectExpr("CASE WHEN id % 10 = 0 THEN NULL WHEN id % 4 = 0 THEN 'k' ELSE concat('x', id) END AS k")
    assert {r[0]: r[1] for r in joins.hot_keys(rows, ["k"], 40).collect()} == {None: 3, "k": 5}
    monkeypatch.setattr(joins, "SLOTS", 1)
    assert {r[0]: r[1] for r in joins.hot_keys(rows, ["k"], 90).collect()} == {None: 2, "k": 3}
    # Without a crowded slot no key is counted, and nothing is staged.
    monkeypatch.setattr(joins, "stage", None)
    assert joins.hot_keys(rows, ["k"], 1000) is None

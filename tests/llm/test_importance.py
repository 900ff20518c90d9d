"""Importance resampling against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sightlake.llm import importance
from test_operators import TEXTS, table


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_features(text, max_n, buckets):
    ws = plain_words(text)
    return [zlib.crc32(" ".join(ws[i:i + n]).encode()) % buckets
            for n in range(1, max_n + 1) for i in range(len(ws) - n + 1)]


def plain_gains(texts, target, max_n, buckets):
    s = Counter(b for t in texts for b in plain_features(t, max_n, buckets))
    t = Counter(b for x in target for b in plain_features(x, max_n, buckets))
    return [math.floor(1000 * math.log(
        (t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)]


@pytest.mark.parametrize("max_n,buckets", [(1, 10_000), (3, 64)])
def test_draw_against_plain_python(spark, max_n, buckets):
    draw = random.Random(1)
    texts = [" ".join(draw.choices(["the", "Page", "clerk", "x1", "é", "漢字"], k=draw.randint(0, 40)))
             for _ in range(60)]
    docs = table(spark, TEXTS + texts + texts[:5]).withColumn("Weight", F.lit("own"))
    target = spark.createDataFrame([("the clerk, the page",), (None,), ("",)], "text string")
    found = importance.resample(
        docs, target, percent=30, seed="7", least_words=5, max_n=max_n, buckets=buckets)
    assert {c.lower() for c in found.columns} == {
        *map(str.lower, docs.columns), "n_features", "score", "rank"} - {"text"}
    rows = docs.collect()
    gains = plain_gains([r["text"] for r in rows], ["the clerk, the page"], max_n, buckets)
    want = []
    for r in rows:
        own = plain_features(r["text"], max_n, buckets)
        key = "" if r["doc_id"] is None else r["doc_id"]
        h = int(hashlib.sha256(f"7:{key}".encode()).hexdigest()[:8], 16)
        weight = sum(gains[b] for b in own)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        want.append([r["doc_id"], len(own), weight, score, len(plain_words(r["text"])) >= 5])
    able = sorted((w for w in want if w[4]), key=lambda w: (-w[3], w[0] is None, w[0]))
    ranks = Counter((w[0], *w[1:4], i + 1) for i, w in enumerate(able[:len(able) * 30 // 100]))
    got = Counter((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in found.collect())
    assert Counter({k: n for k, n in got.items() if k[4] is not None}) == ranks
    assert Counter(k[:4] for k in got.elements()) == Counter(tuple(w[:4]) for w in want)


def test_empty_tables(spark):
    docs, none = table(spark), table(spark).limit(0)
    assert importance.resample(none, docs, percent=10, seed="1").count() == 0
    rows = importance.resample(docs, none, percent=100, seed="1").collect()
    assert sum(r["rank"] is not None for r in rows) == sum(len(plain_words(r["text"])) >= 20 for r in docs.collect())


def test_ranks_of_equal_rows_go_over_several_ranges(spark):
    same = spark.range(5000, numPartitions=5).select(
        F.lit(None).cast("long").alias("doc_id"), F.lit(3).alias("score"), F.lit("x").alias("RANK"),
        *[F.lit("own").alias(n) for n in ("part", "start", "can", "at", "Place", "rows", "able")])
    rows = importance.draw(same, F.lit(True), 40).collect()
    assert sorted(r["rank"] for r in rows if r["rank"] is not None) == list(range(1, 2001))
    assert len(rows) == 5000 and all(r["part"] == r["start"] == r["rows"] == "own" for r in rows)


def test_long_words_and_separators_only():
    scanner = importance.Scanner(2, 1000)
    assert scanner.scan(b"?! \x00-") [0] == 0 and len(scanner.scan(b"?! \x00-")[1]) == 0
    assert len(scanner.scan(b"x" * 200_000)[1]) == 1
    assert len(scanner.scan(b"A,b;" * 50_000)[1]) == 199_999

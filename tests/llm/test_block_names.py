"""Exact copies against grouping by the text itself."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sightlake.llm import block_names
from test_operators import LONG, TEXTS, table


def plain_copies(rows):
    groups = defaultdict(list)
    for d, text in rows:
        groups[re.sub("[\x20\x09-\x0d]", "", text or "")].append((d, text))
    found = []
    for solid, members in groups.items():
        first = min(members, key=lambda m: (-len(m[1] or ""), m[0] is None, m[0] or 0))
        kept = [False] * len(members)
        kept[members.index(first)] = True
        digest = hashlib.sha256(solid.encode()).hexdigest()
        found += [(m[0], first[0], len(members), k, digest) for m, k in zip(members, kept, strict=True)]
    return Counter(found)


@pytest.mark.parametrize("block", [4, 1024])
def test_copies_against_plain_python(spark, block, monkeypatch):
    if block == 4:
        # Tasks forget and send on all the time.
        monkeypatch.setattr(block_names, "HELD", 300)
        monkeypatch.setattr(block_names, "SENT", 50)
    draw = random.Random(block)
    some = ["".join(draw.choices("ab é\n", k=draw.randint(0, 30))) for _ in range(80)]
    long = [] if block == 4 else [LONG[:-1], LONG + "\n", " " + LONG.replace("word5 ", "word6 ", 1)]
    texts = [t for t in TEXTS if block > 4 or len(t or "") < 1000] + some + long
    docs = table(spark, texts).withColumn("Size", F.lit("own")).withColumn("place", F.lit(1))
    found = block_names.exact_copies(docs, block=block)
    got = Counter(
        (r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in found.collect())
    assert got == plain_copies([(r["doc_id"], r["text"]) for r in docs.collect()])
    kept = block_names.drop_copies(docs, block=block)
    assert kept.columns == docs.columns
    assert kept.count() == len({k[4] for k in got})


def test_blocks_shared_by_different_texts(spark):
    # Equal pairs at other places, lengths that are multiples of a block, and prefixes of each other.
    texts = ["abab", "abababab", "ababab", "abab abab", "cdabab", "ababcd", "ab", "abc", "abcd", "ab cd", "abc d"]
    docs = table(spark, texts)
    got = block_names.exact_copies(docs, block=2)
    assert Counter(
        (r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in got.collect()
    ) == plain_copies([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_empty_table_and_other_keys(spark):
    assert block_names.exact_copies(table(spark).limit(0)).count() == 0
    named = spark.createDataFrame([("b", "x y"), ("a", "xy "), (None, "xy "), ("c", "z")], "Name string, body string")
    rows = block_names.exact_copies(named, "body", "Name").collect()
    assert Counter((r["Name"], r["keep_id"], r["kept"]) for r in rows) == Counter(
        [("b", "a", False), ("a", "a", True), (None, "a", False), ("c", "c", True)])


def test_a_hot_text_is_sent_once_by_a_task(spark):
    docs = spark.range(3000, numPartitions=6).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.lit("hot text")).otherwise(
            F.col("id").cast("string")).alias("text"))
    rows = block_names.exact_copies(docs)
    assert rows.where("kept").count() == 1001
    assert rows.where("keep_id = 1 and group_size = 2000").count() == 2000

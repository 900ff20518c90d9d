"""Vector codes against plain loops."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from sightlake.llm import grid_codes

SCHEMA = "vec_id long, embedding array<float>, label int, Code string, error string, group int"


def plain_codes(rows, parts, entries, rounds):
    """(vec_id, code, error, label error) of each row, and the codebooks' hash."""
    rows = [(k, v, label) for k, v, label in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    if not rows:
        return Counter(), hashlib.sha256(b"").hexdigest()
    size = len(rows[0][1]) // parts
    whole = [[math.floor(256 * float(np.float32(x))) for x in v] for _, v, _ in rows]
    cut = lambda z, p: z[p * size:(p + 1) * size]
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))[:entries]
    books = [[cut(whole[i], p) for i in first] for p in range(parts)]

    def nearest(z, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(z, p), e, strict=True)), i)
                   for i, e in enumerate(books[p]))

    for _ in range(rounds):
        held = defaultdict(list)
        for z in whole:
            for p in range(parts):
                held[p, nearest(z, p)[1]].append(cut(z, p))
        for (p, i), own in held.items():
            books[p][i] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = [[nearest(z, p) for p in range(parts)] for z in whole]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = Counter()
    for (_, _, label), e in zip(rows, errors, strict=True):
        by_label[label] += e
    text = ",".join(str(x) for book in books for e in book for x in e)
    return Counter(
        (k, "".join(f"{i:02x}" for _, i in f), e, by_label[label])
        for (k, _, label), f, e in zip(rows, found, errors, strict=True)), hashlib.sha256(text.encode()).hexdigest()


def compressed(spark, rows, **options):
    df = spark.createDataFrame([(*r, "own", "own", 3) for r in rows], SCHEMA)
    out = grid_codes.compress(df, **options)
    assert {c.lower() for c in out.columns} == {
        "vec_id", "label", "group", "code", "error", "label_error", "codebooks_sha256"}
    return out.collect()


@pytest.mark.parametrize("parts,entries,rounds", [(2, 5, 2), (4, 64, 2), (1, 3, 0)])
def test_codes_against_plain_loops(spark, parts, entries, rounds):
    draw = random.Random(parts)
    rows = [(i, [draw.gauss(0, 0.3) for _ in range(8)], draw.choice([1, 2, None])) for i in range(150)]
    rows += [(500 + i, [round(x * 4) / 256 for x in rows[i][1]], 1) for i in range(30)]  # many ties
    rows += [(3, rows[3][1], 1), rows[4], (None, rows[5][1], None), (None, [9000.0] * 8, None)]
    rows += [(-1, None, 1), (-2, [], 1), (-3, [0.1] * 7 + [None], 1), (-4, [0.1] * 7 + [float("nan")], 1),
             (-5, [0.1] * 7 + [float("-inf")], 1)]
    want, books = plain_codes(rows, parts, entries, rounds)
    got = compressed(spark, rows, parts=parts, entries=entries, rounds=rounds)
    assert Counter((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got) == want
    assert {r["codebooks_sha256"] for r in got} == {books}


def test_few_rows_odd_lengths_and_none(spark):
    assert compressed(spark, [(1, None, 1)]) == []
    one = [0.5] * 16
    rows = compressed(spark, [(1, one, None), (2, one, 1), (0, [1.0] * 32, 1)])
    assert [(r["vec_id"], r["code"], r["error"]) for r in sorted(rows, key=lambda r: r["vec_id"])] == [
        (1, "00" * 16, 0), (2, "00" * 16, 0)]
    with pytest.raises(ValueError):
        compressed(spark, [(1, [1.0] * 15, 1)])
    huge = compressed(spark, [(1, [3e38] * 16, 1), (2, [-3e38] * 16, 1)])
    assert [r["error"] for r in huge] == [0, 0]


def test_candidates_hold_every_nearest_entry():
    draw = np.random.default_rng(2)
    for size, spread in ((1, 20), (3, 60), (4, 2000)):
        entries = draw.integers(-spread, spread, (40, size))
        entries[7] = entries[3]
        points = draw.integers(-2 * spread, 2 * spread, (3000, size))
        points[:40] = entries
        grid = grid_codes.Grid(entries, bits=3, cells=50)
        for _ in range(2):  # a full memo is emptied, which changes nothing
            entry, distance = grid.nearest(points)
            every = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
            assert (entry == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
        assert len(grid.memo) <= 50
    far = grid_codes.Grid(np.array([[0, 0], [100, 100], [104, 104], [-90, 5]]), bits=4)
    assert [c.tolist() for c in far.candidates(np.array([[0, 0], [6, 6]]))] == [[0], [1, 2]]

"""SimHash near-duplicates by meeting in the middle.

Two fingerprints at d bits or fewer have a bit string between them that lies within half of d of
both. So every fingerprint emits the variants within half the distance, rows meet on the
variant, and whatever meets is verified. An odd distance joins fingerprints of unlike parity:
then those with an even number of bits reach the smaller half, the others the larger half.

A variant travels as its leading bits: all variants of a fingerprint that share them are one
row, and the task that gets the row makes the rest of the bits. How many bits lead goes by the number
of fingerprints, and where many share them all the same, some more are made before rows move. So a
task gets so many rows of one value and no more. Fingerprints that share a variant are linked to one of them near it, never pair by pair: every link implied that way is
within the distance, and a chain of them holds together whatever a pair of them would.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightlake.llm.components import components
from sightlake.llm.frames import fresh, over_texts, quoted
from sightlake.llm.words import blank_words
from sightlake.session import broadcast_if_small, stage

#: Bits that lead at least and at most, and bits made at once beyond them.
LEADING, WIDEST, STEP = 20, 40, 8
#: Rows of one value that a task is given; about so many a value has on average at most.
CROWD, USUAL = 100_000, 10_000
#: Variants held by a task at once.
HELD = 1 << 20


def fingerprint(words: list[bytes], shingle: int) -> int:
    """Bits set in over half of the shingles' hashes (XXH64, seed 42, of words and blanks)."""
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        starts, ends = starts[:1 - shingle], ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)),
        np.uint64, len(starts))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        block = hashes[at:at + (1 << 14)]
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return sum(1 << i for i in np.flatnonzero(2 * counts > len(hashes)).tolist())


def fingerprints(df: DataFrame, column: str = "text", shingle: int = 3,
                 name: str = "simhash") -> DataFrame:
    """df with the 64-bit fingerprint of each whole text, as a long.

    A-Z are lower-cased first. A text of fewer words than a shingle is one shingle; one without
    words, or null, has fingerprint zero.
    """
    def rows(texts: list[bytes]) -> list[tuple]:
        found = np.array([fingerprint(blank_words(t.lower()), shingle) for t in texts], np.uint64)
        return [(x,) for x in found.view(np.int64).tolist()]

    return over_texts(df, column, f"{quoted(name)} long", rows)


def _masks(bits: int, most: int) -> np.ndarray:
    """All bit masks of a width with up to so many bits, fewest first."""
    return np.array([sum(1 << b for b in set_bits) for n in range(most + 1)
                     for set_bits in combinations(range(bits), n)], np.uint64)


class _Meeting:
    """Variants of a task's fingerprints, and the links their meetings give."""

    def __init__(self, distance: int):
        self.distance, self.near = distance, distance // 2
        self.masks: dict[tuple[int, int], np.ndarray] = {}

    def reach(self, prints: np.ndarray) -> np.ndarray:
        return self.near + (self.distance & 1) * (np.bitwise_count(prints) & 1)

    def expanded(self, prints, variants, bits: int, shift: int):
        """All variants that differ from those given in the named bits, within reach."""
        left = self.reach(prints).astype(np.int64) - np.bitwise_count(prints ^ variants)
        found = []
        for n in np.unique(left):
            masks = self.masks.get((bits, n))
            if masks is None:
                masks = self.masks[bits, n] = _masks(bits, int(n))
            of = left == n
            found.append((np.repeat(prints[of], len(masks)),
                          (variants[of][:, None] ^ (masks << np.uint64(shift))).ravel()))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def links(self, prints, variants, free: int) -> list[np.ndarray]:
        """Links among rows of whole groups; the last ``free`` bits of variants are not made yet."""
        left = self.reach(prints).astype(np.int64) - np.bitwise_count(prints ^ variants)
        size = sum(int((left == n).sum()) * sum(comb(free, k) for k in range(n + 1))
                   for n in range(self.near + (self.distance & 1) + 1))
        if size <= HELD or free == 0:
            return [self.met(*self.expanded(prints, variants, free, 0))]
        step = min(STEP, free)
        prints, variants = self.expanded(prints, variants, step, free - step)
        order = np.argsort(variants, kind="stable")
        prints, variants = prints[order], variants[order]
        cuts = np.flatnonzero(np.diff(variants >> np.uint64(free - step))) + 1
        found = []
        for p, v in zip(np.split(prints, cuts), np.split(variants, cuts), strict=True):
            if len(p) > 1:
                found += self.links(p, v, free - step)
        return found

    def met(self, prints, variants) -> np.ndarray:
        ordered = np.sort(variants)
        shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if not len(shared):
            return np.empty((0, 2), np.uint64)
        place = np.searchsorted(shared, variants)
        place[place == len(shared)] = 0
        of = shared[place] == variants
        group, prints, variants = place[of], prints[of], variants[of]
        far = np.bitwise_count(prints ^ variants) > self.near
        order = np.lexsort((prints, far, group))
        group, prints, far = group[order], prints[order], far[order]
        first = np.concatenate(([True], group[1:] != group[:-1]))
        centre_at = np.flatnonzero(first)[np.cumsum(first) - 1]
        pairs = np.stack([prints[centre_at], prints], axis=1)[~far[centre_at]]
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        pairs = pairs[np.bitwise_count(pairs[:, 0] ^ pairs[:, 1]) <= self.distance]
        return np.unique(pairs, axis=0) if len(pairs) else pairs


def _forest(pairs: list[np.ndarray]) -> np.ndarray:
    """As few of the links as hold together what all of them do."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    kept = []
    for block in pairs:
        for a, b in block.tolist():
            x, y = find(a), find(b)
            if x != y:
                root[max(x, y)] = min(x, y)
                kept.append((a, b))
    return np.array(kept, np.uint64).reshape(-1, 2)


def _met_in_task(distance: int, free: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meeting = _Meeting(distance)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flushed(prints, leading):
            kept = _forest(meeting.links(prints, leading << np.uint64(free) | (
                prints & np.uint64((1 << free) - 1)), free)).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(kept[:, 0]), pa.array(kept[:, 1])], ["a", "b"])

        for batch in batches:
            held.append((batch.column(1).to_numpy().view(np.uint64),
                         batch.column(0).to_numpy().astype(np.int64).view(np.uint64)))
            if sum(len(p) for p, _ in held) >= HELD >> 5:
                prints, leading = (np.concatenate(x) for x in zip(*held, strict=True))
                # Rows come sorted, so all groups but the last one are whole.
                whole = int(np.searchsorted(leading, leading[-1]))
                held = [(prints[whole:], leading[whole:])]
                if whole:
                    yield flushed(prints[:whole], leading[:whole])
        if held:
            yield flushed(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


def _width(count: int, distance: int) -> int:
    """Bits that lead, so that a value has few rows unless fingerprints lie close together."""
    most = distance // 2 + (distance & 1)
    bits = LEADING
    while bits < WIDEST and count * sum(comb(bits, k) for k in range(most + 1)) >> bits > USUAL:
        bits += 1
    return bits


def _varied(rows: DataFrame, bits: int, shift: int, distance: int) -> DataFrame:
    """Rows (variant, print) with all variants in so many bits from a place on, within reach.

    What is not made yet of a variant is the fingerprint's own.
    """
    mark = F.col("print")
    left = F.lit(distance // 2) + F.lit(distance & 1) * (F.bit_count(mark) % 2) - F.bit_count(
        F.col("variant").bitwiseXOR(mark))
    masks = F.when(left == 0, F.array(F.lit(0).cast("long")))
    for n in range(1, distance // 2 + (distance & 1) + 1):
        shifted = (_masks(bits, n) << np.uint64(shift)).view(np.int64).tolist()
        masks = masks.when(left == n, F.array(*[F.lit(m).cast("long") for m in shifted]))
    return rows.select(
        F.explode(F.transform(masks, lambda m: F.col("variant").bitwiseXOR(m))).alias("variant"), mark)


def near_links(prints: DataFrame, name: str, distance: int = 3, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) between distinct fingerprints that hold each component together.

    Every link is verified to be within the distance, and two fingerprints within it are always
    joined by a chain of links. ``prints`` is staged and has each fingerprint once.
    """
    marks = prints.select(F.col(quoted(name)).alias("variant"), F.col(quoted(name)).alias("print"))
    bits = _width(prints.count(), distance)
    free = 64 - bits
    rows = _varied(marks, bits, free, distance)
    # A value has no more rows than what is near it: one look at the fingerprints may do.
    near = sum(comb(bits, k) for k in range(distance // 2 + (distance & 1) + 1))
    densest = marks.groupBy(F.shiftrightunsigned("variant", free)).count().agg(F.max("count")).first()[0]
    crowded, parts = (densest or 0) * near > crowd, []
    while True:
        keyed = rows.select(F.shiftrightunsigned("variant", free).alias("key"), "variant", "print")
        hot = None
        if crowded and free >= STEP:
            hot = stage(keyed.groupBy("key").count().where(F.col("count") > crowd).select("key"), "hot")
            hot = None if hot.isEmpty() else broadcast_if_small(hot)[0]
        dealt = keyed if hot is None else keyed.join(hot, "key", "left_anti")
        dealt = dealt.select("key", "print").repartition("key").sortWithinPartitions("key")
        parts.append(dealt.mapInArrow(_met_in_task(distance, free), "a long, b long"))
        if hot is None:
            return reduce(DataFrame.unionByName, parts).distinct()
        free -= STEP
        rows = stage(_varied(
            keyed.join(hot, "key", "left_semi").select("variant", "print"), STEP, free, distance), "variants")


def classes(prints: DataFrame, name: str, key: str, distance: int = 3) -> DataFrame:
    """(fingerprint, least key of its component) for every distinct fingerprint of a table.

    Rows with equal fingerprints are one node, however many there are. Null keys are no least
    key; a component that has nothing else gets null.
    """
    nodes = stage(prints.groupBy(F.col(quoted(name)).alias("print"))
                  .agg(F.min(quoted(key)).alias("least")), "nodes")
    linked = components(near_links(nodes, "print", distance), "a", "b")
    rooted = nodes.join(linked, nodes["print"] == linked["node"], "left").select(
        "print", "least", F.coalesce("root", "print").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("least_key"))
    return rooted.join(least, "root").select("print", "least_key")


def near_duplicates(df: DataFrame, column: str = "text", key: str = "doc_id", shingle: int = 3,
                    distance: int = 3) -> DataFrame:
    """(key, simhash, component_id) for every row; a component's id is its least key.

    Texts are read once: fingerprints are written to the shared folder with their keys. Texts
    without words share fingerprint zero and are linked like any others; repeated rows stay
    repeated, an empty table gives an empty one.
    """
    thin = stage(fingerprints(df, column, shingle, "simhash")
                 .select(F.col(quoted(key)).alias("key"), "simhash"), "simhash")
    found = classes(thin, "simhash", "key", distance)
    return thin.join(found, thin["simhash"] == found["print"]).select(
        F.col("key").alias(key), "simhash", F.col("least_key").alias("component_id"))


def one_of_each(df: DataFrame, column: str = "text", key: str = "doc_id", shingle: int = 3,
                distance: int = 3) -> DataFrame:
    """The rows of df, a table that reads alike each time, with one row of each component.

    That is the row with the least key (nulls last), the first of them in the table among
    repeated keys. Only keys, places and fingerprints are shuffled; texts are not.
    """
    place = fresh(df, "place")
    placed = df.withColumn(place, F.monotonically_increasing_id())
    thin = stage(fingerprints(placed, column, shingle, "simhash")
                 .select(F.col(place).alias("place"), F.col(quoted(key)).alias("key"), "simhash"),
                 "simhash")
    found = classes(thin, "simhash", "place", distance)
    # The class of a fingerprint is named by a place, which no two rows share.
    first = F.struct(F.col("key").isNull().alias("none"), F.col("key"), F.col("place"))
    by_print = thin.groupBy("simhash").agg(F.min(first).alias("first"))
    kept = (by_print.join(found, by_print["simhash"] == found["print"])
            .groupBy("least_key").agg(F.min("first").alias("first"))
            .select(F.col("first.place").alias("kept_place")))
    return (placed.join(kept, placed[place] == kept["kept_place"], "left_semi").drop(place))

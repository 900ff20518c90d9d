"""Documents drawn to look like a target collection, by importance weights of hashed n-grams.

Separators in a text are collapsed to single blanks. For each length, one pattern then finds every
run of so many words: matches may overlap, and lookarounds hold both ends to word boundaries, so
the spans come straight out of the scan. A span's CRC-32 modulo the number of buckets is its bucket.

What two tables hold in each bucket makes a gain, a document's weight is the sum of its gains, and
noise from a hash of its key turns the weights into a draw without replacement: the rows with the
highest sums are drawn. Counts leave a task once for each bucket, gains are one number a bucket,
and ranks come from ranges of the order, so no task holds more than its part of the rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sightlake.llm.frames import fresh, over_texts, quoted
from sightlake.llm.words import alnum_words
from sightlake.session import stage

BUCKETS, MAX_N = 10_000, 1


class Scanner:
    """Buckets of all runs of 1 to max_n words of a text, repeats included."""

    def __init__(self, max_n: int = MAX_N, buckets: int = BUCKETS):
        self.buckets = buckets
        self.patterns = [
            regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1))
            for n in range(1, max_n + 1)]

    def scan(self, text: bytes) -> tuple[int, np.ndarray]:
        """Number of words, and a bucket for each feature."""
        words = alnum_words(text)
        line = b" ".join(words)
        found = [
            np.fromiter(map(zlib.crc32, map(itemgetter(0), p.finditer(line, overlapped=True))), np.int64)
            for p in self.patterns]
        return len(words), np.concatenate(found) % self.buckets


def bucket_counts(df: DataFrame, column: str, max_n: int = MAX_N, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts of a column; buckets without any are absent.

    Each task adds up its own texts, so it sends one row a bucket at most.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, held = Scanner(max_n, buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                held += np.bincount(scanner.scan(text.as_py() or b"")[1], minlength=buckets)
        full = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(held[full])], ["bucket", "n"])

    texts = df.select(F.col(quoted(column)).cast("string").cast("binary").alias("text"))
    return texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, column: str, target_column: str,
          max_n: int = MAX_N, buckets: int = BUCKETS) -> np.ndarray:
    """For each bucket, 1000 times the logarithm of target over source share, one added to each count.

    Of all counts, only one row for each bucket comes to the driver, however large the tables.
    """
    sides = bucket_counts(source, column, max_n, buckets).select(
        "bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).unionByName(
        bucket_counts(target, target_column, max_n, buckets).select(
            "bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t")))
    held = np.zeros((buckets, 2))
    for row in sides.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect():
        held[row["bucket"]] = row["s"], row["t"]
    of_source, of_target = held.sum(axis=0).tolist()
    return np.array([
        math.floor(1000 * math.log((t + 1) * (of_source + buckets) / ((s + 1) * (of_target + buckets))))
        for s, t in held.tolist()], np.int64)


def weigh(df: DataFrame, target: DataFrame, column: str = "text", target_column: str = "text",
          max_n: int = MAX_N, buckets: int = BUCKETS) -> DataFrame:
    """df with n_words, n_features and weight of each text; nothing is shuffled.

    Null, empty and wordless texts have no features and weigh 0. An empty table on either side
    counts nothing. Columns of these names, whatever their case, are replaced.
    """
    gained = gains(df, target, column, target_column, max_n, buckets)

    def rows(texts: list[bytes]) -> list[tuple]:
        scanner, found = Scanner(max_n, buckets), []
        for text in texts:
            n_words, features = scanner.scan(text)
            found.append((n_words, len(features), int(gained[features].sum())))
        return found

    return over_texts(df, column, "n_words long, n_features long, weight long", rows)


def noisy(weight: Column, key: Column, seed: str) -> Column:
    """The weight and Gumbel noise, in thousandths; a null key counts as an empty one."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    share = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return weight + F.floor(F.lit(-1000.0) * F.log(-F.log(share)))


def draw(df: DataFrame, may: Column, percent: int, key: str = "doc_id", score: str = "score",
         rank: str = "rank") -> DataFrame:
    """df with the ranks, from 1 on, of the rows with the highest scores; null for the others.

    So many per cent, rounded down, of the rows that may be drawn are. Ties go to the smaller key, a
    null one last; rows alike in both follow the table's order. All columns of df move once, to
    their range of the order: leave long ones out. Equal keys and scores part between ranges, and
    what is added up over all ranges is one row for each.
    """
    can, place, at, of, start = (fresh(df, n, rank) for n in ("can", "place", "at", "part", "start"))
    held = stage(df.withColumns({
        can: F.coalesce(may, F.lit(False)), place: F.monotonically_increasing_id()}), "scored")
    order = [F.desc(can), F.desc(quoted(score)), F.asc_nulls_last(quoted(key)), F.asc(place)]
    ranged = held.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = stage(ranged.withColumn(at, F.monotonically_increasing_id()), "ranged")
    part = F.shiftright(at, 33)
    parts = ranged.groupBy(part.alias(of)).agg(
        F.count("*").alias("rows"), F.count_if(F.col(can)).alias("able"))
    drawn = (parts.agg(F.sum("able").alias("able")).first()["able"] or 0) * percent // 100
    before = Window.orderBy(of).rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(of, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias(start))
    number = F.col(start) + F.col(at).bitwiseAND((1 << 33) - 1) + 1
    # One row for each range, of which there are no more than shuffle partitions.
    return ranged.join(F.broadcast(starts), part == F.col(of)).select(
        *[F.col(quoted(c)) for c in df.columns if c.lower() != rank.lower()],
        F.when(F.col(can) & (number <= drawn), number).alias(rank))


def scored(df: DataFrame, target: DataFrame, seed: str, key: str = "doc_id", column: str = "text",
           target_column: str = "text", max_n: int = MAX_N, buckets: int = BUCKETS) -> DataFrame:
    """df with n_words, n_features, weight and score, by which ``draw`` draws."""
    weighed = weigh(df, target, column, target_column, max_n, buckets)
    names = [F.col(quoted(c)) for c in weighed.columns if c.lower() != "score"]
    return weighed.select(*names, noisy(F.col("weight"), F.col(quoted(key)), seed).alias("score"))


def resample(df: DataFrame, target: DataFrame, percent: int, seed: str, least_words: int = 20,
             key: str = "doc_id", column: str = "text", **options) -> DataFrame:
    """df without its texts, with n_features, weight, score and rank: which rows look like the target.

    A row may be drawn from some number of words on. See ``weigh`` and ``draw`` for nulls and ties.
    Texts are left out before rows move; whoever wants those drawn joins them on the key.
    """
    found = scored(df, target, seed, key, column, **options)
    narrow = found.select(*[F.col(quoted(c)) for c in found.columns if c.lower() != column.lower()])
    return draw(narrow, F.col("n_words") >= least_words, percent, key)

"""Vectors as short codes: each part is the number of its codebook's nearest entry.

Components become integers, so every sum and distance is exact. To find the nearest entry, a part's
coarse cell (its components without their last bits) is looked up in a memo. A cell met for the first
time gets the entries that may be nearest to some point of its box: those whose least distance to the
box is no more than the least of all entries' greatest distances to it. Only these are evaluated, in
the order of their numbers, so ties go to the lower one, as they would among all.

Codebooks are learned in rounds. A task adds up its own parts, and sends one sum for each component
of each entry; these sums, whose number parameters bound, are all that the driver sees.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightlake.llm.frames import fresh, quoted, with_fields, without
from sightlake.operators.joins import lookup_join
from sightlake.session import stage

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Last bits that a cell leaves out; cells that a task remembers for each part.
CELL_BITS, CELLS = 5, 100_000
#: Measured bytes of a table of labels that may be broadcast.
SMALL = 12 << 20
_CHUNK = 2048


def limit(dimension: int) -> int:
    """The largest integer component: squared distances of whole vectors then fit 63 bits."""
    return math.isqrt((1 << 60) // max(1, dimension))


def integers(vectors: np.ndarray) -> np.ndarray:
    """floor(256 x) of finite components, held within ``limit``."""
    bound = limit(vectors.shape[1])
    return np.clip(np.floor(SCALE * vectors.astype(np.float64)), -bound, bound).astype(np.int64)


class Grid:
    """The nearest entries of one part's codebook, by memoised cells."""

    def __init__(self, entries: np.ndarray, bits: int = CELL_BITS, cells: int = CELLS):
        self.entries, self.bits, self.cells = entries, bits, cells
        self.memo: dict[bytes, np.ndarray] = {}

    def candidates(self, cells: np.ndarray) -> list[np.ndarray]:
        """For each cell, the entries that none other beats at every point of the box."""
        low = (cells << self.bits)[:, None, :]
        high = low + ((1 << self.bits) - 1)
        near = np.maximum(np.maximum(low - self.entries, self.entries - high), 0)
        far = np.maximum(np.abs(self.entries - low), np.abs(self.entries - high))
        # Far sums may exceed what is exact for points; as doubles they are only ever rounded up a bit.
        bound = (far.astype(np.float64) ** 2).sum(axis=2).min(axis=1) * (1 + 1e-9)
        return [np.flatnonzero(row) for row in (near.astype(np.float64) ** 2).sum(axis=2) <= bound[:, None]]

    def _recalled(self, cells: np.ndarray) -> list[np.ndarray]:
        keys = [c.tobytes() for c in cells]
        new = [i for i, k in enumerate(keys) if k not in self.memo]
        found = {}
        for at in range(0, len(new), _CHUNK):
            some = new[at:at + _CHUNK]
            found |= zip((keys[i] for i in some), self.candidates(cells[some]), strict=True)
        result = [self.memo[k] if k in self.memo else found[k] for k in keys]
        if len(self.memo) + len(found) > self.cells:
            self.memo = {}
        self.memo |= dict(list(found.items())[:self.cells])
        return result

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance for each point; ties go to the lower entry."""
        n, size = points.shape
        entry, distance = np.empty(n, np.int64), np.empty(n, np.int64)
        cells = np.ascontiguousarray(points >> self.bits)
        hashed = cells.view(np.dtype((np.void, 8 * size))).ravel()
        _, one, of = np.unique(hashed, return_index=True, return_inverse=True)
        lists = self._recalled(cells[one])
        sizes = np.array([len(x) for x in lists])
        # Short lists together: none is filled up to the length of a much longer one.
        order = np.argsort(sizes[of], kind="stable")
        for at in range(0, n, _CHUNK):
            rows = order[at:at + _CHUNK]
            most = int(sizes[of[rows]].max())
            few, back = np.unique(of[rows], return_inverse=True)
            table = np.empty((len(few), most), np.int64)
            for row, i in zip(table, few, strict=True):
                row[:sizes[i]], row[sizes[i]:] = lists[i], lists[i][-1]
            tried = table[back]
            apart = ((points[rows][:, None, :] - self.entries[tried]) ** 2).sum(axis=2)
            best = apart.argmin(axis=1)
            entry[rows] = tried[np.arange(len(rows)), best]
            distance[rows] = apart[np.arange(len(rows)), best]
        return entry, distance


class Coder:
    """Codes of whole vectors under a codebook for each part: (parts, entries, size)."""

    def __init__(self, books: np.ndarray):
        self.books = books
        self.grids = [Grid(b) for b in books]

    def code(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entries by row and part, and each row's error."""
        size = self.books.shape[2]
        found = [g.nearest(vectors[:, i * size:(i + 1) * size]) for i, g in enumerate(self.grids)]
        return np.stack([e for e, _ in found], axis=1), np.sum([d for _, d in found], axis=0)

    def sums(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and componentwise sum of the parts of each entry."""
        parts, entries, size = self.books.shape
        codes, _ = self.code(vectors)
        counts, totals = np.zeros((parts, entries), np.int64), np.zeros(self.books.shape, np.int64)
        for i in range(parts):
            np.add.at(counts[i], codes[:, i], 1)
            np.add.at(totals[i], codes[:, i], vectors[:, i * size:(i + 1) * size])
        return counts, totals


def _vectors(column: pa.Array, dimension: int) -> np.ndarray:
    return integers(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dimension))


def usable(df: DataFrame, column: str = "embedding") -> DataFrame:
    """The rows whose vector is there, not empty, and holds finite components only."""
    vector = F.col(quoted(column)).cast("array<double>")
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.where(F.coalesce((F.size(vector) > 0) & ~odd, F.lit(False)))


def _round(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round over all vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(books)
        counts, totals = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
        for batch in batches:
            if batch.num_rows:
                n, t = coder.sums(_vectors(batch.column(0), books.shape[0] * books.shape[2]))
                counts, totals = counts + n, totals + t
        per = np.repeat(counts.ravel(), books.shape[2])
        used = np.flatnonzero(per)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(per[used]), pa.array(totals.ravel()[used])], ["slot", "n", "total"])

    summed = vectors.mapInArrow(run, "slot long, n long, total long").groupBy("slot").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"))
    moved = books.copy().ravel()
    for slot, n, total in summed.collect():  # no more than the codebooks have components
        moved[slot] = total // n
    return moved.reshape(books.shape)


def learn(df: DataFrame, column: str = "embedding", key: str = "vec_id", parts: int = PARTS,
          entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """The rows of df that are coded, and codebooks of integers: (parts, entries, size).

    Vectors of another length than most are left out as well as unusable ones. Entries start as the
    parts of the vectors with the least keys (nulls last, equal keys in the vectors' order, each row
    for itself); there are fewer if the table has fewer rows, and none without any. Parts must
    divide the length.
    """
    vector = F.col(quoted(column))
    kept = usable(df, column)
    common = kept.groupBy(F.size(vector).alias("size")).agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), F.desc("size")).first()
    if common is None:
        return kept, np.zeros((parts, 0, 0), np.int64)
    if common["size"] % parts:
        raise ValueError(f"{common['size']} components do not make {parts} equal parts")
    kept = kept.where(F.size(vector) == common["size"])
    plain = vector.cast("array<double>")
    first = kept.select(F.col(quoted(key)).alias("k"), plain.alias("v")).orderBy(
        F.asc_nulls_last("k"), "v").limit(entries).collect()
    books = integers(np.array([r["v"] for r in first])).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    vectors = kept.select(plain.alias("v"))
    for _ in range(rounds):
        books = _round(vectors, books)
    return kept, books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(df: DataFrame, column: str = "embedding", key: str = "vec_id", label: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """df's coded rows with code, error, label_error and codebooks_sha256, without the vectors.

    A code has two hex digits for each part. The label's error is that of all rows with it, nulls
    together. Vectors that are null, empty, of another length than most, or hold a null or a
    component that is not finite have no row; repeated rows have one each. Components beyond
    ``limit`` (in 256ths; some 700,000 for 64 components) count as that limit. An empty table gives
    an empty one. Columns with the names of results are replaced.
    """
    if entries > 256:
        raise ValueError("two hex digits tell 256 entries apart")
    kept, books = learn(df, column, key, parts, entries, rounds)

    @F.arrow_udf("code string, error long")
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder, step = Coder(books), 2 * parts
        for vectors in batches:
            codes, errors = coder.code(_vectors(vectors, parts * books.shape[2]))
            text = codes.astype(np.uint8).tobytes().hex()
            yield pa.StructArray.from_arrays(
                [pa.array([text[i:i + step] for i in range(0, len(text), step)], pa.string()),
                 pa.array(errors, pa.int64())], ["code", "error"])

    fields = ["code", "error"]
    rows = with_fields(kept, coded(F.col(quoted(column)).cast("array<double>")), fields)
    rows = stage(rows.select(*without(rows, {column.lower()} - set(fields))), "codes")
    group = fresh(rows, "group")
    sums = rows.groupBy(F.col(quoted(label)).alias(group)).agg(F.sum("error").alias("label_error"))
    named = rows.drop("label_error", "codebooks_sha256").withColumn(group, F.col(quoted(label)))
    return lookup_join(named, sums, [group], "left", null_safe=True, broadcast_limit=SMALL).drop(
        group).withColumn("codebooks_sha256", F.lit(digest(books)))

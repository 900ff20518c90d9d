"""Exact copies of texts, found by naming their blocks.

A text is cut into blocks of a fixed size. All blocks are sorted, and a block's name is an integer
that equal blocks have in common and no others. A text is then a list of names; adjacent pairs of
names are sorted and named in the same way, and so on until each text has one name left. Every
level names without collisions, so two texts have the same last name on the same level if and only
if they are equal: no hash decides anything.

A task first numbers the blocks it meets, each once, and sends a block on with its own number: a
block that a third of all rows share costs one row for each task. What the sort finds for these
numbers goes back to the lists, which hold numbers only. The blocks themselves move once.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sightlake.llm.frames import fresh, quoted
from sightlake.llm.words import code_points
from sightlake.operators.joins import lookup_join
from sightlake.session import drop_staged, stage

BLOCK = 1024
#: Bytes of blocks a task remembers, and sends on at once; numbers of a task and of its blocks.
HELD, SENT, OWN_BITS = 32 << 20, 4 << 20, 33
#: Measured bytes of a table of groups that may be broadcast.
SMALL = 12 << 20
#: The characters that do not count.
BLANKS = b" \t\n\x0b\x0c\r"

_PLACE = T.StructField("place", T.LongType())
_ABOUT = [T.StructField("n_chars", T.LongType()), T.StructField("digest", T.StringType())]
_NUMBERED = [
    T.StructField("own", T.ArrayType(T.LongType())), T.StructField("number", T.LongType()),
    T.StructField("block", T.BinaryType())]


class _Numbers:
    """A task's own numbers of blocks. What it forgets to stay small gets another number."""

    def __init__(self):
        self.next = TaskContext.get().partitionId() << OWN_BITS
        self.known: dict[bytes, int] = {}
        self.new: list[tuple[int, bytes]] = []
        self.held = self.waiting = 0

    def of(self, block: bytes) -> int:
        number = self.known.get(block)
        if number is None:
            if self.held > HELD:
                self.known, self.held = {}, 0
            number = self.known[block] = self.next
            self.next += 1
            self.held += len(block) + 100
            self.waiting += len(block) + 16
            self.new.append((number, block))
        return number

    def sent(self) -> list[tuple[int, bytes]]:
        new, self.new, self.waiting = self.new, [], 0
        return new


def _numbered(df: DataFrame, schema: T.StructType, described: Callable) -> DataFrame:
    """Rows with the numbers of their blocks, and rows of the new blocks, in one staged table.

    ``described`` gives, for a value of the last column, its blocks and the columns between.
    """
    fields = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = _Numbers()

        def blocks() -> pa.RecordBatch:
            new = numbers.sent()
            own = [pa.array([n for n, _ in new], pa.int64()), pa.array([b for _, b in new], pa.binary())]
            return pa.RecordBatch.from_arrays(
                [*[pa.nulls(len(new), f.type) for f in fields][:-2], *own], schema=fields)

        for batch in batches:
            rows = []
            for value in batch.column(batch.num_columns - 1):
                parts, about = described(value.as_py())
                rows.append((*about, [numbers.of(p) for p in parts]))
                if numbers.waiting > SENT:
                    yield blocks()
            if not rows:
                continue
            made = list(zip(*rows, strict=True))
            first = batch.num_columns - 1
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(first)],
                 *[pa.array(c, fields.field(first + i).type) for i, c in enumerate(made)],
                 *[pa.nulls(len(rows), f.type) for f in list(fields)[-2:]]], schema=fields)
            yield blocks()

    return stage(df.mapInArrow(run, schema), "blocks")


def _text(size: int) -> Callable:
    def described(text: bytes | None) -> tuple[list[bytes], tuple[int, str]]:
        solid = (text or b"").translate(None, BLANKS)
        parts = [solid[i:i + size] for i in range(0, len(solid), size)] or [b""]
        return parts, (code_points(text or b""), hashlib.sha256(solid).hexdigest())

    return described


def _pairs(names: list[int]) -> tuple[list[bytes], tuple]:
    # A last name without a partner is a block of one: no pair is as short.
    return [struct.pack(f">{len(names[i:i + 2])}q", *names[i:i + 2]) for i in range(0, len(names), 2)], ()


def _sorted_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A name for each block; the blocks come sorted, and equal ones to one task."""
    name, last = (TaskContext.get().partitionId() << OWN_BITS) - 1, None
    for batch in batches:
        names = []
        for block in batch.column(0).to_pylist():
            if block != last:
                name, last = name + 1, block
            names.append(name)
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), pa.array(names, pa.int64())], ["number", "name"])


def _named(numbered: DataFrame) -> DataFrame:
    """(place, names): the lists of a staged table with names in place of the tasks' numbers."""
    blocks = numbered.where("block is not null").select("block", "number")
    names = stage(
        blocks.repartitionByRange("block").sortWithinPartitions("block")
        .mapInArrow(_sorted_names, "number long, name long"), "names")
    lists = numbered.where("place is not null").select("place", F.posexplode("own").alias("at", "number"))
    named = lists.join(names, "number").groupBy("place").agg(
        F.array_sort(F.collect_list(F.struct("at", "name"))).alias("named"))
    result = stage(named.select("place", F.col("named.name").alias("names")), "names")
    drop_staged(numbered.sparkSession, names)
    return result


def _identities(numbered: DataFrame) -> DataFrame:
    """(place, level, name) of each text, from its numbered blocks.

    A level halves the lists; whatever it needs is written, so a lost executor costs that level.
    """
    done, level, held = [], 0, _named(numbered)
    while True:
        done.append(held.where("size(names) = 1").select(
            "place", F.lit(level).alias("level"), F.col("names")[0].alias("name")))
        rest = held.where("size(names) > 1")
        if rest.isEmpty():
            break
        paired = _numbered(rest, T.StructType([_PLACE, *_NUMBERED]), _pairs)
        held, level = _named(paired), level + 1
        drop_staged(paired.sparkSession, paired)
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result


def exact_copies(df: DataFrame, column: str = "text", key: str = "doc_id", block: int = BLOCK) -> DataFrame:
    """A row for each row of df: place, key, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are without blanks; a null text is an empty one, and all texts of blanks
    only are equal. Of equal ones the row with the most characters stays, then that with the least
    key (a null one last), then the first of the table; just one does, though keys repeat. keep_id is
    its key. Other columns are not read. ``place`` tells rows apart: it is that of
    ``monotonically_increasing_id`` over df, for ``drop_copies``.
    """
    held = df.select(
        F.monotonically_increasing_id().alias("place"), F.col(quoted(key)).alias("key"),
        F.col(quoted(column)).cast("string").cast("binary").alias("text"))
    named = T.StructField("key", held.schema["key"].dataType)
    numbered = _numbered(held, T.StructType([_PLACE, named, *_ABOUT, *_NUMBERED]), _text(block))
    rows = numbered.where("place is not null").select("place", "key", "n_chars", "digest")
    rows = stage(rows.join(_identities(numbered), "place"), "identities")
    first = F.min(F.struct(
        (-F.col("n_chars")).alias("short"), F.col("key").isNull().alias("nameless"), "key", "place"))
    groups = rows.groupBy("level", "name").agg(F.count("*").alias("size"), first.alias("first"))
    # A text without a copy meets nothing; copies of one text, however many, meet one row.
    found = lookup_join(rows, groups.where("size > 1"), ["level", "name"], "left", broadcast_limit=SMALL)
    alone = F.col("size").isNull()
    return found.select(
        "place", F.col("key").alias(key), F.when(alone, F.col("key")).otherwise(F.col("first.key")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("first.place") == F.col("place"))).alias("kept"), F.col("digest").alias("text_sha256"))


def drop_copies(df: DataFrame, column: str = "text", key: str = "doc_id", block: int = BLOCK) -> DataFrame:
    """The rows of df that stay, with its columns; df must read alike each time, as a written table."""
    place = fresh(df, "place")
    kept = exact_copies(df, column, key, block).where("kept").select(F.col("place").alias(place))
    return df.withColumn(place, F.monotonically_increasing_id()).join(kept, place, "left_semi").drop(place)

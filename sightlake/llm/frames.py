"""How the operators of this package add columns.

A result column takes the place of an input column of the same name (whatever its case), so a
table that has, say, its own ``n_words`` neither fails nor keeps two of them. Helper columns get
names that the table does not have.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Bytes of texts that a function takes at once, so that what it makes of them stays small.
AT_ONCE = 2 << 20


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def fresh(df: DataFrame, stem: str, *taken: str) -> str:
    """A column name the table does not have."""
    names = {c.lower() for c in (*df.columns, *taken)}
    while stem.lower() in names:
        stem += "_"
    return stem


def without(df: DataFrame, names) -> list[Column]:
    dropped = {n.lower() for n in names}
    return [F.col(quoted(c)) for c in df.columns if c.lower() not in dropped]


def with_fields(df: DataFrame, results: Column, fields: list[str]) -> DataFrame:
    """df with the named fields of a struct as columns, computed once."""
    held = fresh(df, "results", *fields)
    return df.withColumn(held, results).select(
        *without(df, fields), *[F.col(f"{held}.{f}").alias(f) for f in fields])


def with_columns(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """df with columns computed from its input columns only."""
    return df.select(*without(df, columns), *[c.alias(n) for n, c in columns.items()])


def slices(texts: pa.Array, at_once: int) -> Iterator[pa.Array]:
    """A batch's texts in turn, so many bytes or one text at a time."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends, start, taken = np.cumsum(sizes, dtype=np.int64), 0, 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(ends, taken + at_once, side="right")))
        yield texts.slice(start, stop - start)
        start, taken = stop, int(ends[stop - 1])


def over_texts(
    df: DataFrame, column: str, fields: str,
    rows: Callable[[list[bytes]], list[tuple]], at_once: int = AT_ONCE, together: bool = False,
) -> DataFrame:
    """Columns (in DDL), made by a function that takes the UTF-8 texts of a part of a batch.

    A null text is the empty one. Spark bounds an Arrow batch by rows and by bytes, the function
    takes so many bytes at once, nothing is shuffled, and a row depends on nothing else, so a lost
    task runs again alike. For a function that is costly to begin, whole batches may be put together
    up to so many bytes.
    """
    schema = T.StructType.fromDDL(fields)

    def packed(texts: list[pa.Array]) -> pa.Array:
        found = rows([t or b"" for own in texts for t in own.to_pylist()])
        columns = list(zip(*found, strict=True)) if found else [()] * len(schema)
        return pa.StructArray.from_arrays(
            [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, schema, strict=True)],
            schema.names)

    def alone(texts: pa.Array) -> pa.Array:
        return pa.concat_arrays([packed([part]) for part in slices(texts, at_once)] or [packed([])])

    def gathered(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held: list[pa.Array] = []
        for texts in batches:
            held.append(texts)
            if sum(t.nbytes for t in held) >= at_once:
                yield packed(held)
                held = []
        if held:
            yield packed(held)

    made = F.arrow_udf(gathered if together else alone, schema)
    text = F.col(quoted(column)).cast("string").cast("binary")
    return with_fields(df, made(text), schema.names)


def kept_rows(
    df: DataFrame, column: str, judged: Callable[[DataFrame], DataFrame], keep: Column,
) -> DataFrame:
    """The rows of df whose text passes a judgement, with the columns of df and no others."""
    own = [F.col(quoted(c)) for c in df.columns]
    packed = df.select(F.struct(*own).alias("row"), F.col(quoted(column)).alias("text"))
    return judged(packed).where(keep).select("row.*")

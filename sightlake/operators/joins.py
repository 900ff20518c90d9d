"""The lookup join all other operators share: every left row meets at most a few right rows.

Small right sides (measured, not assumed) are broadcast and the left side is not moved
at all. Beyond that both sides are shuffled, and left keys that hold many rows are spread
over several partitions first, so that no task gets a whole hot key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightlake.session import BROADCAST_LIMIT, broadcast_if_small, stage

HOT_ROWS = 1_000_000  # a key with more left rows than this is spread
SLOTS = 1 << 16  # rows are counted by so many hashes of keys first: a hot key's slot has as many rows

_RIGHT, _HOT, _SALT, _COUNT = "__right_", "__hot_", "__salt", "__salts"


def _match(left: DataFrame, right: DataFrame, pairs, null_safe: bool):
    def equal(a: str, b: str):
        return left[a].eqNullSafe(right[b]) if null_safe else left[a] == right[b]

    return reduce(lambda x, y: x & y, [equal(a, b) for a, b in pairs])


def _renamed(df: DataFrame, on: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({k: prefix + k for k in on})


def hot_keys(left: DataFrame, on: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys with more than hot_rows rows, and over how many parts to spread each; None if none has.

    Counts are combined before the shuffle, so a hot key costs one row per input task. However
    many rows there are, a part holds about hot_rows of them, and there are no more hot keys
    than parts. Where it takes many rows to be hot, keys themselves are counted only in slots with
    that many, so that nothing else of a large table is shuffled.
    """
    if hot_rows >= HOT_ROWS:
        slot = F.pmod(F.xxhash64(*on), F.lit(SLOTS))
        rows = left.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"))
        crowded = [r["slot"] for r in rows.where(F.col("n") > hot_rows).collect()]
        if not crowded:
            return None
        left = left.where(slot.isin(crowded))
    counts = left.groupBy(*on).agg(F.count(F.lit(1)).alias(_COUNT))
    hot = stage(counts.where(F.col(_COUNT) > hot_rows).withColumn(
        _COUNT, F.ceil(F.col(_COUNT) / hot_rows).cast("int")), "hot_keys")
    return None if hot.isEmpty() else hot


def _with_salts(df: DataFrame, on: Sequence[str], hot: DataFrame) -> DataFrame:
    """The number of parts of each row's key; one where the key is not hot."""
    marked, _ = broadcast_if_small(_renamed(hot, on, _HOT))
    joined = df.join(marked, _match(df, marked, [(k, _HOT + k) for k in on], True), "left")
    return joined.drop(*[_HOT + k for k in on]).withColumn(
        _COUNT, F.coalesce(_COUNT, F.lit(1)))


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    broadcast_limit: int = BROADCAST_LIMIT,
    hot_rows: int = HOT_ROWS,
    salts: int | None = None,
) -> DataFrame:
    """Equi-join on columns both sides name alike; the key columns come out once.

    ``how`` is left, inner, left_semi or left_anti. ``broadcast_limit=0`` skips measuring
    a right side that is known to be large. ``salts`` sets one number of parts for all hot
    keys, where their own rows would decide it.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"not a lookup join: {how}")
    right = _renamed(right, on, _RIGHT)
    pairs = [(k, _RIGHT + k) for k in on]
    right, small = broadcast_if_small(right, broadcast_limit)
    drop = [_RIGHT + k for k in on]
    if small:
        return left.join(right, _match(left, right, pairs, null_safe), how).drop(*drop)

    hot = hot_keys(left, on, hot_rows)
    if hot is None:
        return left.join(right, _match(left, right, pairs, null_safe), how).drop(*drop)
    if salts is not None:
        hot = hot.withColumn(_COUNT, F.lit(salts))

    # The salt depends on the row and the input partition only, so a task that runs again
    # gives each row the same one, and even exact copies of a row are spread.
    columns = left.columns
    left = _with_salts(left, on, hot)
    left = left.withColumn(_SALT, F.pmod(
        F.xxhash64(*columns) + F.spark_partition_id(), F.col(_COUNT)).cast("int")).drop(_COUNT)
    right = _with_salts(right, drop, _renamed(hot, on, _RIGHT))
    right = right.withColumn(
        _RIGHT + _SALT, F.explode(F.sequence(F.lit(0), F.col(_COUNT) - 1))).drop(_COUNT)
    condition = _match(left, right, pairs, null_safe) & (left[_SALT] == right[_RIGHT + _SALT])
    return left.join(right, condition, how).drop(*drop, _SALT, _RIGHT + _SALT)

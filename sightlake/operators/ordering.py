"""Running totals over a whole table, without a window that takes it all into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from sightlake.session import stage

_PART, _AT = "__part", "__at"


def totals_before(
    df: DataFrame, order: Sequence[Column], amount: Column, name: str = "start"
) -> DataFrame:
    """df with the sum of the amounts of all rows before, in an order without ties.

    Rows go to ranges of the order; a total within each range and the ranges' own sums make up
    the total. There is one sum for each range, of which there are no more than shuffle
    partitions, and only these come to the driver.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    ranged = stage(
        ranged.withColumns({_AT: at, name: amount}).withColumn(_PART, F.shiftright(_AT, 33)), "ranged")
    starts, total = [], 0
    for part, own in sorted(ranged.groupBy(_PART).agg(F.sum(name)).collect()):
        starts.append((part, total))
        total += own or 0
    first = df.sparkSession.createDataFrame(starts, f"{_PART} long, __before long")
    before = Window.partitionBy(_PART).orderBy(_AT).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(name).over(before), F.lit(0))
    return ranged.withColumn(name, inside).join(F.broadcast(first), _PART).select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col(name) + F.col("__before")).alias(name))

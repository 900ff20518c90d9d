"""Connected components of a table of links, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightlake.session import drop_staged, stage


def _star(links: DataFrame, small: bool) -> DataFrame:
    """Each node hands its neighbours (the smaller ones, or the others) its least neighbour.

    Links (high, low) have high > low. The minimum is taken before the join, so a node that
    many links share meets them as one row, and the join may be split by its key's rows.
    """
    if small:
        least = links.groupBy("high").agg(F.min("low").alias("least"))
        joined = links.join(least, "high")
        moved = joined.select(F.col("low").alias("high"), F.col("least").alias("low"))
        kept = least.select("high", F.col("least").alias("low"))
        return moved.where("high <> low").unionByName(kept).distinct()
    both = links.select(F.col("high").alias("node"), F.col("low").alias("other")).unionByName(
        links.select(F.col("low").alias("node"), F.col("high").alias("other")))
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    joined = both.where("other > node").join(least, "node")
    return joined.select(F.col("other").alias("high"), F.col("least").alias("low")).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of a link between longs; root is the component's least node.

    Nodes without a link to another one are absent. Every round is written to the shared folder,
    so that neither the plan nor a lost executor's work grows with the rounds, which are few:
    each one roughly halves the distances.
    """
    held = stage(
        links.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"))
        .where("high <> low").distinct(), "links")
    seen = _mark(held)
    while seen[0]:
        starred = stage(_star(_star(held, small=False), small=True), "links")
        drop_staged(held.sparkSession, held)
        held, before, seen = starred, seen, _mark(starred)
        if seen == before:
            break
    roots = held.select(F.col("high").alias("node"), F.col("low").alias("root"))
    return roots.unionByName(held.select(F.col("low").alias("node"), F.col("low").alias("root"))
                             .distinct())


def _mark(links: DataFrame) -> tuple:
    """What stays the same once a round changes nothing."""
    row = links.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("high", "low").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]

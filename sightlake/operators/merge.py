"""Merging a new pull with the reports already held."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightlake.operators.joins import lookup_join


def distinct_links(updated: DataFrame, key: str = "report_link") -> DataFrame:
    """One row per key: a hot link in the pull is collapsed before it is shuffled."""
    return updated.select(key).distinct()


def last_pulls(lines: DataFrame, key: str = "report_link", turn: str = "turn") -> DataFrame:
    """One row per key: the last of several pulls, by turn, that has it."""
    return lines.groupBy(key).agg(F.max(turn).alias(turn))


def of_last_pull(
    lines: DataFrame, last: DataFrame, key: str = "report_link", turn: str = "turn", **join_options
) -> DataFrame:
    """The lines of several pulls that merging them one by one, by turn, would leave.

    Each pull replaces what earlier ones have of its keys; a null key equals a null key.
    """
    return lookup_join(lines, last, [key, turn], "left_semi", null_safe=True, **join_options)


def surviving_reports(
    updated: DataFrame | None,
    orig: DataFrame,
    key: str = "report_link",
    dedupe_orig: bool = False,
    links: DataFrame | None = None,
    **join_options,
) -> DataFrame:
    """Old reports whose key the new pull lacks; a null key equals a null key.

    ``links`` are the pull's distinct keys, if the caller has them at hand already; the pull
    itself is not needed then.
    """
    if links is None:
        links = distinct_links(updated, key)
    kept = lookup_join(orig, links, [key], "left_anti", null_safe=True, **join_options)
    return one_per_key(kept, key) if dedupe_orig else kept


def one_per_key(reports: DataFrame, key: str = "report_link") -> DataFrame:
    """One report per key, the smallest by its other columns."""
    rest = [c for c in reports.columns if c != key]
    first = F.min(F.struct(*rest)) if rest else F.count(F.lit(1))
    return reports.groupBy(key).agg(first.alias("r")).select(
        *[F.col(key) if c == key else F.col(f"r.`{c}`").alias(c) for c in reports.columns]
    )


def merge_reports(
    updated: DataFrame,
    orig: DataFrame,
    key: str = "report_link",
    dedupe_orig: bool = False,
    **options,
) -> DataFrame:
    """All new reports, duplicates included, and the old ones the pull does not replace.

    ``dedupe_orig`` keeps one old report per key, the smallest by its other columns.
    """
    kept = surviving_reports(updated, orig, key, dedupe_orig, **options)
    return updated.unionByName(kept, allowMissingColumns=True)

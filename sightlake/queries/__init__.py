"""Every operator run over whole given tables, each with the SQL that gives its answer.

The given tables hold no reports, so dates, places, pages and placemarks are built from
their columns. Text that only builds such input is written once and used by both engines;
the SQL that follows it works the answer out its own way.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def case_of(index: str, values: list[str | None]) -> str:
    """SQL CASE that picks a literal by a row number."""
    arms = " ".join(f"WHEN {i} THEN {quoted(v)}" for i, v in enumerate(values))
    return f"CASE {index} {arms} END"


def all_queries() -> dict[str, Query]:
    from sightlake.queries import (
        cleaning, documents, geocoding, pages, pulls, quality, sites, tables,
    )

    merged: dict[str, Query] = {}
    for module in (quality, cleaning, geocoding, pulls, pages, documents, sites, tables):
        merged.update(module.QUERIES)
    return merged

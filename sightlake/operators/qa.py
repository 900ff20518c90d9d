"""Quality-assurance queries over the enhanced reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightlake.session import stage

REPORT_COLUMNS = [
    "date_time", "posted", "shape", "country", "state", "city_latitude", "city_longitude",
]


def is_recent(ts: Column, days: int = 100, as_of: date | str | Column | None = None) -> Column:
    """Less than ``days`` days before ``as_of``; later moments count as recent.

    Written as a bound on the column itself, so that it reaches the Parquet scan.
    """
    today = F.current_date() if as_of is None else as_of
    today = (today if isinstance(today, Column) else F.lit(today)).cast("date")
    return ts >= F.date_sub(today, days - 1).cast("timestamp_ntz")


def daily_counts(
    reports: DataFrame, ts: str, days: int | None = None, as_of: date | str | Column | None = None
) -> DataFrame:
    """Reports per day of a timestamp column, over all time or recent days only."""
    known = reports.where(F.col(ts).isNotNull())
    if days is not None:
        known = known.where(is_recent(F.col(ts), days, as_of))
    return known.groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("num_reports"))


def category_counts(
    reports: DataFrame,
    category: str,
    more_than: int | None = None,
    recent_by: str | None = None,
    days: int = 100,
    as_of: date | str | Column | None = None,
) -> DataFrame:
    """Reports per category, null as 'none'; optionally recent ones, optionally frequent ones."""
    if recent_by is not None:
        reports = reports.where(is_recent(F.col(recent_by), days, as_of))
    counts = reports.groupBy(F.coalesce(F.col(category), F.lit("none")).alias(category)).agg(
        F.count(F.lit(1)).alias("num_reports")
    )
    return counts if more_than is None else counts.where(F.col("num_reports") > more_than)


def in_display_order(counts: DataFrame, category: str) -> DataFrame:
    """Bars from the least to the most frequent category."""
    return counts.orderBy("num_reports", category)


def distinct_geos(
    reports: DataFrame, lat: str = "city_latitude", lon: str = "city_longitude"
) -> DataFrame:
    """Distinct coordinate pairs, both parts known."""
    return (
        reports.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
        .select(F.col(lat).alias("latitude"), F.col(lon).alias("longitude"))
        .distinct()
    )


def record_count(reports: DataFrame) -> DataFrame:
    return reports.agg(F.count(F.lit(1)).alias("num_records"))


def sample_latest(
    reports: DataFrame, ts: str = "posted", tie_break: str = "report_link", n: int = 100
) -> DataFrame:
    """The n rows with the latest timestamp; rows alike in both columns go by all the others.

    Two columns tell where the n-th row lies, so whole rows are read and ordered only from there on.
    """
    order = [F.desc(ts), F.asc(tie_break)]
    known = reports.where(F.col(ts).isNotNull())
    top = known.select(
        F.col(ts).cast("string").alias("at"), F.col(tie_break).cast("string").alias("tie"), ts, tie_break
    ).orderBy(*order).limit(n).select("at", "tie").collect()
    if len(top) == n and n:
        types = dict(reports.dtypes)
        at = F.lit(top[-1]["at"]).cast(types[ts])
        tie = F.lit(top[-1]["tie"]).cast(types[tie_break])
        # Nulls come first among equal timestamps.
        before = F.col(tie_break).isNull() | F.coalesce(F.col(tie_break) <= tie, F.lit(False))
        known = known.where(F.col(ts) >= at).where((F.col(ts) > at) | before)
    rest = F.xxhash64(*[F.col(f"`{c}`") for c in reports.columns])
    return known.orderBy(*order, rest).limit(n)


def shared_counts(
    reports: DataFrame, days: int = 100, as_of: date | str | Column | None = None
) -> DataFrame:
    """(kind, day, item, num_reports, num_recent) from one scan: reports per day and category.

    Kinds are ``date_time`` and ``posted`` (by day; recent by that column itself), ``shape``,
    ``country`` and ``state`` (recent by ``date_time``), and ``all``, a row that an empty table lacks.
    Each row counts once for each kind before anything is shuffled.
    """
    categories = ["shape", "country", "state"]
    recent = {ts: is_recent(F.col(ts), days, as_of) for ts in ("date_time", "posted")}
    rows = reports.select(
        *[F.to_date(ts).alias(ts) for ts in recent],
        *[F.coalesce(F.col(c), F.lit("none")).alias(c) for c in categories],
        *[F.coalesce(r, F.lit(False)).alias(f"recent_{ts}") for ts, r in recent.items()])
    kinds = [*recent, *categories, "all"]
    columns = [c for c in kinds if c != "all"]
    counts = rows.groupingSets([[c] for c in columns] + [[]], *columns).agg(
        F.grouping_id(*columns).alias("g"), F.count(F.lit(1)).alias("num_reports"),
        F.count_if("recent_date_time").alias("recent_date_time"),
        F.count_if("recent_posted").alias("recent_posted"))
    # The set with one column has the bits of all the others.
    every = (1 << len(columns)) - 1
    kind = F.element_at(F.create_map(*[F.lit(x) for i, c in enumerate(kinds) for x in (
        every if c == "all" else every ^ (1 << (len(columns) - 1 - i)), c)]), F.col("g").cast("int"))
    return counts.select(
        kind.alias("kind"), F.coalesce("date_time", "posted").alias("day"),
        F.coalesce(*categories).alias("item"), "num_reports",
        F.when(kind == "posted", F.col("recent_posted")).otherwise(F.col("recent_date_time")).alias("num_recent"))


def qa_report(
    reports: DataFrame, days: int = 100, as_of: date | str | Column | None = None
) -> dict[str, DataFrame]:
    """All queries of the quality page, by name.

    Everything but the sample and the distinct coordinates comes from one set of counts, which is
    staged: over Parquet the whole page takes four scans of a few columns each.
    """
    counts = stage(shared_counts(reports, days, as_of), "counts")

    def per_day(ts: str, num: str) -> DataFrame:
        return counts.where((F.col("kind") == ts) & F.col("day").isNotNull() & (F.col(num) > 0)).select(
            "day", F.col(num).alias("num_reports"))

    def per_category(category: str, num: str, more_than: int = 0) -> DataFrame:
        return counts.where((F.col("kind") == category) & (F.col(num) > more_than)).select(
            F.col("item").alias(category), F.col(num).alias("num_reports"))

    total = counts.where(F.col("kind") == "all").agg(
        F.coalesce(F.sum("num_reports"), F.lit(0)).alias("num_records"))
    results = {"sample": sample_latest(reports), "num_records": total}
    for prefix, num in (("", "num_reports"), ("recent_", "num_recent")):
        results |= {
            f"{prefix}date_time_counts": per_day("date_time", num),
            f"{prefix}posted_counts": per_day("posted", num),
            f"{prefix}shape_counts": per_category("shape", num),
            f"{prefix}country_counts": per_category("country", num, 1),
            f"{prefix}state_counts": per_category("state", num, 1),
        }
    return {**results, "geos": distinct_geos(reports)}

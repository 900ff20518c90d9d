"""Standardising raw reports.

All built-in expressions and no shuffle. Values used more than once are given a projection
of their own, so that each regular expression runs once per row: Spark keeps neighbouring
projections apart when merging them would repeat costly work.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightlake.functions import dates, places
from sightlake.functions.text import has_text

DATES = ("posted", "date_time")


def clean_dates(
    reports: DataFrame,
    as_of: datetime | str | Column | None = None,
    future: str = "null",
    couple_dates: bool = True,
) -> DataFrame:
    """Parse posted and date_time. Coupled, one unusable date makes both null."""
    now = dates.as_timestamp(as_of)
    reports = reports.withColumns({c: dates.report_ts_parts(F.col(c)) for c in DATES})
    reports = reports.withColumns({c: dates.ts_from_parts(F.col(c)) for c in DATES})
    reports = reports.withColumns({c: dates.settle_future(F.col(c), now, future) for c in DATES})
    if not couple_dates:
        return reports
    known = F.col(DATES[0]).isNotNull() & F.col(DATES[1]).isNotNull()
    return reports.withColumns({c: F.when(known, F.col(c)) for c in DATES})


def clean_places(reports: DataFrame) -> DataFrame:
    """Clean shape, state and city. The city rules see the cleaned state.

    A city stays as it is unless it and its state both hold text.
    """
    city, state = F.col("city"), F.col("state")
    both = has_text(city) & has_text(state)
    reports = reports.withColumns({
        "shape": places.clean_shape(F.col("shape")),
        "state": places.clean_state(state),
        "city": F.when(both, places.normalize_city(city)).otherwise(city),
    })
    fixed = F.when(has_text(state), places.fix_city(city, state)).otherwise(city)
    return reports.withColumn("city", fixed)


def standardize(
    reports: DataFrame,
    as_of: datetime | str | Column | None = None,
    future: str = "null",
    couple_dates: bool = True,
) -> DataFrame:
    """Raw reports with dates parsed and shape, state and city cleaned in place."""
    return clean_places(clean_dates(reports, as_of, future, couple_dates))

"""Report dates: parsing, the future rule and coupling, all as Column expressions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from sightlake.functions.text import WS_CLASS

# month/day/two-digit year, then optionally white space and 24-hour hour:minute.
# One or two digits each but for the year; a day may be padded with one blank.
# \z, because $ would accept a trailing line feed.
REPORT_TS = (
    r"^(?:1[0-2]|0?[1-9])/(?:3[01]|[12][0-9]|0?[1-9]| [1-9])/[0-9]{2}"
    rf"(?:[{WS_CLASS}]+(?:2[0-3]|[01]?[0-9]):[0-5]?[0-9])?\z"
)
# Two-digit years from the pivot on belong to the 20th century (fixed value).
CENTURY_PIVOT = 69

ISO_TS = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}\z"

LINK_DATE = r"^[0-9]{4}-(?:1[0-2]|0?[1-9])-(?:3[01]|[12][0-9]|0?[1-9]| [1-9])\z"


def as_timestamp(as_of: datetime | str | Column | None) -> Column:
    """The moment to compare against: given, or the session's local time."""
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, datetime):
        as_of = as_of.isoformat()  # a datetime literal would pass through a time zone
    return (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("timestamp_ntz")


def _parts(c: Column, pattern: str, separators: str) -> Column:
    return F.split(F.when(c.rlike(pattern), c), separators)


def report_ts_parts(c: Column) -> Column:
    """Month, day, year and, if there, hour and minute of a report date; null if malformed."""
    return _parts(c, REPORT_TS, rf"[/:{WS_CLASS}]+")


def ts_from_parts(parts: Column) -> Column:
    def part(i: int) -> Column:
        return F.get(parts, F.lit(i)).try_cast("int")

    year = part(2) + F.when(part(2) >= CENTURY_PIVOT, 1900).otherwise(2000)
    zero = F.lit(0)
    return F.try_make_timestamp_ntz(
        year, part(0), part(1),
        F.coalesce(part(3), zero), F.coalesce(part(4), zero), zero,
    )


def parse_report_ts(c: Column) -> Column:
    """``M/d/yy H:mm`` or ``M/d/yy`` to timestamp_ntz; anything else is null."""
    return ts_from_parts(report_ts_parts(c))


def parse_link_date(c: Column) -> Column:
    """``yyyy-M-d`` to date; anything else is null."""
    parts = _parts(c, LINK_DATE, "[- ]+")

    def part(i: int) -> Column:
        return F.get(parts, F.lit(i)).try_cast("int")

    year = F.when(part(0) > 0, part(0))
    zero = F.lit(0)
    return F.try_make_timestamp_ntz(year, part(1), part(2), zero, zero, zero).cast("date")


def parse_iso_ts(c: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` to timestamp_ntz; anything else is null."""
    return F.when(c.rlike(ISO_TS), c).try_cast("timestamp_ntz")


def settle_future(ts: Column, as_of: Column, future: str = "null") -> Column:
    """Dates after ``as_of``: null by default, or moved back a century."""
    if future == "null":
        return F.when(ts <= as_of, ts)
    if future == "minus_100y":
        return F.when(ts > as_of, ts - F.make_interval(years=F.lit(100))).otherwise(ts)
    raise ValueError(f"future must be 'null' or 'minus_100y', not {future!r}")

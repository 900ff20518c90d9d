"""City gazetteer and geocoding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightlake import schemas
from sightlake.functions.text import blank_to_null
from sightlake.operators.joins import lookup_join

KEYS = schemas.PLACE_KEYS


def build_gazetteer(blocks: DataFrame, locations: DataFrame) -> DataFrame:
    """Mean coordinates and number of address blocks per place.

    Blocks are summed up per location before the join, so what meets the locations is one
    row per location however many blocks one of them has. Null coordinates are left out of
    the means but counted as blocks; places with a null key are dropped.
    """
    per_location = (
        blocks.where(F.col("geoname_id").isNotNull())
        .groupBy("geoname_id")
        .agg(
            F.sum("latitude").alias("lat_sum"), F.count("latitude").alias("lat_n"),
            F.sum("longitude").alias("lon_sum"), F.count("longitude").alias("lon_n"),
            F.count(F.lit(1)).alias("blocks"),
        )
    )
    named = locations.select("geoname_id", *KEYS).dropna(subset=KEYS)

    def mean(total: str, n: str):
        return F.try_divide(F.sum(total), F.sum(n))

    return (
        named.join(per_location, "geoname_id", "inner")
        .groupBy(*KEYS)
        .agg(
            mean("lat_sum", "lat_n").alias("latitude"),
            mean("lon_sum", "lon_n").alias("longitude"),
            F.sum("blocks").alias("num_blocks"),
        )
    )


def best_city(gazetteer: DataFrame) -> DataFrame:
    """Per (state, lower-case city) the place with most blocks; ties go to the smallest keys.

    A minimum over structs: one partial and one final aggregate, no ranked window.
    """
    rank = F.struct(
        (-F.coalesce(F.col("num_blocks"), F.lit(0))).alias("neg_blocks"),
        *KEYS, "latitude", "longitude", "num_blocks",
    )
    return (
        gazetteer.groupBy(
            F.upper("subdivision_1_iso_code").alias("state_key"),
            F.lower("city_name").alias("city_key"),
        )
        .agg(F.min(rank).alias("best"))
        .select("state_key", "city_key", "best.latitude", "best.longitude", "best.num_blocks")
    )


def geocode(reports: DataFrame, best: DataFrame, **join_options) -> DataFrame:
    """Reports with city_latitude and city_longitude, both null where nothing matches.

    The lookup is by (state, lower-case city); the country takes no part. An empty city or
    state is never looked up. ``best`` is measured: a gazetteer that fits is broadcast and
    the reports stay where they are.
    """
    lookup = best.select(
        "state_key", "city_key",
        F.col("latitude").alias("city_latitude"), F.col("longitude").alias("city_longitude"),
    )
    keyed = reports.drop("city_latitude", "city_longitude").withColumns({
        "state_key": blank_to_null(F.col("state")),
        "city_key": F.lower(blank_to_null(F.col("city"))),
    })
    joined = lookup_join(keyed, lookup, ["state_key", "city_key"], "left", **join_options)
    return joined.drop("state_key", "city_key")


def missing_geocodes(reports: DataFrame) -> DataFrame:
    """Number of reports without coordinates per (city, state)."""
    missing = F.col("city_latitude").isNull() | F.col("city_longitude").isNull()
    return (
        reports.where(missing)
        .groupBy("city", "state")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def ranked(audit: DataFrame) -> DataFrame:
    """The audit, most frequent first; ties in state and city order."""
    return audit.orderBy(F.desc("count"), "state", "city")


def total_missing(audit: DataFrame) -> DataFrame:
    return audit.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("total"))

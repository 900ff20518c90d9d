"""Point sites with a buffer polygon each, from KML placemarks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightlake import schemas
from sightlake.functions.geodesy import buffer_ring, ring_to_geojson
from sightlake.functions.html_nodes import description_cells
from sightlake.functions.text import strip_ws

LINK_CELL, BRANCH_CELL = 0, 1  # cells of the description table (fixed values)


def parse_placemarks(placemarks: DataFrame) -> DataFrame:
    """Name, branch, link and coordinates per placemark; ``problem`` marks unusable ones."""
    parts = F.split("Point.coordinates", ",")

    def number(i: int):
        return strip_ws(F.get(parts, F.lit(i))).try_cast("double")

    cells = F.col("cells")
    parsed = placemarks.select(
        "name", F.size(parts).alias("n"),
        number(0).alias("longitude"), number(1).alias("latitude"),
        description_cells(F.col("description")).alias("cells"),
    ).withColumns({
        "branch": F.get(cells, F.lit(BRANCH_CELL))["bold"],
        "link": F.get(cells, F.lit(LINK_CELL))["href"],
    })
    located = F.coalesce(F.abs("latitude") <= 90, F.lit(False)) & F.coalesce(
        F.abs("longitude") <= 360, F.lit(False)
    )
    return parsed.select(
        *schemas.SITE_COLUMNS,
        F.when(F.col("name").isNull(), "no name")
        .when(~(F.coalesce(F.col("n") == 2, F.lit(False)) & located), "bad coordinates")
        .when(F.col("branch").isNull(), "no branch")
        .when(F.col("link").isNull(), "no link")
        .alias("problem"),
    )


def with_buffer(sites: DataFrame, radius_km: int = 100, quad_segs: int = 16) -> DataFrame:
    """Sites with the GeoJSON polygon of a circle around each."""
    ring = buffer_ring("longitude", "latitude", radius_km, quad_segs)
    return sites.withColumn(f"buffer_{radius_km}km_geojson", ring_to_geojson(ring))

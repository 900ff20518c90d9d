"""Schemas and column orders shared by readers, operators and writers."""

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# One JSON object per line; every field is text as it stood on the page.
RAW_REPORT = _strings(
    "text", "duration", "stats", "date_time", "report_link", "city", "state",
    "country", "shape", "summary", "posted",
)

# Column order of the enhanced table (fixed values).
ENHANCED_COLUMNS = [
    "summary", "country", "city", "state", "date_time", "shape", "duration",
    "stats", "report_link", "text", "posted", "city_latitude", "city_longitude",
]

ENHANCED_TYPES = {
    "date_time": "timestamp_ntz",
    "posted": "timestamp_ntz",
    "city_latitude": "double",
    "city_longitude": "double",
}

# Gazetteer group keys, in the order that also breaks ties (fixed values).
PLACE_KEYS = [
    "country_iso_code", "country_name", "subdivision_1_iso_code",
    "subdivision_1_name", "city_name",
]

LOCATION_TYPES = {"geoname_id": "long", **{k: "string" for k in PLACE_KEYS}}
BLOCK_TYPES = {"geoname_id": "long", "latitude": "double", "longitude": "double"}
CITY_TYPES = {
    **{k: "string" for k in PLACE_KEYS},
    "latitude": "double", "longitude": "double", "num_blocks": "long",
}

PLACEMARK = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("Point", _strings("coordinates")),
])

SITE_COLUMNS = ["name", "branch", "link", "latitude", "longitude"]

# ISO-8601 without a zone, as timestamps stand in CSV files and documents.
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"

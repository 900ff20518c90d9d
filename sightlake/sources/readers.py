"""Table readers: NDJSON, CSV, stored pages and KML."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightlake import schemas
from sightlake.functions.text import blank_to_null, tokens_to_null


# Cell values read as missing in the geolocation files (fixed values).
NA_TOKENS = [
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_raw_reports(spark: SparkSession, path: str) -> DataFrame:
    """Raw reports, one JSON object per line, under the fixed all-string schema."""
    return spark.read.schema(schemas.RAW_REPORT).json(path, mode="FAILFAST")


def read_report_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw report lines as they stand, with the link parsed out.

    For jobs that only move reports around: fields outside the schema pass through,
    and no text is parsed and written out again.
    """
    return with_report_link(spark.read.text(path))


def with_report_link(lines: DataFrame, *others: str) -> DataFrame:
    """Lines with their link, and other columns as they are."""
    parsed = F.from_json("value", "report_link string", {"mode": "FAILFAST"})
    return lines.select("value", parsed["report_link"].alias("report_link"), *others)


def parse_lines(lines: DataFrame) -> DataFrame:
    """Raw lines under the fixed all-string schema."""
    parsed = F.from_json("value", schemas.RAW_REPORT, {"mode": "FAILFAST"})
    return lines.select(parsed.alias("r")).select("r.*")


def read_string_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """CSV with a header as all-string columns; empty cells are null.

    ``multi_line`` lets quoted text hold line breaks, at the price that a file cannot be
    split; tables read more than once belong in Parquet.
    """
    # Columns go by their header names. A user schema would go by position instead. Every file's
    # header must be that of the first one, or the job fails: values never change columns.
    return (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )


def _typed(table: DataFrame, types: Mapping[str, str], clean=lambda c: c) -> DataFrame:
    def column(name: str, kind: str) -> Column:
        # A malformed number or date fails the job; it is never read as missing.
        return clean(F.col(f"`{name}`")).cast(kind).alias(name)

    return table.select(*[column(n, k) for n, k in types.items()])


def read_locations(
    spark: SparkSession, path: str, na_tokens: Iterable[str] = NA_TOKENS
) -> DataFrame:
    """City location table: key and place names; missing-value tokens become null."""
    table = read_string_csv(spark, path)
    return _typed(table, schemas.LOCATION_TYPES, lambda c: tokens_to_null(c, na_tokens))


def read_blocks(
    spark: SparkSession, path: str, na_tokens: Iterable[str] = NA_TOKENS
) -> DataFrame:
    """Address block table: location key and coordinates.

    The one large CSV. It holds no free text, so its files may be split.
    """
    table = read_string_csv(spark, path, multi_line=False)
    return _typed(table, schemas.BLOCK_TYPES, lambda c: tokens_to_null(c, na_tokens))


def read_cities(spark: SparkSession, path: str) -> DataFrame:
    """Gazetteer written by the gazetteer job."""
    table = read_string_csv(spark, path)
    return _typed(table, schemas.CITY_TYPES, blank_to_null)


def read_enhanced_csv(spark: SparkSession, path: str) -> DataFrame:
    """Enhanced reports with dates and coordinates typed."""
    types = {c: schemas.ENHANCED_TYPES.get(c, "string") for c in schemas.ENHANCED_COLUMNS}
    return _typed(read_string_csv(spark, path), types, blank_to_null)


def register_reports(reports: DataFrame, name: str = "reports") -> DataFrame:
    """Make the typed reports available to SQL under a view name."""
    reports.createOrReplaceTempView(name)
    return reports


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored pages: url and html, and no other column."""
    return spark.read.parquet(path).select("url", "html")


def read_placemarks(spark: SparkSession, path: str) -> DataFrame:
    """One row per KML placemark, whatever prefix the file gives its namespace."""
    return (
        spark.read.format("xml")
        .option("rowTag", "Placemark")
        .option("ignoreNamespace", True)
        .option("ignoreSurroundingSpaces", False)
        .schema(schemas.PLACEMARK)
        .load(path)
    )


def parse_placemark(xml: Column) -> Column:
    """The same struct for a placemark held in a string column."""
    options = {"rowTag": "Placemark", "ignoreNamespace": "true", "ignoreSurroundingSpaces": "false"}
    return F.from_xml(xml, schemas.PLACEMARK.simpleString(), options)

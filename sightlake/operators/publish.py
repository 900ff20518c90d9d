"""Documents for a search index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightlake.functions.dates import parse_iso_ts
from sightlake.functions.text import blank_to_null
from sightlake.operators.joins import lookup_join
from sightlake.operators.ordering import totals_before

# Declared field types of the index (fixed values).
DOCUMENT_TYPES = {
    "text": "text", "stats": "text", "date_time": "date", "report_link": "text",
    "city": "keyword", "state": "keyword", "shape": "keyword", "duration": "text",
    "summary": "text", "posted": "date", "city_latitude": "float",
    "city_longitude": "float", "location": "geo_point",
}


def number_rows(table: DataFrame, name: str = "_id") -> DataFrame:
    """Running number from 0, without gaps, in file order.

    ``table`` reads Parquet files. A row's number is its place in its file plus the rows of
    all files before, so no row moves, no rows are sorted, and a task that runs again numbers
    its rows alike. Row counts come from the file footers, one row per file, and are summed up
    in ranges of the files' order.
    """
    file, place = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    counts = table.groupBy(file.alias("__file")).agg(
        F.count(F.lit(1)).alias("rows"), F.lit(0).alias("first"))
    return _numbered(
        table.select("*", file.alias("__file"), place.alias("__place")), counts, name)


def with_places(table: DataFrame) -> DataFrame:
    """A scan of files that are read from start to end, with what ``number_placed`` needs.

    Tasks take files by size, so their order says nothing: a row keeps the name of its file.
    What comes out must be written before it is numbered.
    """
    return table.select(
        "*", F.col("_metadata.file_path").alias("__file"),
        F.monotonically_increasing_id().alias("__place"))


def number_placed(placed: DataFrame, name: str = "_id") -> DataFrame:
    """Running number from 0, without gaps, of written rows, in the order of their first files."""
    counts = placed.groupBy("__file").agg(
        F.count(F.lit(1)).alias("rows"), F.min("__place").alias("first"))
    return _numbered(placed, counts, name)


def _numbered(placed: DataFrame, counts: DataFrame, name: str) -> DataFrame:
    # Part files by number first: names are padded to five digits only.
    part = F.regexp_extract("__file", r"part-(\d+)[^/]*\z", 1).try_cast("int")
    folder = F.regexp_extract("__file", r"^.*/", 0)
    starts = totals_before(counts, [folder, part, F.col("__file")], F.col("rows")).select(
        "__file", (F.col("start") - F.col("first")).alias("__start"))
    columns = [c for c in placed.columns if c not in ("__file", "__place")]
    return lookup_join(placed, starts, ["__file"], "inner").select(
        (F.col("__start") + F.col("__place")).alias(name), *columns
    )


def location(lat: Column, lon: Column) -> Column:
    """{lat, lon} where both are known, else null."""
    lat, lon = lat.try_cast("double"), lon.try_cast("double")
    return F.when(
        lat.isNotNull() & lon.isNotNull(), F.struct(lat.alias("lat"), lon.alias("lon"))
    )


def _coordinate_problem(name: str, bound: int) -> Column:
    value = blank_to_null(F.col(name).cast("string"))
    number = value.try_cast("double")
    bad = value.isNotNull() & (number.isNull() | F.isnan(number) | (F.abs(number) > bound))
    return F.when(bad, F.concat(F.lit(name + ": "), value))


def as_text(reports: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every column but the kept ones as text; timestamps in ISO form."""
    def column(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if name in keep:
            return c
        if kind == "timestamp_ntz":
            # Not date_format: that would take the value through the session's time zone.
            return F.translate(c.cast("string"), " ", "T").alias(name)
        return blank_to_null(c.cast("string")).alias(name)

    return reports.select(*[column(n, t) for n, t in reports.dtypes])


def to_index_docs(
    numbered: DataFrame, index: str, doc_type: str, id_column: str = "_id"
) -> DataFrame:
    """Index actions: envelope constants, id, and the report with its location merged in.

    ``problem`` names a coordinate the index would refuse; the id is used up either way.
    """
    fields = [c for c in numbered.columns if c != id_column]
    source = F.struct(
        location(F.col("city_latitude"), F.col("city_longitude")).alias("location"), *fields
    )
    return numbered.select(
        F.lit("index").alias("_op_type"),
        F.lit(index).alias("_index"),
        F.lit(doc_type).alias("_type"),
        F.col(id_column).alias("_id"),
        source.alias("_source"),
        F.coalesce(
            _coordinate_problem("city_latitude", 90), _coordinate_problem("city_longitude", 180)
        ).alias("problem"),
    )


def typed_documents(docs: DataFrame) -> DataFrame:
    """The documents as the index types them; malformed dates are null.

    Fields without a declared type are kept as they are.
    """
    def column(name: str, kind: str) -> Column:
        c = F.col(f"_source.{name}")
        if kind == "date":
            return parse_iso_ts(c).alias(name)
        if kind == "float":
            return c.try_cast("float").alias(name)
        return c.alias(name)

    present = docs.schema["_source"].dataType.names
    declared = [column(n, k) for n, k in DOCUMENT_TYPES.items() if n in present]
    others = [F.col(f"_source.`{n}`").alias(n) for n in present if n not in DOCUMENT_TYPES]
    return docs.select("_id", *declared, *others)

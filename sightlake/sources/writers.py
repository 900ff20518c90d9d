"""Table writers: NDJSON, CSV and bulk-load files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightlake import schemas


def write_ndjson(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line; null fields stay present."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Raw lines as they stand."""
    df.select("value").write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; null and empty are both empty cells, white space is kept."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", schemas.ISO_SECONDS)
        .csv(path)
    )


def write_enhanced_csv(reports: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Enhanced reports: thirteen columns in fixed order, whatever else the table holds."""
    write_csv(reports.select(*schemas.ENHANCED_COLUMNS), path, mode)


def write_bulk_lines(docs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Bulk-load file: per document one action line and one source line."""
    keep_nulls = {"ignoreNullFields": "false"}
    action = F.create_map(
        F.col("_op_type"), F.struct(*[F.col(c) for c in ("_index", "_type", "_id")])
    )
    lines = F.concat_ws("\n", F.to_json(action), F.to_json("_source", keep_nulls))
    write_lines(docs.select(lines.alias("value")), path, mode)

"""Versioned report tables.

Reports lie in buckets by a hash of their link, in folders that never change once written. A
version is the list of folders each of its buckets consists of. A merge writes a folder of its own:
the rows it adds and, of buckets where it replaces reports, those that stay. What a pull does not
touch is shared by the versions before and after it.

A version counts only once its log row is written: a job that dies half way leaves a folder
nobody reads, and the next attempt writes another one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightlake.session import (
    create_file, delete_path, full_path, list_paths, measured_bytes, path_exists,
)

LOG_SCHEMA = "version long, pulls array<string>, parts string, num_rows long, buckets int"
PART_SCHEMA = "bucket int, folder string, num_rows long"
LINE_SCHEMA = "report_link string, value string"
#: A new table has a bucket for each GB of its first pull, and at least so many.
BUCKETS, BUCKET_BYTES = 16, 1 << 30
#: A bucket in more folders than this is written anew by the next merge that adds to it.
MAX_FOLDERS = 8


class Version(NamedTuple):
    version: int
    pulls: list[str]
    parts: str
    num_rows: int
    buckets: int


class Part(NamedTuple):
    bucket: int
    folder: str
    num_rows: int


def _log(spark: SparkSession, root: str) -> DataFrame:
    path = f"{root}/log"
    if not path_exists(spark, path):  # first run: nothing committed yet
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).json(path)


def current_version(spark: SparkSession, root: str) -> Version | None:
    row = _log(spark, root).orderBy(F.desc("version")).limit(1).first()
    return Version(**row.asDict()) if row else None


def version_with(spark: SparkSession, root: str, pull: str) -> Version | None:
    """The version that already holds a pull, if any; makes a repeated pull a no-op."""
    row = _log(spark, root).where(F.array_contains("pulls", pull)).limit(1).first()
    return Version(**row.asDict()) if row else None


def committed_pulls(spark: SparkSession, root: str) -> DataFrame:
    return _log(spark, root).select(F.explode("pulls").alias("pull")).distinct()


def buckets_for(lines: DataFrame) -> int:
    """Number of buckets of a table that begins with these lines."""
    return max(BUCKETS, measured_bytes(lines.select("value")) // BUCKET_BYTES)


def bucket_of(link: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(link), F.lit(buckets)).cast("int")


def parts_of(spark: SparkSession, version: Version) -> list[Part]:
    """What a version consists of: some parts for each bucket, whose folders a scan has to list."""
    rows = spark.read.schema(PART_SCHEMA).json(version.parts).collect()
    return [Part(**r.asDict()) for r in rows]


def read_parts(spark: SparkSession, parts: Iterable[Part]) -> DataFrame:
    """Links and lines of some of a version's parts."""
    paths = [f"{p.folder}/bucket={p.bucket}" for p in parts]
    if not paths:
        return spark.createDataFrame([], LINE_SCHEMA)
    return spark.read.schema(LINE_SCHEMA).parquet(*paths)


def read_version(spark: SparkSession, version: Version) -> DataFrame:
    """All links and lines of a version."""
    return read_parts(spark, parts_of(spark, version))


def write_parts(
    spark: SparkSession, root: str, number: int, kept: Iterable[Part], lines: DataFrame, buckets: int
) -> tuple[str, int]:
    """Write lines to a folder of their own, and list them with the parts kept from the version before.

    Returns where the list is, and the number of rows of all parts. A bucket larger than a task should
    write is split, small ones are written together.
    """
    name = f"v{number:08d}-{uuid.uuid4().hex}"
    folder, listed = full_path(spark, f"{root}/data/{name}"), f"{root}/parts/{name}.json"
    held = lines.select("report_link", "value", bucket_of(F.col("report_link"), buckets).alias("bucket"))
    held.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(folder)
    counts = spark.read.schema(f"{LINE_SCHEMA}, bucket int").parquet(folder).groupBy("bucket").count()
    parts = [*kept, *(Part(bucket, folder, n) for bucket, n in counts.collect())]
    create_file(spark, listed, "".join(json.dumps(p._asdict()) + "\n" for p in parts))
    return listed, sum(p.num_rows for p in parts)


def commit_version(spark: SparkSession, root: str, version: Version) -> Version:
    """Make written parts the current version.

    Its number is a file that only one merge can create; of two at once the later one fails here,
    and nothing reads its folder.
    """
    create_file(
        spark, f"{root}/log/{version.version:08d}.json", json.dumps(version._asdict()) + "\n")
    return version


def expire_versions(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Delete all folders that none of the last ``keep`` versions reads; returns how many.

    Log rows stay, so a pull merged long ago is still known. A merge at work writes under the next
    number and loses nothing. What is listed is a folder for each bucket of each version still there.
    """
    current = current_version(spark, root)
    if current is None:
        return 0
    last = [Version(**r.asDict()) for r in
            _log(spark, root).orderBy(F.desc("version")).limit(max(1, keep)).collect()]
    used = {f"{p.folder}/bucket={p.bucket}" for v in last for p in parts_of(spark, v)}
    lists = {full_path(spark, v.parts) for v in last}
    found = list_paths(spark, f"{root}/data/v*/bucket=*") + list_paths(spark, f"{root}/parts/v*")
    old = [f for f in found if f not in used and f not in lists and _number(f) <= current.version]
    for path in old:
        delete_path(spark, path)
    return len(old)


def _number(folder: str) -> int:
    name = next(n for n in reversed(folder.split("/")) if not n.startswith("bucket="))
    return int(name[1:9])

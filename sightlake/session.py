"""Shared folder, staged tables and size checks."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT = 64 * 1024 * 1024
#: What a broadcast row takes beside its values: its key once more, lengths and its place in a table.
BROADCAST_ROW = 80


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: spark.checkpoint.dir, or the context's checkpoint folder.

    A local session without either gets one beside its warehouse; a cluster must name one.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    spark.sparkContext.setCheckpointDir(f"{warehouse.rstrip('/')}/_checkpoints")
    return spark.sparkContext.getCheckpointDir()


def staging_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, under the application's own name."""
    application = spark.sparkContext.applicationId
    return f"{shared_dir(spark).rstrip('/')}/sightlake/{application}/{name}-{uuid.uuid4().hex}"


_temporary: ContextVar[list[str] | None] = ContextVar("temporary", default=None)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Whatever is staged inside the block goes when it ends, with a result or an error.

    For jobs, which write what they return; a table that is still to be read must stay.
    """
    paths: list[str] = []
    token = _temporary.set(paths)
    try:
        yield
    finally:
        _temporary.reset(token)
        for path in paths:
            delete_path(spark, path)


def stage(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write df once as Parquet in the shared folder and go on from the written table.

    A column of few values may split it into folders, so that who wants one reads no other.

    Used where a costly result (parsed pages, an aggregate whose size is checked) is
    read more than once: lineage ends at the files, so a lost executor costs a re-read
    only. See ``temporary`` for how it goes again.
    """
    path = staging_path(df.sparkSession, name)
    if (held := _temporary.get()) is not None:
        held.append(path)
    df.write.parquet(path, partitionBy=by)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(conf), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    files, hadoop_path = _file_system(spark, path)
    return files.exists(hadoop_path)


def full_path(spark: SparkSession, path: str) -> str:
    """A path as a URI, the way file names of a scan begin."""
    files, hadoop_path = _file_system(spark, path)
    return re.sub("^file:/+", "file:/", files.makeQualified(hadoop_path).toUri().toString()).rstrip("/")


def path_of_uri(spark: SparkSession, uri: str) -> str:
    """The path a reader takes for a file's URI, as scans name it."""
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)).toString()


def create_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not exist yet; fails if it does."""
    files, hadoop_path = _file_system(spark, path)
    out = files.create(hadoop_path, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Full paths of the files and folders that a pattern with ``*`` names."""
    files, hadoop_path = _file_system(spark, pattern)
    found = [str(f.getPath().toUri()) for f in files.globStatus(hadoop_path) or ()]
    return [full_path(spark, f) for f in found]


def delete_path(spark: SparkSession, path: str) -> None:
    files, hadoop_path = _file_system(spark, path)
    files.delete(hadoop_path, True)


def drop_staged(spark: SparkSession, *tables: DataFrame) -> None:
    """Remove the files behind staged tables once nothing reads them any more."""
    for folder in {re.sub(r"(/[^/=]+=[^/]*)?/[^/]*$", "", f) for t in tables for f in t.inputFiles()}:
        delete_path(spark, folder)


def drop_all_staged(spark: SparkSession) -> None:
    """Remove whatever this application has staged, once its results have been taken."""
    delete_path(
        spark, f"{shared_dir(spark).rstrip('/')}/sightlake/{spark.sparkContext.applicationId}")


def spread(scan: DataFrame, tasks_per_core: int = 3) -> DataFrame:
    """A scan with several partitions per core, for work that is heavy per row.

    A table of few small files would keep most cores idle while pages are parsed, and pages
    of one kind tend to lie in the same files. A table that fills the cluster has far more
    partitions than that; it comes back as it is and is not moved.
    """
    wanted = scan.sparkSession.sparkContext.defaultParallelism * tasks_per_core
    return scan.repartition(wanted) if scan.rdd.getNumPartitions() < wanted else scan


def measured_bytes(df: DataFrame, beside: int = 0) -> int:
    """Upper estimate of the table's in-memory size, from one aggregate over it.

    So many bytes are added for each row.
    """
    def width(field: T.StructField):
        if isinstance(field.dataType, (T.NumericType, T.BooleanType, T.DatetimeType)):
            return F.lit(16)
        text = F.col(f"`{field.name}`").cast("string")
        return F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(24)

    row_width = reduce(lambda a, b: a + b, [F.lit(beside), *(width(f) for f in df.schema.fields)])
    return df.agg(F.sum(row_width.cast("long")).alias("bytes")).first()["bytes"] or 0


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> tuple[DataFrame, bool]:
    """df with a broadcast hint when its measured size allows it, else df as it is."""
    if limit > 0 and measured_bytes(df, BROADCAST_ROW) <= limit:
        return F.broadcast(df), True
    return df, False

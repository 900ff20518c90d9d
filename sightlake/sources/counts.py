"""What the jobs counted, as a table: one small file for each run of a job."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from sightlake.session import create_file, path_exists

COUNT_SCHEMA = "job string, target string, name string, num long"


def record_counts(
    spark: SparkSession, path: str | None, job: str, target: str, counts: Mapping[str, int]
) -> None:
    """Add a run's counts to the table at a path, if there is one to keep them in."""
    if path is None:
        return
    lines = [json.dumps({"job": job, "target": target, "name": n, "num": c}) for n, c in counts.items()]
    create_file(spark, f"{path}/{job}-{uuid.uuid4().hex}.json", "\n".join(lines) + "\n")


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], COUNT_SCHEMA)
    return spark.read.schema(COUNT_SCHEMA).json(path)

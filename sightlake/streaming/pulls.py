"""Pulls merged as they land, with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sightlake import session
from sightlake.plans import jobs
from sightlake.sources import versions
from sightlake.sources.readers import with_report_link


def merge_landed_pulls(
    spark: SparkSession, landing_path: str, root: str, checkpoint_path: str, name: str = "pulls"
) -> StreamingQuery:
    """Merge all pulls of NDJSON that landed since the last run into the versioned table.

    A pull is a file in the landing folder, or a folder there with all its files, which must
    land at once. Pulls that landed together are merged at once, as if one after the other, by name.
    A pull's path goes into the version log with the merge, so what Spark hands over again, after a
    failure or under a new checkpoint, is recognised and not merged twice.
    """
    landing = session.full_path(spark, landing_path)
    prefix_end = len(landing) + 2

    def merge(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        inside = F.substring_index(F.substring(F.col("file"), prefix_end, 1 << 30), "/", 1)
        lines = batch.withColumn("pull", F.concat(F.lit(f"{landing}/"), inside))
        # One row per pull: no more than the files the driver has just listed.
        landed = lines.select("pull").distinct().join(
            versions.committed_pulls(own, root), "pull", "left_anti")
        names = [row.pull for row in landed.orderBy("pull").collect()]
        if not names:
            return
        turns = own.createDataFrame(list(enumerate(names)), "turn int, pull string")
        lines = lines.join(F.broadcast(turns), "pull")
        jobs.merge_pulls(own, with_report_link(lines, "turn"), root, names)

    return (
        spark.readStream.option("recursiveFileLookup", True).text(landing_path)
        .select("value", F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("file"))
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint_path)
        .queryName(name)
        .trigger(availableNow=True)
        .start()
    )

"""Stored pages, found by their URLs and read late.

Which pages are wanted is settled on URLs and the places of rows in their files; HTML is read only
where a wanted row lies. Wanted rows are marked in bitmaps, a bit for each row of a file, and a scan
looks its rows up there, some files at a time: HTML is neither shuffled nor joined against a large
table, and files without a wanted page are not opened again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sightlake import session
from sightlake.functions.urls import link_key
from sightlake.operators.joins import lookup_join
from sightlake.sources import readers

#: Bytes of bitmaps that are broadcast at once, and of one beside its bits and its file's name.
MARKED, MARK = 16 << 20, 64
#: So many pages per task or fewer are moved to give all cores some.
MOVED = 1_000


def page_places(spark: SparkSession, path: str) -> DataFrame:
    """(url, page_key, file, row) of every stored page; no HTML is read."""
    scan = spark.read.parquet(path)
    return scan.select(
        "url", link_key(F.col("url")).alias("page_key"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def linked_places(places: DataFrame, keys: DataFrame, **join_options) -> DataFrame:
    """The places of pages that links lead to, by path and query."""
    return lookup_join(places, keys.select("page_key").distinct(), ["page_key"], "left_semi", **join_options)


def _bit(row: Column) -> tuple[Column, Column]:
    """Which bitmap of its file a row's bit is in, and where."""
    return F.bitmap_bucket_number(row + 1), F.bitmap_bit_position(row + 1)


def row_marks(places: DataFrame) -> DataFrame:
    """(file, bucket, marks, n): bitmaps of the rows at some places, up to the last one's bit."""
    bucket, bit = _bit(F.col("row"))
    held = places.select("file", bucket.alias("bucket"), bit.alias("bit"))
    return held.groupBy("file", "bucket").agg(
        F.bitmap_construct_agg("bit").alias("marks"), F.max("bit").alias("last"),
        F.count(F.lit(1)).alias("n"),
    ).selectExpr("file", "bucket", "substring(marks, 1, cast(last DIV 8 AS int) + 1) AS marks", "n")


def _marked(marks: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(marks, (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (bit % 8).cast("int")) == 1


def read_places(
    spark: SparkSession, path: str, places: DataFrame, at_once: int = MARKED
) -> DataFrame:
    """(url, page_key, html, file, row) of the pages at some places, which must be staged.

    Files are taken in groups of so many bytes of bitmaps that a group's can be broadcast; a group's
    scan opens its files only. One row for each file comes to the driver, which lists the files
    anyway; of places it holds bits, however many are wanted. Few pages are spread over the cores
    that will parse them, many stay where they lie.
    """
    marks = session.stage(row_marks(places), "marks")
    counted = marks.groupBy("file").agg(
        F.sum("n").alias("n"),
        F.sum(F.length("marks") + F.octet_length("file") + F.lit(MARK)).alias("size"),
    ).orderBy("file").collect()
    groups: list[list[str]] = []
    held = at_once
    for row in counted:
        if held + row["size"] > at_once:
            groups.append([])
            held = 0
        groups[-1].append(row["file"])
        held += row["size"]
    if not groups:
        return readers.read_pages(spark, path).limit(0).select(
            "url", link_key(F.col("url")).alias("page_key"), "html",
            F.lit("").alias("file"), F.lit(0).cast("long").alias("row"))
    parts = []
    for files in groups:
        wanted = marks.where(F.col("file").between(files[0], files[-1])).select("file", "bucket", "marks")
        scan = spark.read.schema("url string, html string").parquet(*[session.path_of_uri(spark, f) for f in files])
        row = F.col("_metadata.row_index")
        bucket, bit = _bit(row)
        found = scan.select(
            "url", link_key(F.col("url")).alias("page_key"), "html",
            F.col("_metadata.file_path").alias("file"), row.alias("row"),
            bucket.alias("bucket"), bit.alias("bit"))
        parts.append(found.join(F.broadcast(wanted), ["file", "bucket"]).where(
            _marked(F.col("marks"), F.col("bit"))).select("url", "page_key", "html", "file", "row"))
    pages = reduce(DataFrame.unionByName, parts)
    tasks = 3 * spark.sparkContext.defaultParallelism
    return pages.repartition(tasks) if sum(r["n"] for r in counted) <= MOVED * tasks else pages


def one_copy(spark: SparkSession, path: str, places: DataFrame, holds: Column) -> DataFrame:
    """One place for each page that has several copies, which must be staged; staged, too.

    A copy for which ``holds`` (an expression over html) is true comes before others, then the
    least URL, then the first in the order of files. Of pages with copies, HTML is looked at where
    it lies and not moved; all that is compared is URLs and places.
    """
    rank = F.struct((~F.coalesce(F.col("holds"), F.lit(False))).alias("blank"), "url", "file", "row")
    one = F.min(F.struct("url", "file", "row")).alias("p")
    first = session.stage(places.groupBy("page_key").agg(F.count(F.lit(1)).alias("copies"), one), "copies")
    single = first.where("copies = 1").select("p.url", "page_key", "p.file", "p.row")
    several = session.stage(
        linked_places(places, first.where("copies > 1")), "several")
    looked = read_places(spark, path, several).select(
        "page_key", "url", "file", "row", holds.alias("holds"))
    chosen = looked.groupBy("page_key").agg(F.min(rank).alias("p")).select(
        "p.url", "page_key", "p.file", "p.row")
    return session.stage(single.unionByName(chosen), "chosen")

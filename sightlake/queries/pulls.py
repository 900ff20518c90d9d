"""Merging pulls: orders as the new pull, line items as the reports already held."""

from pyspark.sql import functions as F

from sightlake import schemas, session
from sightlake.operators.merge import merge_reports
from sightlake.plans import jobs
from sightlake.queries import Query, cleaning, table
from sightlake.sources import readers, versions, writers
from sightlake.streaming.pulls import merge_landed_pulls

# Links repeat on both sides; some are null.
NEW = (
    "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE concat('/r/', o_custkey) END AS report_link",
    "concat('new ', o_orderkey) AS text",
)
OLD = (
    "CASE WHEN l_linenumber = 7 THEN NULL ELSE concat('/r/', l_partkey) END AS report_link",
    "concat('old ', l_orderkey) AS text", "l_returnflag AS shape",
)


def new_pull(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(*NEW)


def held(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").selectExpr(*OLD)


def merge(spark, sf_dir):
    return merge_reports(new_pull(spark, sf_dir), held(spark, sf_dir))


def merge_hot_links(spark, sf_dir):
    """The same without a broadcast, with every link that repeats spread over several tasks."""
    return merge_reports(
        new_pull(spark, sf_dir), held(spark, sf_dir), broadcast_limit=0, hot_rows=30, salts=8)


def merge_dedupe(spark, sf_dir):
    return merge_reports(new_pull(spark, sf_dir), held(spark, sf_dir), dedupe_orig=True)


def _lines(df):
    line = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.select(line.alias("value"), "report_link")


def versioned_merge(spark, sf_dir):
    """Two pulls merged one after the other into a versioned table of raw lines."""
    root = session.staging_path(spark, "versions")
    jobs.merge_pull(spark, _lines(held(spark, sf_dir)), root, "first")
    jobs.merge_pull(spark, _lines(new_pull(spark, sf_dir)), root, "second")
    return jobs.held_reports(spark, root).select("report_link", "text", "shape")


# Three pulls whose links overlap: line items first, then orders by their priority.
_LATER = "CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW') THEN 2 ELSE 1 END"


def _landed(spark, sf_dir, *pulls):
    """A landing folder with a folder of raw lines for each of some pulls, and where it is."""
    landing = session.staging_path(spark, "landing")
    for pull in pulls:
        _land(spark, sf_dir, landing, pull)
    return landing


def _land(spark, sf_dir, landing, pull):
    rows = held(spark, sf_dir) if pull == 0 else table(spark, sf_dir, "orders").where(
        f"{_LATER} = {pull}").selectExpr(*NEW)
    writers.write_lines(_lines(rows), f"{landing}/pull-{pull}")


def _merged_landing(spark, landing, root):
    checkpoint = session.staging_path(spark, "checkpoint")
    query = merge_landed_pulls(spark, landing, root, checkpoint, name=checkpoint.rsplit("/", 1)[1])
    query.awaitTermination()
    return jobs.held_reports(spark, root).select("report_link", "text", "shape")


def pulls_together(spark, sf_dir):
    """Three pulls that land at once, merged by the stream in one pass."""
    root = session.staging_path(spark, "versions")
    return _merged_landing(spark, _landed(spark, sf_dir, 0, 1, 2), root)


def pulls_apart(spark, sf_dir):
    """The same pulls, each merged by the stream before the next one lands; the first version expires."""
    root, landing = session.staging_path(spark, "versions"), _landed(spark, sf_dir, 0)
    for pull in (1, 2):
        _merged_landing(spark, landing, root)
        _land(spark, sf_dir, landing, pull)
    merged = _merged_landing(spark, landing, root)
    versions.expire_versions(spark, root)
    return merged


def ndjson_round_trip(spark, sf_dir):
    path = session.staging_path(spark, "ndjson")
    writers.write_ndjson(cleaning.raw_reports(spark, sf_dir), path)
    return readers.read_raw_reports(spark, path).select(*schemas.RAW_REPORT.names)


_BOTH = (
    f"WITH n AS (SELECT {', '.join(NEW)} FROM orders), o AS (SELECT {', '.join(OLD)} FROM lineitem), "
    "kept AS (SELECT * FROM o WHERE NOT EXISTS "
    "(SELECT 1 FROM n WHERE n.report_link IS NOT DISTINCT FROM o.report_link))"
)
_MERGED = f"{_BOTH} SELECT report_link, text, CAST(NULL AS VARCHAR) AS shape FROM n UNION ALL SELECT * FROM kept"

_LAST = (
    f"WITH p AS (SELECT {', '.join(OLD)}, 0 AS turn FROM lineitem UNION ALL "
    f"SELECT {', '.join(NEW)}, NULL, {_LATER} FROM orders) "
    "SELECT report_link, text, shape FROM p "
    "QUALIFY turn = max(turn) OVER (PARTITION BY report_link)")

QUERIES = {
    "pulls_together": Query(pulls_together, _LAST),
    "pulls_apart": Query(pulls_apart, _LAST),
    "merge_reports": Query(merge, _MERGED),
    "merge_hot_links": Query(merge_hot_links, _MERGED),
    "merge_reports_dedupe": Query(
        merge_dedupe,
        f"{_BOTH} SELECT report_link, text, CAST(NULL AS VARCHAR) AS shape FROM n UNION ALL "
        "SELECT report_link, text, shape FROM kept "
        "QUALIFY row_number() OVER (PARTITION BY report_link ORDER BY text, shape) = 1"),
    "versioned_merge": Query(versioned_merge, _MERGED),
    "ndjson_round_trip": Query(
        ndjson_round_trip,
        "SELECT concat('text ', o_orderkey) AS text, CAST(NULL AS VARCHAR) AS duration, "
        "CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE concat('a:', o_orderstatus) END AS stats, "
        f"{cleaning.DIRTY_DATE_TIME} AS date_time, concat('/r/', o_orderkey) AS report_link, "
        + cleaning.case_of(f"o_orderkey % {len(cleaning.CITIES)}", [c[0] for c in cleaning.CITIES])
        + " AS city, "
        + cleaning.case_of(f"o_orderkey % {len(cleaning.CITIES)}", [c[1] for c in cleaning.CITIES])
        + " AS state, 'USA' AS country, "
        + cleaning.case_of(f"o_orderkey % {len(cleaning.SHAPES)}", [s[0] for s in cleaning.SHAPES])
        + f" AS shape, o_orderpriority AS summary, {cleaning.DIRTY_POSTED} AS posted FROM orders"),
}

"""The jobs: tables in, tables out. Paths and bounds are arguments."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence
from datetime import date, datetime
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sightlake import schemas, session
from sightlake.functions.text import blank_to_null
from sightlake.functions.urls import host_allowed, link_key
from sightlake.operators import clean, extract, gazetteer, merge, pages, publish, qa, sites
from sightlake.operators.joins import lookup_join
from sightlake.sources import readers, versions, writers
from sightlake.sources.counts import record_counts


def _counted(df: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    """df, and its number of rows and other counts once it has been written."""
    seen = Observation()
    counts = counts or {"rows": F.count(F.lit(1))}
    return df.observe(seen, *[c.alias(n) for n, c in counts.items()]), seen


def _totals(seen: Observation, *names: str) -> dict[str, int]:
    try:
        return {n: seen.get[n] for n in names}
    except Py4JJavaError:  # nothing is observed in a plan known to be empty before it runs
        return dict.fromkeys(names, 0)


def pull_reports(
    spark: SparkSession,
    pages_path: str,
    site: extract.Site,
    index_url: str,
    out_path: str,
    start: str | None = None,
    stop: str | None = None,
    quarantine_path: str | None = None,
    broadcast_limit: int = session.BROADCAST_LIMIT,
    counts_path: str | None = None,
) -> dict[str, int]:
    """Stored pages to raw report lines: index, listing and report pages in turn.

    Only listing pages the index links to within the date bounds, and the report pages those
    link to, are parsed, one copy of each report page. What is wanted is settled on URLs; HTML is
    read where a wanted page lies, and each page is parsed once. Listing rows whose page is not
    stored are set aside with those that cannot be read.
    """
    # A page of another host is not one that a link of the site leads to.
    stored = pages.page_places(spark, pages_path).where(
        host_allowed(F.col("url"), site.hosts) | (F.col("url") == index_url))
    options = {"broadcast_limit": broadcast_limit}
    with session.temporary(spark):
        index = pages.read_places(spark, pages_path, session.stage(
            stored.where(F.col("url") == index_url), "index_places"))
        dated = session.stage(extract.dated_links(extract.index_rows(index), site.page_base), "links")
        wanted = extract.in_date_range(extract.usable(dated), start, stop).where(
            host_allowed(F.col("link_url"), site.hosts)
        ).select(link_key(F.col("link_url")).alias("page_key"))
        listing_pages = pages.read_places(spark, pages_path, session.stage(
            pages.linked_places(stored, wanted, **options), "listing_places"))
        rows = session.stage(extract.listing_rows(listing_pages, site), "listing")

        listing = extract.usable(rows).where(host_allowed(F.col("link_url"), site.hosts))
        linked = listing.select(link_key(F.col("link_url")).alias("page_key"))
        copies = session.stage(pages.linked_places(stored, linked, **options), "report_places")
        chosen = pages.one_copy(spark, pages_path, copies, extract.holds_report(F.col("html")))
        paged = session.stage(extract.with_pages(listing, chosen, **options), "paged")

        detail = extract.report_detail(pages.read_places(spark, pages_path, chosen), "page_key")
        reports = extract.assemble_reports(extract.usable(paged), detail)
        reports, seen = _counted(reports)
        writers.write_ndjson(reports, out_path)
        counts = {"reports": _totals(seen, "rows")["rows"]}
        if quarantine_path is not None:
            bad = reduce(DataFrame.unionByName, [
                extract.quarantined(t).select("url", "link_url", "problem") for t in (dated, rows, paged)])
            bad, seen = _counted(bad)
            bad.write.mode("overwrite").json(quarantine_path)
            counts["quarantined"] = _totals(seen, "rows")["rows"]
    record_counts(spark, counts_path, "pull", out_path, counts)
    return counts


def merge_pulls(
    spark: SparkSession,
    new_lines: DataFrame,
    root: str,
    pulls: Sequence[str],
    dedupe_orig: bool = False,
    buckets: int | None = None,
) -> versions.Version:
    """Merge pulls (``value``, ``report_link``, ``turn``) into the versioned raw table at root.

    The result is that of merging them one after the other, by turn; ``pulls`` names them for the
    log. One aggregate finds the last pull that has a link. Of the held table, the links in the
    pulls' buckets are read, and of buckets where one of them is replaced the whole rows; only these
    buckets are written again. ``buckets`` holds for a new table, else its first pull's size
    decides. Versions hold raw lines with their links in Parquet, so a merge parses the new lines
    only. Of two merges at once one fails. What was held, added and came out is counted beside the
    log.
    """
    held = versions.current_version(spark, root)
    if held is not None:
        buckets = held.buckets
    elif buckets is None:
        buckets = versions.buckets_for(new_lines)
    lines = new_lines.select("report_link", "value", "turn")
    number, parts, orig = 1, [], None
    with session.temporary(spark):
        links = session.stage(merge.last_pulls(lines), "links")
        latest = merge.of_last_pull(lines, links) if len(pulls) > 1 else lines
        if held is not None:
            number, parts = held.version + 1, versions.parts_of(spark, held)
            again = _replaced(spark, held, parts, links, dedupe_orig)
            orig = merge.surviving_reports(
                None, versions.read_parts(spark, (p for p in parts if p.bucket in again)),
                links=links.select("report_link"))
            parts = [p for p in parts if p.bucket not in again]
        if dedupe_orig and len(pulls) > 1:  # to the last pull, those before it are held reports
            earlier = latest.where(F.col("turn") < len(pulls) - 1).select("report_link", "value")
            latest = latest.where(F.col("turn") == len(pulls) - 1)
            orig = earlier if orig is None else orig.unionByName(earlier)
        merged, added = _counted(latest.select("report_link", "value"))
        if orig is not None:
            merged = merged.unionByName(merge.one_per_key(orig) if dedupe_orig else orig)
        listed, rows = versions.write_parts(spark, root, number, parts, merged, buckets)
        counts = {"held": held.num_rows if held else 0, "added": _totals(added, "rows")["rows"],
                  "rows": rows}
    version = versions.commit_version(
        spark, root, versions.Version(number, list(pulls), listed, rows, buckets))
    record_counts(spark, f"{root}/counts", "merge", listed, counts)
    return version


def _replaced(
    spark: SparkSession, held: versions.Version, parts: list[versions.Part], links: DataFrame, whole: bool
) -> set[int]:
    """Buckets of the held version that are written again."""
    if whole:
        return {p.bucket for p in parts}
    bucket = versions.bucket_of(F.col("report_link"), held.buckets)
    touched = {r["b"] for r in links.select(bucket.alias("b")).distinct().collect()}
    folders = Counter(p.bucket for p in parts)
    # Links alone tell where something is replaced.
    met = lookup_join(
        versions.read_parts(spark, (p for p in parts if p.bucket in touched)).select("report_link"),
        links.select("report_link"), ["report_link"], "left_semi", null_safe=True)
    again = {r["b"] for r in met.select(bucket.alias("b")).distinct().collect()}
    return again | {b for b in touched if folders[b] >= versions.MAX_FOLDERS}


def merge_pull(
    spark: SparkSession, new_lines: DataFrame, root: str, pull: str | None = None, **options
) -> versions.Version:
    """Merge one pull (``value``, ``report_link``); one already committed under its name is not
    merged again. The version before stays readable until it is expired."""
    done = versions.version_with(spark, root, pull) if pull is not None else None
    if done is not None:
        return done
    pulls = [] if pull is None else [pull]
    return merge_pulls(spark, new_lines.withColumn("turn", F.lit(0)), root, pulls, **options)


def merge_pull_file(
    spark: SparkSession, new_path: str, root: str, pull: str | None = None, **options
) -> versions.Version:
    return merge_pull(spark, readers.read_report_lines(spark, new_path), root, pull, **options)


def export_reports(spark: SparkSession, root: str, out_path: str) -> None:
    """The current version as NDJSON, every line as it was pulled."""
    writers.write_lines(
        versions.read_version(spark, versions.current_version(spark, root)), out_path)


def held_reports(spark: SparkSession, root: str) -> DataFrame:
    """The current version under the raw report schema."""
    return readers.parse_lines(versions.read_version(spark, versions.current_version(spark, root)))


def make_gazetteer(
    spark: SparkSession,
    locations_path: str,
    blocks_path: str,
    out_path: str,
    na_tokens: Iterable[str] = readers.NA_TOKENS,
) -> None:
    """Location and address block tables to the city gazetteer."""
    na_tokens = list(na_tokens)
    cities = gazetteer.build_gazetteer(
        readers.read_blocks(spark, blocks_path, na_tokens),
        readers.read_locations(spark, locations_path, na_tokens),
    )
    writers.write_csv(cities.orderBy(*gazetteer.KEYS), out_path)


def enhance_reports(
    spark: SparkSession,
    raw: DataFrame,
    cities_path: str,
    csv_path: str | None,
    parquet_path: str,
    as_of: datetime | str | Column | None = None,
    future: str = "null",
    couple_dates: bool = True,
    counts_path: str | None = None,
) -> int:
    """Raw reports, from a file or held, to enhanced reports: Parquet and CSV.

    Parquet is for the other jobs, the CSV, written from it, for hand-over.
    """
    best = gazetteer.best_city(readers.read_cities(spark, cities_path))
    reports = clean.standardize(raw, as_of, future, couple_dates)
    enhanced = gazetteer.geocode(reports, best)
    strings = [c for c, t in enhanced.dtypes if t == "string"]
    enhanced = enhanced.withColumns({c: blank_to_null(F.col(c)) for c in strings}).select(
        *schemas.ENHANCED_COLUMNS
    )
    coded = F.col("city_latitude").isNotNull() & F.col("city_longitude").isNotNull()
    enhanced, seen = _counted(enhanced, rows=F.count(F.lit(1)), geocoded=F.count_if(coded))
    enhanced.write.mode("overwrite").parquet(parquet_path)
    if csv_path is not None:
        writers.write_enhanced_csv(spark.read.parquet(parquet_path), csv_path)
    counts = _totals(seen, "rows", "geocoded")
    record_counts(spark, counts_path, "enhance", parquet_path, counts)
    return counts["rows"]


def audit_geocodes(reports: DataFrame, out_path: str) -> int:
    """Ranked (city, state) pairs without coordinates, and their total."""
    with session.temporary(reports.sparkSession):
        audit = session.stage(gazetteer.missing_geocodes(reports), "audit")
        writers.write_csv(gazetteer.ranked(audit).select("city", "state", "count"), out_path)
        return gazetteer.total_missing(audit).first()["total"]


def index_documents(
    spark: SparkSession,
    reports_path: str,
    index: str,
    doc_type: str,
    out_path: str,
    rejected_path: str,
    bulk_path: str | None = None,
    from_csv: bool = False,
    counts_path: str | None = None,
) -> dict[str, int]:
    """Enhanced reports to index actions, a load file that replaces the one before.

    Parquet reports are numbered where they lie; a CSV is written as Parquet first, with the
    place each row had in its files. Rows the index would refuse are set aside. Documents are made
    once, written by verdict, and all files come from there.
    """
    with session.temporary(spark):
        if from_csv:
            numbered = publish.number_placed(session.stage(
                publish.with_places(readers.read_string_csv(spark, reports_path)), "documents"))
        else:
            numbered = publish.number_rows(spark.read.parquet(reports_path))
        docs = publish.to_index_docs(publish.as_text(numbered, keep=["_id"]), index, doc_type)
        docs = docs.withColumn("refused", F.col("problem").isNotNull())
        docs, seen = _counted(
            docs, indexed=F.count_if(~F.col("refused")), refused=F.count_if(F.col("refused")))
        judged = session.stage(docs, "verdicts", by="refused")
        good = judged.where(~F.col("refused")).drop("refused", "problem")
        writers.write_ndjson(good, out_path)
        writers.write_ndjson(judged.where("refused").drop("refused"), rejected_path)
        if bulk_path is not None:
            writers.write_bulk_lines(good, bulk_path)
    counts = _totals(seen, "indexed", "refused")
    record_counts(spark, counts_path, "index", out_path, counts)
    return counts


def report_quality(
    spark: SparkSession,
    reports_path: str,
    out_path: str,
    days: int = 100,
    as_of: date | str | Column | None = None,
) -> dict[str, DataFrame]:
    """All quality queries over the Parquet reports, each written under its name."""
    reports = readers.register_reports(spark.read.parquet(reports_path))
    results = {}
    with session.temporary(spark):
        for name, result in qa.qa_report(reports, days, as_of).items():
            result.write.mode("overwrite").parquet(f"{out_path}/{name}")
            results[name] = spark.read.parquet(f"{out_path}/{name}")
    return results


def make_sites(
    spark: SparkSession,
    kml_path: str,
    out_path: str,
    radius_km: int = 100,
    quarantine_path: str | None = None,
) -> None:
    """KML placemarks to sites with buffer polygons."""
    parsed = sites.parse_placemarks(readers.read_placemarks(spark, kml_path))
    writers.write_csv(sites.with_buffer(extract.usable(parsed), radius_km), out_path)
    if quarantine_path is not None:
        writers.write_ndjson(extract.quarantined(parsed), quarantine_path)

"""Date, city, state and shape clean-up over orders and customers."""

from pyspark.sql import functions as F

from sightlake.functions import places
from sightlake.operators.clean import clean_dates, clean_places, standardize
from sightlake.queries import Query, case_of, table
from sightlake.session import spread

AS_OF = "2001-01-01"


def _short(day: str) -> str:
    return f"concat(month({day}), '/', day({day}), '/', lpad(cast(year({day}) % 100 AS string), 2, '0'))"


DAY = "o_orderdate"
TIME = "concat(o_orderkey % 24, ':', lpad(cast(o_orderkey % 60 AS string), 2, '0'))"
PADDED = (
    f"concat(lpad(cast(month({DAY}) AS string), 2, '0'), '/', lpad(cast(day({DAY}) AS string), 2, '0'), "
    f"'/', lpad(cast(year({DAY}) % 100 AS string), 2, '0'))"
)
# Good long and short dates, four-digit years, the year 65, null, words, hour 24, two blanks.
DIRTY_DATE_TIME = (
    f"CASE o_orderkey % 8 WHEN 0 THEN concat({_short(DAY)}, ' ', {TIME}) WHEN 1 THEN {PADDED} "
    f"WHEN 2 THEN concat(month({DAY}), '/', day({DAY}), '/', year({DAY})) "
    f"WHEN 3 THEN concat(month({DAY}), '/28/65 ', {TIME}) WHEN 4 THEN NULL WHEN 5 THEN 'unknown' "
    f"WHEN 6 THEN concat({_short(DAY)}, ' 24:00') ELSE concat({_short(DAY)}, '  ', {TIME}) END"
)
DIRTY_POSTED = f"CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE {_short(DAY + ' + INTERVAL 30 DAY')} END"

PARSED_SQL = f"""
    SELECT *, try_strptime(dirty_posted, ['%m/%d/%y %H:%M', '%m/%d/%y']) AS p,
           try_strptime(dirty_date_time, ['%m/%d/%y %H:%M', '%m/%d/%y']) AS d
    FROM (SELECT *, {DIRTY_POSTED} AS dirty_posted, {DIRTY_DATE_TIME} AS dirty_date_time FROM orders)
"""

# Dirty city, raw state, cleaned city.
CITIES = [
    ("St. Louis", "mo", "St Louis"), ("St. Louis", "IL", "Saint Louis"),
    ("st.  Louis", "MO", "Saint  Louis"), ("St.", "TX", "Saint"), ("St.Louis", "MO", "St.Louis"),
    ("St Louis", "MO", "St Louis"), ("Ft. Worth (north)", "TX", "Fort Worth"),
    ("MT. Vernon/Skagit", "WA", "Mount Vernon"), ("A (b) c (d) e", "TX", "A  e"),
    ("A (b\nc)", "TX", "A (b\nc)"), ("Open (paren", "TX", "Open (paren"), ("(unknown)", "TX", ""),
    ("\xa0Waco\t", "TX", "Waco"), ("St.\t Paul", "MN", "Saint Paul"),
    ("New York City", "ny", "New York"), ("Washington, D.C.", "DC", "Washington"),
    ("St. Petersburg", "FL", "St. Petersburg"), ("Port St. Lucie", "FL", "Port Saint Lucie"),
    ("St. Peters", "MO", "City of Saint Peters"), ("St. Louis (x)", None, "St. Louis (x)"),
    ("St. Louis (x)", "", "St. Louis (x)"), (None, "TX", None), ("WACO (east)/west", "tx", "WACO"),
]
STATES = [("nf", "NL"), ("PQ", "QC"), ("sa", "SK"), ("YK", "YT"), (" tx", " TX"), ("ny", "NY"),
          ("", ""), (None, None)]
# Dirty shape, cleaned shape, cleaned with "changed" merged as well.
SHAPES = [("Triangular", "triangle", "triangle"), ("CHANGED", "changed", "changing"),
          ("Circular", "circular", "circular"), ("Light", "light", "light"), ("", "", ""),
          (None, None, None)]


def picked(index: str, values):
    """The value a row number picks from a list, as a column."""
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]), F.expr(index).cast("int"))


def dirty_orders(spark, sf_dir):
    return spread(table(spark, sf_dir, "orders")).select(
        "o_orderkey", F.expr(DIRTY_POSTED).alias("posted"), F.expr(DIRTY_DATE_TIME).alias("date_time"))


def _dates(spark, sf_dir, **options):
    return clean_dates(dirty_orders(spark, sf_dir), AS_OF, **options)


def clean_ts(spark, sf_dir):
    return _dates(spark, sf_dir)


def clean_ts_uncoupled(spark, sf_dir):
    return _dates(spark, sf_dir, couple_dates=False)


def clean_ts_century(spark, sf_dir):
    return _dates(spark, sf_dir, future="minus_100y")


def clean_city(spark, sf_dir):
    index = f"c_custkey % {len(CITIES)}"
    rows = spread(table(spark, sf_dir, "customer")).select(
        "c_custkey", F.lit(None).cast("string").alias("shape"),
        picked(index, [c[0] for c in CITIES]).alias("city"),
        picked(index, [c[1] for c in CITIES]).alias("state"))
    return clean_places(rows).select("c_custkey", "state", "city")


def clean_state(spark, sf_dir):
    state = picked(f"c_custkey % {len(STATES)}", [s[0] for s in STATES])
    return table(spark, sf_dir, "customer").select("c_custkey", places.clean_state(state).alias("state"))


def clean_shape(spark, sf_dir):
    shape = picked(f"c_custkey % {len(SHAPES)}", [s[0] for s in SHAPES])
    merges = {**places.SHAPE_MERGES, "changed": "changing"}
    return table(spark, sf_dir, "customer").select(
        "c_custkey", places.clean_shape(shape).alias("shape"),
        places.clean_shape(shape, merges).alias("shape_merged"))


def clean_text_places(spark, sf_dir):
    """Every line of the documents as a city, with what the tables hold as its state and shape."""
    lines = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("shape"), F.col("lang").alias("state"),
        F.posexplode(F.split("text", "\n")).alias("line", "city"))
    return clean_places(lines)


def raw_reports(spark, sf_dir):
    """Orders as raw reports: dirty dates, places and shapes by order key."""
    index = f"o_orderkey % {len(CITIES)}"
    return spread(table(spark, sf_dir, "orders")).select(
        F.expr("concat('text ', o_orderkey)").alias("text"),
        F.expr("cast(NULL AS string)").alias("duration"),
        F.expr("CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE concat('a:', o_orderstatus) END").alias("stats"),
        F.expr(DIRTY_DATE_TIME).alias("date_time"),
        F.expr("concat('/r/', o_orderkey)").alias("report_link"),
        picked(index, [c[0] for c in CITIES]).alias("city"),
        picked(index, [c[1] for c in CITIES]).alias("state"),
        F.lit("USA").alias("country"),
        picked(f"o_orderkey % {len(SHAPES)}", [s[0] for s in SHAPES]).alias("shape"),
        F.col("o_orderpriority").alias("summary"),
        F.expr(DIRTY_POSTED).alias("posted"))


def standardize_reports(spark, sf_dir):
    return standardize(raw_reports(spark, sf_dir), AS_OF).select(
        "report_link", "posted", "date_time", "shape", "state", "city")


CITY_SQL = case_of("{key} % " + str(len(CITIES)), [c[2] for c in CITIES])
STATE_SQL = case_of(
    "{key} % " + str(len(CITIES)), [c[1].upper() if c[1] else c[1] for c in CITIES])
SHAPE_SQL = case_of("{key} % " + str(len(SHAPES)), [s[1] for s in SHAPES])
COUPLED = (
    f"p IS NOT NULL AND d IS NOT NULL AND p <= TIMESTAMP '{AS_OF}' AND d <= TIMESTAMP '{AS_OF}'")


def _moved(c):
    return f"CASE WHEN {c} > TIMESTAMP '{AS_OF}' THEN {c} - INTERVAL 100 YEAR ELSE {c} END"


# White space as text processing counts it (fixed values), for RE2.
_WS = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def _stripped(text):
    return f"regexp_replace(regexp_replace({text}, '^[{_WS}]+', ''), '[{_WS}]+$', '')"


def _first_word(text, short, full):
    return f"regexp_replace({text}, '^(?i:{short})[{_WS}]*?( |$)', '{full}\\1')"


def _lines_sql():
    """The rules one after the other, each line by all of them."""
    steps = [
        "SELECT doc_id, source, lang, generate_subscripts(ls, 1) - 1 AS line, unnest(ls) AS city FROM "
        "(SELECT doc_id, source, lang, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)",
        f"SELECT *, {_stripped("regexp_replace(city, '[(].*[)]', '')")} AS a FROM s0",
        f"SELECT *, {_stripped("split_part(a, '/', 1)")} AS b FROM s1"]
    for i, (short, full) in enumerate((("st[.]", "Saint"), ("ft[.]", "Fort"), ("mt[.]", "Mount"))):
        steps.append(f"SELECT * EXCLUDE (b), {_first_word('b', short, full)} AS b FROM s{i + 2}")
    fixes = " ".join(
        f"WHEN lower(b) = '{name}'{f" AND state = '{only}'" if only else ''} THEN '{full}'"
        for name, only, full in places.CITY_FIXES)
    ctes = ", ".join(f"s{i} AS ({text})" for i, text in enumerate(steps))
    return (
        f"WITH {ctes}, r AS (SELECT *, CASE upper(lang) WHEN 'NF' THEN 'NL' WHEN 'PQ' THEN 'QC' WHEN 'SA' "
        "THEN 'SK' WHEN 'YK' THEN 'YT' ELSE upper(lang) END AS state FROM s5) "
        "SELECT doc_id, CASE lower(source) WHEN 'triangular' THEN 'triangle' ELSE lower(source) END AS shape, "
        "state, CAST(line AS INTEGER) AS line, CASE WHEN city = '' OR state IS NULL OR state = '' THEN city "
        f"ELSE CASE {fixes} ELSE b END END AS city FROM r")


QUERIES = {
    "clean_text_places": Query(clean_text_places, _lines_sql()),
    "clean_ts": Query(
        clean_ts,
        f"SELECT o_orderkey, CASE WHEN {COUPLED} THEN p END AS posted, "
        f"CASE WHEN {COUPLED} THEN d END AS date_time FROM ({PARSED_SQL})"),
    "clean_ts_uncoupled": Query(
        clean_ts_uncoupled,
        f"SELECT o_orderkey, CASE WHEN p <= TIMESTAMP '{AS_OF}' THEN p END AS posted, "
        f"CASE WHEN d <= TIMESTAMP '{AS_OF}' THEN d END AS date_time FROM ({PARSED_SQL})"),
    "clean_ts_century": Query(
        clean_ts_century,
        f"SELECT o_orderkey, CASE WHEN d IS NOT NULL THEN {_moved('p')} END AS posted, "
        f"CASE WHEN p IS NOT NULL THEN {_moved('d')} END AS date_time FROM ({PARSED_SQL})"),
    "clean_city": Query(
        clean_city, f"SELECT c_custkey, {STATE_SQL.format(key='c_custkey')} AS state, "
        f"{CITY_SQL.format(key='c_custkey')} AS city FROM customer"),
    "clean_state": Query(
        clean_state,
        f"SELECT c_custkey, {case_of(f'c_custkey % {len(STATES)}', [s[1] for s in STATES])} AS state "
        "FROM customer"),
    "clean_shape": Query(
        clean_shape,
        f"SELECT c_custkey, {SHAPE_SQL.format(key='c_custkey')} AS shape, "
        f"{case_of(f'c_custkey % {len(SHAPES)}', [s[2] for s in SHAPES])} AS shape_merged FROM customer"),
    "standardize_reports": Query(
        standardize_reports,
        f"SELECT concat('/r/', o_orderkey) AS report_link, CASE WHEN {COUPLED} THEN p END AS posted, "
        f"CASE WHEN {COUPLED} THEN d END AS date_time, {SHAPE_SQL.format(key='o_orderkey')} AS shape, "
        f"{STATE_SQL.format(key='o_orderkey')} AS state, {CITY_SQL.format(key='o_orderkey')} AS city "
        f"FROM ({PARSED_SQL})"),
}

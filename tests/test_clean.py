import random
import re
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sightlake.functions import dates, places, text
from sightlake.operators.clean import clean_dates, clean_places, standardize
from sightlake.operators.publish import as_text

AS_OF = "2024-06-01T00:00:00"


def column_of(spark, values, expression):
    """Results of an expression over one string column ``c``, in input order."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, c string")
    return [r.out for r in df.select("i", expression(F.col("c")).alias("out")).orderBy("i").collect()]


def strptime_both(value):
    for form in ("%m/%d/%y %H:%M", "%m/%d/%y"):
        try:
            return datetime.strptime(value, form)
        except (ValueError, TypeError):
            pass
    return None


TIMESTAMPS = {
    "3/5/19 21:30": datetime(2019, 3, 5, 21, 30),
    "03/05/19": datetime(2019, 3, 5),
    "6/15/65 9:05": datetime(2065, 6, 15, 9, 5),
    "6/15/69": datetime(1969, 6, 15),
    "6/15/99": datetime(1999, 6, 15),
    "1/5/19  22:0": datetime(2019, 1, 5, 22),
    "1/5/19\t22:00": datetime(2019, 1, 5, 22),
    "2/29/20 1:00": datetime(2020, 2, 29, 1),
    "1/ 5/19": datetime(2019, 1, 5),
    "2/29/19": None, "1/5/19 24:00": None, "1/5/2019 22:00": None, " 1/5/19": None,
    "1/5/19 ": None, "": None, "1/5/19\n": None, "1/5/19 22:60": None, None: None,
}


def test_timestamp_fixtures(spark):
    assert column_of(spark, list(TIMESTAMPS), dates.parse_report_ts) == list(TIMESTAMPS.values())


BLANKS = ["", " ", "  ", "\t", "\n", "\xa0", "\x1c", "　", "​"]


def random_timestamp(rng):
    def number():
        return rng.choice(["{}", "{:02d}", " {}", "{:03d}"][: rng.choice([2, 2, 4])]).format(
            rng.randint(0, rng.choice([12, 30, 60, 99])))

    day = f"{number()}/{number()}/{number().zfill(2)}"
    end = rng.choice(["", "", *BLANKS])
    if rng.random() < 0.3:
        return day + end
    return f"{day}{rng.choice([' ', *BLANKS])}{number()}:{number()}{end}"


@settings(max_examples=5, deadline=None)
@given(st.integers(0, 2**32))
def test_timestamps_agree_with_strptime(spark, seed):
    rng = random.Random(seed)
    values = [random_timestamp(rng) for _ in range(3000)]
    values += [f"{m}/{d}/{y} {h}:{m}" for m in (1, 2, 12) for d in (28, 29, 30, 31)
               for y in ("00", "20", "69", "68", "99") for h in (0, 9, 23, 24)]
    want = [strptime_both(v) for v in values]
    assert sum(w is not None for w in want) > 100
    assert column_of(spark, values, dates.parse_report_ts) == want


def test_link_dates(spark):
    cases = {"2019-03-05": (2019, 3, 5), "2019-3-5": (2019, 3, 5), "2019-02-30": None,
             "19-03-05": None, "2019-03-05 ": None, "0000-01-01": None, "x": None, None: None}
    got = column_of(spark, list(cases), dates.parse_link_date)
    assert [g and (g.year, g.month, g.day) for g in got] == list(cases.values())


T = datetime
FUTURE_CASES = [
    ("3/7/19", "3/5/19 21:30", *[(T(2019, 3, 7), T(2019, 3, 5, 21, 30))] * 3),
    ("3/7/19", "6/15/65 9:05", (None, None), (T(2019, 3, 7), T(1965, 6, 15, 9, 5)), (T(2019, 3, 7), None)),
    ("3/7/19", "unknown", (None, None), (None, None), (T(2019, 3, 7), None)),
    (None, "3/5/19", (None, None), (None, None), (None, T(2019, 3, 5))),
]


@pytest.mark.parametrize("which,options", [
    (2, {}), (3, {"future": "minus_100y"}), (4, {"couple_dates": False})])
def test_future_and_coupling(spark, which, options):
    df = spark.createDataFrame([c[:2] for c in FUTURE_CASES], "posted string, date_time string")
    got = [tuple(r) for r in clean_dates(df.coalesce(1), AS_OF, **options).collect()]
    assert got == [c[which] for c in FUTURE_CASES]


def test_time_zones_do_not_matter(spark):
    # 2:30 on that day does not exist in New York; report times have no zone.
    df = spark.createDataFrame([("3/10/19 2:30", "3/10/19")], "date_time string, posted string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for as_of, kept in (("2019-03-10T02:30:00", True), ("2019-03-10T02:29:59", False)):
            for moment in (as_of, datetime.fromisoformat(as_of)):
                out = clean_dates(df, moment)
                text = as_text(out).first().asDict()
                assert text["date_time"] == ("2019-03-10T02:30:00" if kept else None)
                assert out.first().date_time == (datetime(2019, 3, 10, 2, 30) if kept else None)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_as_of_defaults_to_now(spark):
    soon = (datetime.now() + timedelta(days=3)).strftime("%m/%d/%y")
    past = (datetime.now() - timedelta(days=3)).strftime("%m/%d/%y")
    df = spark.createDataFrame([(soon, soon), (past, past)], "posted string, date_time string")
    assert [r.posted is None for r in clean_dates(df.coalesce(1)).collect()] == [True, False]


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
    ("St. Louis (x)", "", "St. Louis (x)"), ("", "TX", ""), (None, "TX", None),
    ("Saint Peters", "IL", "Saint Peters"), ("Washington, D.C.", None, "Washington, D.C."),
]


def test_city_fixtures(spark):
    rows = [(i, c, s, None) for i, (c, s, _) in enumerate(CITIES)]
    df = spark.createDataFrame(rows, "i int, city string, state string, shape string")
    got = [r.city for r in clean_places(df).orderBy("i").collect()]
    assert got == [c[2] for c in CITIES]


def test_shape_and_state(spark):
    # "changed" stays: the rule for it compares instead of assigning, so it has no effect.
    shapes = {"Triangular": "triangle", "CHANGED": "changed", "Circular": "circular",
              "Light": "light", "": "", None: None}
    assert column_of(spark, list(shapes), places.clean_shape) == list(shapes.values())
    merged = {**places.SHAPE_MERGES, "changed": "changing"}
    assert column_of(spark, ["CHANGED"], lambda c: places.clean_shape(c, merged)) == ["changing"]
    states = {"nf": "NL", "PQ": "QC", "sa": "SK", "YK": "YT", " tx": " TX", "": "", None: None}
    assert column_of(spark, list(states), places.clean_state) == list(states.values())


PIECES = ["(", ")", "/", " ", "\t", "\n", "\r", "\x85", " ", "\x1f", "St.", "ft.", "MT.",
          "a", "Zé"]


@settings(max_examples=4, deadline=None)
@given(st.integers(0, 2**32))
def test_text_rules_agree_with_python(spark, seed):
    rng = random.Random(seed)
    values = ["".join(rng.choices(PIECES, k=rng.randint(0, 8))) for _ in range(1500)]
    assert column_of(spark, values, text.strip_ws) == [v.strip() for v in values]
    assert column_of(spark, values, places.strip_parens) == [
        re.sub(r"\(.*\)", "", v).strip() for v in values]
    assert column_of(spark, values, places.first_of_slashes) == [
        v.split("/")[0].strip() for v in values]

    def expanded(v):
        head, *rest = v.strip().split(" ")
        return " ".join(["Saint" if head.strip().lower() == "st." else head, *rest])

    got = column_of(spark, values, lambda c: places.expand_prefix(text.strip_ws(c), "st.", "Saint"))
    assert got == [expanded(v) for v in values]

    def normalized(v):
        v = re.sub(r"\(.*\)", "", v).strip().split("/")[0].strip()
        for short, full in places.CITY_PREFIXES.items():
            head, *rest = v.split(" ")
            v = " ".join([full if head.strip().lower() == short else head, *rest])
        return v

    assert column_of(spark, values, places.normalize_city) == [normalized(v) for v in values]


def test_standardize_is_native_and_keeps_columns(spark):
    raw = spark.createDataFrame(
        [("St. Louis", "mo", "Light", "3/5/19 1:00", "3/7/19", "t")],
        "city string, state string, shape string, date_time string, posted string, text string")
    out = standardize(raw, AS_OF)
    assert out.columns == raw.columns
    row = out.first()
    assert (row.city, row.state, row.shape) == ("St Louis", "MO", "light")
    assert row.date_time == datetime(2019, 3, 5, 1) and row.posted == datetime(2019, 3, 7)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    # One match per date and city; the parentheses and three prefixes for odd cities only.
    assert plan.count("RLIKE") == 3 and plan.count("regexp_replace") == 4

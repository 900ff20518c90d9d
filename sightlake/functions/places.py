"""Shape, state and city clean-up as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sightlake.functions.text import WS_CLASS, strip_ws

# Shapes merged after lower-casing (fixed values).
SHAPE_MERGES = {"triangular": "triangle"}

# Misprinted or outdated region codes (fixed values).
STATE_FIXES = {"NF": "NL", "PQ": "QC", "SA": "SK", "YK": "YT"}

# Leading words written out in full (fixed values).
CITY_PREFIXES = {"st.": "Saint", "ft.": "Fort", "mt.": "Mount"}

# (lower-case city, state or None for any, replacement) (fixed values).
CITY_FIXES = [
    ("new york city", None, "New York"),
    ("saint louis", "MO", "St Louis"),
    ("washington, d.c.", None, "Washington"),
    ("saint petersburg", "FL", "St. Petersburg"),
    ("port st. lucie", "FL", "Port Saint Lucie"),
    ("saint peters", "MO", "City of Saint Peters"),
]


def _replace_whole(c: Column, table: dict[str, str]) -> Column:
    replacements = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(replacements, c), c)


def clean_shape(shape: Column, merges: dict[str, str] = SHAPE_MERGES) -> Column:
    """Lower-case shape with near-synonyms merged; null and empty stay."""
    return _replace_whole(F.lower(shape), merges)


def clean_state(state: Column) -> Column:
    """Upper-case state with known misprints fixed; not stripped; null and empty stay."""
    return _replace_whole(F.upper(state), STATE_FIXES)


def strip_parens(city: Column) -> Column:
    """Drop everything from the first ``(`` to the last ``)`` of a line."""
    # (?d): only a line feed ends a line.
    return strip_ws(F.regexp_replace(city, r"(?d)\(.*\)", ""))


def first_of_slashes(city: Column) -> Column:
    return strip_ws(F.substring_index(city, "/", 1))


def expand_prefix(city: Column, short: str, full: str) -> Column:
    """Write out an abbreviated first word; the rest keeps its spelling and spacing."""
    # The first word ends at the first blank; other white space in it is ignored.
    word = short.replace(".", r"\.")
    return F.regexp_replace(city, rf"^(?i:{word})[{WS_CLASS}]*?(?= |\z)", full)


# What a city must hold for normalising to change it: most names pass this one look.
IRREGULAR_CITY = (
    rf"[(/]|^[{WS_CLASS}]|[{WS_CLASS}]\z|^(?i:"
    + "|".join(short.replace(".", r"\.") for short in CITY_PREFIXES) + ")"
)


def normalize_city(city: Column) -> Column:
    """Without parentheses, second names and abbreviated first words, and stripped."""
    full = first_of_slashes(strip_parens(city))
    for short, word in CITY_PREFIXES.items():
        full = expand_prefix(full, short, word)
    return F.when(city.rlike(IRREGULAR_CITY), full).otherwise(city)


def fix_city(city: Column, state: Column) -> Column:
    """Spot corrections that bring city names in line with the gazetteer."""
    folded = F.lower(city)
    result = F
    for name, only_in, replacement in CITY_FIXES:
        hit = folded == name
        if only_in is not None:
            hit = hit & (state == only_in)
        result = result.when(hit, replacement)
    return result.otherwise(city)

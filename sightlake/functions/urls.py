"""Link helpers as Column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def host_allowed(url: Column, hosts: Sequence[str]) -> Column:
    """True for a URL on one of the hosts or on a host below one of them."""
    wanted = [h.lower() for h in hosts if not re.search("[/?#:]", h)]  # no host holds any of these
    if not wanted:
        return F.lit(False)
    if not all(h and h.isascii() for h in wanted):
        host = host_of(url)
        ok = reduce(lambda a, b: a | b, [(host == h) | host.endswith("." + h) for h in wanted])
        return F.coalesce(ok, F.lit(False))
    # One match says all: cutting the host out and comparing it takes one for each comparison.
    # The Kelvin sign is the one letter beyond ASCII whose lower case is within.
    names = "|".join(re.escape(h).replace("k", r"[k\x{212A}]") for h in wanted)
    plain = [url.startswith(f"{scheme}://{h}/") for h in wanted for scheme in ("https", "http")]
    ok = reduce(lambda a, b: a | b, plain) | url.rlike(
        r"^[A-Za-z][A-Za-z0-9+.-]*+://(?:[^/?#@]*+@)?+(?:[^/?#:]*\.)?(?i:" + names + r")(?=[/?#:]|\z)")
    return F.coalesce(ok, F.lit(False))


def link_key(url: Column) -> Column:
    """What names a page apart from its host: path and query, without the fragment."""
    site = r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*/?"
    # A pattern bound to the beginning is tried once, not at each letter.
    rest = F.when(url.contains("#"), F.regexp_replace(url, rf"^{site}|^/|#.*", "")).otherwise(
        F.regexp_replace(url, rf"^(?:{site}|/)", ""))
    return F.concat(F.lit("/"), rest)


def resolve_link(page_url: Column, href: Column) -> Column:
    """Absolute URL of a link found on a page."""
    site = F.regexp_extract(page_url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)
    scheme = F.regexp_extract(page_url, r"^[A-Za-z][A-Za-z0-9+.-]*:", 0)
    page = F.regexp_extract(page_url, r"^[^?#]*", 0)
    folder = F.regexp_replace(F.substring(page, F.length(site) + 1, 1 << 30), r"[^/]*\z", "")
    folder = F.when(folder == "", "/").otherwise(folder)
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(site, href))
        .when(href.startswith("?"), F.concat(page, href))
        .otherwise(F.concat(site, _without_dots(F.concat(folder, href))))
    )


def _without_dots(path: Column) -> Column:
    """A path from the root without "." and ".." segments; its query stays as it is."""
    own = F.regexp_extract(path, r"^[^?#]*", 0)
    rest = F.substring(path, F.length(own) + 1, 1 << 30)
    dots = r"(?:^|/)\.\.?(?:/|\z)"
    # A dot segment at the end leaves its slash.
    parts = F.split(F.regexp_replace(own, r"(/\.\.?)\z", "$1/"), "/")
    kept = F.aggregate(
        F.slice(parts, 2, F.size(parts)), F.array().cast("array<string>"),
        lambda held, part: F.when(part == ".", held)
        .when(part == "..", F.slice(held, 1, F.greatest(F.size(held) - 1, F.lit(0))))
        .otherwise(F.concat(held, F.array(part))))
    return F.when(own.rlike(dots), F.concat(F.lit("/"), F.array_join(kept, "/"), rest)
                  ).otherwise(path)

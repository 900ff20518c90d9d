"""Text helpers as Column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Unicode text processing counts as white space (fixed values):
# the ASCII controls, the file/group/record/unit separators, NEL, NBSP and the
# typographic blanks.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set inside a regular expression character class.
WS_CLASS = r"\x09-\x0D\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"


def strip_ws(c: Column) -> Column:
    """Strip all leading and trailing Unicode white space (``trim`` only strips blanks)."""
    return F.btrim(c, F.lit(WHITESPACE))


def has_text(c: Column) -> Column:
    """True for a value that is neither null nor empty; never null itself."""
    return c.isNotNull() & (c != "")


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def tokens_to_null(c: Column, tokens: Iterable[str]) -> Column:
    """Null where the value equals one of the missing-value tokens."""
    tokens = list(tokens)
    return F.when(~c.isin(tokens), c) if tokens else c

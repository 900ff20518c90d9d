"""Quality rules kept as a ledger: one bit per failed rule, beside the measurements.

Every rule is evaluated once. A policy is a named, versioned set of rules; applying one, or
trying a set without one of its rules, is bit arithmetic on the ledger and reads no text again.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightlake.llm.frames import fresh, over_texts, quoted, with_columns
from sightlake.llm.words import blank_words, code_points

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
_MIX = np.uint64(0x9E3779B97F4A7C15)
MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, "
    "n_repeat_words long")


class Rule(NamedTuple):
    """A document fails where the SQL condition over the measurements holds."""

    name: str
    fails: str


class Policy(NamedTuple):
    """The rules that count; a later version is a new policy, the ledger stays."""

    name: str
    version: int
    rules: tuple[str, ...]


#: The bit of a rule is its place; append only, so that written ledgers keep their meaning.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("repeated_lines", "n_lines >= 4 AND 2 * n_dup_lines > n_lines"),
    Rule("word_length", "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words)"),
)
BASE = Policy("base", 1, ("few_words", "repeated_windows"))
STRICT = Policy("strict", 1, tuple(r.name for r in RULES))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside a window of that many words that the text has at least twice.

    Windows are ranked by doubling: equal ranks are equal words, no hash decides. Hashes only tell
    beforehand that no two windows are equal.
    """
    if len(words) <= window:
        return 0
    mixed, width = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64), 1
    while width < window:
        step = min(width, window - width)
        mixed = mixed[:-step] * (_MIX + np.uint64(2 * width)) + mixed[step:]
        width += step
    mixed.sort()
    if not (mixed[1:] == mixed[:-1]).any():
        return 0
    seen: dict[bytes, int] = {}
    rank = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    width = 1
    while width < window:
        step = min(width, window - width)
        paired = rank[:-step] * np.int64(len(words)) + rank[step:]
        distinct, rank = np.unique(paired, return_inverse=True)
        width += step
        if len(distinct) == len(rank):
            return 0
    again = np.flatnonzero(np.bincount(rank)[rank] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, again, 1)
    np.add.at(edges, again + window, -1)
    return int(np.count_nonzero(np.cumsum(edges)))


def _measured(text: bytes) -> tuple:
    words = blank_words(text)
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return (
        len(words), code_points(b"".join(words)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines), len(lines) - len(set(lines)), repeated_words(words))


def measure(df: DataFrame, column: str = "text") -> DataFrame:
    """df with n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words.

    Words are runs of anything but ASCII white space; lines without a word do not count. A null
    or empty text measures zero throughout, a text of any length is read whole.
    """
    return over_texts(df, column, MEASURES, lambda texts: [_measured(t) for t in texts])


def ledger(
    df: DataFrame, column: str = "text", rules: Sequence[Rule] = RULES, failed: str = "failed",
) -> DataFrame:
    """Measurements and a long of failure bits, bit i for rule i.

    Rows are neither dropped nor merged: repeated rows get equal ledgers, null and empty texts
    fail ``few_words``, and columns of the same names are replaced.
    """
    measured = measure(df, column)
    bits = F.lit(0).cast("long")
    for place, rule in enumerate(rules):
        bits = bits.bitwiseOR(
            F.when(F.expr(rule.fails), F.lit(1 << place)).otherwise(F.lit(0)).cast("long"))
    return with_columns(measured, {failed: bits})


def policy_mask(policy: Policy, rules: Sequence[Rule] = RULES) -> int:
    places = {r.name: i for i, r in enumerate(rules)}
    return sum(1 << places[name] for name in set(policy.rules))


def passes(policy: Policy, rules: Sequence[Rule] = RULES, failed: str = "failed"):
    """True where the ledger has none of the policy's bits."""
    return F.col(quoted(failed)).bitwiseAND(F.lit(policy_mask(policy, rules))) == 0


def ablations(
    written: DataFrame, policy: Policy, rules: Sequence[Rule] = RULES, failed: str = "failed",
) -> DataFrame:
    """For each rule of the policy: how many documents fail it, and how many fail it alone.

    The second is what dropping the rule would keep. Documents are summed by their bits first,
    so the shuffle moves one row per task and combination, whatever the number of documents.
    """
    mask = policy_mask(policy, rules)
    bits = fresh(written, "bits")
    counted = (written.select(F.col(quoted(failed)).bitwiseAND(F.lit(mask)).alias(bits))
               .groupBy(bits).agg(F.count("*").alias("documents")))
    listed = [(i, r.name) for i, r in enumerate(rules) if mask >> i & 1]
    arms = F.array(*[F.struct(
        F.lit(name).alias("rule"), F.lit(1 << i).cast("long").alias("bit")) for i, name in listed])
    rows = counted.select(bits, "documents", F.inline(arms))
    has = F.col(bits).bitwiseAND(F.col("bit")) != 0
    return rows.groupBy("rule").agg(
        F.sum(F.when(has, F.col("documents")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col(bits) == F.col("bit"), F.col("documents")).otherwise(0))
        .alias("n_only"))

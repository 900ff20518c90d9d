"""Document quality and toxicity from weak labels.

Simple labellers vote on every document. What votes come together is counted over the whole
table; expectation-maximisation over those counts estimates how often each labeller is right and
with that what each combination of votes means. The posterior labels of a bounded sample train a
linear scorer over hashed features, and the scorer rates every document by its whole text, also
where no labeller says anything.

Labellers of quality look at the form of a text. Those of toxicity are word lists: a fixed one,
and two (whole words, beginnings of words) read off a bounded sample of labelled rows, since
insults in a language nobody wrote a list for can only be known from labels.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightlake.llm.frames import over_texts, quoted, without
from sightlake.llm.quality_rules import SYMBOLS, repeated_words
from sightlake.llm.words import alnum_words, blank_words
from sightlake.session import drop_staged, stage

#: Documented bounds: labelled rows that word lists are read from, rows that train the scorer.
LABELLED_ROWS, TRAINING_ROWS = 20_000, 8_000
BUCKETS = 1 << 18
#: Bytes of a word that count as its beginning.
BEGINNINGS = (4, 6, 8)
#: How much larger a word's share of toxic documents must be than that of others.
LIKELIER = 30
#: A feature of the scorer occurs in so many rows of the sample.
LEAST_ROWS = 20
#: Insults that need no labels.
INSULTS = frozenset(
    b"idiot idiots moron morons scum scumbag loser losers pathetic worthless stupid imbecile "
    b"disgusting trash clown".split())
#: Labellers against a text, then those for it: quality by form, toxicity by lists.
QUALITY_LABELLERS = (
    "capitals", "exclamations", "symbols", "separators", "repeats", "short", "plain", "sentences")
TOXICITY_LABELLERS = ("insults", "words", "beginnings", "none listed")
QUALITY_FOR, TOXICITY_FOR = 2, 1


def _form(text: bytes) -> dict[str, float]:
    """Shares that describe a text's form."""
    words = blank_words(text)
    n = max(1, len(words))
    letters = max(1, len(text.translate(None, _NOT_LETTERS)))
    return {
        "capitals": len(text.translate(None, _NOT_CAPITALS)) / letters,
        "exclamations": text.count(b"!") / n,
        "symbols": (len(text) - len(text.translate(None, SYMBOLS))) / n,
        "separators": text.count(b"|") / n,
        "repeats": repeated_words(words) / n,
        "short": 1.0 if len(words) < 20 else 0.0,
        "stops": text.count(b".") / n,
    }


_NOT_LETTERS = bytes(b for b in range(256) if not (65 <= b <= 90 or 97 <= b <= 122))
_NOT_CAPITALS = bytes(b for b in range(256) if not 65 <= b <= 90)
#: From which share on a labeller votes against a text.
_LIMITS = {"capitals": 0.5, "exclamations": 0.2, "symbols": 0.2, "separators": 0.2,
           "repeats": 0.2, "short": 0.5}


class Lists(NamedTuple):
    words: frozenset[bytes]
    beginnings: frozenset[bytes]


class Model(NamedTuple):
    """Weights by bucket for quality and toxicity, a constant each, and what votes are worth:
    labellers' accuracies, and by votes on toxicity how likely they make it."""

    weights: np.ndarray
    constants: np.ndarray
    posterior: dict[int, float]
    accuracies: dict[str, float]
    lists: Lists


def _beginnings(words: set[bytes]) -> set[bytes]:
    return {w[:n] for n in BEGINNINGS for w in words if len(w) >= n}


def _numbered(texts: list[bytes]) -> tuple[dict[bytes, int], list[np.ndarray]]:
    """Numbers of the distinct words of some texts, and those of each text's own."""
    numbers: dict[bytes, int] = {}
    owned = []
    for text in texts:
        words = set(alnum_words(text))
        new = words.difference(numbers)
        numbers.update(zip(new, range(len(numbers), len(numbers) + len(new)), strict=True))
        owned.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
    return numbers, owned


def _quality_votes(form: dict[str, float]) -> int:
    """Bits of the labellers that say something of a text's quality."""
    against = [form[name] >= limit for name, limit in _LIMITS.items()]
    plain = not any(form[name] >= limit / 4 for name, limit in _LIMITS.items() if name != "short")
    sentences = 0.02 <= form["stops"] <= 0.5 and not any(against[:5])
    return sum(1 << i for i, says in enumerate([*against, plain, sentences]) if says)


def _toxicity_votes(numbers: dict[bytes, int], owned: list[np.ndarray], lists: Lists) -> list[int]:
    """The same of toxicity, for some texts; a word is looked up once for all of them."""
    said = np.zeros(len(numbers), np.int64)
    for bit, listed in ((1, INSULTS), (2, lists.words)):
        said[[numbers[w] for w in listed if w in numbers]] += bit
    least = min(BEGINNINGS)
    heads = {b[:least] for b in lists.beginnings}
    said[[numbers[w] for w in numbers if w[:least] in heads
          and not lists.beginnings.isdisjoint(_beginnings({w}))]] += 4
    return [int(np.bitwise_or.reduce(said[own])) or 8 for own in owned]


def _votes(texts: list[bytes], lists: Lists) -> list[tuple[int, int]]:
    """Votes on the quality and on the toxicity of some texts."""
    toxic = _toxicity_votes(*_numbered(texts), lists)
    return [(_quality_votes(_form(t)), votes) for t, votes in zip(texts, toxic, strict=True)]


def _features(texts: list[bytes], lists: Lists) -> Iterator[tuple[int, int, np.ndarray]]:
    """Votes on each text, and distinct buckets of words, beginnings, steps of the form, and the votes."""
    numbers, owned = _numbered(texts)
    # A word and its beginnings; the word once more for one it is too short for.
    buckets = np.empty((len(numbers), 1 + len(BEGINNINGS)), np.int32)
    buckets[:, 0] = np.fromiter(map(zlib.crc32, numbers), np.int64, len(numbers)) & (BUCKETS - 1)
    marked = zlib.crc32(b"^")
    for i, n in enumerate(BEGINNINGS, 1):
        buckets[:, i] = np.fromiter(
            (zlib.crc32(w[:n], marked) if len(w) >= n else zlib.crc32(w) for w in numbers),
            np.int64, len(numbers)) & (BUCKETS - 1)
    for text, own, toxic in zip(texts, owned, _toxicity_votes(numbers, owned, lists), strict=True):
        form = _form(text)
        bad = _quality_votes(form)
        named = [f"={k}{min(9, int(10 * v))}".encode() for k, v in form.items()]
        named += [f"=bad{i}".encode() for i in range(len(QUALITY_LABELLERS)) if bad >> i & 1]
        named += [f"=toxic{i}".encode() for i in range(len(TOXICITY_LABELLERS)) if toxic >> i & 1]
        others = np.fromiter(map(zlib.crc32, named), np.int64, len(named)) & (BUCKETS - 1)
        yield bad, toxic, np.unique(np.concatenate((buckets[own].ravel(), others)))


def _placed(df: DataFrame, column: str, key: str) -> DataFrame:
    return df.select(F.col(quoted(key)).alias("key"), F.col(quoted(column)).alias("text"),
                     F.monotonically_increasing_id().alias("place"))


def _sample(placed: DataFrame, rows: int) -> DataFrame:
    """Places of at most so many rows, those whose keys and places hash lowest."""
    return placed.orderBy(F.xxhash64(F.lit(7), "key", "place")).limit(rows).drop("key", "text")


def learn_lists(df: DataFrame, labels: DataFrame, column: str = "text", key: str = "doc_id",
                rows: int = LABELLED_ROWS) -> Lists:
    """Words and beginnings of words that are far likelier in toxic documents.

    Of a bounded sample of labelled rows; a word counts if so many toxic documents hold it that
    chance among all the sample's words would hardly bring it about, and their share is a multiple
    of that of other documents: what the scorer makes of a word in both is its own affair. Null
    labels and keys say nothing, of several labels of a key the greatest counts, and each of
    several rows with a key has it. Without labels of both kinds the lists are empty.
    """
    labelled = labels.where("toxic IS NOT NULL").groupBy(F.col(quoted(key)).alias("key")).agg(
        F.max("toxic").alias("toxic"))
    placed = _placed(df, column, key)
    picked = _sample(placed.select("key", "place").join(labelled, "key"), rows)
    held = placed.join(F.broadcast(picked), "place")

    def named(texts: list[bytes]) -> list[tuple]:
        found = (set(alnum_words(t)) for t in texts)
        return [([*(b"=" + w for w in words), *(b"^" + w for w in _beginnings(words))],)
                for words in found]

    # Not explode: for it Spark has texts without names left out before the join, by this function
    # on every text of the table.
    marked = over_texts(held, "text", "names array<binary>", named).select(
        "toxic", F.explode_outer("names").alias("name")).where("name IS NOT NULL")
    total = held.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    if not total["toxic"] or total["toxic"] == total["n"]:
        return Lists(frozenset(), frozenset())
    counted = stage(marked.groupBy("name").agg(
        F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")), "words")
    names = max(1, counted.count())
    least = max(4.0, (math.log(names) + 5) / math.log(total["n"] / total["toxic"]))
    kept = counted.where(
        (F.col("toxic") >= least) & (F.col("toxic") * (total["n"] - total["toxic"])
                                     >= LIKELIER * (F.col("clean") + 0.5) * total["toxic"])).select("name")
    found = [bytes(r["name"]) for r in kept.toLocalIterator()]
    drop_staged(df.sparkSession, counted)
    return Lists(frozenset(n[1:] for n in found if n[:1] == b"="),
                 frozenset(n[1:] for n in found if n[:1] == b"^"))


def estimate(counts: dict[int, int], against: int, in_favour: int,
             rounds: int = 200) -> tuple[dict[int, float], np.ndarray]:
    """(posterior of being voted against for each combination of votes, labellers' accuracies).

    A labeller that says nothing tells nothing; one that votes is right with its accuracy, which
    begins at 0.8 (a prior worth ten votes) and is estimated from how it agrees with the others;
    every labeller is taken to be better than chance, and neither class to be likelier.
    """
    patterns = np.array(sorted(counts), np.int64)
    weight = np.array([counts[p] for p in patterns.tolist()], float)
    votes = ((patterns[:, None] >> np.arange(against + in_favour)) & 1).astype(float)
    side = np.where(np.arange(against + in_favour) < against, 1.0, -1.0)
    accuracy, belief = np.full(len(side), 0.8), np.full(len(patterns), 0.5)
    for _ in range(rounds):
        odds = votes @ (side * np.log(accuracy / (1 - accuracy)))
        belief, before = 1 / (1 + np.exp(-odds)), belief
        if np.abs(belief - before).max() < 1e-9:
            break
        right = np.where(side > 0, belief[:, None], 1 - belief[:, None])
        cast = weight @ votes
        accuracy = np.clip((weight @ (votes * right) + 8) / (cast + 10), 0.55, 0.999)
    return dict(zip(patterns.tolist(), belief.tolist(), strict=True)), accuracy


def _fit(buckets: np.ndarray, sizes: np.ndarray, belief: np.ndarray, rounds: int = 80):
    """Weights of a logistic regression on binary features, by damped gradient steps.

    Each row counts for the likelier class, by how much likelier it is.
    """
    weights, constant = np.zeros(BUCKETS), 0.0
    target, trust = (belief > 0.5).astype(float), np.abs(2 * belief - 1)
    if not len(target):
        return weights, constant
    common = np.flatnonzero(np.bincount(buckets, minlength=BUCKETS) >= min(
        LEAST_ROWS, 1 + len(sizes) // 20))
    place = np.full(BUCKETS, -1)
    place[common] = np.arange(len(common))
    row = np.repeat(np.arange(len(sizes)), sizes)
    use = place[buckets] >= 0
    feature, row = place[buckets[use]], row[use]
    learned = np.zeros(len(common))
    moved, moved_constant = np.full(len(common), 1e-2), 1e-2
    for _ in range(rounds):
        score = np.bincount(row, weights=learned[feature], minlength=len(sizes)) + constant
        error = trust * (1 / (1 + np.exp(-np.clip(score, -30, 30))) - target)
        step = np.bincount(feature, weights=error[row], minlength=len(common)) + 2 * learned
        moved += step ** 2
        learned -= 0.3 * step / np.sqrt(moved)
        moved_constant += error.sum() ** 2
        constant -= 0.3 * error.sum() / math.sqrt(moved_constant)
    weights[common] = learned
    return weights, constant


def train(df: DataFrame, lists: Lists, column: str = "text", key: str = "doc_id",
          rows: int = TRAINING_ROWS) -> Model:
    """Votes of all documents, their meaning, and a scorer of both targets.

    The driver gets the counts of vote combinations (at most 4,096 rows) and the hashed features of
    the sample; the bound on its rows is a parameter.
    """
    voted = over_texts(
        df.select(F.col(quoted(key)).alias("key"), F.col(quoted(column)).alias("text")), "text",
        "bad long, toxic long",
        lambda texts: _votes(texts, lists))
    counted = voted.groupBy("bad", "toxic").agg(F.count("*").alias("n")).collect()
    meanings, accuracies = [], {}
    for name, labellers, for_ in (("bad", QUALITY_LABELLERS, QUALITY_FOR),
                                  ("toxic", TOXICITY_LABELLERS, TOXICITY_FOR)):
        counts: dict[int, int] = {}
        for r in counted:
            counts[r[name]] = counts.get(r[name], 0) + r["n"]
        posterior, rates = estimate(counts or {0: 0}, len(labellers) - for_, for_)
        meanings.append(posterior)
        accuracies |= {f"{name}: {x}": float(a) for x, a in zip(labellers, rates, strict=True)}

    def described(texts: list[bytes]) -> list[tuple]:
        return list(_features(texts, lists))

    placed = _placed(df, column, key)
    picked = placed.join(F.broadcast(_sample(placed.select("key", "place"), rows)), "place")
    sample = over_texts(picked, "text", "bad long, toxic long, buckets array<int>", described).select(
        "bad", "toxic", "buckets").toArrow()
    lengths = np.diff(sample["buckets"].combine_chunks().offsets.to_numpy()) if len(sample) else (
        np.empty(0, np.int64))
    buckets = (sample["buckets"].combine_chunks().flatten().to_numpy() if len(sample)
               else np.empty(0, np.int64))
    fitted = [
        _fit(buckets, lengths, np.array([meaning[v] for v in sample[name].to_pylist()]))
        for name, meaning in zip(("bad", "toxic"), meanings, strict=True)]
    return Model(np.stack([w for w, _ in fitted], axis=1).astype(np.float32),
                 np.array([c for _, c in fitted]), meanings[1], accuracies, lists)


def score(df: DataFrame, model: Model, column: str = "text") -> DataFrame:
    """df with ``quality`` and ``toxicity`` from 0 to 1, over the whole text of every row.

    A text is as toxic as the scorer or its votes make it: a listed word counts however little else
    there is. A null or empty text has the form of a short one and no words. Columns of the same names are
    replaced, rows stay where they are. The weights have a fixed size and are broadcast.
    """
    sent = df.sparkSession.sparkContext.broadcast(
        (model.weights, model.constants, model.posterior, model.lists))

    def rows(texts: list[bytes]) -> list[tuple]:
        weights, constants, posterior, lists = sent.value
        found = []
        for _, voted, features in _features(texts, lists):
            total = weights[features].sum(axis=0) + constants
            bad, toxic = (1 / (1 + np.exp(-np.clip(total, -30, 30)))).tolist()
            found.append((1 - bad, max(toxic, posterior.get(voted, 0.0))))
        return found

    return over_texts(df, column, "quality double, toxicity double", rows)


def classify(df: DataFrame, labels: DataFrame, column: str = "text", key: str = "doc_id",
             labelled_rows: int = LABELLED_ROWS, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """df with ``quality``, ``toxicity`` and ``kept``: good and not toxic, each by one half.

    Every row is scored, null and empty texts as short ones, repeated rows alike; an empty table
    gives an empty one. Labels are read by ``learn_lists`` alone, so rows without one, labels of
    other keys, double and null labels do no harm; without any, the fixed list is all there is.
    Columns of these names are replaced.
    """
    lists = learn_lists(df, labels, column, key, labelled_rows)
    scored = score(df, train(df, lists, column, key, training_rows), column)
    kept = (F.col("quality") >= 0.5) & (F.col("toxicity") < 0.5)
    return scored.select(*without(scored, ["kept"]), kept.alias("kept"))

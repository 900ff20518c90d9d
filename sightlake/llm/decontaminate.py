"""Benchmark passages in training documents, by suffix arrays of the training side.

A shard is some documents of a task. Its words become numbers as they are read, its suffixes are sorted as
far as the longest benchmark item goes, and every suffix of the benchmark is looked up in the
order by binary search: the range that shares its window gives all places, and extending the
match there gives the longest verbatim one. Only suffixes that can hold a window are sorted:
those that go on for a window's length in words the benchmark has.

The benchmark is the query set, sent to every shard in blocks of a bounded size; documents are
neither shuffled nor joined.
"""

from __future__ import annotations

from collections import OrderedDict, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightlake.llm.frames import AT_ONCE, kept_rows, over_texts, quoted
from sightlake.llm.words import alnum_words

WINDOW = 13
#: Bytes of benchmark text in one block, and so in one broadcast; built blocks a worker keeps;
#: bytes of documents that meet a block together, where there are more blocks than that; and with
#: fewer, how many times the benchmark's bytes.
BLOCK_BYTES, BUILT, TOGETHER, TIMES = 4 << 20, 6, 64 << 20, 4
FOUND = (
    "n_words long, n_hit long, n_items long, items array<string>, longest_words long, "
    "longest_start long, longest_item string")


class _Block:
    """Words and suffixes of some benchmark items."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.numbers: dict[bytes, int] = {}
        self.names, words, owner, left = [], [], [], []
        for name, text in items:
            own = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in alnum_words(text)]
            if own:
                owner += [len(self.names)] * (len(own) + 1)
                self.names.append(name)
                words += [*own, -1]
                left += [*range(len(own), 0, -1), 0]
        self.words = np.array(words or [-1], np.int32)
        self.owner = np.array(owner or [0], np.int32)
        self.left = np.array(left or [0], np.int32)
        sizes = np.bincount(self.owner, minlength=1) - 1 if words else np.zeros(1, np.int64)
        self.sizes = np.minimum(sizes, window)[self.owner]
        #: Suffixes that start a window, and how long it is.
        self.starts = np.flatnonzero((self.left > 0) & (self.left >= self.sizes))
        self.lengths = self.sizes[self.starts]
        self.least = int(self.lengths.min()) if len(self.starts) else 0
        self.deepest = int(self.left.max())


def _suffix_array(words: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """The starts in the order of their suffixes, compared up to a depth; a multikey sort.

    Only suffixes that are still tied are compared further on. words ends with so many zeros
    that a suffix may be read to the depth from any start.
    """
    order = starts
    tied = np.arange(len(starts))
    rank = np.zeros(len(starts), np.int64)
    for at in range(0, depth, 2):
        own = order[tied]
        key = words[own + at].astype(np.int64) << 32 | words[own + at + 1]
        by = np.lexsort((key, rank[tied]))
        order[tied] = own[by]
        key, group = key[by], rank[tied]
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (group[1:] != group[:-1])))
        rank[tied] = tied[np.flatnonzero(new)][np.cumsum(new) - 1]
        # A zero ends a run; what is tied there is equal as far as a match can go.
        on = (words[own[by] + at] > 0) & (words[own[by] + at + 1] > 0)
        alone = new & np.concatenate((new[1:], [True]))
        tied = tied[~alone & on]
        if not len(tied):
            break
    return order


def _bound(words, array, block: _Block, queries, lengths, upper: bool) -> np.ndarray:
    """For each query the first place in the array whose suffix is past the query's window."""
    low = np.zeros(len(queries), np.int64)
    high = np.full(len(queries), len(array), np.int64)
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) >> 1
        sign = np.zeros(len(open_), np.int8)
        going = np.arange(len(open_))
        for at in range(int(lengths[open_].max())):
            going = going[lengths[open_[going]] > at]
            if not len(going):
                break
            ours = words[array[middle[going]] + at]
            theirs = block.words[queries[open_[going]] + at]
            sign[going] = np.sign(ours - theirs)
            going = going[ours == theirs]
        past = sign > 0 if upper else sign >= 0
        high[open_[past]] = middle[past]
        low[open_[~past]] = middle[~past] + 1
    return low


def _places(block: _Block, words: np.ndarray):
    """All (place, query) where a window of the block starts in the shard."""
    none = np.empty(0, np.int64)
    if not len(block.starts):
        return none, none
    # Every document ends with a zero, so something breaks each run.
    breaks = np.flatnonzero(words == 0).astype(np.int32)
    run = np.repeat(breaks, np.diff(breaks, prepend=np.int32(-1)))
    run -= np.arange(len(run), dtype=np.int32)
    starts = np.flatnonzero(run >= block.least)
    if not len(starts):
        return none, none
    padded = np.concatenate((words, np.zeros(block.deepest + 2, np.int32)))
    array = _suffix_array(padded, starts, block.deepest)
    low = _bound(padded, array, block, block.starts, block.lengths, upper=False)
    high = _bound(padded, array, block, block.starts, block.lengths, upper=True)
    counts = high - low
    query = np.repeat(np.arange(len(counts)), counts)
    offset = np.arange(len(query)) - np.repeat(np.cumsum(counts) - counts, counts)
    return array[low[query] + offset], query


def _extended(block: _Block, padded, places, queries) -> np.ndarray:
    """Words that go on alike from each place, the window included."""
    length = block.lengths[queries].astype(np.int64)
    start = block.starts[queries]
    going = np.arange(len(places))
    while len(going):
        going = going[length[going] < block.left[start[going]]]
        at = length[going]
        same = padded[places[going] + at] == block.words[start[going] + at]
        going = going[same]
        length[going] += 1
    return length


def _numbered(texts: list[bytes]) -> tuple[dict[bytes, int], np.ndarray, np.ndarray]:
    """Numbers of the words of a shard, its texts in numbers with a zero after each, their sizes."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    numbers[b""] = 0  # no word is empty
    parts, sizes = [], []
    for text in texts:
        own = [numbers[w] for w in alnum_words(text)]
        sizes.append(len(own))
        own.append(0)
        parts.append(np.array(own, np.int32))
    return (numbers, np.concatenate(parts) if parts else np.empty(0, np.int32),
            np.array(sizes, np.int64))


def find_in_shard(texts: list[bytes], blocks: Iterable[_Block]) -> list[tuple]:
    """A row of FOUND for each document of a shard."""
    numbers, shard, sizes = _numbered(texts)
    firsts = np.concatenate(([0], np.cumsum(sizes + 1)))
    edges = np.zeros(len(shard) + 1, np.int32)
    items: list[set] = [set() for _ in texts]
    best: list[tuple] = [(0, None, None)] * len(texts)
    for block in blocks:
        get = block.numbers.get
        words = np.array([get(w, 0) for w in numbers], np.int32)[shard]
        places, queries = _places(block, words)
        if not len(places):
            continue
        np.add.at(edges, places, 1)
        np.add.at(edges, places + block.lengths[queries], -1)
        padded = np.concatenate((words, np.zeros(block.deepest + 2, np.int32)))
        length = _extended(block, padded, places, queries)
        of = np.searchsorted(firsts, places, side="right") - 1
        owner = block.owner[block.starts[queries]]
        for d, o in np.unique(np.stack([of, owner], axis=1), axis=0).tolist():
            items[d].add(block.names[o])
        order = np.lexsort((owner, places, -length, of))
        firsts_of = order[np.unique(of[order], return_index=True)[1]]
        for x in firsts_of.tolist():
            found = (int(length[x]), int(places[x] - firsts[of[x]]), block.names[owner[x]])
            if found[0] > best[of[x]][0]:
                best[of[x]] = found
    covered = np.concatenate(([0], np.cumsum(np.cumsum(edges[:-1], dtype=np.int32) > 0)))
    return [
        (size, int(covered[first + size] - covered[first]), len(named), sorted(named), *top)
        for first, size, named, top in zip(firsts.tolist(), sizes.tolist(), items, best, strict=False)]


_built: OrderedDict[tuple[int, int], _Block] = OrderedDict()


def _block(number: int, sent: Broadcast, window: int) -> _Block:
    """A block of the benchmark, built once in a worker while there is room for it."""
    key = number, window
    if key not in _built:
        while len(_built) >= BUILT:
            _built.popitem(last=False)
        _built[key] = _Block(sent.value, window)
    _built.move_to_end(key)
    return _built[key]


def _blocks(rows: Iterator, limit: int) -> Iterator[list[tuple[str, bytes]]]:
    held, size = [], 0
    for name, text in rows:
        if held and size + len(text) > limit:
            yield held
            held, size = [], 0
        held.append((name, bytes(text)))
        size += len(text)
    if held:
        yield held


def find_benchmark(
    documents: DataFrame, benchmark: DataFrame, column: str = "text", item: str = "item_id",
    item_column: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """documents with the FOUND columns: words, hit words, items met, the longest match.

    A word is hit if it lies in an occurrence of a window: so many consecutive words of an item,
    or all of a shorter one. The longest match is the longest run of words that goes on in an
    item from an occurrence; among equals the first place and the least item count. Null texts
    have no words and are hit by nothing, an item without words hits nothing, items of equal ids
    count once, a null item id stands as the empty string. Rows are neither dropped nor moved.

    The benchmark is the query set: a worker holds all of its text, and what is built of it for some
    blocks. With more blocks, documents are gathered, so that a block is built once for many.
    """
    context = documents.sparkSession.sparkContext
    named = benchmark.select(
        F.coalesce(F.col(quoted(item)).cast("string"), F.lit("")),
        F.coalesce(F.col(quoted(item_column)).cast("string").cast("binary"), F.lit(b"")))
    sent, size = [], 0
    for block in _blocks(named.toLocalIterator(), block_bytes):
        size += sum(len(text) for _, text in block)
        sent.append(context.broadcast(block))
    numbered = [(s._jbroadcast.id(), s) for s in sent]
    # All of the benchmark is looked up in every shard, so a shard is large beside it.
    at_once = min(TOGETHER, max(AT_ONCE, TIMES * size))

    def rows(texts: list[bytes]) -> list[tuple]:
        return find_in_shard(texts, (_block(n, s, window) for n, s in numbered))

    if len(sent) > BUILT:
        return over_texts(documents, column, FOUND, rows, TOGETHER, together=True)
    return over_texts(documents, column, FOUND, rows, at_once)


def contaminated(found: str = "n_hit", words: str = "n_words", share: int = 20):
    """Something is hit, and at least one word in so many."""
    return (F.col(found) > 0) & (share * F.col(found) >= F.col(words))


def remove_contaminated(
    documents: DataFrame, benchmark: DataFrame, column: str = "text", **options,
) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    return kept_rows(documents, column, lambda d: find_benchmark(d, benchmark, **options),
                     ~contaminated())

"""Long repeated byte strings, found by sorting suffixes.

Every window of 400 bytes has a mark: of its 128-byte grams the one with the least hash, the
first one among equals. Equal windows have equal marks at equal offsets, so rows meet on the mark.
Consecutive windows with one mark travel together, as one run of bytes; equal runs are counted
before they are moved, and only runs whose mark occurs elsewhere with other bytes around it are
compared. For those, what follows the mark and (backwards) what precedes it are sorted: by a
multikey sort as far as a shallow depth, then by blind tries where prefixes stay equal beyond it.
The common prefixes in both orders tell, for every window, whether another run has it.

A mark that more runs share than a task should sort is split: windows that are equal have their mark
at equal offsets, so its runs are cut into slots of a few offsets, and all windows of a slot share
a longer gram, which deals the pieces out. Equal pieces are counted before they are moved, as runs
are, and the rest is sorted in the same way. Texts move once to give the bytes of the runs that are
compared, and once to meet what goes, however large the table is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sightlake.llm.frames import fresh, quoted, with_fields
from sightlake.operators.joins import lookup_join
from sightlake.session import broadcast_if_small, stage

WINDOW, GRAM = 400, 128
SHALLOW = 192
#: Bytes of documents hashed at once; runs of a mark that are sorted together; offsets in a slot.
BLOCK, CROWD, SLOT = 1 << 20, 300, 16
#: Measured bytes of a table of marks that may be broadcast; hashed relations take several times that.
SENT = 12 << 20
#: Enough for a place in a block; the same in all blocks, so that equal windows choose alike.
PLACE_BITS = 23
_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD = (1 << 64) - 1
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, base))), dtype=np.uint64)


def _marks(data: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of some bytes where its mark starts; and every gram's hash."""
    powers = _powers(_BASE, len(data))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(
        (data.astype(np.uint64) + np.uint64(1)) * powers, dtype=np.uint64)))
    grams = (sums[gram:] - sums[:-gram]) * _powers(_BASE_INVERSE, len(data))[:len(data) - gram + 1]
    for shift in (32, 29, 32):
        grams ^= grams >> np.uint64(shift)
        grams *= np.uint64(0xD6E8FEB86659FD93)
    grams ^= grams >> np.uint64(32)
    # The hash's leading bits, then the place: the least is the first of the least grams.
    bits = np.uint64(PLACE_BITS)
    ranked = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    width = window - gram + 1
    padded = np.full(-(-len(ranked) // width) * width, np.iinfo(np.uint64).max)
    padded[:len(ranked)] = ranked
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(data) - window + 1
    least = np.minimum(behind[:n], ahead[width - 1:width - 1 + n])
    return (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64), grams


def _runs(places: list[int], texts: list[bytes], window: int, gram: int):
    """(mark, content, place, low, n, at) of all runs of windows in some documents.

    The run has n windows, the first at byte ``low``; its mark starts ``at`` bytes further on.
    Documents are hashed together; what crosses from one to the next is left out. Longer documents
    than a block go in blocks that overlap by a window, which cuts runs but loses no window.
    """
    pieces = [(place, start, text[start:start + BLOCK + window - 1])
              for place, text in zip(places, texts, strict=True)
              for start in range(0, max(1, len(text) - window + 1), BLOCK) if len(text) >= window]
    found, held, size = [], [], 0
    for piece in [*pieces, None]:
        if held and (piece is None or size + len(piece[2]) > BLOCK):
            data = np.frombuffer(b"".join(p[2] for p in held), np.uint8)
            lengths = np.array([len(p[2]) for p in held])
            ends = np.cumsum(lengths)
            marks, grams = _marks(data, window, gram)
            of = np.repeat(np.arange(len(held)), lengths)[:len(marks)]
            inside = np.flatnonzero(np.arange(len(marks)) + window <= ends[of])
            mark = marks[inside]
            new = np.flatnonzero(np.concatenate(([True], (np.diff(mark) != 0) | (np.diff(inside) != 1))))
            first, last = inside[new], inside[np.concatenate((new[1:] - 1, [len(inside) - 1]))]
            buffer, digest = data.tobytes(), xxhash.xxh3_64_intdigest
            content = np.fromiter((digest(buffer[a:b + window]) for a, b in zip(
                first.tolist(), last.tolist(), strict=True)), np.uint64, len(first))
            owner = of[first]
            low = first - (ends - lengths)[owner] + np.array([p[1] for p in held])[owner]
            found.append((
                grams[marks[first]].view(np.int64), content.view(np.int64),
                np.array([p[0] for p in held], np.int64)[owner], low, last - first + 1,
                marks[first] - first))
            held, size = [], 0
        if piece is not None:
            held.append(piece)
            size += len(piece[2])
    return [np.concatenate(x) for x in zip(*found, strict=True)] if found else [
        np.empty(0, np.int64)] * 6


_RUN = "mark long, content long, place long, low long, n long, at long"


def _all_runs(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = _runs(batch.column(0).to_pylist(),
                            [t or b"" for t in batch.column(1).to_pylist()], window, gram)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                ["mark", "content", "place", "low", "n", "at"])
    return run


def _shallow(strings: list[bytes], depth: int) -> tuple[list[list[int]], np.ndarray]:
    """Groups of strings, in order, whose prefixes of a depth are equal; and the groups' own
    common prefixes with the group before. Multikey: eight bytes at a time, ties only."""
    n = len(strings)
    held = np.zeros((n, depth + 8), np.uint8)
    for i, s in enumerate(strings):
        cut = s[:depth]
        held[i, :len(cut)] = np.frombuffer(cut, np.uint8)
    lengths = np.minimum([len(s) for s in strings], depth)
    words = held[:, :depth].copy().view(">u8").astype(np.uint64)
    order, group = np.arange(n), np.zeros(n, np.int64)
    tied = np.arange(n)
    for at in range(words.shape[1] + 1):
        own = order[tied]
        # A string that ends comes before those it is a prefix of.
        key = words[own, at] if at < words.shape[1] else lengths[own].astype(np.uint64)
        by = np.lexsort((key, group[tied]))
        order[tied] = own[by]
        key, held_group = key[by], group[tied]
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (held_group[1:] != held_group[:-1])))
        group[tied] = tied[np.flatnonzero(new)][np.cumsum(new) - 1]
        alone = new & np.concatenate((new[1:], [True]))
        tied = tied[~alone]
        if not len(tied):
            break
    cuts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    groups = [g.tolist() for g in np.split(order, cuts[1:])]
    common = np.zeros(len(groups), np.int64)
    for i in range(1, len(groups)):
        common[i] = _common(strings[groups[i - 1][-1]], strings[groups[i][0]], 0)
    return groups, common


def _common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, by halving; the first bytes are known to agree."""
    low, high = known, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) >> 1
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class _BlindTrie:
    """Orders strings with long common prefixes, holding branching bytes only.

    A node is [depth, children by byte, a string below it]. To insert, follow branching bytes
    without looking between them, compare with one string found there, and branch where they part.
    """

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root: list | None = None

    def _at(self, i: int, depth: int) -> int:
        s = self.strings[i]
        return s[depth] if depth < len(s) else -1

    def insert(self, i: int, known: int) -> None:
        if self.root is None:
            self.root = [len(self.strings[i]), None, [i]]
            return
        node = self.root
        while node[1] is not None:
            node = node[1].get(self._at(i, node[0])) or next(iter(node[1].values()))
        other = node[2][0]
        depth = _common(self.strings[i], self.strings[other], known)
        node, above, edge = self.root, None, None
        while node[1] is not None and node[0] < depth:
            above, edge = node, self._at(i, node[0])
            node = node[1][edge]
        if node[0] == depth and node[1] is not None:
            equal = node[1].get(self._at(i, depth))
            if equal is not None:
                equal[2].append(i)
            else:
                node[1][self._at(i, depth)] = [len(self.strings[i]), None, [i]]
        elif node[1] is None and node[0] == depth == len(self.strings[i]):
            node[2].append(i)
        else:
            split = [depth, {self._at(i, depth): [len(self.strings[i]), None, [i]],
                             self._at(node[2][0], depth): node}, node[2]]
            if above is None:
                self.root = split
            else:
                above[1][edge] = split

    def walk(self) -> tuple[list[int], list[int]]:
        """Strings in order, and the common prefix of each with the one before."""
        order: list[int] = []
        common: list[int] = []
        stack = [(self.root, 0)]
        while stack:
            node, shared = stack.pop()
            if node[1] is None:
                order += node[2]
                common += [shared] + [node[0]] * (len(node[2]) - 1)
            else:
                below = sorted(node[1])
                for byte in reversed(below):
                    stack.append((node[1][byte], shared if byte == below[0] else node[0]))
        return order, common


def sort_suffixes(strings: list[bytes], shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of strings, and the common prefix of each with the one before (0 for the first)."""
    if not strings:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    groups, common = _shallow(strings, shallow)
    order: list[int] = []
    prefixes: list[int] = []
    for members, before in zip(groups, common.tolist(), strict=True):
        if len(members) == 1:
            order += members
            prefixes.append(before)
            continue
        trie = _BlindTrie(strings)
        known = min(shallow, min(len(strings[m]) for m in members))
        for m in members:
            trie.insert(m, known)
        own, shared = trie.walk()
        order += own
        prefixes += [before, *shared[1:]]
    return np.array(order), np.array(prefixes)


def repeated_windows(
    runs: list[bytes], ats: np.ndarray, counts: np.ndarray, window: int, gram: int,
) -> list[list[tuple[int, int]]]:
    """For each of some distinct runs, ranges of its windows that another run has, too.

    A window starts so many bytes before the mark as its offset says. Two runs share it if they
    agree that far before the mark and, from the mark on, for the rest of the window.
    """
    n = len(runs)
    hit: list[list[int]] = [[] for _ in runs]
    if n < 2:
        return [[] for _ in runs]
    after, after_common = sort_suffixes([r[a:] for r, a in zip(runs, ats.tolist(), strict=True)])
    before, before_common = sort_suffixes([r[:a][::-1] for r, a in zip(runs, ats.tolist(), strict=True)])
    right, left = np.empty(n, np.int64), np.empty(n, np.int64)
    for offset in range(window - gram + 1):
        has = (offset <= ats) & (offset > ats - counts)
        if has.sum() < 2:
            continue
        right[after] = np.cumsum(after_common < window - offset)
        left[before] = np.cumsum(before_common < offset) if offset else 0
        rows = np.flatnonzero(has)
        key = right[rows] * (n + 1) + left[rows]
        by = np.argsort(key, kind="stable")
        same = key[by][1:] == key[by][:-1]
        twice = np.zeros(len(rows), bool)
        twice[by[1:][same]] = True
        twice[by[:-1][same]] = True
        for i in rows[twice].tolist():
            hit[i].append(int(ats[i]) - offset)
    return [_ranges(sorted(h)) for h in hit]


def _ranges(starts: list[int]) -> list[tuple[int, int]]:
    """Sorted starts as (first, past the last)."""
    found: list[tuple[int, int]] = []
    for s in starts:
        if found and found[-1][1] == s:
            found[-1] = (found[-1][0], s + 1)
        else:
            found.append((s, s + 1))
    return found


_HIT = "mark long, content long, first long, past long"


def _hit_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in columns], ["mark", "content", "first", "past"])


def _compared(window: int, gram: int):
    """Whole marks, which come sorted, are compared some thousand runs at a time."""
    def resolve(table: pa.Table) -> pa.RecordBatch:
        marks, contents, ats, counts, runs = (table.column(i).to_pylist() for i in range(5))
        found = repeated_windows(runs, np.array(ats), np.array(counts), window, gram)
        return _hit_batch([(m, c, a, b) for m, c, ranges in zip(marks, contents, found, strict=True)
                           for a, b in ranges])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= 4_000:
                table = pa.Table.from_batches(held)
                marks = table.column(0).to_numpy()
                whole = int(np.searchsorted(marks, marks[-1]))
                if whole:
                    yield resolve(table.slice(0, whole))
                    held = table.slice(whole).combine_chunks().to_batches()
        if held:
            yield resolve(pa.Table.from_batches(held))
    return run


_PIECE = "mark long, content long, at long, n long, data binary, run_mark long, run_content long, skip long"


def _pieces(window: int):
    """Runs cut by the offsets of their windows; the new mark is that of what a slot's windows share."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            rows = []
            for mark, content, at, n, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # Window j starts so many bytes before the mark as its offset, at - j, says.
                for slot in range((at - n + 1) // SLOT, at // SLOT + 1):
                    first, past = max(0, at - slot * SLOT - SLOT + 1), min(n, at - slot * SLOT + 1)
                    # What any window of the slot holds, so it lies inside the run.
                    low, high = at - slot * SLOT, at - slot * SLOT - SLOT + 1 + window
                    piece = data[first:past - 1 + window]
                    rows.append((
                        digest(data[low:high], slot) ^ mark & _WORD, digest(piece, at - first), at - first,
                        past - first, piece, mark, content, first))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 8
            signed = [np.array(columns[i], np.uint64).view(np.int64) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.binary() if i == 4 else pa.int64())
                 for i, c in enumerate([*signed, *columns[2:]])],
                ["mark", "content", "at", "n", "data", "run_mark", "run_content", "skip"])
    return run


def _sorted_hits(runs: DataFrame, window: int, gram: int) -> DataFrame:
    """Hits among distinct runs (mark, content, at, n, data), each mark's sorted together."""
    return runs.select("mark", "content", "at", "n", "data").repartition("mark").sortWithinPartitions(
        "mark").mapInArrow(_compared(window, gram), _HIT)


def _split_hits(runs: DataFrame, window: int, gram: int) -> DataFrame:
    """The same for runs of marks that many share, piece by piece."""
    pieces = stage(runs.select("mark", "content", "at", "n", "data").mapInArrow(
        _pieces(window), _PIECE), "pieces")
    own = ["run_mark", "run_content", "skip"]
    held = pieces.select("mark", "content", "n", *own)
    distinct = stage(held.groupBy("mark", "content").agg(
        F.count("*").alias("copies"), F.min(F.struct(*own)).alias("one"), F.first("n").alias("n")), "pieces")
    whole = distinct.where("copies > 1").select(
        "mark", "content", F.lit(0).cast("long").alias("first"), F.col("n").alias("past"))
    several = distinct.groupBy("mark").agg(F.count("*").alias("contents")).where("contents > 1")
    asked = lookup_join(distinct, several, ["mark"], "left_semi", broadcast_limit=SENT, hot_rows=CROWD)
    compared = pieces.join(asked.select("one.*"), own, "left_semi")
    hits = stage(whole.unionByName(_sorted_hits(compared, window, gram)), "piece_hits")
    found = lookup_join(held, hits, ["mark", "content"], "inner", broadcast_limit=SENT)
    return found.select(
        F.col("run_mark").alias("mark"), F.col("run_content").alias("content"),
        (F.col("skip") + F.col("first")).alias("first"), (F.col("skip") + F.col("past")).alias("past"))


def find_repeats(df: DataFrame, column: str, window: int = WINDOW, gram: int = GRAM,
                 crowd: int = CROWD) -> DataFrame:
    """(place, first, past): ranges of starts of windows of df's texts that start elsewhere, too.

    Places are those of ``monotonically_increasing_id`` over df, which must read alike each time.
    """
    placed = df.select(F.monotonically_increasing_id().alias("place"),
                       F.col(quoted(column)).cast("string").cast("binary").alias("text"))
    runs = stage(placed.mapInArrow(_all_runs(window, gram), _RUN), "runs")
    # One row a run: most marks occur once and end here.
    shared = stage(runs.groupBy("mark").agg(F.count("*").alias("rows")).where("rows > 1")
                   .select("mark"), "shared_marks")
    small, _ = broadcast_if_small(shared, SENT)
    again = stage(runs.join(small, "mark", "left_semi"), "shared_runs")
    distinct = stage(again.groupBy("mark", "content").agg(
        F.count("*").alias("copies"), F.min(F.struct("place", "low", "n", "at")).alias("one")),
        "contents")
    sizes = distinct.groupBy("mark").agg(F.count("*").alias("contents")).where("contents > 1")
    # A run that occurs twice is repeated throughout; it is still what others are compared with.
    whole = distinct.where("copies > 1").select(
        "mark", "content", F.lit(0).cast("long").alias("first"), F.col("one.n").alias("past"))

    asked = lookup_join(
        distinct, stage(sizes, "sizes"), ["mark"], "inner", broadcast_limit=SENT, hot_rows=crowd,
    ).select("one.place", F.struct("mark", "content", "one.low", "one.n", "one.at",
                                   (F.col("contents") > crowd).alias("crowded")).alias("run"))
    asked = stage(asked.groupBy("place").agg(F.collect_list("run").alias("asked")), "asked")
    # A merge at every size: what is asked for grows with the texts.
    cut = placed.join(asked.hint("merge"), "place").select("text", F.explode("asked").alias("run")).select(
        "run.mark", "run.content", "run.at", "run.n",
        F.substring("text", F.col("run.low").cast("int") + 1,
                    (F.col("run.n") + window - 1).cast("int")).alias("data"), "run.crowded")
    cut = stage(cut, "cut_runs", by="crowded")
    hits = whole.unionByName(_sorted_hits(cut.where(~F.col("crowded")), window, gram))
    crowded = cut.where("crowded")
    if not crowded.isEmpty():
        hits = hits.unionByName(_split_hits(crowded, window, gram))
    small, _ = broadcast_if_small(stage(hits, "hits"), SENT)
    return again.join(small, ["mark", "content"]).select(
        "place", (F.col("low") + F.col("first")).alias("first"),
        (F.col("low") + F.col("past")).alias("past"))


def remove_repeats(df: DataFrame, column: str = "text", window: int = WINDOW, gram: int = GRAM,
                   crowd: int = CROWD) -> DataFrame:
    """df with n_bytes, n_removed, n_spans and ``kept``, the bytes that stay (binary).

    A byte goes if a window that covers it starts at another place as well, in the same text or
    another; all is judged on the input. Null texts are empty, texts below a window's length stay
    whole, and of repeated rows of that length nothing stays. Ranges are put together by the row
    they are for, and meet the texts in a merge join at every size, since they grow with the texts.
    """
    place, ranges = fresh(df, "place"), fresh(df, "ranges")
    found = find_repeats(df, column, window, gram, crowd).groupBy(F.col("place").alias(place)).agg(
        F.array_sort(F.collect_set(F.struct("first", "past"))).alias(ranges))
    joined = df.withColumn(place, F.monotonically_increasing_id()).join(
        stage(found, "ranges").hint("merge"), place, "left")

    @F.arrow_udf("n_bytes long, n_removed long, n_spans long, kept binary")
    def cleaned(texts: pa.Array, gone: pa.Array) -> pa.Array:
        rows = []
        for text, windows in zip(texts, gone, strict=True):
            data = text.as_py() or b""
            spans: list[list[int]] = []
            for w in windows.as_py() or ():
                if spans and w["first"] <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], w["past"] - 1 + window)
                else:
                    spans.append([w["first"], w["past"] - 1 + window])
            edges = [0, *[x for s in spans for x in s], len(data)]
            kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            rows.append((len(data), len(data) - len(kept), len(spans), kept))
        columns = list(zip(*rows, strict=True)) if rows else [()] * 4
        return pa.StructArray.from_arrays(
            [pa.array(c, t) for c, t in zip(
                columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
            ["n_bytes", "n_removed", "n_spans", "kept"])

    text = F.col(quoted(column)).cast("string").cast("binary")
    return with_fields(joined, cleaned(text, F.col(ranges)),
                       ["n_bytes", "n_removed", "n_spans", "kept"]).drop(place, ranges)

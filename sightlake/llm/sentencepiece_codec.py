"""SentencePiece BPE by prefix tables.

In an encoding by merges, every prefix of a text has exactly one encoding, so one last token. A
token that ends at a place is that last token if it and the last token of what stands before it
would come out of the merges as just these two. The table of last tokens is filled from left to
right: an automaton yields the tokens that end at each place, a pair test picks the one that
fits, and the ids are read off backwards. Work grows with the text's length, also without blanks.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightlake.llm.frames import AT_ONCE, quoted, slices, with_columns, with_fields

#: Ways to cut a text into chunks, finest first: runs of letters and of others, each with the blank
#: marks before it; runs between blank marks; the whole text.
_CUTS = [re.compile(p) for p in (r"▁*[^\W\d_²³¹]+|▁*(?:[\d_²³¹]|[^\w▁])+|▁+", "▁*[^▁]+|▁+", r"(?s:.+)")]
#: Memory bounds of a worker; what falls out of them is computed again.
CACHED_CHUNKS, CACHED_CHUNK_CHARS, CACHED_PAIRS = 500_000, 32, 500_000


@lru_cache(2)
def processor(model_file: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=model_file)


class PrefixEncoder:
    """Ids as the library gives them for a merge-type model with byte fallback."""

    def __init__(self, model_file: str, cached: int = CACHED_CHUNKS):
        self.cached, self.cached_pairs = cached, min(CACHED_PAIRS, 4 * cached)
        self.model = processor(model_file)
        self.normalizer = sentencepiece.SentencePieceNormalizer(model_file=model_file)
        model = self.model
        self.pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.lengths = [len(p) for p in self.pieces]
        byte_ids = {}
        ids: dict[str, int] = {}
        for i, piece in enumerate(self.pieces):
            if model.is_byte(i):
                byte_ids[int(piece[1:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                ids[piece] = i
        self.fallback = [byte_ids.get(b) for b in range(256)] if byte_ids else None
        self.scores = {p: model.get_score(i) for p, i in ids.items()}
        # No merge crosses a cut that no piece crosses.
        self.cut = next(cut for cut in _CUTS if all(cut.fullmatch(p) for p in ids))
        self.automaton = ahocorasick.Automaton()
        for piece, i in ids.items():
            self.automaton.add_word(piece, (len(piece), i))
        self.automaton.make_automaton()
        self.merges: dict[int, list[tuple[float, str, str]]] = {}
        self.pairs: dict[int, bool] = {}
        #: Chunks met lately, and those met before them.
        self.chunks: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _merges(self, token: int) -> list[tuple[float, str, str]]:
        """The merges that build a piece: score, then its first and last part after each."""
        parts = [*self.pieces[token]]
        found = [(0.0, parts[0], parts[-1])]
        while len(parts) > 1:
            options = [(self.scores.get(x + y), -i) for i, (x, y) in enumerate(zip(parts, parts[1:]))]
            score, place = max(o for o in options if o[0] is not None)
            parts[-place:2 - place] = [parts[-place] + parts[1 - place]]
            found.append((score, parts[0], parts[-1]))
        self.merges[token] = found
        return found

    def _fits(self, left: int, right: int) -> bool:
        """Whether merging the characters of both pieces ends with just these two.

        Each side goes through its own merges, the better score first and the left one among
        equals, unless a merge across the border is better than the next of both sides.
        """
        ours, theirs = (self.merges.get(t) or self._merges(t) for t in (left, right))
        i = j = 0
        while True:
            across = self.scores.get(ours[i][2] + theirs[j][1])
            a = ours[i + 1][0] if i + 1 < len(ours) else None
            b = theirs[j + 1][0] if j + 1 < len(theirs) else None
            if across is not None and (a is None or across > a) and (b is None or across >= b):
                return False
            if a is not None and (b is None or a >= b):
                i += 1
            elif b is not None:
                j += 1
            else:
                return True

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a text that no merge leaves, through its table of last tokens.

        A character in no piece has -1 in the table: nothing merges with it.
        """
        # By the last character's place; the one more slot, also at -1, is the empty prefix.
        last = [-1] * (len(chunk) + 1)
        pairs, size = self.pairs, len(self.pieces)
        for end, (length, token) in self.automaton.iter(chunk):
            if last[end] < 0:
                before = last[end - length]
                if before >= 0:
                    try:
                        if not pairs[before * size + token]:
                            continue
                    except KeyError:
                        if len(pairs) >= self.cached_pairs:
                            pairs.clear()
                        fits = pairs[before * size + token] = self._fits(before, token)
                        if not fits:
                            continue
                last[end] = token
        ids: list[int] = []
        place, lengths = len(chunk) - 1, self.lengths
        while place >= 0:
            token = last[place]
            if token < 0:
                ids.extend(self._unknown(chunk[place]))
                place -= 1
            else:
                ids.append(token)
                place -= lengths[token]
        ids.reverse()
        return array("i", ids).tobytes()

    def _unknown(self, character: str) -> list[int]:
        if self.fallback is None:
            return [self.model.unk_id()]
        return [self.fallback[b] for b in reversed(character.encode())]

    def _new(self, chunk: str) -> bytes:
        found = self.chunks.get(chunk)
        if found is not None:
            return found
        found = self.older.get(chunk)
        if found is None:
            found = self._chunk(chunk)
        if len(chunk) <= CACHED_CHUNK_CHARS:
            if len(self.chunks) >= self.cached:
                self.older, self.chunks = self.chunks, {}
            self.chunks[chunk] = found
        return found

    def packed(self, text: str) -> bytes:
        """Ids of a text as 32-bit integers in the machine's order."""
        chunks = self.cut.findall(self.normalizer.normalize(text))
        found = list(map(self.chunks.get, chunks))
        if None in found:
            found = [self._new(c) if f is None else f for c, f in zip(chunks, found, strict=True)]
        return b"".join(found)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()


@lru_cache(2)
def encoder(model_file: str, cached: int = CACHED_CHUNKS) -> PrefixEncoder:
    return PrefixEncoder(model_file, cached)


def _encoded(texts: pa.Array, model_file: str, end: bool, cached: int) -> pa.ListArray:
    coder = encoder(model_file, cached)
    tail = array("i", [coder.model.eos_id()] if end else []).tobytes()
    held, offsets = bytearray(), [0]
    for text in texts:
        held += coder.packed(text.as_py() or "")
        held += tail
        offsets.append(len(held) >> 2)
    return pa.ListArray.from_arrays(np.array(offsets, np.int32), np.frombuffer(held, np.int32))


def _decoded(rows: pa.ListArray, model_file: str) -> pa.StringArray:
    model = processor(model_file)
    return pa.array([
        model.decode(r.values.to_numpy(zero_copy_only=False).tolist()) if r.is_valid else None
        for r in rows], pa.string())


def encode(df: DataFrame, model_file: str, column: str = "text", ids: str = "ids",
           end: bool = True, cached: int = CACHED_CHUNKS) -> DataFrame:
    """df with the ids of each text (array of int), the end id last if asked for.

    A null text counts as empty, which leaves the end id alone. Rows keep their places: nothing
    is shuffled, equal rows get equal ids. The model is a file that all executors have. A worker
    keeps up to twice ``cached`` chunks, some 200 bytes each, and four times as many pairs at
    most; fewer cost time only.
    """
    @F.arrow_udf("array<int>")
    def encoded(texts: pa.Array) -> pa.Array:
        return _encoded(texts, model_file, end, cached)

    return with_columns(df, {ids: encoded(F.col(quoted(column)).cast("string"))})


def decode(df: DataFrame, model_file: str, ids: str = "ids", column: str = "decoded") -> DataFrame:
    """df with the text that the ids stand for, as the library decodes them; null stays null."""
    @F.arrow_udf("string")
    def decoded(rows: pa.Array) -> pa.Array:
        return _decoded(rows, model_file)

    return with_columns(df, {column: decoded(F.col(quoted(ids)))})


def round_trip(df: DataFrame, model_file: str, column: str = "text", ids: str = "ids",
               decoded: str = "decoded", end: bool = True, cached: int = CACHED_CHUNKS) -> DataFrame:
    """What ``decode`` makes of ``encode``, in one pass: asked for both, Spark encodes twice.

    Some texts of a batch are coded at a time, and go back before the next ones are.
    """
    schema = T.StructType([
        T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.StringType())])

    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for part in slices(texts, AT_ONCE):
                found = _encoded(part, model_file, end, cached)
                yield pa.StructArray.from_arrays([found, _decoded(found, model_file)], schema.names)

    coded = F.arrow_udf(both, schema)
    return with_fields(df, coded(F.col(quoted(column)).cast("string")), schema.names)

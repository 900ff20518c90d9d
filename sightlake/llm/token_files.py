"""Token ids as Arrow files of equal-length sequences.

A shard is one Arrow IPC file. Its batches have fixed-size lists, so a sequence is a slice of a
mapped buffer and needs no decoding: ``ids`` (16 bits where the vocabulary allows it, else 32),
``mask`` (which places hold a token: only a shard's last sequence is filled up), ``first`` (where a
document begins) and, of any length, ``doc_ids`` of the documents that begin in the sequence.

Documents are dealt out by ranges of their ids before they are encoded, so a shard is encoded,
packed and written in one task, and shards in order hold documents in order. What a shard writes
depends on its rows only; it is moved to its name when whole, so a task may run again.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from sightlake.llm.frames import quoted
from sightlake.session import full_path, stage

LENGTH = 2048
BATCH_SEQUENCES = 64
CACHED_WORDS, CACHED_PIECES = 400_000, 200_000
#: Words that are looked through together for what only the library should take apart.
CHECKED = 256
#: Characters of texts that are encoded together.
TOGETHER = 8 << 20
#: Fixed value: how the word tokenizer takes lower-case text apart.
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: What only the library itself should take apart: letters and marks beyond Latin ones, special
#: tokens, and the separators that not all engines count as white space.
_OTHER = re.compile("[^\x00-įı-ɏ]|[\x1c-\x1f]|<\\|(?:startoftext|endoftext)\\|>")
_BLANKS = re.compile("[\t-\r ]+")


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies use for bytes: printable ones are themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Memo:
    """What was found for strings, in two generations: the older one goes when the younger is full."""

    def __init__(self, size: int):
        self.size = size
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def found(self, keys: list[str], find: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """Bytes for every string; new ones, each once, are found together."""
        found = list(map(self.young.get, keys))
        if None not in found:
            return found
        missing = list(dict.fromkeys([k for k, value in zip(keys, found, strict=True) if value is None]))
        held = list(map(self.old.get, missing))
        new = [k for k, value in zip(missing, held, strict=True) if value is None]
        made = iter(find(new) if new else [])
        added = {k: next(made) if value is None else value
                 for k, value in zip(missing, held, strict=True)}
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young.update(added)
        return [added[k] if value is None else value for k, value in zip(keys, found, strict=True)]


class WordEncoder:
    """Ids of the library, word by word: what stands between blanks is taken apart once.

    White space is in no piece, so a word's ids depend on nothing else. Pieces end with a token of
    their own kind, so many new ones are encoded as one text.
    """

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if self.vocabulary <= 1 << 16 else "<u4")
        self.pieces = Tokenizer(self.tokenizer.model)
        self.pieces.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        suffix = self.tokenizer.model.end_of_word_suffix
        if not suffix:
            raise ValueError("the vocabulary must mark the ends of words")
        self.final = np.zeros(self.vocabulary, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.final[i] = token.endswith(suffix)
        self.letters = {**_byte_letters(), 0x20: " "}  # what stands between pieces
        self.of_word, self.of_piece = _Memo(CACHED_WORDS), _Memo(CACHED_PIECES)

    def _packed(self, ids) -> bytes:
        return np.asarray(ids, self.dtype).tobytes()

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        joined = " ".join(pieces).encode().decode("latin-1").translate(self.letters)
        ids = np.array(self.pieces.encode(joined, add_special_tokens=False).ids, np.int64)
        data, width = self._packed(ids), self.dtype.itemsize
        cuts = [0, *((np.flatnonzero(self.final[ids]) + 1) * width).tolist()]
        return [data[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def _words(self, words: list[str]) -> list[bytes]:
        # Numbers of pieces; none for what only the library takes apart.
        pieces: list[str] = []
        sizes: list[int | None] = []
        for at in range(0, len(words), CHECKED):
            part = words[at:at + CHECKED]
            all_plain = _plain(" ".join(part))
            for word in part:
                if not (all_plain or _plain(word)):
                    sizes.append(None)
                elif word.isalpha():
                    pieces.append(word)
                    sizes.append(1)
                else:
                    own = _PIECE.findall(word)
                    pieces += own
                    sizes.append(len(own))
        found = iter(self.of_piece.found(pieces, self._pieces))
        return [
            next(found) if n == 1 else b"".join(islice(found, n)) if n is not None
            else self._packed(self.tokenizer.encode(w, add_special_tokens=False).ids)
            for w, n in zip(words, sizes, strict=True)]

    def packed(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, little-endian; a word of all of them is looked up once."""
        lines = [
            text.lower() if _plain(text) else
            " ".join([w.lower() if _plain(w) else w for w in _BLANKS.split(text)]) for text in texts]
        split = pc.ascii_split_whitespace(pa.array(lines, pa.large_string()))
        words = split.flatten().dictionary_encode()
        found = pa.array(
            self.of_word.found(words.dictionary.to_pylist(), self._words), pa.large_binary())
        ids = found.take(words.indices)
        _, ends, data = ids.buffers()
        cuts = np.frombuffer(ends, np.int64, len(ids) + 1)[split.offsets.to_numpy()].tolist()
        data = memoryview(data) if data is not None else b""
        return [bytes(data[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _plain(text: str) -> bool:
    """Whether a text holds nothing that only the library should take apart."""
    if text.isascii():
        return "<|" not in text and not (
            "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text)
    return not _OTHER.search(text)


@lru_cache(2)
def encoder(tokenizer_file: str) -> WordEncoder:
    return WordEncoder(tokenizer_file)


def file_schema(length: int, dtype: np.dtype) -> pa.Schema:
    return pa.schema([
        ("ids", pa.list_(pa.from_numpy_dtype(dtype), length)),
        ("mask", pa.list_(pa.bool_(), length)),
        ("first", pa.list_(pa.bool_(), length)),
        ("doc_ids", pa.list_(pa.int64()))])


def open_store(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a folder, and the folder's path on it."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        return pa.fs.LocalFileSystem(), path
    return pa.fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", path))


class _ShardWriter:
    """Packs documents end to end into sequences and writes them in batches."""

    def __init__(self, sink, length: int, dtype: np.dtype):
        self.length, self.dtype = length, dtype
        self.schema = file_schema(length, dtype)
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.parts: list[np.ndarray] = []
        self.starts: list[int] = []
        self.names: list = []
        self.held = self.n_tokens = self.n_docs = 0

    def add(self, name, ids: np.ndarray) -> None:
        self.starts.append(self.held)
        self.names.append(name)
        self.parts.append(ids)
        self.held += len(ids)
        self.n_tokens += len(ids)
        self.n_docs += 1
        if self.held >= self.length * BATCH_SEQUENCES:
            # Whole batches only, so a sequence's number tells its batch.
            self._write(self.held // (self.length * BATCH_SEQUENCES) * BATCH_SEQUENCES)

    def _write(self, sequences: int) -> None:
        """The first so many sequences; the last one is filled up if ids run out."""
        stream = np.concatenate(self.parts) if self.parts else np.empty(0, self.dtype)
        size = sequences * self.length
        real = min(len(stream), size)
        ids = np.zeros(size, self.dtype)
        ids[:real] = stream[:real]
        first = np.zeros(size, bool)
        here = [s for s in self.starts if s < size]
        first[here] = True
        names = pa.array(self.names[:len(here)], pa.int64())
        per = np.bincount(np.array(here, np.int64) // self.length, minlength=sequences)
        for at in range(0, sequences, BATCH_SEQUENCES):
            to = min(at + BATCH_SEQUENCES, sequences)
            a, b = at * self.length, to * self.length
            skip = int(per[:at].sum())
            offsets = np.concatenate(([0], np.cumsum(per[at:to]))).astype(np.int32)
            self.writer.write_batch(pa.RecordBatch.from_arrays([
                pa.FixedSizeListArray.from_arrays(pa.array(ids[a:b]), self.length),
                pa.FixedSizeListArray.from_arrays(pa.array(np.arange(a, b) < real), self.length),
                pa.FixedSizeListArray.from_arrays(pa.array(first[a:b]), self.length),
                pa.ListArray.from_arrays(offsets, names.slice(skip, int(offsets[-1]))),
            ], schema=self.schema))
        self.parts = [stream[size:]] if len(stream) > size else []
        self.names = self.names[len(here):]
        self.starts = [s - size for s in self.starts[len(here):]]
        self.held = max(0, self.held - size)

    def close(self) -> None:
        if self.held:
            self._write(-(-self.held // self.length))
        self.writer.close()


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of a batch, some millions of characters at a time."""
    names, texts, size = [], [], 0
    for name, text in zip(batch.column(0), batch.column(1), strict=True):
        names.append(name.as_py())
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if size > TOGETHER:
            yield names, texts
            names, texts, size = [], [], 0
    yield names, texts


def _written(folder: str, tokenizer_file: str, end_id: int, length: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = open_store(folder)
        store.create_dir(top, recursive=True)
        shard = TaskContext.get().partitionId()
        name = f"{top.rstrip('/')}/shard-{shard:06d}.arrow"
        part = f"{name}.{uuid.uuid4().hex}.part"
        coder = encoder(tokenizer_file)
        tail = np.array([end_id], coder.dtype).tobytes()
        with store.open_output_stream(part) as sink:
            shards = _ShardWriter(sink, length, coder.dtype)
            for batch in batches:
                for keys, texts in _slices(batch):
                    for key, ids in zip(keys, coder.packed(texts), strict=True):
                        shards.add(key, np.frombuffer(ids + tail, coder.dtype))
            shards.close()
        if shards.n_docs:
            store.move(part, name)
        else:
            store.delete_file(part)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x]) for x in (shard, os.path.basename(name), shards.n_docs, shards.n_tokens)],
            ["shard", "file", "n_docs", "n_tokens"])

    return run


def write_files(
    df: DataFrame, folder: str, tokenizer_file: str, end_id: int, column: str = "text",
    key: str = "doc_id", length: int = LENGTH,
) -> DataFrame:
    """Write the ids of every text, and return the manifest: shard, file, n_docs, n_tokens, start.

    Documents follow one another by ascending key, nulls first; rows of equal keys stand in the
    order of the table. Each is the text's ids and the end id, which an empty or null text has
    alone. ``start`` counts the ids in all shards before. Ranges go by key and place, so rows that
    share a key may go to several shards. Other columns are not written.
    """
    # Executors take the folder for what the driver's default file system makes of it.
    folder = full_path(df.sparkSession, folder)
    held = df.select(
        F.col(quoted(key)).cast("long").alias("doc_id"),
        F.col(quoted(column)).cast("string").alias("text"),
        F.monotonically_increasing_id().alias("place"))
    dealt = held.repartitionByRange("doc_id", "place").sortWithinPartitions("doc_id", "place")
    manifest = stage(
        dealt.select("doc_id", "text").mapInArrow(
            _written(folder, tokenizer_file, end_id, length),
            "shard long, file string, n_docs long, n_tokens long"), "manifest")
    # One row for each shard.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.where("n_docs > 0").withColumn(
        "start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long"))


def _documents(store, path: str) -> Iterator[tuple[int | None, list[np.ndarray]]]:
    """(document id, its ids in pieces) in the order of a shard's file, a batch at a time."""
    with store.open_input_file(path) as source:
        reader = pa.ipc.open_file(source)
        name, held, begun = None, [], False
        for number in range(reader.num_record_batches):
            batch = reader.get_batch(number)
            ids = batch.column("ids").flatten().to_numpy()
            mask = batch.column("mask").flatten().to_numpy(zero_copy_only=False)
            real = int(np.count_nonzero(mask))
            starts = np.flatnonzero(
                batch.column("first").flatten().to_numpy(zero_copy_only=False)).tolist()
            names = batch.column("doc_ids").flatten().to_pylist()
            if begun and (head := ids[:starts[0] if starts else real]).size:
                held.append(head)
            stops = [*starts[1:], real] if starts else []
            for start, stop, following in zip(starts, stops, names, strict=True):
                if begun:
                    yield name, held
                name, held, begun = following, [ids[start:stop]], True
        if begun:
            yield name, held


def _read(folder: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = open_store(folder)
        for batch in batches:
            for file, start in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                rows: list[tuple] = []
                for name, parts in _documents(store, f"{top.rstrip('/')}/{file}"):
                    checked, size = 0, 0
                    for part in parts:
                        checked = zlib.crc32(part.astype("<u4").tobytes(), checked)
                        size += len(part)
                    rows.append((name, start, size, checked))
                    start += size
                    if len(rows) >= 10_000:
                        yield _as_batch(rows)
                        rows = []
                yield _as_batch(rows)

    return run


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of the ids, of every document in the files."""
    # Few rows, much work: as many tasks as there are shards, up to some for each core.
    tasks = max(1, min(manifest.count(), 8 * spark.sparkContext.defaultParallelism))
    shards = manifest.select("file", "start", "shard").repartition(tasks, "shard").select(
        "file", "start")
    return shards.mapInArrow(
        _read(full_path(spark, folder)), "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_sequence(path: str, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of one sequence of a local shard; the ids are a view of the mapped file."""
    with pa.memory_map(path) as source:
        reader = pa.ipc.open_file(source)
        batch = reader.get_batch(number // BATCH_SEQUENCES)
        at = number % BATCH_SEQUENCES
        return (batch.column("ids")[at].values.to_numpy(),
                batch.column("mask")[at].values.to_numpy(zero_copy_only=False))

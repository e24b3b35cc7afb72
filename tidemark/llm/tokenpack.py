"""Token ids in patched frame-of-reference files, written and read by document order.

A file holds the ids of consecutive documents. Its ids are cut into blocks of 128; each block stores its minimum, the
differences to it packed at the width that serves 90 % of them, and an exception list with the positions and
values of the rest. Block starts are indexed, so a range of ids is read without decoding what precedes it.

Files travel as one binary cell each of a Spark table (partition, file, first, payload): Spark's committer then
makes the output whole even if executors are lost, and any store that Spark reaches will do.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import texts

BLOCK = 128
FILE_IDS = 1 << 20  # a file ends with the document that reaches this
PERCENTILE = 0.9
MAGIC = b"PFR1"
HEADER = struct.Struct("<4sIIIQ")  # magic, ids, documents, exceptions, bytes of packed blocks

FILES_SCHEMA = "part int, file int, first long, n_ids long, payload binary"


def _pack(rest: np.ndarray, width: int) -> np.ndarray:
    """(blocks, 128) values below 2**width to (blocks, 4 * width) 32-bit words."""
    lanes = np.ascontiguousarray(rest.T).astype(np.uint64)
    out = np.zeros((4 * width + 1, len(rest)), dtype=np.uint64)
    for lane in range(BLOCK):
        word, shift = divmod(lane * width, 32)
        moved = lanes[lane] << np.uint64(shift)
        out[word] |= moved & np.uint64(0xFFFFFFFF)
        out[word + 1] |= moved >> np.uint64(32)
    return np.ascontiguousarray(out[: 4 * width].T).astype("<u4")


def _unpack(packed: np.ndarray, width: int) -> np.ndarray:
    words = np.zeros((4 * width + 1, len(packed)), dtype=np.uint64)
    words[: 4 * width] = packed.T
    out = np.empty((BLOCK, len(packed)), dtype=np.uint32)
    mask = np.uint64((1 << width) - 1)
    for lane in range(BLOCK):
        word, shift = divmod(lane * width, 32)
        both = words[word] | (words[word + 1] << np.uint64(32))
        out[lane] = (both >> np.uint64(shift)) & mask
    return out.T


def write_file(doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """One file: header, document table, block table (index of starts), packed blocks, exceptions."""
    count = len(ids)
    blocks = -(-count // BLOCK)
    padded = np.empty(blocks * BLOCK, dtype=np.uint32)
    padded[:count] = ids
    if count:
        padded[count:] = ids[-1]
    padded = padded.reshape(blocks, BLOCK)
    least = padded.min(axis=1) if blocks else np.empty(0, dtype=np.uint32)
    rest = padded - least[:, None]
    place = int(np.ceil(PERCENTILE * BLOCK)) - 1
    usual = np.partition(rest, place, axis=1)[:, place] if blocks else least
    widths = np.frexp(usual.astype(np.float64))[1].astype(np.uint8)  # bit lengths
    beyond = rest >= (np.uint64(1) << widths.astype(np.uint64))[:, None]
    row, position = np.nonzero(beyond)
    values = rest[beyond].astype("<u4")
    rest = np.where(beyond, 0, rest)
    starts = np.concatenate([[0], np.cumsum(widths.astype(np.int64) * (BLOCK // 8))]).astype("<u8")
    body = np.zeros(int(starts[-1]), dtype=np.uint8)
    for width in np.unique(widths):
        if width:
            chosen = np.flatnonzero(widths == width)
            packed = _pack(rest[chosen], int(width)).view(np.uint8)
            body[starts[chosen].astype(np.int64)[:, None] + np.arange(packed.shape[1])] = packed
    exceptions = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=blocks))]).astype("<u4")
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    parts = [
        HEADER.pack(MAGIC, count, len(doc_ids), len(values), len(body)),
        known.tobytes(),
        np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(),
        np.asarray(sizes, dtype="<u4").tobytes(),
        least.astype("<u4").tobytes(),
        widths.tobytes(),
        starts.tobytes(),
        exceptions.tobytes(),
        body.tobytes(),
        position.astype(np.uint8).tobytes(),
        values.tobytes(),
    ]
    return b"".join(parts)


class PackedFile:
    """Reader of one file: the document table at once, ids by range."""

    def __init__(self, payload: bytes):
        magic, self.count, documents, extra, body = HEADER.unpack_from(payload)
        if magic != MAGIC:
            raise ValueError("not a packed id file")
        blocks = -(-self.count // BLOCK)
        at = HEADER.size

        def take(kind: str, number: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, dtype=kind, count=number, offset=at)
            at += out.nbytes
            return out

        known, numbers = take("u1", documents), take("<i8", documents)
        self.doc_ids = [int(n) if k else None for n, k in zip(numbers, known)]
        self.sizes = take("<u4", documents).astype(np.int64)
        self.least, self.widths, self.starts = take("<u4", blocks), take("u1", blocks), take("<u8", blocks + 1)
        self.exceptions, self.body = take("<u4", blocks + 1), take("u1", body)
        self.positions, self.values = take("u1", extra), take("<u4", extra)

    def ids(self, start: int = 0, end: int | None = None) -> np.ndarray:
        """The ids from ``start`` to before ``end``; only the blocks that hold them are decoded."""
        end = self.count if end is None else min(end, self.count)
        if start >= end:
            return np.empty(0, dtype=np.uint32)
        first, last = start // BLOCK, -(-end // BLOCK)
        widths = self.widths[first:last]
        rest = np.zeros((last - first, BLOCK), dtype=np.uint32)
        for width in np.unique(widths):
            if width:
                chosen = np.flatnonzero(widths == width)
                place = self.starts[first + chosen].astype(np.int64)[:, None] + np.arange(int(width) * BLOCK // 8)
                rest[chosen] = _unpack(self.body[place].view("<u4"), int(width))
        low, high = int(self.exceptions[first]), int(self.exceptions[last])
        row = np.repeat(np.arange(last - first), np.diff(self.exceptions[first : last + 1].astype(np.int64)))
        rest[row, self.positions[low:high]] = self.values[low:high]
        rest += self.least[first:last, None]
        return rest.ravel()[start - first * BLOCK : end - first * BLOCK]


class Chunks(dict):
    """Numbers of the white-space-separated chunks seen; new ones wait in ``pending``."""

    pending: list[str]

    def __missing__(self, chunk: str) -> int:
        number = self[chunk] = len(self) + 1
        self.pending.append(chunk)
        return number


def byte_letters() -> dict[int, str]:
    """Translation of Latin-1 characters to the letters of byte-level vocabularies.

    Such a vocabulary names printable bytes by themselves and the others, in order, by the characters from 256 on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {b: chr(b) for b in printable}
    names |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in names)}
    return {c: "".join(names[b] for b in chr(c).encode()) for c in range(256)}


class Encoder:
    """Batches of texts to ids, with the ids of repeated chunks kept for the life of the worker.

    A chunk of letters, with or without punctuation behind it, is one word of the library's model, which is asked
    directly: the look-up of words is then short, and a word is learned once whatever stands behind it.

    Only for tokenizers that drop white space, lower-case, and never join ids across it (checked on load). A text goes
    to the library whole if it is not Latin-1 or holds a rare separator or what may be a special token.
    """

    LIMIT = 700_000  # chunks kept; beyond, those met most go on, at most half
    TAIL = ".,;:!?"  # punctuation that may stand behind a word

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer, self.end_id = Tokenizer.from_file(path), end_id
        probe = ["Ab cD", "don't  stop\nA.b", "É à\t12"]
        split = [[i for w in p.lower().split() for i in self._library([w])[0]] for p in probe]
        self.by_chunk = split == self._library(probe)
        self.letters, self.tails, self.by_word = byte_letters(), {}, True
        single = [chr(c) for c in range(256) if chr(c).isalpha() and chr(c).lower() == chr(c)]
        probe = [*single, "".join(single), "hello", "naïve", "straße", "überall", "thés"]
        probe += [w + t for w in probe[-5:] for t in (".", ",", "?!", "...", ";:")]
        self.words: dict[str, tuple[int, ...]] = {}
        try:
            self.by_word = [self._word(w) for w in probe] == [tuple(ids) for ids in self._library(probe)]
        except Exception:  # a model that takes no single words
            self.by_word = False
        self._empty()

    def _word(self, chunk: str) -> tuple[int, ...] | None:
        """The ids of a chunk that is a word with or without a tail; None if the whole library must see it."""
        word = chunk.rstrip(self.TAIL)
        if not (self.by_word and word.isalpha()):
            return None
        ids = self.words.get(word)
        if ids is None:
            # tuples of numbers are nothing for the garbage collector to walk
            letters = word if word.isascii() else word.translate(self.letters)
            ids = self.words[word] = tuple([t.id for t in self.tokenizer.model.tokenize(letters)])
        if len(word) == len(chunk):
            return ids
        tail = chunk[len(word) :]
        if tail not in self.tails:
            if len(self.tails) > 1000:
                self.tails.clear()
            self.tails[tail] = tuple(self._library([tail])[0])
        return ids + self.tails[tail]

    def _library(self, batch: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)]

    def _empty(self) -> None:
        self.chunks = Chunks()
        self.chunks.pending = []
        self.words.clear()
        self.store = np.zeros(1 << 20, dtype=np.uint32)  # number 0 is the end id
        self.store[0] = self.end_id
        self.used = 1
        self.starts, self.sizes = np.zeros(1, dtype=np.int64), np.ones(1, dtype=np.int64)
        self.met = np.zeros(1, dtype=np.int64)

    def _keep_common(self) -> None:
        """Forget the chunks met once, and so many of the rarer others that at most half of ``LIMIT`` is left."""
        counts = self.met[1:]
        rarest = np.partition(counts, len(counts) - self.LIMIT // 2)[-(self.LIMIT // 2)] if len(counts) > self.LIMIT // 2 else 0
        kept = np.flatnonzero(counts > max(1, rarest)) + 1
        place = np.concatenate([[0], kept])
        stays = np.zeros(len(counts) + 1, dtype=bool)
        stays[kept] = True
        common = [chunk for chunk, stay in zip(self.chunks, stays[1:].tolist()) if stay]
        self.chunks = Chunks(zip(common, range(1, len(common) + 1)))
        self.chunks.pending = []
        # a chunk found again must be met as often to stay next time
        self.met = self.met[place] // 2
        begins, self.sizes = self.starts[place], self.sizes[place]
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.used = int(self.sizes.sum())
        held = self.store[np.repeat(begins - self.starts, self.sizes) + np.arange(self.used)]
        self.store[: self.used] = held
        self.words = {word: ids for word, ids in self.words.items() if word in self.chunks}

    def _by_offsets(self, chunks: list[str]) -> Iterator[list[int]]:
        """The ids of each chunk, told apart by their offsets in joined texts."""
        groups = [chunks[i : i + 1000] for i in range(0, len(chunks), 1000)]
        encoded = self.tokenizer.encode_batch([" ".join(g) for g in groups], add_special_tokens=False)
        for group, encoding in zip(groups, encoded):
            begins = np.cumsum([0] + [len(c) + 1 for c in group[:-1]])
            place = np.fromiter((o[0] for o in encoding.offsets), dtype=np.int64, count=len(encoding.ids))
            counts = np.bincount(np.searchsorted(begins, place, side="right") - 1, minlength=len(group))
            ends = np.cumsum(counts)
            ids = encoding.ids
            yield from (ids[a:b] for a, b in zip((ends - counts).tolist(), ends.tolist()))

    def _learn(self) -> None:
        pending, self.chunks.pending = self.chunks.pending, []
        known = [self._word(chunk) for chunk in pending]
        others = self._by_offsets([c for c, ids in zip(pending, known) if ids is None])
        known = [next(others) if ids is None else ids for ids in known]
        size = np.fromiter(map(len, known), dtype=np.int64, count=len(known))
        ids = np.fromiter(chain.from_iterable(known), dtype=np.uint32, count=int(size.sum()))
        while self.used + len(ids) > len(self.store):
            self.store = np.concatenate([self.store, np.zeros_like(self.store)])
        self.store[self.used : self.used + len(ids)] = ids
        starts = self.used + np.cumsum(size) - size
        self.used += len(ids)
        self.starts, self.sizes = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, size])
        self.met = np.concatenate([self.met, np.zeros(len(size), dtype=np.int64)])

    @staticmethod
    def _plain(text: str) -> bool:
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return len(raw.translate(None, b"\x1c\x1d\x1e\x1f\x85\xa0")) == len(raw) and "<|" not in text

    def encode(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, an end id after each, and their numbers."""
        if len(self.chunks) > self.LIMIT:
            self._keep_common()
        plain = [self.by_chunk and self._plain(t) for t in batch]
        rows = [t.lower().split() if p else [] for t, p in zip(batch, plain)]
        number = self.chunks.__getitem__
        places = [np.fromiter(map(number, row), dtype=np.int64, count=len(row)) for row in rows]
        if self.chunks.pending:
            self._learn()
        end = np.zeros(1, dtype=np.int64)
        flat = np.concatenate([x for p in places for x in (p, end)])
        self.met += np.bincount(flat, minlength=len(self.met))
        size = self.sizes[flat]
        ahead = np.cumsum(size) - size
        ids = self.store[np.repeat(self.starts[flat] - ahead, size) + np.arange(int(size.sum()))]
        ends = np.cumsum([len(p) + 1 for p in places])
        sizes = np.diff(np.concatenate([[0], (ahead + size)[ends - 1]]))
        odd = [i for i, p in enumerate(plain) if not p]
        if odd:
            pieces = np.split(ids, np.cumsum(sizes)[:-1])
            for i, whole in zip(odd, self._library([batch[i] for i in odd])):
                pieces[i] = np.array([*whole, self.end_id], dtype=np.uint32)
            ids, sizes = np.concatenate(pieces), np.array([len(p) for p in pieces], dtype=np.int64)
        return ids, sizes


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, end_id: int) -> Encoder:
    """The worker's encoder for this vocabulary file."""
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = Encoder(path, end_id)
    return _ENCODERS[path, end_id]


def write_ids(docs: DataFrame, vocabulary: str, end_id: int = 2, path: str | None = None) -> str:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order and write the files; returns their table's path.

    ``vocabulary``: a tokenizer file that every executor can read. Null texts count as empty and give the end
    id alone. Null doc_ids come first; rows of equal doc_id are ordered by their text's hash. An empty table
    gives no file.
    """
    spark = docs.sparkSession
    order = ["doc_id", F.xxhash64("text")]
    placed = texts(docs).repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, end_id).encode
        part, file, first = TaskContext.get().partitionId(), 0, 0
        held_docs: list = []
        held_sizes: list[np.ndarray] = []
        held_ids: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            payload = write_file(held_docs, np.concatenate(held_sizes), np.concatenate(held_ids))
            cells = [[part], [file], [first], [size], [payload]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=k) for c, k in zip(cells, kinds)],
                names=["part", "file", "first", "n_ids", "payload"],
            )

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                few = batch.slice(start, 256)
                ids, sizes = encode([t or "" for t in few.column(1).to_pylist()])
                held_docs += few.column(0).to_pylist()
                held_sizes.append(sizes)
                held_ids.append(ids)
                size += len(ids)
                if size >= FILE_IDS:
                    yield flush()
                    file, first = file + 1, first + size
                    held_docs, held_sizes, held_ids, size = [], [], [], 0
        if held_docs:
            yield flush()

    files = placed.mapInArrow(run, FILES_SCHEMA)
    if path is None:
        from tidemark.session import scratch_path

        path = scratch_path(spark, "token-ids")
    files.write.option("compression", "none").parquet(path)
    return path


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """The documents of written files: doc_id, start, n_tokens, ids_crc32 and (if wanted) ``ids``.

    ``start`` counts the ids of all documents before, over all files: each task's total is one row, so the
    running sum is over as many rows as there were tasks.
    """
    files = spark.read.parquet(path)
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    ahead = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = files.join(F.broadcast(totals.select("part", ahead.alias("ahead"))), "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                file = PackedFile(payload)
                ids = file.ids().astype("<u4")
                ends = np.cumsum(file.sizes)
                begins = ends - file.sizes
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(begins.tolist(), ends.tolist())]
                columns = [
                    pa.array(file.doc_ids, type=pa.int64()),
                    pa.array(start + begins),
                    pa.array(file.sizes),
                    pa.array(crcs, type=pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    offsets = np.concatenate([[0], ends]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(offsets, ids.astype(np.int32)))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    begin = (F.col("ahead") + F.col("first")).alias("start")
    return placed.select(begin, "payload").mapInArrow(run, schema)


__all__ = ["Encoder", "PackedFile", "read_ids", "write_file", "write_ids"]

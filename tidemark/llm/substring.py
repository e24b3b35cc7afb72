"""Repeated passages: Rabin-Karp hashes of every window of words, counted in Spark, merged into removal intervals.

A task hashes all windows of some rows at once (running sums of word hash times base power, so a window is one
difference). What repeats inside those rows is settled there; every other hash goes once to the bucket of its leading
bits, packed with the place where it first starts. A bucket keeps the first start of each hash and answers with the others,
packed by the documents they belong to. There the answers meet the texts, and covered words are removed.

A hash that a third of all rows hold thus crosses as one entry per task, never as its rows. Buckets and destinations
are counted from the bytes of the texts, so a task holds a bounded number of entries at any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, texts

WINDOW = 20
CHUNK_WORDS = 1 << 21  # words that a task hashes at once; a longer text is a chunk of its own
BUCKET_BYTES = 12 << 20  # bytes of text per bucket of hashes: some two million windows
PLACE_BYTES = 8 << 20  # bytes of text per destination of the answers
CACHE_WORDS = 1 << 18
BASE, SECOND_BASE, MIX = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD  # odd
LAST = (1 << 63) - 1  # a null doc_id comes after all others
FIELDS = [("hash", 8), ("check", 2), ("doc", 8), ("tag", 8), ("start", 4)]
PLACES = FIELDS[2:]


class WordHashes(dict):
    """XXH64 of words; emptied when full, which changes no value."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _powers(base: int, size: int) -> np.ndarray:
    factors = np.full(size + 1, base, dtype=np.uint64)
    factors[0] = 1
    return np.cumprod(factors, dtype=np.uint64)


class Roller:
    """Polynomial hashes modulo 2^64 of the windows of a word sequence, by a 64-bit and a further 16-bit hash."""

    def __init__(self, window: int):
        self.window, self.size = window, 0

    def _reserve(self, size: int) -> None:
        if size > self.size:
            self.size = size
            self.up = [_powers(b, size) for b in (BASE, SECOND_BASE)]
            self.down = [_powers(pow(b, -1, 1 << 64), size) for b in (BASE, SECOND_BASE)]

    def windows(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        count = len(words) - self.window + 1
        self._reserve(len(words))
        hashes = []
        for values, up, down in zip((words, (words ^ (words >> np.uint64(31))) * np.uint64(MIX)), self.up, self.down):
            sums = np.zeros(len(words) + 1, dtype=np.uint64)
            np.cumsum(values * up[: len(words)], out=sums[1:])
            hashes.append((sums[self.window :] - sums[: -self.window]) * down[:count])
        return hashes[0], (hashes[1] >> np.uint64(48)).astype(np.uint16)


def pack(columns: dict[str, np.ndarray], fields: list[tuple[str, int]]) -> bytes:
    """Byte planes of integer columns, empty planes left out; the first column ascends and is stored as differences."""
    size = len(columns[fields[0][0]])
    flags, planes = [], []
    for number, (name, width) in enumerate(fields):
        values = columns[name].astype(f"<u{width}")
        if number == 0:
            values = np.diff(values, prepend=values.dtype.type(0))
        for plane in np.ascontiguousarray(values.view(np.uint8).reshape(size, width).T):
            flags.append(plane.any())
            if flags[-1]:
                planes.append(plane.tobytes())
    raw = np.packbits(np.array(flags)).tobytes() + b"".join(planes)
    return bytes([len(planes)]) + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def unpack(blob: bytes, size: int, fields: list[tuple[str, int]]) -> dict[str, np.ndarray]:
    widths = sum(width for _, width in fields)
    head = -(-widths // 8)
    raw = pa.Codec("zstd").decompress(blob[1:], head + blob[0] * size, asbytes=True)
    raw = np.frombuffer(raw, dtype=np.uint8)
    flags = np.unpackbits(raw[:head])[:widths].astype(bool)
    planes = np.zeros((widths, size), dtype=np.uint8)
    planes[flags] = raw[head:].reshape(-1, size)
    columns, at = {}, 0
    for number, (name, width) in enumerate(fields):
        values = np.ascontiguousarray(planes[at : at + width].T).view(f"<u{width}").reshape(size)
        columns[name] = np.cumsum(values, dtype=values.dtype) if number == 0 else values
        at += width
    return columns


def _later(columns: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of entries sorted by hash: positions of those whose sequence starts earlier too, and of the first ones."""
    same = np.zeros(len(columns["hash"]) + 1, dtype=bool)
    same[1:-1] = columns["hash"][1:] == columns["hash"][:-1]
    group = np.flatnonzero(same[1:] | same[:-1])
    if not len(group):
        return group, np.arange(len(columns["hash"]))
    part = {name: values[group] for name, values in columns.items()}
    order = np.lexsort([part[n] for n in ("start", "tag", "doc", "check", "hash")])
    part = {name: values[order] for name, values in part.items()}
    begins = np.ones(len(order), dtype=bool)
    begins[1:] = (part["hash"][1:] != part["hash"][:-1]) | (part["check"][1:] != part["check"][:-1])
    lead = np.maximum.accumulate(np.where(begins, np.arange(len(order)), 0))
    tied = np.ones(len(order), dtype=bool)  # at the very place of the first one: a repeated row, not an earlier start
    for name in ("doc", "tag", "start"):
        tied &= part[name] == part[name][lead]
    first = np.ones(len(columns["hash"]), dtype=bool)
    first[group[order[~begins]]] = False
    return group[order[~tied]], np.flatnonzero(first)


def _ordered(doc_id: np.ndarray) -> np.ndarray:
    """Longs as unsigned numbers of the same order."""
    return doc_id.view(np.uint64) ^ np.uint64(1 << 63)


def _signed(doc: np.ndarray) -> np.ndarray:
    return (doc ^ np.uint64(1 << 63)).view(np.int64)


def _answers(columns: dict[str, np.ndarray], chosen: np.ndarray, places: int) -> Iterator[tuple[int, int, bytes]]:
    """The chosen starts packed by destination: (destination, count, blob)."""
    part = {name: columns[name][chosen] for name, _ in PLACES}
    goal = _destination(part["doc"], places)
    order = np.lexsort([part["start"], part["tag"], part["doc"], goal])
    goal = goal[order]
    edges = np.flatnonzero(np.r_[True, goal[1:] != goal[:-1], True]) if len(goal) else []
    for start, end in zip(edges[:-1], edges[1:]):
        rows = order[start:end]
        yield int(goal[start]), len(rows), pack({n: part[n][rows] for n, _ in PLACES}, PLACES)


def _destination(doc: np.ndarray, places: int) -> np.ndarray:
    key = doc ^ np.uint64(1 << 63)
    return np.mod((key ^ (key >> np.uint64(15)) ^ (key >> np.uint64(31))).view(np.int64), places)


def _destination_column(key: Column, places: int) -> Column:
    """The destination that ``_destination`` gives."""
    mixed = key.bitwiseXOR(F.shiftrightunsigned(key, 15)).bitwiseXOR(F.shiftrightunsigned(key, 31))
    return F.pmod(mixed, F.lit(places))


def _hashed(window: int, buckets: int, places: int):
    """(doc_id, tag, text) to packed first starts per bucket (kind 0) and starts known to be later ones (kind 1)."""

    def chunk(roller: Roller, docs: list, tags: list, words: list[np.ndarray]) -> Iterator[tuple[int, int, int, bytes]]:
        flat = np.concatenate(words)
        if len(flat) < window:
            return
        sizes = np.array([len(w) for w in words])
        begin = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(words)), np.maximum(sizes - window + 1, 0))
        count = np.bincount(owner, minlength=len(words))
        start = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        hashes, check = roller.windows(flat)
        at = begin[owner] + start
        order = np.argsort(hashes[at], kind="stable")
        at, owner, start = at[order], owner[order], start[order]
        columns = {
            "hash": hashes[at],
            "check": check[at],
            "doc": _ordered(np.array(docs, dtype=np.int64))[owner],
            "tag": np.array(tags, dtype=np.int64).view(np.uint64)[owner],
            "start": start.astype(np.uint32),
        }
        later, first = _later(columns)
        for goal, size, blob in _answers(columns, later, places):
            yield 1, goal, size, blob
        columns = {name: values[first] for name, values in columns.items()}
        bucket = (columns["hash"] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            yield 0, int(bucket[a]), b - a, pack({n: v[a:b] for n, v in columns.items()}, FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, roller = WordHashes(), Roller(window)
        docs, tags, words, held = [], [], [], 0
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist())
            for doc, tag, text in rows:
                found = text.split() if text else []
                if held and held + len(found) > CHUNK_WORDS:
                    yield from rows_of(chunk(roller, docs, tags, words))
                    docs, tags, words, held = [], [], [], 0
                docs.append(doc)
                tags.append(tag)
                words.append(np.fromiter(map(known.__getitem__, found), np.uint64, len(found)))
                held += len(found)
        if held:
            yield from rows_of(chunk(roller, docs, tags, words))

    return run


ROW = "kind int, goal long, size long, blob binary"
ROW_ARROW = pa.schema([("kind", pa.int32()), ("goal", pa.int64()), ("size", pa.int64()), ("blob", pa.binary())])


def rows_of(rows: Iterator[tuple[int, int, int, bytes]]) -> Iterator[pa.RecordBatch]:
    """Batches of packed rows, each of some megabytes at most."""
    schema = ROW_ARROW
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[3])
        if size > 4 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _counted(places: int):
    """Rows of whole buckets (sorted by kind and goal) to the starts that are not the first of their hash."""

    def bucket(held: list[tuple[int, bytes]]) -> Iterator[tuple[int, int, int, bytes]]:
        parts = [unpack(blob, size, FIELDS) for size, blob in held]
        columns = {name: np.concatenate([p[name] for p in parts]) for name, _ in FIELDS}
        order = np.argsort(columns["hash"], kind="stable")
        columns = {name: values[order] for name, values in columns.items()}
        for goal, size, blob in _answers(columns, _later(columns)[0], places):
            yield 1, goal, size, blob

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            held, last = [], None
            for batch in batches:
                for kind, goal, size, blob in zip(*(c.to_pylist() for c in batch.columns)):
                    if kind == 1:
                        yield kind, goal, size, blob
                        continue
                    if goal != last and held:
                        yield from bucket(held)
                        held = []
                    last = goal
                    held.append((size, blob))
            if held:
                yield from bucket(held)

        yield from rows_of(rows())

    return run


SPANS = "doc_id long, n_words long, n_removed long, spans array<struct<start:int,length:int>>, kept string"
SPAN_ARROW = pa.struct([("start", pa.int32()), ("length", pa.int32())])
SPANS_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(SPAN_ARROW)), ("kept", pa.string())]
)


def _cut(window: int):
    """Per destination the answers (kind 0), then the texts (kind 1), to the texts without the covered words."""
    schema = SPANS_ARROW

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        goal, parts, index = None, [], None
        for batch in batches:
            out = []
            names = batch.schema.names
            rows = zip(*(batch.column(names.index(n)).to_pylist() for n in ("goal", "kind", "size", "doc_id", "tag")), batch.column(names.index("blob")).to_pylist())
            for at, kind, size, doc, tag, blob in rows:
                if at != goal:
                    goal, parts, index = at, [], None
                if kind == 0:
                    parts.append(unpack(blob, size, PLACES))
                    continue
                if index is None:
                    index, parts = _index(parts), []
                words = (blob or b"").split()
                spans = _merged(index.get((LAST if doc is None else doc, tag)), window)
                kept, last = [], 0
                for start, length in spans:
                    kept += words[last:start]
                    last = start + length
                kept += words[last:]
                listed = [{"start": a, "length": b} for a, b in spans]
                out.append((doc, len(words), len(words) - len(kept), listed, b" ".join(kept).decode()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def _index(parts: list[dict[str, np.ndarray]]) -> dict[tuple[int, int], np.ndarray]:
    """Sorted starts by (doc_id, tag)."""
    if not parts:
        return {}
    doc, tag, start = (np.concatenate([p[n] for p in parts]) for n, _ in PLACES)
    order = np.lexsort([start, tag, doc])
    doc, tag, start = _signed(doc[order]), tag[order].view(np.int64), start[order].astype(np.int64)
    edges = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]), True])
    return {(int(doc[a]), int(tag[a])): start[a:b] for a, b in zip(edges[:-1], edges[1:])}


def _merged(starts: np.ndarray | None, window: int) -> list[tuple[int, int]]:
    """Maximal intervals (start, length) covered by windows at the sorted ``starts``."""
    if starts is None:
        return []
    breaks = np.flatnonzero(np.diff(starts) > window)
    first = np.r_[starts[0], starts[breaks + 1]]
    last = np.r_[starts[breaks], starts[-1]] + window
    return list(zip(first.tolist(), (last - first).tolist()))


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, ``spans`` and ``kept``.

    A window is ``window`` consecutive words (of anything but ASCII white space) of one document. Words covered by a
    window whose sequence also starts earlier (smaller doc_id, or the same document before) are removed; ``spans``
    are the maximal removed intervals, ``kept`` the other words joined by one space. A null text has no words. A null
    doc_id comes after all others. Rows with one doc_id are ordered by a hash of their texts; equal rows are one
    document and get the same result. Sequences are told apart by 80 bits of hash.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = texts(docs).select(F.coalesce("doc_id", F.lit(LAST)).alias("key"), "doc_id", "text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    twice = rows.groupBy("key").count().filter("count > 1").select("key")
    if twice.isEmpty():
        rows = rows.withColumn("tag", F.lit(0).cast("long"))
    else:
        rows = rows.join(twice.withColumn("twice", F.lit(True)), "key", "left")
        rows = rows.withColumn("tag", F.when(F.col("twice"), F.xxhash64("text")).otherwise(F.lit(0)).cast("long")).drop("twice")
    buckets, places = -(-total // BUCKET_BYTES) or 1, -(-total // PLACE_BYTES) | 1
    hashed = rows.select("key", "tag", "text").mapInArrow(_hashed(window, buckets, places), ROW)
    counted = hashed.repartition("kind", "goal").sortWithinPartitions("kind", "goal").mapInArrow(_counted(places), ROW)
    answers = counted.select(F.lit(0).alias("kind"), "goal", "size", F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("tag"), "blob")
    whole = rows.select(F.lit(1).alias("kind"), _destination_column(F.col("key"), places).alias("goal"), F.lit(0).cast("long").alias("size"), "doc_id", "tag", F.col("text").cast("binary").alias("blob"))
    placed = answers.unionByName(whole).repartition("goal").sortWithinPartitions("goal", "kind")
    return placed.mapInArrow(_cut(window), SPANS)

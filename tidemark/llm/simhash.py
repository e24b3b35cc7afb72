"""SimHash fingerprints and near-duplicate groups by shared blocks and Hamming distance.

The pigeonhole principle gives every pair within the radius: of ``radius + agree`` blocks at most ``radius`` can
differ, so some ``agree`` blocks are equal, and each choice of ``agree`` blocks is one key.

Equal fingerprints collapse to one row before the join. Keys held by one fingerprint are dropped, a key
held by many is cut into chunks. A chunk returns a spanning forest of its links, never its pairs. Chunks of a
key that still lie in several components afterwards are compared with each other, so no link is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    mapped,
    materialize,
    min_labels,
    run_bounds,
    sorted_runs,
    spread,
    text_bytes,
    texts,
)
from tidemark.llm.components import connected_components

CHUNK = 2048  # rows of one key that a task compares at once
SEED = 42


@dataclass(frozen=True)
class SimHash:
    """``words`` per shingle, ``radius``: links at that many or fewer of 64 differing bits, ``agree`` blocks are one key."""

    words: int = 4
    radius: int = 4
    agree: int = 3


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of each word shingle of a lower-cased text; fewer words give one shingle, none gives none."""
    tokens = text.lower().split()
    digest = xxhash.xxh64_intdigest
    if len(tokens) <= words:
        hashes = [digest(b" ".join(tokens), SEED)] if tokens else []
    else:
        hashes = [digest(b" ".join(s), SEED) for s in zip(*(tokens[i:] for i in range(words)))]
    return np.array(hashes, dtype=np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if set in over half the hashes; without hashes it is zero."""
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 8192):
        raw = np.ascontiguousarray(hashes[start : start + 8192].astype("<u8")).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, spec: SimHash = SimHash()) -> DataFrame:
    """One row (doc_id, w0) per row of ``docs``; w0 is the fingerprint as a signed long.

    Null and wordless texts have fingerprint zero.
    """

    def run(batch: pa.RecordBatch):
        prints = [fingerprint(shingle_hashes(text, spec.words)) for text in text_bytes(batch.column(1))]
        yield [batch.column(0), np.array(prints, dtype=np.uint64).view(np.int64)]

    return mapped(texts(docs), run, "doc_id long, w0 long")


def _block_keys(spec: SimHash) -> Column:
    """One key per choice of blocks: its number, then the bits of the blocks."""
    blocks = spec.radius + spec.agree
    edges = [64 * i // blocks for i in range(blocks + 1)]
    bits = {
        i: F.shiftrightunsigned("w0", edges[i]).bitwiseAND(F.lit((1 << (edges[i + 1] - edges[i])) - 1))
        for i in range(blocks)
    }
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), spec.agree)):
        key, shift = F.lit(0).cast("long"), 0
        for i in chosen:
            key = key.bitwiseOR(F.shiftleft(bits[i], shift))
            shift += edges[i + 1] - edges[i]
        keys.append(key.bitwiseOR(F.lit(number << shift).cast("long")))
    return F.array(*keys)


def _forests(members: DataFrame, spec: SimHash) -> DataFrame:
    """(key, chunk, uid, w0) to the edges (src, dst) of a spanning forest of each chunk's links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in sorted_runs(batches, ["key", "chunk"]):
            words = columns["w0"].astype(np.int64).view(np.uint64)
            for start, end in run_bounds(columns, ["key", "chunk"]):
                part, uid = words[start:end], columns["uid"][start:end]
                labels = min_labels(np.bitwise_count(part[:, None] ^ part[None, :]) <= spec.radius)
                tied = np.flatnonzero(labels != np.arange(len(labels)))
                if len(tied):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(uid[tied]), pa.array(uid[labels[tied]])], names=["src", "dst"]
                    )

    placed = members.select("key", "chunk", "uid", "w0")
    placed = placed.repartition("key", "chunk").sortWithinPartitions("key", "chunk")
    return placed.mapInArrow(run, "src long, dst long")


def shared_keys(keys: DataFrame) -> DataFrame:
    """(key, uid) rows of keys that more than one row holds, with the number ``n`` of their rows."""
    counts = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return keys.join(counts.hint("shuffle_hash"), "key")


def group_fingerprints(unique: DataFrame, spec: SimHash, chunk: int = CHUNK) -> DataFrame:
    """Components of distinct fingerprints (uid, w0): rows (node, root) for those with a link."""
    count = unique.count()
    number = math.comb(spec.radius + spec.agree, spec.agree)
    keys = spread(unique, count * number).select(F.explode(_block_keys(spec)).alias("key"), "uid")
    held = materialize(shared_keys(keys), "blocks")
    most = held.agg(F.max("n")).first()[0] or 0
    words = unique.select("uid", "w0")
    slots = F.ceil(F.col("n") / chunk).cast("long")
    slot = F.pmod(F.xxhash64("uid", "key"), slots)
    edges = materialize(_forests(held.withColumn("chunk", slot).join(words, "uid"), spec), "links")
    found = connected_components(edges)
    if most <= chunk:
        return found
    found = materialize(found, "groups")
    hot = held.filter(F.col("n") > chunk).join(
        found.select(F.col("node").alias("uid"), "root"), "uid", "left"
    )
    hot = hot.withColumn("root", F.coalesce("root", "uid"))
    open_keys = hot.groupBy("key", "root").agg(F.lit(1)).groupBy("key").count().filter("count > 1")
    left = hot.join(open_keys, "key", "left_semi").withColumn("slot", slot)
    other = F.explode(F.sequence(F.lit(0).cast("long"), slots - 1))
    pairs = left.withColumn("other", other).filter("slot <> other")
    pair = F.least("slot", "other") * slots + F.greatest("slot", "other")
    across = _forests(pairs.withColumn("chunk", pair).join(words, "uid"), spec)
    return connected_components(
        found.select(F.col("node").alias("src"), F.col("root").alias("dst")).union(across)
    )


def near_duplicates(docs: DataFrame, spec: SimHash = SimHash(), chunk: int = CHUNK) -> DataFrame:
    """One row per row of ``docs``: doc_id, the fingerprint w0 and ``component_id``.

    ``component_id`` is the smallest doc_id reachable by links. A null doc_id never is one while another
    member has an id. Null and wordless texts share fingerprint zero and so form one group. Equal rows
    each get their row. Empty input gives an empty result.
    """
    prints = materialize(fingerprints(docs, spec), "prints")
    unique = prints.groupBy("w0").agg(F.min("doc_id").alias("first_id"))
    unique = materialize(unique.withColumn("uid", F.monotonically_increasing_id()), "unique")
    groups = group_fingerprints(unique, spec, chunk)
    rooted = unique.join(groups, unique["uid"] == groups["node"], "left").withColumn("root", F.coalesce("root", "uid"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labelled = rooted.join(least, "root").select("w0", "component_id")
    return prints.join(labelled, "w0").select("doc_id", "w0", "component_id")


def fingerprint_hex() -> Column:
    return F.lower(F.lpad(F.hex("w0"), 16, "0"))


def keep_one(docs: DataFrame, spec: SimHash = SimHash()) -> DataFrame:
    """``docs`` without near-duplicates: the row with the smallest doc_id of each group stays, whole.

    Rows of one doc_id are one document: of them the row whose text has the smallest hash stays (among equal texts
    the smallest as JSON). Rows with a null doc_id stay (they cannot be told apart). All columns are kept.
    """
    found = near_duplicates(docs, spec)
    fate = found.filter("doc_id is not null").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("rows"), F.min("component_id").alias("first")
    )
    fate = materialize(fate.filter("rows > 1 or first <> doc_id"), "fate")
    gone = fate.filter("first <> doc_id").select(F.col("doc_id").alias("gone_id"))
    kept = docs.join(gone, docs["doc_id"].cast("long") == F.col("gone_id"), "left_anti")
    if fate.filter("first = doc_id").isEmpty():
        return kept
    twice = fate.filter("first = doc_id").select(F.col("doc_id").alias("twice_id"))
    same = docs["doc_id"].cast("long") == F.col("twice_id")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = kept.join(twice, same, "left_semi").groupBy(F.col("doc_id").cast("long").alias("one_id"))
    one = one.agg(F.min_by(row, F.struct(F.xxhash64("text"), F.to_json(row))).alias("row")).select("row.*")
    return kept.join(twice, same, "left_anti").unionByName(one)

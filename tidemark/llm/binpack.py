"""Conflict-constrained best-fit packing of documents into bins of equal capacity.

No bin holds two pieces of one source or of one duplicate cluster, except that pieces of one document are cut
so that all but the last fill a bin each. Pieces are dealt into groups of about ``GROUP`` by a hash of their row
number, whatever their key, and each group is packed longest first: bins stand in the order of what is left in
them and carry bitmaps of their sources and clusters; the search starts at the tightest bin that is large
enough and goes on until one has no conflict. Groups are packed independently, so tasks stay bounded and the
loss against one sequential run is at most a few bins a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mapped, materialize, sorted_runs, text_bytes

CAPACITY = 2048
GROUP = 4096
SCAN = 128


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, length (white-space words), source and cluster (both hashed) of each row of ``docs``.

    The cluster is that of equal texts up to case and white space. A null source counts as one source.
    """
    rows = docs.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64(F.col("source").cast("string"))
    )

    def run(batch: pa.RecordBatch):
        length, cluster = [], []
        for text in text_bytes(batch.column(1)):
            tokens = text.lower().split()
            length.append(len(tokens))
            cluster.append(xxhash.xxh64_intdigest(b" ".join(tokens)))
        yield [batch.column(0), length, batch.column(2), np.array(cluster, dtype=np.uint64).view(np.int64)]

    return mapped(rows, run, "doc_id long, length long, source long, cluster long")


def best_fit(length: np.ndarray, source: np.ndarray, cluster: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; pieces are placed in the order given."""
    _, sources = np.unique(source, return_inverse=True)
    _, clusters = np.unique(cluster, return_inverse=True)
    marks = np.stack([sources, clusters + sources.max(initial=-1) + 1], axis=1)
    words = int(marks.max(initial=0)) // 64 + 1
    size = len(length)
    bitmaps = np.zeros((size, words), dtype=np.uint64)
    left = np.zeros(size, dtype=np.int64)  # room left, in ascending order
    order = np.zeros(size, dtype=np.int64)  # the bin at each place of that order
    bins, offsets = np.empty(size, dtype=np.int64), np.empty(size, dtype=np.int64)
    used = 0
    for piece in range(size):
        need = length[piece]
        word, bit = np.divmod(marks[piece], 64)
        mask = np.uint64(1) << bit.astype(np.uint64)
        at = int(np.searchsorted(left[:used], need))
        place = -1
        while at < used:
            near = order[at : min(at + SCAN, used)]
            free = ((bitmaps[near, word[0]] & mask[0]) | (bitmaps[near, word[1]] & mask[1])) == 0
            first = int(free.argmax())
            if free[first]:
                place = at + first
                break
            at += len(near)
        if place < 0:
            chosen, room, place = used, capacity, used
            used += 1
        else:
            chosen, room = int(order[place]), int(left[place])
        rest = room - need
        to = int(np.searchsorted(left[:place], rest, side="right"))
        left[to + 1 : place + 1] = left[to:place].copy()
        order[to + 1 : place + 1] = order[to:place].copy()
        left[to], order[to] = rest, chosen
        bitmaps[chosen, word[0]] |= mask[0]
        bitmaps[chosen, word[1]] |= mask[1]
        bins[piece], offsets[piece] = chosen, capacity - room
    return bins, offsets


def pack(sized: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Place rows of (doc_id, length, source, cluster: longs) into bins.

    One row per piece: doc_id, piece (from 0), start (in the document), length, bin_id, position (in the bin). A document
    longer than ``capacity`` is cut into full pieces and a rest. A null or zero length gives one row without
    bin. Null sources (clusters) conflict with each other. Repeated rows are packed each. Empty input: empty.
    """
    rows = sized.select("doc_id", "length", "source", "cluster")
    rows = materialize(rows.withColumn("uid", F.monotonically_increasing_id()), "sized")
    last = F.greatest(F.ceil(F.col("length") / capacity) - 1, F.lit(0)).cast("long")
    pieces = rows.filter("length > 0").withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    pieces = pieces.select(
        "doc_id",
        "piece",
        (F.col("piece") * capacity).alias("start"),
        F.least(F.lit(capacity), F.col("length") - F.col("piece") * capacity).cast("long").alias("size"),
        F.coalesce("source", F.lit(0)).alias("source"),
        F.coalesce("cluster", F.lit(0)).alias("cluster"),
        "uid",
    )
    total = rows.filter("length > 0").agg(F.sum(last + 1)).first()[0] or 0
    groups = max(1, -(-int(total) // group))
    pieces = pieces.withColumn("pack", F.pmod(F.xxhash64("uid", "piece"), F.lit(groups)))
    pieces = pieces.withColumn("known", F.col("doc_id").isNotNull().cast("int")).fillna(0, ["doc_id"])
    placed = pieces.repartition("pack").sortWithinPartitions("pack", F.desc("size"), "uid", "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in sorted_runs(batches, ["pack"]):
            number = columns["pack"]
            edges = np.flatnonzero(np.diff(number)) + 1
            for part in np.split(np.arange(len(number)), edges):
                cells = {name: values[part] for name, values in columns.items()}
                bins, offsets = best_fit(cells["size"], cells["source"], cells["cluster"], capacity)
                ids = pa.array(cells["doc_id"], mask=cells["known"] == 0, type=pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(cells["piece"]), pa.array(cells["start"]), pa.array(cells["size"]),
                     pa.array((cells["pack"].astype(np.int64) << 24) + bins), pa.array(offsets)],
                    names=["doc_id", "piece", "start", "length", "bin_id", "position"],
                )

    schema = "doc_id long, piece long, start long, length long, bin_id long, position long"
    packed = placed.mapInArrow(run, schema)
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    empty = rows.filter("length is null or length <= 0").select(
        "doc_id", zero.alias("piece"), zero.alias("start"), zero.alias("length"), none.alias("bin_id"), none.alias("position")
    )
    return packed.union(empty)

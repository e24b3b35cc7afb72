"""Near-duplicate vectors by spherical-cap filters with structured random product codes.

A filter direction is a tuple of codewords, one per block of the (randomly rotated) coordinates; each vector is
list-decoded to every direction whose inner product with it reaches ``threshold``. Vectors that share a
filter are compared by exact cosine. Independent ``rounds`` of codes make up for vectors that one code serves
badly. Equal vectors are collapsed first; filters held by one vector are dropped.

A pair is counted at the smallest filter the two share, so tasks return counts and a spanning forest and
never pairs. A filter with more than ``CHUNK`` vectors is cut into chunks, and each pair of chunks is one
group of work. The number of comparisons inside a truly dense cap is quadratic (exact link counts ask for it), but it
is spread over tasks, stays in matrix products, and writes one row per vector and filter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mapped, materialize, min_labels, run_bounds, sorted_runs, spread
from tidemark.llm.components import connected_components
from tidemark.llm.simhash import shared_keys

CHUNK = 1024
LENGTHS = 4096  # a filter's key holds the vector length modulo this
LISTED = 25  # about so many filters a vector and round


@dataclass(frozen=True)
class CapFilters:
    """``codewords``: per block; two blocks give codewords**2 directions a round.

    With 64 dimensions the defaults list some 20 directions per vector and round and find about 99.5 % of the pairs at
    cosine 0.9 exactly, more above. Raise ``codewords`` (and ``threshold`` slightly) with the number of vectors:
    unrelated vectors meet in a share of filters that does not depend on the table's size.
    """

    cosine: float = 0.9
    codewords: int = 512
    threshold: float = 0.45
    rounds: int = 3
    seed: int = 20

    def codes(self, dims: int, number: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """The rotation and the unit codewords (divided by sqrt 2) of the two blocks of one round."""
        rng = np.random.default_rng([self.seed, number, dims])
        rotation, _ = np.linalg.qr(rng.standard_normal((dims, dims)))
        blocks = []
        for width in (dims - dims // 2, dims // 2):
            code = rng.standard_normal((self.codewords, max(width, 1)))
            blocks.append(code / np.linalg.norm(code, axis=1, keepdims=True) / np.sqrt(2))
        return rotation, blocks

    def decode(self, unit: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``unit`` and their filters: all directions that reach the threshold, or else the nearest."""
        dims = unit.shape[1]
        rotation, (first, second) = self.codes(dims, number)
        turned = unit @ rotation
        half = dims - dims // 2
        left = turned[:, :half] @ first.T
        right = turned[:, half:] @ second.T if dims > 1 else np.zeros((len(unit), self.codewords))
        rows, filters = [], []
        for row, (a, b) in enumerate(zip(left, right)):
            cut = min(self.threshold, a.max() + b.max())
            i = np.flatnonzero(a >= cut - b.max())
            j = np.flatnonzero(b >= cut - a.max())
            p, q = np.nonzero(a[i][:, None] + b[j][None, :] >= cut)
            rows.append(np.full(len(p), row))
            filters.append(i[p] * self.codewords + j[q])
        keys = np.concatenate(filters).astype(np.int64) + number * self.codewords**2
        return np.concatenate(rows), keys


def _vectors(column: pa.Array) -> list[np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(pa.compute.list_value_length(column).to_numpy(zero_copy_only=False))
    return np.split(flat, ends[:-1])


def _filter_rows(unique: DataFrame, spec: CapFilters) -> DataFrame:
    lengths = LENGTHS

    def run(batch: pa.RecordBatch):
        uid, vectors = batch.column(0).to_numpy(), _vectors(batch.column(1))
        sizes = np.array([len(v) for v in vectors])
        for dims in np.unique(sizes):
            here = np.flatnonzero(sizes == dims)
            matrix = np.stack([vectors[i] for i in here])
            matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
            for number in range(spec.rounds):
                for start in range(0, len(here), 1024):
                    rows, keys = spec.decode(matrix[start : start + 1024], number)
                    yield [keys * lengths + int(dims) % lengths, uid[here[start + rows]]]

    return mapped(unique.select("uid", "embedding"), run, "key long, uid long")


def _compare(members: DataFrame, spec: CapFilters) -> DataFrame:
    """Chunks of a filter's vectors to (uid, links, tied): links first met here, and a forest edge."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in sorted_runs(batches, ["key", "pair"]):
            for start, end in run_bounds(columns, ["key", "pair"]):
                sizes = np.array([len(v) for v in columns["embedding"][start:end]])
                for dims in np.unique(sizes):  # lengths with one remainder meet under one key
                    yield from links_of({n: v[start:end][sizes == dims] for n, v in columns.items()})

    def links_of(columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, uid, side = columns["key"][0], columns["uid"], columns["side"]
        matrix = np.stack(columns["embedding"]).astype(np.float64)
        norms = np.linalg.norm(matrix, axis=1)
        link = (matrix @ matrix.T) / (norms[:, None] * norms[None, :]) >= spec.cosine
        np.fill_diagonal(link, False)
        if side.any():
            link &= side[:, None] != side[None, :]
        labels = min_labels(link)
        linked = np.flatnonzero(link.any(axis=1))
        if not len(linked):
            return
        fresh = link[np.ix_(linked, linked)] & ~_met_before(columns["keys"][linked], key)
        links = fresh @ columns["copies"][linked].astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(uid[linked]), pa.array(links), pa.array(uid[labels[linked]])], names=["uid", "links", "tied"]
        )

    placed = members.select("key", "pair", "side", "uid", "copies", "embedding", "keys")
    placed = placed.repartition("key", "pair").sortWithinPartitions("key", "pair")
    return placed.mapInArrow(run, "uid long, links long, tied long")


def _met_before(keys: np.ndarray, key: int) -> np.ndarray:
    """Do two rows share a filter smaller than ``key``?"""
    row = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    flat = np.concatenate(keys)
    row, flat = row[flat < key], flat[flat < key]
    names, column, counts = np.unique(flat, return_inverse=True, return_counts=True)
    many = counts > 1
    place = np.cumsum(many) - 1
    use = many[column]
    holds = np.zeros((len(keys), int(many.sum())), dtype=np.float32)
    holds[row[use], place[column[use]]] = 1
    return holds @ holds.T > 0


def near_vectors(vectors: DataFrame, spec: CapFilters = CapFilters(), chunk: int = CHUNK) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    n_links: other vectors with cosine >= ``spec.cosine``, equal ones included; component_id: the smallest
    vec_id reachable; kept: whether it is the row's own. Null, empty and zero vectors and such with null or
    non-finite components link with nothing. Vectors of different length never link. Repeated rows count as
    different vectors. A row with a null vec_id counts in n_links and has component_id null if no other id
    is reachable; it is not kept. Empty input gives an empty result.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>"))
    bad = F.expr("exists(embedding, x -> x is null or isnan(x) or abs(x) = float('inf'))")
    usable = F.coalesce(F.expr("exists(embedding, x -> x <> 0)") & ~bad, F.lit(False))
    good = rows.filter(usable)
    unique = good.groupBy("embedding").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    unique = materialize(unique.withColumn("uid", F.monotonically_increasing_id()), "vectors")

    dealt = spread(unique, unique.count() * spec.rounds * LISTED)
    held = materialize(shared_keys(_filter_rows(dealt, spec)), "filters")
    lists = held.groupBy("uid").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    payload = unique.select("uid", "copies", "embedding").join(lists, "uid")
    slots = F.ceil(F.col("n") / chunk).cast("long")
    slot = F.pmod(F.xxhash64("uid"), slots)
    pairs = held.withColumn("slot", slot).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), slots - 1))
    )
    low, high = F.least("slot", "other"), F.greatest("slot", "other")
    pairs = pairs.select(
        "key",
        "uid",
        (low * slots + high).alias("pair"),
        F.when(low < high, (F.col("slot") == low).cast("int") + 1).otherwise(0).alias("side"),
    )
    found = materialize(_compare(pairs.join(payload, "uid"), spec), "links")
    groups = connected_components(found.select(F.col("uid").alias("src"), F.col("tied").alias("dst")))

    counted = found.groupBy("uid").agg(F.sum("links").alias("links"))
    rooted = unique.join(counted, "uid", "left").join(
        groups, unique["uid"] == groups["node"], "left"
    ).withColumn("root", F.coalesce("root", "uid"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labelled = rooted.join(least, "root").select(
        "embedding", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    linked = good.join(labelled, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.filter(~usable).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.union(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )

"""Conversation prefix trie: shared beginnings as nodes, subtree totals by centroid decomposition.

A node is a distinct sequence of first turns, told apart by 128 bits of summed (position, turn) hashes that a blocked
prefix scan gives every row, however long a conversation is. It is named by its smallest member and its depth.

Subtree totals: a component of the parent-edge forest is split at its centroid, the deepest node whose subtree holds over
half of the component's weight (rows of conversations). The total of the component's nodes at and below the centroid is added to
the nodes on the path from the centroid to the component's top; the child subtrees and the rest are the next
components. Every (ancestor, descendant) pair is parted exactly once, and each round halves the weights, so a trie of any shape takes
a logarithmic number of rounds over tables, not one round per level of depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, small_batches
from tidemark.plans.blocked import Scan, prefix_scan
from tidemark.plans.ranked import with_rank

WORD = "[^\\x20\\x09-\\x0D]+"
FAMILY, HEADS = 20, 4
PIECE_BYTES = 1 << 16


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations that share the beginnings of others: (conv_id, length) and (conv_id, depth, one, two, words).

    Conversation c takes the first h = crc32(c) % 4 turns of conversation c - c % 20 (SQL remainder, towards zero) and then its own turns after its
    first h. Turns are ordered by turn (null first), then role and text; null role or text is empty; rows without conv_id are
    no conversation. ``one`` and ``two`` are hashes of role and text, ``words`` counts the words of the text.
    """
    small_batches(conversations.sparkSession)
    turns = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    ).filter("conv_id is not null")
    ranked = with_rank(turns, ["conv_id"], ["turn", "role", "text"]).select(
        "conv_id",
        "rank",
        F.xxhash64(F.lit(1), "role", "text").alias("one"),
        F.xxhash64(F.lit(2), "role", "text").alias("two"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
    )
    ranked = materialize(ranked, "turns")
    sizes = ranked.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    heads = sizes.withColumn("head", F.crc32(F.col("conv_id").cast("string")) % HEADS)
    heads = heads.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).join(bases, "base", "left")
    taken = F.least("head", F.coalesce("base_own", F.lit(0)))
    heads = heads.withColumn("taken", taken).withColumn("length", taken + F.greatest(F.col("own") - F.col("head"), F.lit(0)))
    heads = materialize(heads.select("conv_id", "base", "head", "taken", "length"), "heads")
    own = ranked.join(heads, "conv_id").filter("rank > head")
    own = own.select("conv_id", (F.col("taken") + F.col("rank") - F.col("head")).alias("depth"), "one", "two", "words")
    shared = heads.filter("taken > 0").select("conv_id", "base", F.explode(F.sequence(F.lit(1).cast("long"), "taken")).alias("depth"))
    first = ranked.select(F.col("conv_id").alias("base"), F.col("rank").alias("depth"), "one", "two", "words").filter(f"depth < {HEADS}")
    shared = shared.join(first, ["base", "depth"]).select(*own.columns)
    return heads.select("conv_id", "length"), own.union(shared)


def trie_nodes(lengths: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored tables: nodes (node, conv_id, depth, n_convs, weight, words) and paths (conv_id, depth, node, first).

    ``turns`` has one row per (conv_id, depth from 1 on) with the hashes of the turn; ``lengths`` has every conversation.
    A path lists the nodes of a conversation from the root (depth 0) on; ``first`` is the node's smallest member. The
    ``weight`` of a node is the number of path entries at and below it.
    """
    hashes = {f"{c}{half}": F.xxhash64("depth", "one", "two", F.lit(c)) for c in "ab" for half in ("h", "l")}
    halves = {n: F.shiftright(h, 32) if n[1] == "h" else h.bitwiseAND(F.lit(0xFFFFFFFF)) for n, h in hashes.items()}
    scanned = prefix_scan(turns, ["conv_id"], "depth", {n: Scan("sum", h.cast("long")) for n, h in halves.items()})
    rows = scanned.select("conv_id", "depth", "words", F.xxhash64("ah", "al").alias("a"), F.xxhash64("bh", "bl").alias("b"))
    zero = F.lit(0).cast("long")
    roots = lengths.select("conv_id", zero.alias("depth"), zero.alias("words"), zero.alias("a"), zero.alias("b"))
    rows = materialize(rows.union(roots).join(lengths, "conv_id"), "entries")
    nodes = rows.groupBy("depth", "a", "b").agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"),
        F.max("words").alias("words"),
    )
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    names = nodes.select("depth", "a", "b", "node", F.col("conv_id").alias("first"))
    paths = materialize(rows.join(names, ["depth", "a", "b"]).select("conv_id", "depth", "node", "first"), "paths")
    return nodes.drop("a", "b"), paths


def subtree_totals(nodes: DataFrame, steps: DataFrame, values: list[str]) -> DataFrame:
    """(node, values) with each of ``values`` summed over the subtree of every node, by centroid decomposition.

    ``nodes``: node, conv_id, depth, weight, top (the root of its tree), childless and the values. ``steps``: (conv_id, depth,
    node, next): node and next node on the path of each conversation that names a node.
    """
    totals = {v: f"__{v}" for v in values}
    state = nodes.select("node", "conv_id", "depth", F.col("top").alias("comp"), "weight", "childless", *values)
    state = state.withColumns({t: F.lit(0).cast("long") for t in totals.values()})
    looked = steps.select(
        F.col("conv_id").alias("__conv"), F.col("depth").alias("__depth"), F.col("node").alias("__at"), F.col("next").alias("__next")
    )
    done = []
    while not state.isEmpty():
        tops = state.filter("node = comp").select("comp", F.col("weight").alias("total"))
        heavy = state.select("comp", "node", "depth", "weight").join(tops, "comp").filter("2 * weight > total")
        cent = heavy.groupBy("comp").agg(F.max(F.struct("depth", "node", "weight")).alias("c"), F.max("total").alias("total"))
        cent = cent.select("comp", "total", F.col("c.depth").alias("c_depth"), F.col("c.node").alias("c_node"), F.col("c.weight").alias("c_weight"))
        marked = state.join(cent, "comp")
        at = (F.col("conv_id") == F.col("__conv")) & (F.least("depth", "c_depth") == F.col("__depth"))
        marked = marked.join(looked, at, "left").select(
            *state.columns,
            "c_node",
            "c_weight",
            (2 * F.col("weight") > F.col("total")).alias("above"),
            F.coalesce((F.col("depth") > F.col("c_depth")) & (F.col("__at") == F.col("c_node")), F.lit(False)).alias("below"),
            "__next",
        )
        marked = materialize(marked, "split")
        inside = marked.filter("below or node = c_node").groupBy("comp")
        sums = inside.agg(*[F.sum(v).alias(f"__s{v}") for v in values])
        path = marked.filter("above").join(sums, "comp").withColumns({t: F.col(t) + F.col(f"__s{v}") for v, t in totals.items()})
        path = path.withColumn("weight", F.col("weight") - F.col("c_weight"))
        path = path.withColumn("done", F.col("node") == F.col("c_node")).select(*state.columns, "done")
        rest = marked.filter("not above").withColumn("comp", F.when(F.col("below"), F.col("__next")).otherwise(F.col("comp")))
        alone = F.col("childless") & (F.col("comp") == F.col("node"))  # a leaf that is its own component
        rest = rest.withColumns({t: F.when(alone, F.col(v)).otherwise(F.col(t)) for v, t in totals.items()})
        after = materialize(path.union(rest.withColumn("done", alone).select(*state.columns, "done")), "components")
        done.append(after.filter("done").select("node", *[F.col(t).alias(v) for v, t in totals.items()]))
        state = after.filter("not done").drop("done")
    if not done:
        return nodes.select("node", *values)
    whole = done[0]
    for part in done[1:]:
        whole = whole.union(part)
    return whole


def listed_digests(members: DataFrame) -> DataFrame:
    """(node, sha256) of the ascending decimal conv_ids of each node, joined by commas.

    Ids are joined to pieces in tasks of their own ranges; the task of a node reads its pieces one after another.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, held, size = None, None, [], 0
        for batch in batches:
            out = []
            for at, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and (at != node or size > PIECE_BYTES):
                    out.append((node, first, ",".join(held)))
                    held, size = [], 0
                if not held:
                    node, first = at, conv
                held.append(str(conv))
                size += len(held[-1]) + 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["node", "first", "piece"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (node, first, ",".join(held))], names=["node", "first", "piece"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            out = []
            for at, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if at != node:
                    if digest:
                        out.append((node, digest.hexdigest()))
                    node, digest = at, hashlib.sha256(piece.encode())
                else:
                    digest.update(b"," + piece.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["node", "sha256"])
        if digest:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([digest.hexdigest()])], names=["node", "sha256"])

    order = ["node", "conv_id"]
    parts = members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pieces, "node long, first long, piece string")
    return parts.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digests, "node long, sha256 string")


def prefix_trie(lengths: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per node of the trie of the conversations: conv_id (smallest member), depth, parent_conv_id (null at the
    root), n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    ``n_leaves`` counts the childless nodes of the subtree, ``saved_tokens`` sums (n_convs - 1) x words of the last
    turn over it. No conversations give no rows; conversations without turns end at the root.
    """
    nodes, paths = trie_nodes(lengths, turns)
    after = paths.select("conv_id", (F.col("depth") - 1).alias("depth"), F.col("node").alias("next"))
    named = nodes.select("conv_id").distinct()
    steps = paths.join(named, "conv_id", "left_semi").join(after, ["conv_id", "depth"], "left")
    steps = materialize(steps, "steps")
    up = steps.filter("next is not null").groupBy(F.col("next").alias("node")).agg(F.min("first").alias("parent_conv_id"), F.min(F.col("node")).alias("parent"))
    children = up.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    linked = nodes.join(up.drop("parent"), "node", "left").join(children, "node", "left")
    linked = linked.withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    linked = materialize(linked.withColumn("childless", F.col("n_children") == 0), "linked")
    root = nodes.filter("depth = 0").select(F.col("node").alias("top"))
    own = linked.crossJoin(F.broadcast(root)).select(  # one row: the root
        "node",
        "conv_id",
        "depth",
        "weight",
        "top",
        "childless",
        F.col("childless").cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
    )
    rolled = subtree_totals(own, steps, ["n_leaves", "saved_tokens"])
    ends = paths.join(lengths.withColumnRenamed("length", "depth"), ["conv_id", "depth"]).select("node", "conv_id")
    joined = linked.join(rolled, "node").join(listed_digests(ends), "node", "left")
    return joined.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.col("n_children").cast("long").alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )

"""Trees as arrays: the draws of the SQL expressions, walks of large trees, one block against many."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.operators import forest, trees


def test_draws_are_those_of_the_expressions(spark):
    df = spark.range(-50, 250).select(
        F.col("id").alias("n"), F.lit(7).alias("member"), F.xxhash64(F.lit(1), F.lit("d")).alias("h")
    )
    got = df.select(
        "n",
        "h",
        trees.poisson_weight(6.0, F.lit(1), F.lit("d"), F.col("n"), F.col("member")).alias("w"),
        trees.feature_subset(64, 9, F.lit(1), F.lit("d"), "member", "n").alias("s"),
    ).toPandas()
    n, h, member = got.n.to_numpy(), got.h.to_numpy()[:1].view(np.uint64), np.full(1, 7)
    weights = forest.poisson_weights(6.0, forest.hash_int(member, forest.hash_long(n, h)))
    assert weights.tolist() == got.w.tolist()
    subsets = forest.feature_subsets(64, 9, forest.hash_long(n, forest.hash_int(member, h)))
    assert subsets.tolist() == [list(s) for s in got.s]


def test_rows_take_one_step_per_level_of_a_large_tree():
    """65,535 splits: a look-up that went through all of them for every step would take minutes here."""
    levels = 16
    inner = (1 << levels) - 1
    node = np.arange(2 * inner + 1)
    level = np.floor(np.log2(node + 1))
    middle = (node + 1 - 2**level + 0.5) / 2**level
    split = node < inner
    tree = forest.Tree(node, np.where(split, 0, -1), middle, node.astype(float), ~split)
    x = np.random.default_rng(1).random((200_000, 1))
    assert (tree.node[tree.leaves(x)] == np.floor(x[:, 0] * (1 << levels)) + inner).all()
    assert (tree.guess[tree.leaves(x)] == tree.node[tree.leaves(x)]).all()


def test_missing_features_go_right():
    x = forest.features_matrix(pa.chunked_array([pa.array([[0.1, None], None, [0.2], [0.1, 0.2, 0.3]], pa.list_(pa.float64()))]), 2)
    tree = forest.Tree(*(np.array(a) for a in ([0], [1], [0.5], [0.0], [False])))
    assert tree.node[tree.leaves(x)].tolist() == [2, 2, 2, 1]


def test_votes():
    none = np.nan
    got = forest.majority(np.array([[0, 1, 1], [2, 1, none], [none, none, none], [none, none, 1]]), np.array([1.0, 1.0, 0.0]))
    assert got[:2].tolist() == [0, 1] and np.isnan(got[2]) and got[3] == 1


def test_blocks_of_a_chunk_add_up(spark, monkeypatch):
    rng = random.Random(4)
    rows = [("d", i, [rng.random(), rng.random()], float(rng.random() > 0.5)) for i in range(1, 1601)]
    df = spark.createDataFrame(rows, "dataset string, instance_id long, features array<double>, actual double")
    o = trees.TreeOptions(members=3, first_rows=400, grace_rows=50, split_delta=0.5)

    def run():
        return sorted(trees.prequential_trees(df, ["dataset"], 2, o).collect())

    whole = run()
    monkeypatch.setattr(trees, "block_rows", lambda n_features, o: o.detector_grain)
    assert run() == whole

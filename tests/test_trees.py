"""Chunked trees: split arithmetic against brute force, learning, resets, partition independence."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import preprocess, trees

SCHEMA = "dataset string, instance_id long, features array<double>, actual double"


def entropy(labels):
    n = len(labels)
    return -sum(c / n * math.log2(c / n) for c in (labels.count(v) for v in set(labels)))


def deviation(values):
    mean = sum(values) / len(values)
    return math.sqrt(max(0.0, sum((v - mean) ** 2 for v in values) / len(values)))


@pytest.mark.parametrize("task", ["classification", "regression"])
def test_gains(spark, task):
    rng = random.Random(1)
    rows = [(i, rng.random(), float(rng.randrange(3))) for i in range(200)]
    cells = (
        spark.createDataFrame(rows, "i long, x double, y double")
        .groupBy(F.lit(0).alias("f"), trees.bin_of(F.col("x"), 8).alias("bin"), (F.col("y").cast("int") if task == "classification" else F.lit(0)).alias("cls"))
        .agg(F.count("*").cast("double").alias("w"), F.sum("y").alias("sy"), F.sum(F.col("y") * F.col("y")).alias("syy"))
        .withColumn("node", F.lit(0))
    )
    got = {r.cut: r.gain for r in trees.split_gains(cells, ["node"], 8, task).collect()}
    spread = entropy if task == "classification" else deviation
    ys = [y for _, _, y in rows]
    for cut in range(7):
        left = [y for _, x, y in rows if x < (cut + 1) / 8]
        right = [y for _, x, y in rows if x >= (cut + 1) / 8]
        want = spread(ys) - len(left) / 200 * spread(left) - len(right) / 200 * spread(right)
        assert got[cut] == pytest.approx(want)


def concept(n, task, flip_at=None, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(1, n + 1):
        x = [rng.random() for _ in range(3)]
        high = (x[1] > 0.5) != (flip_at is not None and i >= flip_at)
        rows.append(("d", i, x, float(high) if task == "classification" else (10.0 if high else 1.0) + x[0]))
    return rows


@pytest.mark.parametrize("task,members", [("classification", 1), ("classification", 3), ("regression", 1), ("regression", 3)])
def test_learns_the_concept(spark, task, members):
    df = spark.createDataFrame(concept(2000, task), SCHEMA)
    o = trees.TreeOptions(task, members, first_rows=500, detect=False)
    out = trees.prequential_trees(df, ["dataset"], 3, o)
    assert out.count() == 2000
    assert out.filter("instance_id <= 500 and prediction is not null").count() == 0
    late = out.filter("instance_id > 1000").agg(F.avg("error")).first()[0]
    assert late < (0.05 if task == "classification" else 0.8)


def test_drift_starts_a_new_tree(spark):
    df = spark.createDataFrame(concept(6000, "classification", flip_at=3001), SCHEMA)
    o = trees.TreeOptions(first_rows=1000, most_rows=1000)
    out = trees.prequential_trees(df, ["dataset"], 3, o)
    drifts = [r.instance_id for r in out.filter("drift").orderBy("instance_id").collect()]
    assert any(3000 < d <= 4000 for d in drifts)
    assert out.filter("instance_id > 5000").agg(F.avg("error")).first()[0] < 0.1
    assert out.agg(F.max("segment")).first()[0] == len(drifts)


def test_partitioning_does_not_change_the_result(spark):
    df = spark.createDataFrame(concept(1200, "classification"), SCHEMA)
    o = trees.TreeOptions(members=2, first_rows=400, detect=False)
    a = trees.prequential_trees(df.repartition(1), ["dataset"], 3, o)
    b = trees.prequential_trees(df.repartition(7), ["dataset"], 3, o)
    assert a.select("instance_id", "prediction").exceptAll(b.select("instance_id", "prediction")).count() == 0


def test_poisson_weights(spark):
    r = spark.range(20000).select(trees.poisson_weight(6.0, F.lit(1), F.col("id")).alias("w")).agg(F.avg("w"), F.var_samp("w")).first()
    assert abs(r[0] - 6) < 0.1 and abs(r[1] - 6) < 0.3


def test_subsets_have_the_exact_size(spark):
    picked = trees.feature_subset(64, 9, F.lit(1), "id")
    sizes = spark.range(200).select(F.size(F.array_distinct(picked)).alias("s"), F.array_max(picked).alias("m"))
    assert {r.s for r in sizes.collect()} == {9} and max(r.m for r in sizes.collect()) <= 63


def test_more_rows_and_other_streams_change_nothing_earlier(spark):
    long = [("long", *r[1:]) for r in concept(1700, "classification", seed=5)]
    short = [("short", *r[1:]) for r in concept(900, "classification", seed=6)]
    o = trees.TreeOptions(first_rows=100, grace_rows=50, split_delta=1e-3)

    def run(rows):
        out = trees.prequential_trees(spark.createDataFrame(rows, SCHEMA), ["dataset"], 3, o)
        return {(r.dataset, r.instance_id): (r.prediction, r.drift, r.segment) for r in out.collect()}

    alone, both = run(short), run(short + long)
    assert {k: v for k, v in both.items() if k[0] == "short"} == alone
    prefix = run(long[:700])
    assert {k: both[k] for k in prefix} == prefix
    assert sum(v[0] is not None for v in alone.values()) == 800


def test_what_the_instances_are_made_of_is_worked_once(spark):
    """Block totals and the rows are two reads; an expensive step before the trees must not run for each."""
    worked = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            worked.add(batch.num_rows)
            yield batch

    rows = spark.createDataFrame(concept(600, "classification"), SCHEMA)
    o = trees.TreeOptions(first_rows=200, most_rows=400)
    assert trees.prequential_trees(rows.mapInArrow(counted, SCHEMA), ["dataset"], 3, o).count() == 600
    assert worked.value == 600


def test_detector_keeps_the_state_of_runs_without_groups(spark):
    """Two chunks of groups in two calls are the groups in one call; a run that has none in the second keeps its state."""
    rng = random.Random(4)
    groups = [("d", m, 100 * i, float(rng.randrange(5) + 60 * (i > 40)), 1.0) for m in (-1, 0) for i in range(1, 81)]
    groups += [("idle", 0, 100 * i, 3.0, 1.0) for i in range(1, 21)]
    df = spark.createDataFrame(groups, "dataset string, member int, n long, sy double, syy double")
    o = trees.TreeOptions()

    def states(frame):
        return {(r.dataset, r.member): (r.state, r.drift_n) for r in frame.collect()}

    whole = states(trees._detect(df, None, ["dataset"], o))
    first = trees._detect(df.filter("n <= 4000"), None, ["dataset"], o)
    second = states(trees._detect(df.filter("n > 4000"), first, ["dataset"], o))
    assert second.keys() == whole.keys() and {k: v[0] for k, v in second.items()} == {k: v[0] for k, v in whole.items()}
    assert whole["d", -1][1] > 4000 and second["d", -1][1] == whole["d", -1][1]
    assert second["idle", 0] == (states(first)["idle", 0][0], None)


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.tidemark.blockRows", "700")
    yield
    spark.conf.unset("spark.tidemark.blockRows")


def test_flags_and_segments_take_no_window_over_the_rows(spark, small_blocks):
    """Two runs with drifts and a short one without, sparse ids: segments are the drifts up to a row, looked up by block."""
    rows = [(d, 3 * r[1] + 7, *r[2:]) for d, seed in (("a", 2), ("b", 3)) for r in concept(6000, "classification", 3001, seed)]
    rows += [("calm", *r[1:]) for r in concept(300, "classification")]
    o = trees.TreeOptions(first_rows=1000, most_rows=1000)
    out = trees.prequential_trees(spark.createDataFrame(rows, SCHEMA), ["dataset"], 3, o)
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not any("Window" in line and "instance_id" in line for line in plan)
    got = sorted(out.collect(), key=lambda r: (r.dataset, r.instance_id))
    assert len(got) == 12300 and {r.dataset for r in got if r.drift} == {"a", "b"}
    run, drifts = None, 0
    for r in got:
        drifts = (drifts if r.dataset == run else 0) + r.drift
        run = r.dataset
        assert r.segment == drifts


def test_flags_of_drifts_on_the_edges_of_blocks(spark, small_blocks):
    drifts = {"a": {1, 700, 701, 1400, 2101}, "b": {1399}, "c": set()}
    rows = spark.createDataFrame([(k, n) for k in drifts for n in range(1, 2102)], "k string, n long")
    flagged = spark.createDataFrame([(k, n) for k, ns in drifts.items() for n in ns], "k string, n long")
    ends = spark.createDataFrame([(k, 2101) for k in drifts], "k string, last long")
    got = trees._flagged(rows, flagged, ends, ["k"]).collect()
    assert len(got) == 3 * 2101
    assert all(r.drift == (r.n in drifts[r.k]) and r.segment == sum(d <= r.n for d in drifts[r.k]) for r in got)


def test_numbers_of_the_normalisation_are_those_of_a_scan(spark, small_blocks):
    rows = [(d, 5 * r[1], *r[2:]) for d, n in (("a", 1500), ("b", 640)) for r in concept(n, "regression", seed=n)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    o = trees.TreeOptions("regression", first_rows=200)

    def run(position):
        scaled = preprocess.normalize_stream(df, ["dataset"], 3, position=position)
        assert scaled.columns == df.columns + ([position] if position else [])
        return sorted(trees.prequential_trees(scaled, ["dataset"], 3, o, position=position).collect())

    numbered, scanned = run("place"), run(None)
    assert [r[:3] + r[5:] for r in numbered] == [r[:3] + r[5:] for r in scanned] and len(numbered) == 2140
    assert [r.prediction for r in numbered] == pytest.approx([r.prediction for r in scanned], nan_ok=True)
    with pytest.raises(ValueError, match="up to 16 features"):
        preprocess.normalize_stream(df, ["dataset"], 17, position="place")

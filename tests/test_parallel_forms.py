"""Forms that split one large key: chunked learners, exact quantiles, bounded event lists."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import analysis, chunk_linear, learners, metrics, neighbours


@pytest.mark.parametrize("loss", [learners.SQUARED, learners.HINGE, learners.PERCEPTRON, learners.PASSIVE_AGGRESSIVE])
def test_chunks_of_one_row_are_the_exact_learner(spark, loss):
    rng = random.Random(3)
    rows = []
    for i in range(1, 7):
        x = [rng.random(), rng.random()]
        rows.append(("a", i, x, float(x[0] > 0.5) if loss != learners.SQUARED else 5 * x[0]))
    df = spark.createDataFrame(rows, "k string, instance_id long, features array<double>, actual double")
    out = chunk_linear.chunked_linear(df, ["k"], loss, eta=0.5, first_rows=1, most_rows=1)
    got = {r.instance_id: r.prediction for r in out.collect()}
    model = learners.Linear(loss, eta=0.5, schedule="constant")
    for _, i, x, y in rows:
        want = model.predict(x)
        assert got[i] == (None if want is None else pytest.approx(want))
        model.learn(x, y)


def test_chunked_learner_separates(spark):
    rng = random.Random(4)
    rows = [("a", i, [rng.random() - 0.5, rng.random() - 0.5]) for i in range(1, 4001)]
    df = spark.createDataFrame(rows, "k string, instance_id long, features array<double>").withColumn(
        "actual", (F.col("features")[0] > 0).cast("double")
    )
    out = chunk_linear.chunked_linear(df, ["k"], learners.PASSIVE_AGGRESSIVE, first_rows=500)
    late = out.filter("instance_id > 2000").agg(F.avg((F.col("prediction") == F.col("actual")).cast("int"))).first()[0]
    assert out.count() == 4000 and late > 0.9


@pytest.mark.parametrize("bins", [2, 7, 4096])
def test_quantiles(spark, bins):
    rng = random.Random(6)
    groups = {
        "many": [rng.gauss(0, 1) for _ in range(301)],
        "ties": [float(rng.randrange(4)) for _ in range(200)],
        "one": [5.0],
        "same": [2.0] * 9,
        "skew": [1e9] + [rng.random() for _ in range(50)],
    }
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "model string, v double")
    points = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    got = {r.model: r for r in analysis.quantiles(df, "v", points, bins=bins).collect()}
    want = df.groupBy("model").agg(*[F.percentile("v", F.lit(q)).alias(n) for n, q in points.items()])
    for r in want.collect():
        for n in points:
            assert got[r.model][n] == pytest.approx(r[n])
    assert got["many"].c == pytest.approx(statistics.median(groups["many"]))


def test_one_summary_row_per_run(spark):
    keys = ["dataset", "task", "model"]
    events = spark.range(1, 26).select(
        F.lit("d").alias("dataset"),
        F.lit("regression").alias("task"),
        F.lit("m").alias("model"),
        (F.col("id") * 2000).alias("instance_id"),
        F.lit("ADWIN").alias("detector"),
        F.current_timestamp().alias("timestamp"),
    )
    summary = spark.createDataFrame([("d", "regression", "m", 60000, 25), ("d", "regression", "none", 10, 0)], "dataset string, task string, model string, total_instances long, drift_events long")
    out = metrics.with_drift_details(summary, events, keys, listed=10).collect()
    by_model = {r.model: r for r in out}
    assert len(out) == 2 and by_model["m"].drift_events == 25 and by_model["none"].drift_details is None
    assert [d.instance_id for d in by_model["m"].drift_details] == list(range(2000, 20001, 2000))


@pytest.mark.parametrize("kind", ["random", "ties", "far", "same", "not finite"])
@pytest.mark.parametrize("memory", [1, 30, 1000])
def test_nearest_by_matrix_products_keeps_the_exact_order(kind, memory):
    rng = np.random.default_rng(8)
    points = rng.normal(size=(700, 3))
    if kind == "ties":
        points = np.floor(points)
    if kind == "far":
        points += 1e7
    if kind == "same":
        points[:] = 0.1
    if kind == "not finite":
        points[50, 1], points[300, 0] = np.nan, np.inf
    parts = np.sort(rng.integers(0, 3, 700))
    own = np.arange(100, 700)
    for i, best in zip(own, neighbours.nearest(points, parts, own, 5, memory), strict=True):
        near = np.array([j for j in range(max(0, i - memory), i) if parts[j] == parts[i]], dtype=int)
        gap = points[near] - points[i]
        want = near[np.argsort(np.einsum("ij,ij->i", gap, gap), kind="stable")[:5]]
        assert best.tolist() == want.tolist()

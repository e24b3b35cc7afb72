"""Blocked scans and tiles against plain Python, across block borders."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.plans.blocked import Scan, prefix_scan, rolling, rolling_distinct, segment_scan


def stream(n=257, keys=("a", "b"), seed=3):
    rng = random.Random(seed)
    rows = []
    for k in keys:
        for i in range(1, n + 1):
            rows.append((k, i, rng.choice([None, 1, 2, 3, 5]), rng.random() < 0.03))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [7, 64, 10_000])
def test_prefix_scan(spark, block):
    rows = stream()
    df = spark.createDataFrame(rows, "k string, i long, v int, d boolean")
    out = prefix_scan(
        df,
        ["k"],
        "i",
        {
            "total": Scan("sum", F.col("v")),
            "n": Scan("count", F.col("v").isNotNull()),
            "low": Scan("min", F.col("v")),
            "high": Scan("max", F.col("v")),
            "before": Scan("last", F.col("v"), exclusive=True),
            "sum_before": Scan("sum", F.col("v"), exclusive=True),
        },
        block_rows=block,
    )
    got = {(r.k, r.i): r for r in out.collect()}
    assert len(got) == len(rows)
    for k in ("a", "b"):
        seen = []
        for _, i, v, _ in sorted(r for r in rows if r[0] == k):
            r = got[(k, i)]
            assert r.before == (seen[-1] if seen else None)
            assert r.sum_before == (sum(seen) if seen else None)
            seen += [v] if v is not None else []
            assert (r.total, r.n) == (sum(seen) if seen else None, len(seen))
            assert (r.low, r.high) == ((min(seen), max(seen)) if seen else (None, None))


@pytest.mark.parametrize("block", [5, 50, 10_000])
def test_segment_scan(spark, block):
    rows = stream()
    df = spark.createDataFrame(rows, "k string, i long, v int, d boolean")
    numbered = prefix_scan(df, ["k"], "i", {"seg": Scan("count", F.col("d"))}, block_rows=block)
    out = segment_scan(numbered, ["k"], "i", "seg", {"total": Scan("sum", F.col("v"))}, block_rows=block)
    got = {(r.k, r.i): r for r in out.collect()}
    for k in ("a", "b"):
        seg, seen = 0, []
        for _, i, v, d in sorted(r for r in rows if r[0] == k):
            if d:
                seg, seen = seg + 1, []
            seen += [v] if v is not None else []
            assert (got[(k, i)].seg, got[(k, i)].total) == (seg, sum(seen) if seen else None)


@pytest.mark.parametrize("kind", ["long", "double"])
@pytest.mark.parametrize("window", [1, 10, 100])
def test_rolling(spark, kind, window):
    rows = [(k, i, (i * 7919) % 13) for k in ("a", "b") for i in range(1, 258)]
    df = spark.createDataFrame(rows, "k string, i long, v long").withColumn("v", F.col("v").cast(kind))
    out = rolling(df, ["k"], "i", window, {"s": F.col("v")}, block_rows=32)
    got = {(r.k, r.i): r.s for r in out.collect()}
    assert len(got) == len(rows)
    for k in ("a", "b"):
        values = [v for kk, _, v in rows if kk == k]
        for i in range(1, 258):
            assert got[(k, i)] == pytest.approx(sum(values[max(0, i - window) : i]))


@pytest.mark.parametrize("window", [1, 9, 60])
def test_rolling_distinct(spark, window):
    rng = random.Random(5)
    values = [rng.randrange(6) for _ in range(300)]
    df = spark.createDataFrame([("a", i + 1, v) for i, v in enumerate(values)], "k string, i long, v int")
    out = rolling_distinct(df, ["k"], "i", window, {"c": "v"}, block_rows=37)
    got = {r.i: r.c for r in out.collect()}
    for i in range(1, 301):
        assert got[i] == len(set(values[max(0, i - window) : i]))


def test_rows_are_spread_by_block_not_by_key(spark):
    df = spark.range(1, 1000).select(F.lit("one").alias("k"), F.col("id").alias("i"))
    plan = prefix_scan(df, ["k"], "i", {"n": Scan("count", F.lit(True))}, block_rows=100)._jdf.queryExecution().toString()
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan
    assert "__blk" in plan.split("Exchange hashpartitioning(")[1].split(")")[0]


def test_rank_blocks_on_sparse_ids_and_timestamps(spark):
    from tidemark.operators.metrics import number_segments, prequential_metrics
    from tidemark.plans.ranked import rank_blocks

    rng = random.Random(8)
    rows = [(k, "regression", i, None if i == 1 else 1.0, float(rng.randrange(9)), rng.random() < 0.02) for k in "ab" for i in range(1, 301)]
    rng.shuffle(rows)
    dense = spark.createDataFrame(rows, "k string, task string, i long, prediction double, error double, drift boolean")
    sparse = dense.withColumn("i", F.col("i") * 1_000_000_000)
    stamped = dense.withColumn("i", F.timestamp_seconds(F.col("i") * 86_400 + F.col("i") % 7))
    keys = ["k", "task"]

    def plain(df, columns):
        return sorted(tuple(r[c] for c in columns) for r in df.collect())

    columns = ["k", "n", "n_correct", "segment", "segment_row", "error"]
    expect = plain(number_segments(dense, keys, "i", 7), columns)
    for frame in (sparse, stamped):
        assert plain(number_segments(rank_blocks(frame, keys, "i", 7), keys, "i"), columns) == expect
    options = dict(order="i", window_rows=20, warmup_rows=5)
    columns = ["k", "n", "segment", "cumulative_mae", "cumulative_mse", "window_mae", "window_mse"]
    expect = plain(prequential_metrics(dense, keys, block_rows=7, **options), columns)
    for frame in (sparse, stamped):
        got = plain(prequential_metrics(rank_blocks(frame, keys, "i", 7), keys, **options), columns)
        assert [r[:3] for r in got] == [r[:3] for r in expect]
        assert all(a == b or abs(a - b) < 1e-9 for x, y in zip(got, expect) for a, b in zip(x[3:], y[3:]))


def test_two_level_carries(spark, monkeypatch):
    from tidemark.plans import blocked
    from tidemark.plans.ranked import rank_blocks

    monkeypatch.setattr(blocked, "GROUP_BLOCKS", 3)
    rows = stream()
    df = spark.createDataFrame(rows, "k string, i long, v int, d boolean")
    scans = {
        "total": Scan("sum", F.col("v")),
        "n": Scan("count", F.col("v").isNotNull()),
        "low": Scan("min", F.col("v")),
        "high": Scan("max", F.col("v")),
        "before": Scan("last", F.col("v"), exclusive=True),
    }
    expect = sorted(map(str, prefix_scan(df, ["k"], "i", scans, 10_000).drop("v", "d").collect()))
    sparse = rank_blocks(df.withColumn("i", F.col("i") * 977_777), ["k"], "i", block_rows=5)
    sizes = sparse.groupBy("k", blocked.BLOCK).count().groupBy("k").agg(F.max("count"), F.count("count")).collect()
    assert sorted(tuple(r) for r in sizes) == [("a", 5, 52), ("b", 5, 52)]
    got = prefix_scan(sparse, ["k"], "i", scans).withColumn("i", (F.col("i") / 977_777).cast("long")).drop("v", "d", blocked.BLOCK)
    assert sorted(map(str, got.collect())) == expect


def test_no_window_sees_more_rows_than_blocks(spark, monkeypatch):
    """Every window over the rows is partitioned by block, every window over blocks by group."""
    import re

    from tidemark.operators.metrics import number_segments
    from tidemark.plans.ranked import rank_blocks

    df = spark.createDataFrame([("a", i * 10**9, 1.0, 0.0, i % 50 == 0) for i in range(1, 200)], "k string, i long, prediction double, error double, drift boolean")
    plan = number_segments(rank_blocks(df, ["k"], "i", 16), ["k"], "i")._jdf.queryExecution().optimizedPlan().toString()
    specs = re.findall(r"Window \[.*?\], \[(.*?)\], \[(.*?)\]", plan)
    assert specs
    for partition, order in specs:
        row_level = order.startswith("i#")
        assert not row_level or "__blk" in partition
        assert row_level or "__grp" in partition or order.startswith(("__grp", "__task"))


@pytest.mark.parametrize("slice_rows", ["4000000", "700"])
def test_exact_blocked_sgd_has_every_digit(spark, slice_rows):
    import random

    from tidemark.operators.blocked_sgd import sgd_regression
    from tidemark.operators.learners import SQUARED, Linear

    rng = random.Random(6)
    rows = [("a", i, [rng.random(), rng.random()], rng.expovariate(0.02)) for i in range(1, 2001)]
    frame = spark.createDataFrame(rows, "k string, instance_id long, features array<double>, actual double")
    model, want = Linear(SQUARED), {}
    for _, i, x, y in rows:
        want[i] = model.predict(x)
        model.learn(x, y)
    kept = spark.conf.get("spark.tidemark.sliceRows", None)
    spark.conf.set("spark.tidemark.sliceRows", slice_rows)
    try:
        out = sgd_regression(frame, ["k"], block_rows=100, exact=True).collect()
    finally:
        spark.conf.unset("spark.tidemark.sliceRows") if kept is None else spark.conf.set("spark.tidemark.sliceRows", kept)
    assert {r["instance_id"]: r["prediction"] for r in out} == want

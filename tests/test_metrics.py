"""Metrics against a direct transcription of their definition, with the documented borders."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import metrics

KEYS = ["dataset", "task", "model"]
SCHEMA = (
    "dataset string, task string, model string, instance_id long, prediction double, actual double, error double, "
    "drift boolean"
)


def run(task, n, drifts=(), null_at=(1,), seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(1, n + 1):
        y = float(rng.randrange(2)) if task == "classification" else rng.random() * 10
        p = None if i in null_at else (float(rng.randrange(2)) if task == "classification" else rng.random() * 10)
        e = None if p is None else (float(p != y) if task == "classification" else abs(p - y))
        rows.append(("d", task, "m", i, p, y, e, i in drifts and p is not None))
    return rows


def expected(rows, window, warmup):
    out, n, ok, seg, seg_errors, seg_row, recent = {}, 0, 0, 0, [], 0, []
    for _, task, _, i, p, _, e, drift in rows:
        if p is None:
            continue
        if drift:
            seg, seg_errors, seg_row = seg + 1, [], 0
        n += 1
        ok += e == 0
        seg_row += 1
        if seg == 0 or seg_row > warmup:
            seg_errors.append(e)
        recent = (recent + [e])[-window:]
        mean = lambda v: sum(v) / len(v) if v else None
        if task == "classification":
            out[i] = (n, seg, ok / n, sum(r == 0 for r in recent) / len(recent), None, None)
        else:
            out[i] = (n, seg, None, None, mean(seg_errors), mean(recent))
    return out


@pytest.mark.parametrize("task", ["classification", "regression"])
@pytest.mark.parametrize("block", [16, 1000])
@pytest.mark.parametrize("drifts,nulls", [((1, 60, 61, 130), (5, 6)), ((150,), (1,)), ((), ())])
def test_metrics(spark, task, block, drifts, nulls):
    rows = run(task, 150, drifts, nulls)
    out = metrics.prequential_metrics(
        spark.createDataFrame(rows, SCHEMA), KEYS, window_rows=20, warmup_rows=10, block_rows=block
    )
    want = expected(rows, 20, 10)
    got = out.collect()
    assert len(got) == len(want)
    for r in got:
        n, seg, acc, win_acc, mae, win_mae = want[r.instance_id]
        assert (r.n, r.segment) == (n, seg)
        assert r.cumulative_accuracy == acc and r.window_accuracy == win_acc
        assert (r.cumulative_mae is None) == (mae is None)
        if task == "regression":
            assert r.window_mae == pytest.approx(win_mae)
            assert mae is None or r.cumulative_mae == pytest.approx(mae)


@pytest.mark.parametrize("after", [199, 200, 201])
def test_warmup_border(spark, after):
    rows = run("regression", 300 + after - 1, (300,), ())
    last = metrics.prequential_metrics(spark.createDataFrame(rows, SCHEMA), KEYS).filter(f"instance_id = {299 + after}").first()
    assert last.segment_row == after
    assert (last.cumulative_mae is None) == (after <= 200)


@pytest.mark.parametrize("n", [999, 1000, 1001])
def test_window_border(spark, n):
    rows = run("classification", n, (), ())
    last = metrics.prequential_metrics(spark.createDataFrame(rows, SCHEMA), KEYS, block_rows=300).filter(f"instance_id = {n}").first()
    recent = [r[6] for r in rows][-1000:]
    assert last.window_accuracy == sum(e == 0 for e in recent) / len(recent)


def test_summary_equals_last_metric_row(spark):
    rows = run("regression", 400, (100,), (1, 2)) + run("classification", 350, (50, 120), (3,))
    pred = spark.createDataFrame(rows, SCHEMA)
    summary = {r.task: r for r in metrics.run_summary(pred, KEYS, window_rows=50).collect()}
    full = metrics.prequential_metrics(pred, KEYS, window_rows=50).collect()
    for task, s in summary.items():
        last = max((r for r in full if r.task == task), key=lambda r: r.instance_id)
        assert s.total_instances == last.n and s.drift_events == last.segment
        for c in ("cumulative_accuracy", "window_accuracy", "cumulative_mae", "window_mse"):
            assert getattr(s, c) == pytest.approx(getattr(last, c))


def test_empty_and_single(spark):
    empty = metrics.prequential_metrics(spark.createDataFrame([], SCHEMA), KEYS)
    assert empty.count() == 0 and "window_mse" in empty.columns
    one = metrics.prequential_metrics(spark.createDataFrame(run("regression", 1, (), ()), SCHEMA), KEYS).collect()
    assert len(one) == 1 and one[0].cumulative_mae == one[0].window_mae


def test_scores(spark):
    rows = [("d", "classification", "m", i, float(p), float(a), float(p != a), False) for i, (p, a) in enumerate([(1, 1), (1, 0), (0, 0), (0, 0), (1, 1), (0, 1)])]
    out = {r["class"]: r for r in metrics.classification_scores(spark.createDataFrame(rows, SCHEMA), KEYS).collect()}
    assert out[1].accuracy == pytest.approx(4 / 6) and out[1].kappa == pytest.approx(1 / 3)
    assert out[1].precision == pytest.approx(2 / 3) and out[0].recall == pytest.approx(2 / 3)


def test_decimal_errors_do_not_depend_on_blocks(spark):
    rows = [(*r[:6], None if r[6] is None else Decimal(f"{r[6]:.2f}"), r[7]) for r in run("regression", 500, (200,))]
    df = spark.createDataFrame(rows, SCHEMA.replace("error double", "error decimal(12,2)"))
    a = metrics.prequential_metrics(df, KEYS, window_rows=30, block_rows=40)
    b = metrics.prequential_metrics(df, KEYS, window_rows=30, block_rows=4000)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_log_and_rate_of_logging(spark):
    rows = run("regression", 250, (), ())
    log = metrics.metrics_log(metrics.prequential_metrics(spark.createDataFrame(rows, SCHEMA), KEYS), every=100)
    assert sorted(r.instance for r in log.select("instance").collect()) == [100, 200]
    assert log.filter(F.col("cumulative_mae").isNull()).count() == 0


def test_timed_log_by_count_and_by_tick(spark):
    from pyspark.sql import functions as F

    rows = [("a", i, 100 + i // 7 + (50 if i > 40 else 0)) for i in range(1, 90)] + [("b", 5, 0)]
    df = spark.createDataFrame(rows, "k string, instance_id long, s long").withColumn("at", F.timestamp_seconds("s"))
    got = {(r["k"], r["instance"]) for r in metrics.timed_log(df, ["k"], "at", 3, every=20).collect()}
    ticks = {}
    for k, i, s in rows:
        ticks.setdefault((k, s // 3), i)
    assert got == {(k, i) for (k, _), i in ticks.items()} | {(k, i) for k, i, _ in rows if i % 20 == 0}

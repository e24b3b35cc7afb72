"""Joins of drift events with metric histories, and the views over logs."""

import statistics

import pytest
from pyspark.sql import functions as F

from tidemark.operators import analysis, compare, inject, preprocess
from tidemark.sources import logs, streams

LOG = (
    "dataset string, task string, model string, instance long, cumulative_accuracy double, window_accuracy double, "
    "cumulative_mae double, cumulative_mse double, window_mae double, window_mse double"
)
DRIFT = "dataset string, task string, model string, instance_id long"


def log_rows(task="classification", model="m", n=300, step=10, missing=()):
    out = []
    for i in range(step, n * step + 1, step):
        v = None if i in missing else (i % 70) / 100
        cls = task == "classification"
        out.append(("d", task, model, i, v if cls else None, v if cls else None, None if cls else v, None, None if cls else v, None))
    return out


def value(row):
    return row[4] if row[1] == "classification" else row[6]


def brute_impact(rows, d, keep=500):
    before = [r for r in rows if r[3] < d]
    after = [r for r in rows if r[3] > d]
    if not before or not after:
        return None
    recovery = after[:keep]
    return (value(before[-1]), value(after[0]), value(recovery[-1]), len(recovery), recovery[-1][3] - d)


@pytest.mark.parametrize("task", ["classification", "regression"])
@pytest.mark.parametrize("keep", [3, 500])
def test_impact(spark, task, keep):
    rows = log_rows(task)
    points = [5, 10, 11, 1500, 1505, 2990, 2995, 3000, 4000]
    drifts = spark.createDataFrame([("d", task, "m", d) for d in points] + [("d", task, "absent", 7)], DRIFT)
    out = analysis.drift_impact(spark.createDataFrame(rows, LOG), drifts, recovery_rows=keep).collect()
    got = {
        r.drift_instance: (
            r.before_performance,
            r.immediate_after_performance,
            r.recovery_performance,
            r.recovery_time,
            r.recovery_instances,
        )
        for r in out
    }
    assert got == {d: b for d in points if (b := brute_impact(rows, d, keep))}
    sign = 1 if task == "classification" else -1
    for r in out:
        assert r.immediate_drop == pytest.approx(sign * (r.before_performance - r.immediate_after_performance))
        assert r.recovery_amount == pytest.approx(sign * (r.recovery_performance - r.immediate_after_performance))


@pytest.mark.parametrize("window", [40, 500])
def test_shift_and_spread(spark, window):
    rows = log_rows(missing=(1000, 1010))
    points = [3, 10, 500, 1005, 1700, 2999, 3000, 9000]
    drifts = spark.createDataFrame([("d", "classification", "m", d) for d in points], DRIFT)
    metrics = spark.createDataFrame(rows, LOG)
    shifts = {r.drift_instance: r for r in analysis.mean_shift(metrics, drifts, window).collect()}
    spread = {r.drift_instance: r for r in analysis.accuracy_variance(metrics, drifts, window).collect()}
    for d in points:
        before = [value(r) for r in rows if d - window <= r[3] < d]
        after = [value(r) for r in rows if d < r[3] <= d + window]
        assert (d in shifts) == (d in spread) == bool(before and after)
        if d in shifts:
            b, a = ([v for v in side if v is not None] for side in (before, after))
            assert shifts[d].before_mean == pytest.approx(statistics.mean(b))
            assert shifts[d].shift == pytest.approx(statistics.mean(a) - statistics.mean(b))
            assert shifts[d].shift_type == ("decrease" if shifts[d].shift < 0 else "increase")
            want = statistics.stdev(b) if len(b) > 1 else None
            assert spread[d].before_std == (pytest.approx(want) if want is not None else None)


def test_all_missing_side_keeps_the_row(spark):
    rows = log_rows(n=20, missing=tuple(range(110, 210)))
    drifts = spark.createDataFrame([("d", "classification", "m", 105)], DRIFT)
    r = analysis.mean_shift(spark.createDataFrame(rows, LOG), drifts).first()
    assert r.after_mean is None and r.shift is None and r.shift_type == "increase"


def test_empty_inputs(spark):
    metrics, drifts = spark.createDataFrame([], LOG), spark.createDataFrame([], DRIFT)
    assert analysis.mean_shift(metrics, drifts).count() == 0
    assert analysis.drift_impact(metrics, drifts).count() == 0
    report = analysis.drift_report(
        drifts,
        analysis.mean_shift(metrics, drifts),
        analysis.drift_impact(metrics, drifts),
        analysis.accuracy_variance(metrics, drifts),
    )
    assert {(r.metric, r.value) for r in report.filter("section = 'summary' and metric = 'models'").collect()} == {("models", 0.0)}


def test_best_ties_and_nulls(spark):
    rows = [
        ("d", "classification", "b", 1, 0.8, None, None, None, None, None),
        ("d", "classification", "a", 1, 0.8, None, None, None, None, None),
        ("d", "regression", "x", 1, None, None, None, None, None, None),
        ("e", "regression", "y", 1, None, None, 3.0, None, None, None),
        ("e", "regression", "z", 1, None, None, 2.0, None, None, None),
    ]
    best = compare.best_runs(compare.latest(spark.createDataFrame(rows, LOG)))
    assert sorted((r.dataset, r.model, r.value) for r in best.collect()) == [("d", "a", 0.8), ("e", "z", 2.0)]


def test_latest_skips_nulls_per_column(spark):
    rows = [
        ("d", "classification", "m", 1, 0.5, 0.4, None, None, None, None),
        ("d", "classification", "m", 2, None, 0.6, None, None, None, None),
    ]
    r = compare.latest_table(spark.createDataFrame(rows, LOG)).first()
    assert (r.instance, r.cumulative_accuracy, r.window_accuracy, r.cumulative_mae) == (2, "0.5000", "0.6000", "N/A")


def test_selection(spark):
    df = spark.createDataFrame(log_rows() + log_rows("regression", "n"), LOG)
    assert compare.select_runs(df).count() == 600
    assert compare.select_runs(df, task="regression", models=["m"]).count() == 0
    assert compare.series(df, "rolling", task="regression", dataset="d", models=["n"]).count() == 300


def test_injection(spark):
    df = spark.range(1, 11).select(F.col("id").alias("instance_id"), (F.col("id") % 3).cast("int").alias("label"), F.col("id").cast("double").alias("target"))
    swapped = {r.instance_id: (r.label, r.drift_injected) for r in inject.inject_label_swap(df, 5).collect()}
    assert swapped[4] == (1, False) and swapped[5] == (2, True) and swapped[6] == (1, True) and swapped[7] == (0, True)
    scaled = {r.instance_id: r.target for r in inject.inject_target_scale(df, 5).collect()}
    assert scaled[4] == 4.0 and scaled[5] == 10.0
    off = inject.inject_label_swap(df, 5, inject=False)
    assert off.filter("drift_injected").count() == 0


@pytest.mark.parametrize("wide", [False, True])
@pytest.mark.parametrize("block", [13, 1000])
def test_normalize(spark, wide, block, monkeypatch):
    if wide:
        monkeypatch.setattr(preprocess, "WIDE", 1)
    import random

    rng = random.Random(2)
    rows = [(i, [rng.random() * 9, 4.0, float("nan") if i % 11 == 0 else -float(i)]) for i in range(1, 151)]
    df = spark.createDataFrame([("k", *r) for r in rows], "k string, instance_id long, features array<double>")
    got = {r.instance_id: r.features for r in preprocess.normalize_stream(df, ["k"], 3, block_rows=block).collect()}
    from tidemark.operators.prequential import Scaler

    scaler = Scaler()
    for i, x in rows:
        assert got[i] == pytest.approx(scaler.apply(x))


def test_sticky_nan(spark):
    rows = [("k", i, [float("nan") if i == 3 else float(i)]) for i in range(1, 6)]
    df = spark.createDataFrame(rows, "k string, instance_id long, features array<double>")
    out = preprocess.normalize_stream(df, ["k"], 1, warmup_rows=1, sticky_nan=True)
    assert [r.features[0] for r in out.orderBy("instance_id").collect()] == [0.0, 1.0, 0.0, 0.0, 0.0]


def test_logs_round_trip_and_rejects(spark, tmp_path):
    df = spark.createDataFrame(log_rows(missing=(20,)) + log_rows("regression", "two_words"), LOG)
    root = str(tmp_path / "logs")
    logs.write_metric_logs(df, root)
    folder = tmp_path / "logs" / "run=d_classification_m_metrics.csv"
    (folder / "part-bad.csv").write_text("instance,cumulative_accuracy,window_accuracy\nx1,0.5,abc\n7,N/A,0.25\n")
    (tmp_path / "logs" / "notes.csv").write_text("a\n")
    other = tmp_path / "logs" / "run=d_classification_my_regression_model_metrics.csv"
    other.mkdir()
    (other / "part-0.csv").write_text("instance,cumulative_accuracy,window_accuracy\n")
    assert [r.file.rsplit("/", 1)[1] for r in logs.unread_files(spark, root).collect()] == ["notes.csv"]
    read, rejects = logs.read_metric_logs(spark, root)
    assert read.count() == 601 and rejects.count() == 1
    assert {r.model for r in read.select("model").distinct().collect()} == {"m", "two_words"}
    assert read.filter("instance = 20 and model = 'm'").first().cumulative_accuracy is None
    assert read.filter("instance = 7").first().window_accuracy == 0.25


def test_summary_files(spark, tmp_path):
    (tmp_path / "electricity_classification_hoeffding_tree_metrics_results.json").write_text(
        '{\n "total_instances": 9,\n "drift_events": 1,\n "drift_details": [\n {"instance_id": 4, "detector": "ADWIN", '
        '"timestamp": "2025-11-15T10:00:00.5"}],\n "cumulative_accuracy": 0.5,\n "window_accuracy": null\n}'
    )
    (tmp_path / "bike_regression_sgd_results.json").write_text('{"status": "failed"}')
    (tmp_path / "odd_results.json").write_text("not json {")
    read = logs.read_run_summaries(spark, str(tmp_path))
    assert [r.file.rsplit("/", 1)[1] for r in logs.rejected_summaries(spark, str(tmp_path)).collect()] == ["odd_results.json"]
    done = {(r.dataset, r.task, r.model): r.total_instances for r in compare.compare_runs(read).collect()}
    assert done == {("electricity", "classification", "hoeffding_tree"): 9}
    assert [(r.model, r.instance_id) for r in logs.drift_details(read).collect()] == [("hoeffding_tree", 4)]


def test_messages(spark):
    df = spark.createDataFrame([('{"instance_id":1,"features":[1.0,NaN],"label":1}',), ("broken",)], "value string")
    out = streams.decode(df).collect()
    assert out[0].instance_id == 1 and out[0].features[1] != out[0].features[1] and out[1].instance_id is None
    options = streams.kafka_options("stream-bike", "host:9092", max_per_trigger=5)
    assert options["startingOffsets"] == "latest" and options["maxOffsetsPerTrigger"] == "5"
    assert streams.kafka_sink_options("t", "h")["kafka.acks"] == "all"


def test_boxes_and_histogram(spark):
    df = spark.createDataFrame([("m", float(v)) for v in [1, 2, 3, 4, 100]], "model string, v double")
    r = analysis.box_stats(df, "v").first()
    assert (r.q1, r.median, r.q3, r.low_whisker, r.high_whisker, r.outliers) == (2, 3, 4, 1, 4, 1)
    bins = {r.bin: r.rows for r in analysis.histogram(df, "v", bins=3).collect()}
    assert bins == {1: 4, 3: 1}


def test_drift_events_are_stored_whole(spark, tmp_path):
    many = 100_050
    events = spark.range(1, many + 1).select(
        F.lit("d").alias("dataset"),
        F.lit("regression").alias("task"),
        F.lit("my_model").alias("model"),
        (F.col("id") * 2000).alias("instance_id"),
        F.lit("ADWIN").alias("detector"),
        F.current_timestamp().alias("timestamp"),
    )
    logs.write_drift_events(events, str(tmp_path))
    read = logs.read_drift_events(spark, str(tmp_path))
    assert read.groupBy("dataset", "task", "model").agg(F.count("timestamp"), F.max("instance_id")).collect() == [
        ("d", "regression", "my_model", many, many * 2000)
    ]


def test_summary_queries_know_every_drift(spark, tmp_path, monkeypatch):
    from tidemark.catalog import queries

    many = 100_050
    pred = spark.range(1, many + 1).select(
        F.lit("d").alias("dataset"),
        F.lit("regression").alias("task"),
        F.lit("m").alias("model"),
        F.col("id").alias("instance_id"),
        F.lit(1.0).alias("prediction"),
        F.lit(1.0).alias("actual"),
        F.lit(0).alias("error"),
        F.lit(True).alias("drift"),
    )
    monkeypatch.setattr(queries, "_pred", lambda spark, sf_dir: pred)
    assert queries.summary_scan_events(spark, "").agg(F.count("*"), F.max("instance_id")).first() == (many, many)
    row = queries.preq_run_summary(spark, "").first()
    assert (row.drift_events, row.first_drift, row.listed_drifts) == (many, 1, many)

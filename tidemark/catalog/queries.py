"""Registered queries: each operator over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import adwin, adwin_blocks, analysis, blocked_sgd, chunk_linear, compare, cumulative, gate, inject, learners, metrics, neighbours, preprocess, speculative, trees
from tidemark.operators.prequential import TOY_DETECTION, Detection, TestThenTrain, compare_learners, prequential
from tidemark.plans.ranked import rank_blocks
from tidemark.session import materialize, scratch_path
from tidemark.sources import logs, streams, tables
from tidemark.sources.tables import KEYS, table
from tidemark.streaming import prequential as streaming

Query = Callable[[SparkSession, str], DataFrame]
USER_KEYS = [*KEYS, "user_id"]
_derived: dict[tuple[str, str, str], DataFrame] = {}


def _once(spark: SparkSession, sf_dir: str, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Intermediate tables (predictions, metric log) are written once per application, as the files
    that the analyses read."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _derived:
        _derived[key] = materialize(build(), label)
    return _derived[key]


def _pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "predictions", lambda: tables.predictions(spark, sf_dir))


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric log with every evaluated row."""
    return _once(
        spark,
        sf_dir,
        "metric_log",
        lambda: metrics.prequential_metrics(_pred(spark, sf_dir), KEYS).withColumnRenamed("instance_id", "instance"),
    )


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative metrics of every evaluated row: the log if it is at hand, else these columns alone."""
    if (spark.sparkContext.applicationId, sf_dir, "metric_log") in _derived:
        return _log(spark, sf_dir)
    return _once(
        spark,
        sf_dir,
        "cumulative_log",
        lambda: cumulative.cumulative_metrics(_pred(spark, sf_dir), KEYS).withColumnRenamed("instance_id", "instance"),
    )


def _drifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written once too, so that joins are planned by the size of the drifts, not of the predictions."""
    return _once(spark, sf_dir, "drifts", lambda: _pred(spark, sf_dir).filter("drift").select(*KEYS, "instance_id"))


def _task(df: DataFrame, task: str) -> DataFrame:
    return df.filter(F.col("task") == task)


def _rounded(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(
        *[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


# injection, messages, preprocessing


def inject_label_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = inject.inject_label_swap(tables.instances_classification(spark, sf_dir), drift_point=4000)
    return out.select("instance_id", "label", "drift_injected")


def inject_target_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = inject.inject_target_scale(tables.instances_regression(spark, sf_dir), drift_point=4000)
    return out.select("instance_id", "target", "drift_injected")


def encode_decode_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    cls = inject.inject_label_swap(tables.instances_classification(spark, sf_dir), drift_point=4000)
    reg = inject.inject_target_scale(tables.instances_regression(spark, sf_dir), drift_point=4000)
    sent = streams.encode(cls).unionByName(streams.encode(reg))
    got = streams.decode(sent)
    return got.select(
        "dataset",
        "task",
        "instance_id",
        F.col("features")[0].alias("x1"),
        F.col("features")[1].alias("x2"),
        streams.actual().alias("actual"),
        "drift_injected",
    )


def running_minmax_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = preprocess.normalize_stream(tables.instances_regression(spark, sf_dir), ["dataset", "task"], 2)
    return out.select("instance_id", F.col("features")[0].alias("x1"), F.col("features")[1].alias("x2"))


def normalize_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = preprocess.normalize_stream(tables.feature_vectors(spark, sf_dir), ["dataset", "task"], 64)
    return out.select("instance_id", F.posexplode("features").alias("feature", "value"))


def running_mean_m2(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.round(F.col("target") * 100).cast("decimal(12,0)")
    out = preprocess.running_moments(tables.instances_regression(spark, sf_dir), ["dataset", "task"], cents)
    return out.select("instance_id", "n", "running_mean", "running_m2")


# metrics


def preq_reg_segment_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.prequential_metrics(_task(_pred(spark, sf_dir), "regression"), KEYS)
    return out.select(
        *KEYS, "instance_id", "n", "segment", "cumulative_mae", "cumulative_mse", "window_mae", "window_mse"
    )


def sparse_prefix_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics of streams whose ids lie a billion apart: blocks by exact rank."""
    pred = _task(_pred(spark, sf_dir), "regression").withColumn("instance_id", F.col("instance_id") * 1_000_000_000)
    out = metrics.prequential_metrics(rank_blocks(pred, KEYS, "instance_id", block_rows=1 << 12), KEYS)
    return out.select(*KEYS, "instance_id", "n", "segment", "cumulative_mae", "cumulative_mse", "window_mae", "window_mse")


def preq_cls_segment_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.prequential_metrics(_task(_pred(spark, sf_dir), "classification"), KEYS)
    return out.select(
        *KEYS,
        "instance_id",
        "n",
        "segment",
        "cumulative_accuracy",
        "cumulative_accuracy_as_coded",
        "segment_accuracy",
        "window_accuracy",
    )


def preq_keyed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user is a stream of its own; a drift is a row of type ``error``."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    pred = (
        _pred(spark, sf_dir)
        .filter("task = 'regression' and model = 'last_user'")
        .join(events.withColumn("instance_id", F.col("event_id") + 1), "instance_id")
        .withColumn("drift", F.col("prediction").isNotNull() & (F.col("event_type") == "error"))
        .filter("dataset = 'events'")
    )
    out = metrics.prequential_metrics(pred, USER_KEYS, window_rows=20, warmup_rows=5)
    return out.select(
        "user_id", "instance_id", "n", "segment", "segment_row", "cumulative_mae", "window_mae", "window_mse"
    )


def prediction_diversity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.prediction_diversity(_pred(spark, sf_dir), KEYS)


def metrics_log_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic log itself: one row per 1000 instances is the operator's output."""
    out = metrics.metrics_log(metrics.prequential_metrics(_pred(spark, sf_dir), KEYS))
    return out.select(
        *KEYS,
        "instance",
        "cumulative_accuracy",
        "window_accuracy",
        "cumulative_mae",
        "cumulative_mse",
        "window_mae",
    )


def metrics_log_timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of the event streams by count and by time: every 1000th instance and the first one of each hour."""
    scored = metrics.prequential_metrics(_pred(spark, sf_dir), KEYS)
    times = table(spark, sf_dir, "events").select((F.col("event_id") + 1).alias("instance_id"), "ts")
    log = metrics.timed_log(scored.join(times, "instance_id"), KEYS, "ts", 3600)
    return log.select(*KEYS, "instance", "cumulative_accuracy", "window_accuracy", "cumulative_mae", "cumulative_mse", "window_mae")


def preq_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    pred = _pred(spark, sf_dir)
    events = metrics.drift_events(pred, KEYS)
    listed = events.groupBy(*KEYS).agg(
        F.min("instance_id").alias("first_drift"), F.count(F.lit(1)).cast("int").alias("listed_drifts")
    )
    return metrics.run_summary(pred, KEYS).join(listed, KEYS, "left").select(
        *KEYS,
        "total_instances",
        "drift_events",
        "first_drift",
        "listed_drifts",
        "cumulative_accuracy",
        "window_accuracy",
        "cumulative_mae",
        "cumulative_mse",
        "window_mae",
        "window_mse",
    )


def segment_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.number_segments(_pred(spark, sf_dir), KEYS)
    return out.select(*KEYS, "instance_id", "n", "n_correct", "segment", "segment_row")


def rows_since_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.rows_since_drift(_pred(spark, sf_dir), KEYS)
    return out.select(*KEYS, "instance_id", "rows_since_drift")


def confusion_kappa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.classification_scores(_task(_pred(spark, sf_dir), "classification"), KEYS)


def label_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document length as a predictor of the quality label: an imbalanced problem."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "source")
    pred = table(spark, sf_dir, "labels").join(docs, "doc_id").select(
        "source", F.col("quality").alias("actual"), (F.col("n_chars") >= 500).cast("int").alias("prediction")
    )
    return metrics.classification_scores(pred, ["source"])


def regression_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.regression_scores(_task(_pred(spark, sf_dir), "regression"), KEYS), 4)


def halo_equals_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocked scan and tiled rolling sum with small blocks; the oracle uses one global window."""
    from tidemark.plans.blocked import Scan, prefix_scan, rolling

    cents = tables.instances_regression(spark, sf_dir).withColumn(
        "cents", F.round(F.col("target") * 100).cast("long")
    )
    scanned = prefix_scan(
        cents,
        ["dataset"],
        "instance_id",
        {
            "n": Scan("count", F.lit(True)),
            "total": Scan("sum", F.col("cents")),
            "low": Scan("min", F.col("cents")),
            "high": Scan("max", F.col("cents")),
        },
        block_rows=700,
    )
    out = rolling(scanned, ["dataset"], "n", 1000, {"last_1000": F.col("cents")}, block_rows=1500)
    return out.select("instance_id", "n", "total", "low", "high", "last_1000")


# drift


def _alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").filter("event_type = 'error'").select(
        F.lit("events").alias("dataset"), (F.col("event_id") + 1).alias("instance_id")
    )


def drift_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.gate_alarms(_alarms(spark, sf_dir), ["dataset"])


def drift_detection_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inject.detection_delay(_pred(spark, sf_dir), _drifts(spark, sf_dir), KEYS, drift_point=4000)


def _injected_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of the persistence forecasts, multiplied by three in the second half of the stream."""
    pred = _pred(spark, sf_dir)
    half = pred.groupBy(*KEYS).agg((F.max("instance_id") / 2).alias("half"))
    return pred.join(half, KEYS).withColumn(
        "error", F.when(F.col("instance_id") > F.col("half"), F.col("error") * 3).otherwise(F.col("error"))
    )


def adwin_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = adwin.detect_drift(_injected_errors(spark, sf_dir), KEYS, F.col("error"))
    return out.filter("direction != 0")


def adwin_grained(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = adwin.detect_drift(_injected_errors(spark, sf_dir), KEYS, F.col("error"), grain=32)
    return out.filter("direction != 0")


def adwin_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One detector per user over its values."""
    rows = tables.instances_regression(spark, sf_dir)
    return adwin.detect_drift(rows, ["dataset", "task", "user_id"], F.col("target"), cooldown=0, min_rows=0)


def adwin_stream_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One detector over all events, in parallel blocks; values are tripled in the second half."""
    rows = tables.instances_regression(spark, sf_dir)
    half = rows.groupBy("dataset").agg((F.max("instance_id") / 2).alias("half"))
    value = F.when(F.col("instance_id") > F.col("half"), F.col("target") * 3).otherwise(F.col("target"))
    out = adwin_blocks.detect_drift_blocks(rows.join(half, "dataset"), ["dataset"], value, block_rows=8192)
    return out.filter("direction != 0")


def _toy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        tables.instances_regression(spark, sf_dir)
        .withColumns(
            {
                "model": F.lit("sgd_toy"),
                "features": F.slice("features", 1, 1),
                "actual": F.when(F.col("instance_id") < 4000, F.col("target")).otherwise(-5 * F.col("target")),
            }
        )
    )


def adwin_toy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prequential(_toy(spark, sf_dir), KEYS, detection=TOY_DETECTION, normalize=False)


# learners


def knn_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tables.feature_vectors(spark, sf_dir).withColumn("actual", F.col("label"))
    return neighbours.knn(rows, ["dataset", "task"], "classification", memory=100).select(
        "instance_id", "prediction", "actual"
    )


def knn_regress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicts the first embedding coordinate, scaled to an integer, from the others."""
    scaled = F.round(F.col("features")[0] * 1000)
    rows = tables.feature_vectors(spark, sf_dir).withColumns(
        {"actual": scaled, "features": F.slice("features", 2, 63)}
    )
    return neighbours.knn(rows, ["dataset", "task"], "regression", memory=100).select(
        "instance_id", "prediction", "actual"
    )


def _user_stream(spark: SparkSession, sf_dir: str, task: str, model: str) -> DataFrame:
    rows = (
        tables.instances_classification(spark, sf_dir).withColumn("actual", F.col("label"))
        if task == "classification"
        else tables.instances_regression(spark, sf_dir).withColumn("actual", F.col("target"))
    )
    return rows.withColumn("model", F.lit(model))


def _keyed(task: str, model: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = _user_stream(spark, sf_dir, task, model)
        out = prequential(rows, USER_KEYS, detection=None, normalize=False)
        return _rounded(out.select("user_id", "instance_id", "prediction", "error"))

    return run


LINEAR_MODELS = "model in ('sgd', 'sgd_toy', 'perceptron', 'passive_aggressive')"


def sgd_stream_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream per event type, each learned in parallel blocks."""
    rows = table(spark, sf_dir, "events").select(
        "event_type",
        (F.col("event_id") + 1).alias("instance_id"),
        F.array(F.get_json_object("props", "$.k").cast("double") / 100.0, F.hour("ts") / 24.0).alias("features"),
        F.col("value").alias("actual"),
    )
    out = blocked_sgd.sgd_regression(rows, ["event_type"], block_rows=500, exact=True)
    return _rounded(out.select("event_type", "instance_id", "prediction"))


def sgd_drift_speculative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as one stream with detector and reset, learned in parallel blocks."""
    rows = table(spark, sf_dir, "events").select(
        F.lit("events").alias("dataset"),
        (F.col("event_id") + 1).alias("instance_id"),
        F.array(F.get_json_object("props", "$.k").cast("double") / 100.0, F.hour("ts") / 24.0).alias("features"),
        F.col("value").alias("actual"),
    )
    out = speculative.sgd_with_resets(rows, ["dataset"], block_rows=5000)
    return _rounded(out.select("dataset", "instance_id", "prediction", "drift", "segment"))


def _chunked(task: str, loss: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = _user_stream(spark, sf_dir, task, loss)
        return _rounded(chunk_linear.chunked_linear(rows, ["dataset", "task"], loss, first_rows=1250, eta=0.5))

    return run


def multi_learner_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All linear learners on all user streams in one job, then one line per learner."""
    cls = _user_stream(spark, sf_dir, "classification", "").drop("model", "label")
    reg = _user_stream(spark, sf_dir, "regression", "").drop("model", "target")
    models = learners.registry(spark).filter(LINEAR_MODELS)
    runs = compare_learners(
        cls.unionByName(reg), models, ["dataset", "task", "user_id"], detection=None, normalize=False
    )
    return (
        runs.filter("prediction is not null")
        .groupBy("task", "model")
        .agg(F.count(F.lit(1)).alias("evaluated"), F.round(F.avg("error"), 4).alias("mean_error"))
    )


def multiclass_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The linear classifiers on ten labels, over four streams of vectors."""
    rows = tables.feature_vectors(spark, sf_dir).select(
        "task",
        (F.col("instance_id") % 4).alias("stream"),
        "instance_id",
        "features",
        F.col("label").cast("double").alias("actual"),
    )
    models = learners.registry(spark).filter("task = 'classification'").filter(LINEAR_MODELS)
    runs = compare_learners(
        rows, models, ["task", "stream"], detection=None, normalize=False, classes=range(10)
    )
    return runs.select("model", "stream", "instance_id", "prediction", "error")


def preq_with_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every keyed linear learner with detector and reset, on streams with an injected drift."""
    cls = inject.inject_label_swap(tables.instances_classification(spark, sf_dir), 4000).withColumn("actual", F.col("label").cast("double"))
    reg = inject.inject_target_scale(tables.instances_regression(spark, sf_dir), 4000).withColumn("actual", F.col("target"))
    columns = ["dataset", "task", "instance_id", "features", "actual"]
    both = cls.select(*columns).unionByName(reg.select(*columns))
    models = learners.registry(spark).filter(LINEAR_MODELS)
    return compare_learners(both, models)


def _user_instances(spark: SparkSession, sf_dir: str, injected: bool = False) -> DataFrame:
    """Both tasks over the events, one stream per user, optionally with drift injected in the middle."""
    cls, reg = tables.instances_classification(spark, sf_dir), tables.instances_regression(spark, sf_dir)
    if injected:
        middle = table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] // 2
        cls, reg = inject.inject_label_swap(cls, middle), inject.inject_target_scale(reg, middle)
    columns = ["dataset", "task", "user_id", "instance_id", "features", "actual"]
    cls = cls.withColumn("actual", F.col("label").cast("double")).select(*columns)
    return cls.unionByName(reg.withColumn("actual", F.col("target")).select(*columns))


def all_learner_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every learner of the registry, with detector and reset, on all user streams with an injected drift."""
    runs = compare_learners(
        _user_instances(spark, sf_dir, injected=True),
        learners.registry(spark),
        ["dataset", "task", "user_id"],
        detection=Detection(cooldown=100, min_rows=30),
    )
    return runs.groupBy("task", "model").agg(
        F.count("prediction").alias("evaluated"), F.count_if("drift").alias("drifts"), F.avg("error").alias("mean_error")
    )


def detected_drift_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the detector to the analysis: 16 streams per task with drift injected in the middle, a linear learner
    on each, the log of its metrics, and per run the detection delay and what its alarms did to the metrics."""
    middle = table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] // 2
    rows = _user_instances(spark, sf_dir, injected=True)
    model = F.concat(F.lit("sgd_"), (F.col("user_id") % 16).cast("string"))
    runs = prequential(
        rows.withColumn("model", model),
        KEYS,
        detection=Detection(cooldown=100, min_rows=30),
        learner=lambda key: learners.create_learner(key["task"], "sgd"),
    )
    runs = materialize(runs, "detected-runs")
    drifts = materialize(runs.filter("drift").select(*KEYS, "instance_id"), "detected-drifts")
    log = metrics.prequential_metrics(runs, KEYS).withColumnRenamed("instance_id", "instance")
    log = materialize(log, "detected-log")
    shift = analysis.mean_shift(log, drifts).groupBy(*KEYS).agg(F.avg("shift").alias("average_shift"))
    impact = analysis.drift_impact(log, drifts).groupBy(*KEYS).agg(F.avg("immediate_drop").alias("average_drop"))
    delay = inject.detection_delay(runs, drifts, KEYS, middle)
    return _rounded(delay.join(shift, KEYS, "left").join(impact, KEYS, "left"))


def experiment_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predefined matrix run on the user streams; records and comparison are written and read back."""
    root = scratch_path(spark, "experiments")
    matrix = learners.experiment_matrix(spark)
    learners.check_requests(matrix)
    streams_ = _user_instances(spark, sf_dir).drop("dataset")
    # the matrix has a fixed number of rows
    asked = streams_.join(F.broadcast(matrix), "task")
    keys = [*KEYS, "user_id"]
    runs = prequential(asked, keys, detection=Detection(cooldown=100, min_rows=30))
    runs = materialize(runs, "experiment-runs")
    logs.write_experiment_records(metrics.run_summary(runs, keys), f"{root}/records", detection=True)
    logs.write_comparison(logs.read_experiment_records(spark, f"{root}/records"), f"{root}/comparison")
    return logs.read_comparison(spark, f"{root}/comparison")


def _trees(task: str, members: int, wide: bool) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if wide:
            rows, size = tables.feature_vectors(spark, sf_dir).withColumn("actual", F.col("label")), 64
            options = trees.TreeOptions(task, members, first_rows=100, grace_rows=50, split_delta=1e-3)
        else:
            rows, size = tables.instances_regression(spark, sf_dir).withColumn("actual", F.col("target")), 2
            options = trees.TreeOptions(task, members)
        position = None if wide else "n"
        scaled = preprocess.normalize_stream(rows, ["dataset", "task"], size, position=position)
        return trees.prequential_trees(scaled, ["dataset", "task"], size, options, position=position)

    return run


def split_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best cut of every embedding coordinate for telling the labels apart, at the root."""
    cells = (
        tables.feature_vectors(spark, sf_dir)
        .select(F.lit(0).alias("node"), F.col("label").alias("cls"), F.posexplode("features").alias("f", "x"))
        .groupBy("node", "f", trees.bin_of((F.col("x") + 1) / 2, 16).alias("bin"), "cls")
        .agg(F.count(F.lit(1)).cast("double").alias("w"), F.lit(0.0).alias("sy"), F.lit(0.0).alias("syy"))
    )
    gains = trees.split_gains(cells, ["node"], 16, "classification").withColumn("gain", F.round("gain", 9))
    return trees.best_cuts(gains, ["node"]).select("f", "n", "cut", "gain")


# analysis


def mean_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(analysis.mean_shift(_history(spark, sf_dir), _drifts(spark, sf_dir)))


def accuracy_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(analysis.accuracy_variance(_history(spark, sf_dir), _drifts(spark, sf_dir)))


def class_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.class_ratio_around_drift(
        tables.instances_classification(spark, sf_dir), _task(_drifts(spark, sf_dir), "classification")
    )


def drift_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(analysis.drift_impact(_history(spark, sf_dir), _drifts(spark, sf_dir)))


def drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, drifts = _history(spark, sf_dir), _drifts(spark, sf_dir)
    shifts = materialize(analysis.mean_shift(log, drifts), "shifts")
    impact = materialize(analysis.drift_impact(log, drifts), "impact")
    spread = analysis.accuracy_variance(log, drifts)
    return _rounded(analysis.drift_report(drifts, shifts, impact, spread), 4)


def drift_report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report as lines of text, written and read back."""
    path = scratch_path(spark, "report")
    analysis.report_lines(drift_report(spark, sf_dir)).write.text(path)
    return spark.read.text(path).select(F.col("value").alias("line"))


def _shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(analysis.mean_shift(_history(spark, sf_dir), _drifts(spark, sf_dir)))


def shift_boxstats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(analysis.box_stats(materialize(_shifts(spark, sf_dir), "shifts"), "shift_magnitude"), 4)


def shift_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.histogram(materialize(_shifts(spark, sf_dir), "shifts"), "shift")


def shift_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.bounds(_shifts(spark, sf_dir), "before_mean", "after_mean")


def drift_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.drift_timeline(_drifts(spark, sf_dir), ["last", "last_user"])


def drift_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.gap_between_drifts(_drifts(spark, sf_dir))


def metric_trajectory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.metric_trajectory(_history(spark, sf_dir), _drifts(spark, sf_dir))


def series_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.series(_log(spark, sf_dir), "cumulative", dataset="events")


def series_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.series(_log(spark, sf_dir), "rolling", task="regression", models=["last"])


def latest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.latest(_log(spark, sf_dir))


def latest_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.latest_table(_log(spark, sf_dir))


def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.best_runs(compare.latest(_log(spark, sf_dir)))


def run_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.compare_runs(metrics.run_summary(_pred(spark, sf_dir), KEYS))


def live_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = compare.live_stats(_log(spark, sf_dir), _drifts(spark, sf_dir), _hourly(spark, sf_dir), ["event_type"])
    return _rounded(stats, 9)


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly snapshots of how many events each type has seen."""
    return table(spark, sf_dir, "events").groupBy("event_type", F.date_trunc("hour", "ts").alias("at")).agg(
        F.max("event_id").alias("instances")
    )


def processing_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.processing_rate(_hourly(spark, sf_dir), ["event_type"])


def first_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis.first_models(analysis.drift_impact(_history(spark, sf_dir), _drifts(spark, sf_dir)))


def distinct_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.distinct_values(_log(spark, sf_dir))


def formatted_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names, numbers and timestamps as the reports print them."""
    events = table(spark, sf_dir, "events")
    path = F.concat(
        F.lit("/logs/"),
        text.run_file_name(F.lit("events"), F.initcap("event_type"), F.concat(F.lit("user_"), F.col("user_id")), "_metrics_results.json"),
    )
    parts = text.run_of_path(path)
    return events.select(
        "event_id",
        parts["dataset"].alias("dataset"),
        parts["task"].alias("task"),
        parts["model"].alias("model"),
        text.topic_name("stream-", F.col("event_type")).alias("topic"),
        text.thousands(F.col("event_id")).alias("shown_id"),
        text.number(F.when(F.col("event_type") == "error", text.MISSING).otherwise(F.col("value").cast("string"))).alias("parsed"),
        text.seconds_between(F.date_trunc("day", "ts"), F.col("ts")).alias("second_of_day"),
    )


# logs, experiments, streaming


def log_scan_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the runs' CSV logs, reads all files back and unites them."""
    root = scratch_path(spark, "logs")
    logs.write_metric_logs(_log(spark, sf_dir), root)
    read, _ = logs.read_metric_logs(spark, root)
    return read.select(
        *KEYS, "instance", "cumulative_accuracy", "window_accuracy", "cumulative_mae", "cumulative_mse", "window_mae"
    )


def summary_scan_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the runs' JSON summaries and, beside them, their drift events, and reads the events back."""
    root, pred = scratch_path(spark, "summaries"), _pred(spark, sf_dir)
    logs.write_run_summaries(metrics.run_summary(pred, KEYS), root)
    logs.write_drift_events(metrics.drift_events(pred, KEYS), root)
    runs = logs.read_run_summaries(spark, root).select(*KEYS)
    return logs.read_drift_events(spark, root).join(runs, KEYS, "left_semi").select(*KEYS, "instance_id", "detector")


def model_task_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests named by the events; which of them no learner can serve, and how often they came."""
    names = ["hoeffding_tree", "arf", "knn", "sgd", "passive_aggressive", "perceptron", "fimtdd", "lstm"]
    specs = table(spark, sf_dir, "events").select(
        F.concat_ws(
            ":",
            F.col("event_type"),
            F.when(F.col("user_id") % 2 == 0, "classification").otherwise("regression"),
            F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("event_id") % 8 + 1).cast("int")),
        ).alias("spec")
    )
    bad = learners.unsupported(learners.parse_experiments(specs))
    return bad.groupBy("dataset", "task", "model").agg(F.count(F.lit(1)).alias("requests"))


def experiment_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predefined experiments joined to their streams: the rows each run has to process."""
    cls = tables.instances_classification(spark, sf_dir).select(
        F.lit("electricity").alias("dataset"), "task", "instance_id"
    )
    reg = tables.instances_regression(spark, sf_dir).select(F.lit("bike").alias("dataset"), "task", "instance_id")
    # the matrix has a fixed number of rows
    runs = cls.unionByName(reg).join(F.broadcast(learners.experiment_matrix(spark)), ["dataset", "task"])
    return runs.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("instances"), F.max("instance_id").alias("last_instance")
    )


def stream_preq_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metric log of a streaming run over JSON files; same rows as the batch log."""
    root = scratch_path(spark, "stream")
    reg = tables.instances_regression(spark, sf_dir).withColumn("target", F.round(F.col("target") * 100))
    cls = tables.instances_classification(spark, sf_dir)
    for sent in (reg, cls):
        streams.encode(sent).write.mode("append").text(f"{root}/in")
    # a few files at a time, in whatever order: early rows wait in the state
    received = streams.decode(streams.read_files(spark, f"{root}/in", "value string", "text", files_per_trigger=4))
    runs = received.select(
        "dataset", "task", F.lit("last").alias("model"), "instance_id", "features", streams.actual().alias("actual")
    )

    def make(key):
        return streaming.FixedDrift(TestThenTrain(key["task"], streaming.Persistence, None, False), 2500)

    streaming.drain(streaming.stream_metrics(runs, KEYS, make=make), f"{root}/out", f"{root}/checkpoint")
    # rows behind ids that never came
    waiting = streaming.waiting_metrics(spark, f"{root}/checkpoint", KEYS, make=make)
    out = spark.read.parquet(f"{root}/out").unionByName(waiting)
    return out.select(
        *KEYS,
        "instance",
        "n",
        "segment",
        "cumulative_accuracy",
        "window_accuracy",
        (F.col("cumulative_mae") / 100).alias("cumulative_mae"),
        (F.col("window_mae") / 100).alias("window_mae"),
    )


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        inject_label_swap,
        inject_target_scale,
        encode_decode_roundtrip,
        running_minmax_normalize,
        normalize_wide,
        running_mean_m2,
        preq_reg_segment_metrics,
        sparse_prefix_metrics,
        preq_cls_segment_metrics,
        preq_keyed_metrics,
        prediction_diversity,
        metrics_log_periodic,
        metrics_log_timed,
        preq_run_summary,
        segment_assign,
        rows_since_drift,
        confusion_kappa,
        label_scores,
        regression_scores,
        halo_equals_global,
        drift_gate,
        drift_detection_delay,
        adwin_runs,
        adwin_grained,
        adwin_keyed,
        adwin_stream_blocks,
        adwin_toy,
        knn_classify,
        knn_regress,
        sgd_stream_blocked,
        sgd_drift_speculative,
        multi_learner_compare,
        multiclass_linear,
        all_learner_compare,
        detected_drift_analysis,
        experiment_results,
        preq_with_drift,
        split_statistics,
        mean_shift,
        accuracy_variance,
        class_ratio,
        drift_impact,
        drift_report,
        drift_report_text,
        shift_boxstats,
        shift_histogram,
        shift_bounds,
        drift_timeline,
        drift_gaps,
        metric_trajectory,
        series_cumulative,
        series_rolling,
        latest_metrics,
        latest_table,
        best_model,
        run_comparison,
        live_stats,
        processing_rate,
        first_models,
        distinct_lists,
        formatted_names,
        log_scan_union,
        summary_scan_events,
        model_task_check,
        experiment_matrix,
        stream_preq_metrics,
    )
}
QUERIES |= {
    "sgd_regress_keyed": _keyed("regression", "sgd"),
    "sgd_toy_keyed": _keyed("regression", "sgd_toy"),
    "sgd_classify_keyed": _keyed("classification", "sgd"),
    "perceptron_keyed": _keyed("classification", "perceptron"),
    "pa_keyed": _keyed("classification", "passive_aggressive"),
    "pa_chunked": _chunked("classification", learners.PASSIVE_AGGRESSIVE),
    "sgd_classify_chunked": _chunked("classification", learners.HINGE),
    "hoeffding_tree_preq": _trees("classification", 1, wide=True),
    "fimtdd_preq": _trees("regression", 1, wide=False),
    "arf_classify_preq": _trees("classification", learners.ENSEMBLE_SIZE, wide=True),
    "arf_regress_preq": _trees("regression", learners.ENSEMBLE_SIZE, wide=False),
}

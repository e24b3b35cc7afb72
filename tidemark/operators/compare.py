"""Views over metric logs and run summaries: latest state, best runs, live figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import four_places, seconds_between
from tidemark.operators.analysis import KEYS, performance, recent_performance

METRICS = (
    "cumulative_accuracy",
    "window_accuracy",
    "cumulative_mae",
    "cumulative_mse",
    "window_mae",
    "window_mse",
)


def select_runs(df: DataFrame, task: str = "all", dataset: str = "all", models: Sequence[str] = ()) -> DataFrame:
    """``all`` and an empty model list let everything through."""
    if task != "all":
        df = df.filter(F.col("task") == task)
    if dataset != "all":
        df = df.filter(F.col("dataset") == dataset)
    return df.filter(F.col("model").isin(list(models))) if models else df


def latest(log: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """Per run, the last known value of every column (nulls do not hide earlier values)."""
    return log.groupBy(*KEYS).agg(
        F.max("instance").alias("instance"),
        *[F.max_by(m, F.when(F.col(m).isNotNull(), F.col("instance"))).alias(m) for m in metrics],
    )


def latest_table(log: DataFrame) -> DataFrame:
    """The same, formatted."""
    state = latest(log)
    return state.select(*KEYS, "instance", *[four_places(F.col(m)).alias(m) for m in METRICS])


def series(
    log: DataFrame, kind: str = "cumulative", task: str = "all", dataset: str = "all", models: Sequence[str] = ()
) -> DataFrame:
    """One metric series per run, missing points dropped. Order by instance when displaying."""
    value = performance() if kind == "cumulative" else recent_performance()
    return (
        select_runs(log, task, dataset, models)
        .select(*KEYS, "instance", value.alias("value"))
        .na.drop(subset=["value"])
    )


def best_runs(summary: DataFrame, by: Sequence[str] = ("dataset", "task")) -> DataFrame:
    """Best run per group: highest accuracy, lowest error; ties by name; no row when all are null."""
    score = F.when(F.col("task") == "classification", -F.col("cumulative_accuracy")).otherwise(F.col("cumulative_mae"))
    fields = [k for k in KEYS if k not in by]
    first = F.min(F.struct(score.alias("score"), *fields, performance().alias("value"))).alias("first")
    best = summary.filter(score.isNotNull()).groupBy(*by).agg(first)
    return best.select(*by, *[F.col(f"first.{f}") for f in fields], "first.value").select(*KEYS, "value")


def live_stats(log: DataFrame, drifts: DataFrame, snapshots: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: furthest instance, sum of run lengths, drift events, mean accuracy, active models, rate.

    The rate is the sum over ``keys`` of the instances per second between their two latest ``snapshots``.
    """
    figures = latest(log).agg(
        F.max("instance").alias("max_instance"),
        F.sum("instance").alias("total_instances"),
        F.avg(F.when(F.col("task") == "classification", F.col("cumulative_accuracy"))).alias("average_accuracy"),
        F.count_distinct("model").alias("active_models"),
    )
    rates = processing_rate(snapshots, keys).groupBy(*keys).agg(F.max_by("rate", "at").alias("rate"))
    return figures.withColumns(
        {
            "drift_events": drifts.agg(F.count(F.lit(1))).scalar(),
            "processing_rate": rates.agg(F.sum("rate")).scalar(),
        }
    )


def processing_rate(snapshots: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Instances per second between consecutive snapshots (``at``, ``instances``); 0 when not growing."""
    order = Window.partitionBy(*keys).orderBy("at")
    grown = F.col("instances") - F.lag("instances").over(order)
    seconds = seconds_between(F.lag("at").over(order), F.col("at"))
    return snapshots.select(
        *keys,
        "at",
        "instances",
        F.when((grown > 0) & (seconds > 0), grown / seconds).otherwise(F.lit(0.0)).alias("rate"),
    )


def compare_runs(summary: DataFrame) -> DataFrame:
    """One row per finished run; metrics of the other task are null."""
    is_cls = F.col("task") == "classification"
    return summary.filter("total_instances is not null").select(
        *KEYS,
        "total_instances",
        "drift_events",
        *[F.when(is_cls, F.col(c)).alias(c) for c in ("cumulative_accuracy", "window_accuracy")],
        *[F.when(~is_cls, F.col(c)).alias(c) for c in ("cumulative_mae", "cumulative_mse", "window_mae")],
    )


def distinct_values(log: DataFrame) -> DataFrame:
    """Distinct datasets, tasks and models as (kind, value)."""
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("value")) for k in KEYS])).alias("p")
    return log.select(kinds).select("p.kind", "p.value").distinct().orderBy("kind", "value")

"""Drift events joined to metric histories: shift, spread, impact, report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import four_places, shift_type
from tidemark.plans.blocked import Scan, prefix_scan

KEYS = ("dataset", "task", "model")
SHIFT_WINDOW = 500
SPREAD_WINDOW = 1000
RECOVERY_ROWS = 500


def performance() -> Column:
    """The metric a task is judged by: accuracy or mean absolute error."""
    return F.when(F.col("task") == "classification", F.col("cumulative_accuracy")).otherwise(F.col("cumulative_mae"))


def recent_performance() -> Column:
    return F.when(F.col("task") == "classification", F.col("window_accuracy")).otherwise(F.col("window_mae"))


def around_drift(
    metrics: DataFrame, drifts: DataFrame, window: int, keys: Sequence[str] = KEYS, instance: str = "instance"
) -> DataFrame:
    """Metric rows within ``window`` instances before or after each drift; ``side`` is -1 or 1.

    The range becomes an equi join on (keys, bucket of ``window`` instances): a drift looks at three
    buckets, and no bucket holds more than ``window`` rows of a stream.
    """
    bucketed = metrics.withColumn("__bucket", F.expr(f"`{instance}` div {window}"))
    spans = drifts.select(*keys, F.col("instance_id").alias("drift_instance")).withColumn(
        "__bucket",
        F.explode(F.sequence(F.expr(f"(drift_instance - {window}) div {window} - 1"), F.expr(f"(drift_instance + {window}) div {window}"))),
    )
    at, drift = F.col(instance), F.col("drift_instance")
    near = bucketed.join(spans, [*keys, "__bucket"]).filter(
        (at >= drift - window) & (at <= drift + window) & (at != drift)
    )
    return near.withColumn("side", F.when(at < drift, -1).otherwise(1)).drop("__bucket")


def mean_shift(
    metrics: DataFrame, drifts: DataFrame, window: int = SHIFT_WINDOW, metric: Column | None = None
) -> DataFrame:
    """Mean metric before and after each drift. An event with an empty side gives no row; a side whose
    values are all missing gives nulls."""
    value = performance() if metric is None else metric
    near = around_drift(metrics.select(*KEYS, "instance", value.alias("value")), drifts, window)
    means = (
        near.groupBy(*KEYS, "drift_instance")
        .agg(
            F.avg(F.when(F.col("side") < 0, F.col("value"))).alias("before_mean"),
            F.avg(F.when(F.col("side") > 0, F.col("value"))).alias("after_mean"),
            F.count_if(F.col("side") < 0).alias("__before"),
            F.count_if(F.col("side") > 0).alias("__after"),
        )
        .filter((F.col("__before") > 0) & (F.col("__after") > 0))
    )
    shift = F.col("after_mean") - F.col("before_mean")
    return means.select(
        *KEYS,
        "drift_instance",
        "before_mean",
        "after_mean",
        shift.alias("shift"),
        F.abs(shift).alias("shift_magnitude"),
        shift_type(shift).alias("shift_type"),
    )


def accuracy_variance(metrics: DataFrame, drifts: DataFrame, window: int = SPREAD_WINDOW) -> DataFrame:
    """Mean and sample deviation of accuracy before and after each drift of a classification run."""
    is_cls = F.col("task") == "classification"
    near = around_drift(
        metrics.filter(is_cls).select(*KEYS, "instance", F.col("cumulative_accuracy").alias("value")),
        drifts.filter(is_cls),
        window,
    )
    before, after = (F.when(F.col("side") == s, F.col("value")) for s in (-1, 1))
    stats = (
        near.groupBy(*KEYS, "drift_instance")
        .agg(
            F.avg(before).alias("before_mean_acc"),
            F.avg(after).alias("after_mean_acc"),
            F.stddev_samp(before).alias("before_std"),
            F.stddev_samp(after).alias("after_std"),
            F.count_if(F.col("side") < 0).alias("__before"),
            F.count_if(F.col("side") > 0).alias("__after"),
        )
        .filter((F.col("__before") > 0) & (F.col("__after") > 0))
    )
    return stats.select(
        "dataset",
        "model",
        "drift_instance",
        "before_mean_acc",
        "after_mean_acc",
        "before_std",
        "after_std",
        (F.col("before_mean_acc") - F.col("after_mean_acc")).alias("accuracy_drop"),
        (F.col("after_std") - F.col("before_std")).alias("variance_change"),
    )


def class_ratio_around_drift(
    instances: DataFrame, drifts: DataFrame, window: int = SPREAD_WINDOW, positive: int = 1
) -> DataFrame:
    """Share of the ``positive`` class before and after each drift, from the labels themselves."""
    keys = ["dataset", "task"]
    rows = instances.select(*keys, F.col("instance_id").alias("instance"), "label")
    points = drifts.select(*keys, "instance_id").distinct()
    near = around_drift(rows, points, window, keys)
    hit = (F.col("label") == positive).cast("int")
    return near.groupBy(*keys, "drift_instance").agg(
        F.avg(F.when(F.col("side") < 0, hit)).alias("before_ratio"),
        F.avg(F.when(F.col("side") > 0, hit)).alias("after_ratio"),
    )


def drift_impact(metrics: DataFrame, drifts: DataFrame, recovery_rows: int = RECOVERY_ROWS) -> DataFrame:
    """Last metric row before each drift, first row after it, and the last of the ``recovery_rows``
    log rows that follow.

    Log rows are numbered per run by a blocked scan in which the drifts take part, so each drift
    learns its rank; the three rows are then fetched by an equi join on (run, row number).
    """
    keys = list(KEYS)
    rows = metrics.select(*keys, F.col("instance").alias("at"), performance().alias("value"), F.lit(0).alias("event"))
    marks = drifts.select(
        *keys, F.col("instance_id").alias("at"), F.lit(None).cast("double").alias("value"), F.lit(1).alias("event")
    )
    is_row = F.col("event") == 0
    ranked = prefix_scan(
        rows.unionByName(marks).withColumn("__o", F.col("at") * 2 + F.col("event")),
        keys,
        "__o",
        {"__rank": Scan("count", is_row), "__latest": Scan("last", F.when(is_row, F.col("at")))},
    )
    totals = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__total"))
    events = (
        ranked.filter("event = 1")
        .join(totals, keys)
        .withColumns(
            {
                "__before": F.col("__rank") - F.col("__latest").eqNullSafe(F.col("at")).cast("int"),
                "__after": F.col("__rank") + 1,
                "__recovered": F.least(F.col("__rank") + recovery_rows, F.col("__total")),
            }
        )
        .filter("__before > 0 and __after <= __total")
    )
    wanted = events.select(
        *keys,
        F.col("at").alias("drift_instance"),
        (F.col("__recovered") - F.col("__rank")).alias("recovery_time"),
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(role).alias("role"), F.col(c).alias("__rank"))
                    for role, c in (("before", "__before"), ("after", "__after"), ("recovered", "__recovered"))
                ]
            )
        ).alias("w"),
    ).select(*keys, "drift_instance", "recovery_time", "w.role", "w.__rank")
    numbered = ranked.filter("event = 0").select(*keys, "__rank", "at", "value")
    fetched = wanted.join(numbered, [*keys, "__rank"])

    def pick(role: str, column: str) -> Column:
        return F.max(F.when(F.col("role") == role, F.col(column)))

    found = fetched.groupBy(*keys, "drift_instance", "recovery_time").agg(
        pick("before", "value").alias("before_performance"),
        pick("after", "value").alias("immediate_after_performance"),
        pick("recovered", "value").alias("recovery_performance"),
        pick("recovered", "at").alias("__recovered_at"),
    )
    before, after, recovered = (
        F.col(c) for c in ("before_performance", "immediate_after_performance", "recovery_performance")
    )
    lower_is_worse = F.col("task") == "classification"
    return found.select(
        *keys,
        "drift_instance",
        before,
        after,
        recovered,
        F.when(lower_is_worse, before - after).otherwise(after - before).alias("immediate_drop"),
        F.when(lower_is_worse, recovered - after).otherwise(after - recovered).alias("recovery_amount"),
        "recovery_time",
        (F.col("__recovered_at") - F.col("drift_instance")).alias("recovery_instances"),
    )


def drift_report(drifts: DataFrame, shifts: DataFrame, impact: DataFrame, spread: DataFrame) -> DataFrame:
    """The summary as (section, model, metric, value); ``model`` is ``all`` for global figures."""

    def tidy(df: DataFrame, section: str, metrics: Sequence[str]) -> DataFrame:
        pairs = F.explode(
            F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
        ).alias("p")
        return df.select(F.lit(section).alias("section"), "model", pairs).select("section", "model", "p.metric", "p.value")

    everything = F.lit("all").alias("model")
    counts = drifts.agg(
        F.count(F.lit(1)).alias("total_drift_events"),
        F.count_distinct("dataset").alias("datasets"),
        F.count_distinct("model").alias("models"),
        F.count_distinct("task").alias("tasks"),
    ).select(everything, "*")
    shift_all = shifts.agg(
        F.avg("shift_magnitude").alias("average_shift"),
        F.max("shift_magnitude").alias("max_shift"),
        F.min("shift_magnitude").alias("min_shift"),
    ).select(everything, "*")
    shift_models = shifts.groupBy("model").agg(
        F.avg("shift_magnitude").alias("average_shift"), F.stddev_samp("shift_magnitude").alias("std_shift")
    )
    by_model = impact.rollup("model").agg(
        F.grouping("model").alias("__all"),
        F.avg("immediate_drop").alias("average_immediate_drop"),
        F.avg("recovery_amount").alias("average_recovery_amount"),
        F.avg("recovery_time").alias("average_recovery_time"),
    ).withColumn("model", F.when(F.col("__all") == 1, F.lit("all")).otherwise(F.col("model")))
    spread_all = spread.agg(
        F.avg("accuracy_drop").alias("average_accuracy_drop"), F.avg("variance_change").alias("average_variance_change")
    ).select(everything, "*")
    return (
        tidy(counts, "summary", ["total_drift_events", "datasets", "models", "tasks"])
        .unionByName(tidy(shift_all, "mean_shift", ["average_shift", "max_shift", "min_shift"]))
        .unionByName(tidy(shift_models, "mean_shift_by_model", ["average_shift", "std_shift"]))
        .unionByName(
            tidy(by_model, "impact", ["average_immediate_drop", "average_recovery_amount", "average_recovery_time"])
        )
        .unionByName(tidy(spread_all, "class_imbalance", ["average_accuracy_drop", "average_variance_change"]))
    )


def report_lines(report: DataFrame) -> DataFrame:
    """The report as text lines, ready for ``write.text``."""
    return report.select(
        F.concat_ws(" ", "section", "model", F.concat("metric", F.lit(":")), four_places(F.col("value"))).alias("value")
    )


def quantiles(df: DataFrame, value: str, points: Mapping[str, float], group: str = "model", bins: int = 4096) -> DataFrame:
    """Exact interpolated quantiles per group without gathering a group.

    Equal values are counted first; a histogram of ``bins`` cells per group then tells which cells hold
    the ranks asked for, and only the values of those cells are ranked.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("c"))
    spans = counted.groupBy(group).agg(
        F.min(value).alias("lo"), F.max(value).alias("hi"), F.sum("c").alias("total")
    )
    x, lo, hi = F.col(value), F.col("lo"), F.col("hi")
    cell = F.when(hi == lo, 0).otherwise(F.least(F.floor((x - lo) / (hi - lo) * bins), F.lit(bins - 1)))
    placed = counted.join(spans, group).withColumn("cell", cell.cast("int"))
    cells = placed.groupBy(group, "cell").agg(F.sum("c").alias("size"), F.max("total").alias("total"))
    # at most ``bins`` rows per group
    before = Window.partitionBy(group).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("seen", F.coalesce(F.sum("size").over(before), F.lit(0)))
    wanted = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias("name"), F.lit(side).alias("side"), rank.cast("long").alias("rank"), (at - F.floor(at)).alias("share"))
                for name, q in points.items()
                for at in (q * (F.col("total") - 1),)
                for side, rank in ((0, F.floor(at)), (1, F.ceil(at)))
            ]
        )
    ).alias("r")
    asked = cells.select(group, "cell", "seen", "size", wanted).select(group, "cell", "seen", "size", "r.*")
    asked = asked.filter((F.col("rank") >= F.col("seen")) & (F.col("rank") < F.col("seen") + F.col("size")))
    inside = Window.partitionBy(group, "cell").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = placed.join(asked.select(group, "cell").distinct(), [group, "cell"], "left_semi")
    ranked = held.select(group, "cell", value, "c", F.sum("c").over(inside).alias("upto"))
    offset = F.col("rank") - F.col("seen")
    found = asked.join(ranked, [group, "cell"]).filter((offset < F.col("upto")) & (offset >= F.col("upto") - F.col("c")))

    def interpolate(name: str) -> Column:
        low, high = (F.max(F.when((F.col("name") == name) & (F.col("side") == s), F.col(value))) for s in (0, 1))
        share = F.max(F.when(F.col("name") == name, F.col("share")))
        return (low + (high - low) * share).alias(name)

    return found.groupBy(group).agg(*[interpolate(name) for name in points])


def box_stats(df: DataFrame, value: str, group: str = "model") -> DataFrame:
    """Quartiles, and whiskers at the last value within 1.5 interquartile ranges."""
    quartiles = quantiles(df, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, group)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = (F.col(value) >= F.col("q1") - reach) & (F.col(value) <= F.col("q3") + reach)
    return (
        df.join(quartiles, group)
        .groupBy(group, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col(value))).alias("low_whisker"),
            F.max(F.when(inside, F.col(value))).alias("high_whisker"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def histogram(df: DataFrame, value: str, bins: int = 10, group: str = "model") -> DataFrame:
    """Counts per group in ``bins`` equal bins over the global range; the maximum is in the last bin."""
    x = F.col(value)
    lo, hi = df.agg(F.min(value)).scalar(), df.agg(F.max(value)).scalar()
    bin_ = F.when(hi == lo, 1).otherwise(F.least(F.floor((x - lo) / (hi - lo) * bins) + 1, F.lit(bins)))
    return (
        df.filter(x.isNotNull())
        .select(group, bin_.cast("int").alias("bin"))
        .groupBy(group, "bin")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def bounds(df: DataFrame, a: str, b: str) -> DataFrame:
    """Smallest and largest value over two columns."""
    return df.agg(
        F.least(F.min(a), F.min(b)).alias("low"), F.greatest(F.max(a), F.max(b)).alias("high")
    )


def first_models(impact: DataFrame, order: str = "drift_instance", limit: int = 3) -> DataFrame:
    """The first ``limit`` models in order of appearance, names breaking ties."""
    return impact.groupBy("model").agg(F.min(order).alias("first_seen")).orderBy("first_seen", "model").limit(limit)


def drift_timeline(drifts: DataFrame, models: Sequence[str] = ()) -> DataFrame:
    kept = drifts.filter(F.col("model").isin(list(models))) if models else drifts
    return kept.select(*KEYS, F.col("instance_id").alias("instance"))


def metric_trajectory(metrics: DataFrame, drifts: DataFrame) -> DataFrame:
    """The judged metric of every log row, marked where a drift was accepted."""
    marks = drifts.select(*KEYS, F.col("instance_id").alias("instance"), F.lit(True).alias("__d")).distinct()
    return (
        metrics.select(*KEYS, "instance", performance().alias("metric"))
        .join(marks, [*KEYS, "instance"], "left")
        .select(*KEYS, "instance", "metric", F.coalesce("__d", F.lit(False)).alias("is_drift"))
    )


def gap_between_drifts(drifts: DataFrame) -> DataFrame:
    """Instances from one drift to the next of the same run."""
    at = F.col("instance_id")
    before = prefix_scan(drifts, KEYS, "instance_id", {"__before": Scan("last", at, exclusive=True)})
    return before.select(*KEYS, at, (at - F.col("__before")).alias("gap"))

"""Prequential metrics over a predictions table: cumulative, segment and rolling.

Input columns: keys, ``instance_id``, ``prediction``, ``actual``, ``error``, ``drift``. A row with a
null prediction was read but not evaluated. ``error`` may be any numeric type; decimal errors give
sums that do not depend on the partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.blocked import (
    BLOCK,
    Scan,
    attach,
    carries,
    prefix_scan,
    rolling,
    rolling_distinct,
    segment_scan,
    with_block,
)

WINDOW_ROWS = 1000
WARMUP_ROWS = 200
LISTED_DRIFTS = 100_000
SALTS = 64
LOG_EVERY = 1000


def zero_one_error(prediction: Column, label: Column) -> Column:
    """0/1 error; the prediction is truncated to an integer first, as the label is one."""
    return (prediction.cast("int") != label.cast("int")).cast("int")


def absolute_error(prediction: Column, target: Column) -> Column:
    return F.abs(prediction - target)


def number_segments(
    pred: DataFrame, keys: Sequence[str], order: str = "instance_id", block_rows: int | None = None
) -> DataFrame:
    """Add ``n`` (evaluated rows so far), ``n_correct`` (of them with zero error), ``segment``
    (drifts so far) and ``segment_row`` (evaluated rows since the segment began, the drift row
    being the first). Keeps the block column for a scan that follows.

    Blocks come from the ids, or from ``pred`` if it has them (``ranked.rank_blocks``, for sparse ids and timestamps).
    Block totals and the count after a block's last drift come from two narrow map-side aggregates over the input;
    then the rows are shuffled once by (keys, block).
    """
    keys = list(keys)
    grouped = BLOCK in pred.columns
    rows = pred if grouped else with_block(pred, order, block_rows)
    evaluated = F.col("prediction").isNotNull()
    correct = evaluated & (F.col("error") == 0)
    totals = rows.groupBy(*keys, BLOCK).agg(
        F.count_if(evaluated).alias("__t_n"),
        F.count_if(correct).alias("__t_ok"),
        F.count_if("drift").alias("__t_d"),
        F.max(F.when(F.col("drift"), F.col(order))).alias("__at"),
    )
    tails = (
        rows.join(totals.filter("__at is not null").select(*keys, BLOCK, "__at"), [*keys, BLOCK])
        .filter(F.col(order) >= F.col("__at"))
        .groupBy(*keys, BLOCK)
        .agg(F.count_if(evaluated).alias("__tail"))
    )
    counts = {c: Scan("sum", F.col(f"__t_{c}")) for c in ("n", "ok", "d")}
    ends = carries(totals.join(tails, [*keys, BLOCK], "left"), keys, counts, grouped)
    ends = ends.withColumns({f"__c__{c}": F.coalesce(f"__c_{c}", F.lit(0)) for c in counts})
    start = F.struct(F.col(BLOCK).alias("o"), (F.col("__c__n") + F.col("__t_n") - F.col("__tail")).alias("v"))
    ends = ends.withColumn("__t_start", F.when(F.col("__tail").isNotNull(), start))
    carry = carries(ends, keys, {"start": Scan("last", F.col("__t_start"))}, grouped).select(
        *keys, BLOCK, "__c__n", "__c__ok", "__c__d", F.coalesce("__c_start.v", F.lit(0)).alias("__c__start")
    )
    upto_now = Window.partitionBy(*keys, BLOCK).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = attach(rows, carry, [*keys, BLOCK]).withColumns(
        {
            "n": F.col("__c__n") + F.count_if(evaluated).over(upto_now),
            "n_correct": F.col("__c__ok") + F.count_if(correct).over(upto_now),
            "segment": F.col("__c__d") + F.count_if("drift").over(upto_now),
        }
    )
    own_start = F.when(F.col("drift"), F.col("n") - evaluated.cast("int"))
    placed = counted.withColumn(
        "segment_row", F.col("n") - F.coalesce(F.last(own_start, ignorenulls=True).over(upto_now), F.col("__c__start"))
    )
    return placed.select(*[c for c in pred.columns if c != BLOCK], BLOCK, "n", "n_correct", "segment", "segment_row")


def prequential_metrics(
    pred: DataFrame,
    keys: Sequence[str],
    order: str = "instance_id",
    window_rows: int = WINDOW_ROWS,
    warmup_rows: int = WARMUP_ROWS,
    block_rows: int | None = None,
) -> DataFrame:
    """All metric columns for every evaluated row.

    Segment means restart at each drift and leave out the first ``warmup_rows`` rows after it; the
    first segment has no warm-up. The rolling window is not reset by drift.
    """
    keys = list(keys)
    grouped = BLOCK in pred.columns
    needed = pred.select(*keys, order, "prediction", "error", "drift", *[BLOCK] * grouped)
    numbered = number_segments(needed, keys, order, block_rows)
    evaluated = F.col("prediction").isNotNull()
    counts = (F.col("segment") == 0) | (F.col("segment_row") > warmup_rows)
    error = F.when(evaluated & counts, F.col("error"))
    sums = segment_scan(
        numbered,
        keys,
        order,
        "segment",
        {
            "__n": Scan("count", error.isNotNull()),
            "__err": Scan("sum", error),
            "__sq": Scan("sum", error * error),
            "__seg_ok": Scan("count", (F.col("error") == 0) & evaluated),
        },
        block_rows,
        grouped=grouped,
    )
    scored = sums.filter(evaluated).drop(BLOCK, "prediction", "drift")
    recent = rolling(
        scored,
        keys,
        "n",
        window_rows,
        {
            "__w_err": F.col("error"),
            "__w_sq": F.col("error") * F.col("error"),
            "__w_ok": (F.col("error") == 0).cast("int"),
        },
        block_rows,
    ).withColumn("__w_n", F.least("n", F.lit(window_rows)))
    is_cls = F.col("task") == "classification"
    return recent.select(
        *keys,
        order,
        "n",
        "segment",
        "segment_row",
        F.when(is_cls, _mean("n_correct", "n")).alias("cumulative_accuracy"),
        F.when(is_cls, _mean("__seg_ok", "n")).alias("cumulative_accuracy_as_coded"),
        F.when(is_cls, _mean("__seg_ok", "segment_row")).alias("segment_accuracy"),
        F.when(is_cls, _mean("__w_ok", "__w_n")).alias("window_accuracy"),
        F.when(~is_cls, _mean("__err", "__n")).alias("cumulative_mae"),
        F.when(~is_cls, _mean("__sq", "__n")).alias("cumulative_mse"),
        F.when(~is_cls, _mean("__w_err", "__w_n")).alias("window_mae"),
        F.when(~is_cls, _mean("__w_sq", "__w_n")).alias("window_mse"),
    )


def _mean(total: str, n: str) -> Column:
    return F.when(F.col(n) > 0, F.col(total).cast("double") / F.col(n))


def metrics_log(metrics: DataFrame, every: int = LOG_EVERY, order: str = "instance_id") -> DataFrame:
    """The periodic log: one row per ``every`` instances."""
    return metrics.filter(F.col(order) % every == 0).withColumnRenamed(order, "instance")


def timed_log(
    metrics: DataFrame, keys: Sequence[str], at: str, seconds: int, every: int = LOG_EVERY, order: str = "instance_id"
) -> DataFrame:
    """The log by count and by time: one row per ``every`` instances, and the first row of each tick of ``seconds``.

    Ticks are counted from the epoch on the timestamp ``at``, so a row's being logged does not depend on the rows
    logged before, and a stream cut or resumed anywhere gives the same log. Quiet ticks give no row.
    """
    keys = list(keys)
    tick = F.floor(F.unix_micros(F.col(at).cast("timestamp")) / (seconds * 1_000_000)).alias("__tick")
    firsts = metrics.groupBy(*keys, tick).agg(F.min(order).alias(order)).select(*keys, order, F.lit(True).alias("__first"))
    marked = metrics.join(firsts, [*keys, order], "left")
    logged = marked.filter(F.col("__first") | (F.col(order) % every == 0)).drop("__first")
    return logged.withColumnRenamed(order, "instance")


def prediction_diversity(
    pred: DataFrame,
    keys: Sequence[str],
    order: str = "instance_id",
    window_rows: int = WINDOW_ROWS,
    block_rows: int | None = None,
) -> DataFrame:
    """Distinct predictions and distinct actual values among the last ``window_rows`` evaluated rows."""
    keys = list(keys)
    numbered = prefix_scan(pred, keys, order, {"n": Scan("count", F.col("prediction").isNotNull())}, block_rows)
    scored = numbered.filter(F.col("prediction").isNotNull()).select(*keys, order, "n", "prediction", "actual")
    counted = rolling_distinct(
        scored, keys, "n", window_rows, {"unique_predictions": "prediction", "unique_actuals": "actual"}, block_rows
    )
    return counted.select(*keys, order, "n", "unique_predictions", "unique_actuals")


def drift_events(pred: DataFrame, keys: Sequence[str], order: str = "instance_id", detector: str = "ADWIN") -> DataFrame:
    """One row per accepted drift, stamped with the time of the run."""
    return pred.filter("drift").select(
        *keys, F.col(order).alias("instance_id"), F.lit(detector).alias("detector"), F.current_timestamp().alias("timestamp")
    )


def run_summary(
    pred: DataFrame,
    keys: Sequence[str],
    order: str = "instance_id",
    window_rows: int = WINDOW_ROWS,
    warmup_rows: int = WARMUP_ROWS,
    block_rows: int | None = None,
) -> DataFrame:
    """Final state of every run without computing the metric of every row.

    The last segment and the last window are picked by thresholds on the numbered rows, so after
    the numbering only map-side aggregates are left.
    """
    keys = list(keys)
    evaluated = F.col("prediction").isNotNull()
    numbered = number_segments(pred, keys, order, block_rows).drop(BLOCK)
    ends = numbered.groupBy(*keys).agg(F.max("n").alias("__end"), F.max("segment").alias("__last"))
    # one row per run, copied to every salt: the rows of a large run meet it on many partitions
    ends = ends.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = numbered.withColumn("__salt", F.pmod(F.col(order), F.lit(SALTS)).cast("int"))
    rows = salted.join(ends, [*keys, "__salt"])
    error = F.when(evaluated, F.col("error"))
    in_window = evaluated & (F.col("n") > F.col("__end") - window_rows)
    in_segment = evaluated & (F.col("segment") == F.col("__last"))
    counted = in_segment & ((F.col("__last") == 0) | (F.col("segment_row") > warmup_rows))
    is_cls = F.col("task") == "classification"
    agg = rows.groupBy(*keys).agg(
        F.count_if(evaluated).alias("total_instances"),
        F.count_if("drift").alias("drift_events"),
        F.count_if(evaluated & (F.col("error") == 0)).alias("__ok"),
        F.count_if(in_window).alias("__w_n"),
        F.count_if(in_window & (F.col("error") == 0)).alias("__w_ok"),
        F.sum(F.when(in_window, error)).alias("__w_err"),
        F.sum(F.when(in_window, error * error)).alias("__w_sq"),
        F.count_if(counted).alias("__n"),
        F.sum(F.when(counted, error)).alias("__err"),
        F.sum(F.when(counted, error * error)).alias("__sq"),
    )

    return agg.select(
        *keys,
        "total_instances",
        "drift_events",
        F.when(is_cls, _mean("__ok", "total_instances")).alias("cumulative_accuracy"),
        F.when(is_cls, _mean("__w_ok", "__w_n")).alias("window_accuracy"),
        F.when(~is_cls, _mean("__err", "__n")).alias("cumulative_mae"),
        F.when(~is_cls, _mean("__sq", "__n")).alias("cumulative_mse"),
        F.when(~is_cls, _mean("__w_err", "__w_n")).alias("window_mae"),
        F.when(~is_cls, _mean("__w_sq", "__w_n")).alias("window_mse"),
    )


def with_drift_details(
    summary: DataFrame, events: DataFrame, keys: Sequence[str], listed: int = LISTED_DRIFTS
) -> DataFrame:
    """Attach the nested event list of the run-summary record: one row per run.

    The list holds the first ``listed`` drifts in order, so no row grows without bound; ``drift_events`` of
    the summary counts all, and ``events`` itself is the full list (stored by ``logs.write_drift_events``).
    """
    keys = list(keys)
    ranked = prefix_scan(events, keys, "instance_id", {"__r": Scan("count", F.lit(True))})
    details = ranked.filter(F.col("__r") <= listed).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("instance_id", "detector", "timestamp"))).alias("drift_details")
    )
    return summary.join(details, keys, "left")


def rows_since_drift(
    pred: DataFrame, keys: Sequence[str], order: str = "instance_id", block_rows: int | None = None
) -> DataFrame:
    """Distance to the latest earlier drift; null before the first one."""
    marked = prefix_scan(
        pred,
        keys,
        order,
        {"__last": Scan("last", F.when(F.col("drift"), F.col(order)), exclusive=True)},
        block_rows,
    )
    return marked.withColumn("rows_since_drift", F.col(order) - F.col("__last")).drop("__last")


def confusion(pred: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts per (actual, predicted) class."""
    return (
        pred.filter(F.col("prediction").isNotNull())
        .groupBy(*keys, F.col("actual").cast("int").alias("actual"), F.col("prediction").cast("int").alias("predicted"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def classification_scores(pred: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Accuracy and Cohen's kappa per run, precision, recall and F1 per class, from the confusion counts."""
    keys = list(keys)
    cells = confusion(pred, keys)
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("rows")).otherwise(0)
    by_actual = cells.groupBy(*keys, F.col("actual").alias("class")).agg(
        F.sum("rows").alias("a"), F.sum(hit).alias("h"), F.lit(0).cast("long").alias("p")
    )
    by_predicted = cells.groupBy(*keys, F.col("predicted").alias("class")).agg(
        F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("h"), F.sum("rows").alias("p")
    )
    per_class = by_actual.unionByName(by_predicted).groupBy(*keys, "class").agg(
        F.sum("a").alias("support"), F.sum("h").alias("hits"), F.sum("p").alias("predicted")
    )
    run = Window.partitionBy(*keys)
    n = F.sum("support").over(run)
    chance = F.sum(F.col("support").cast("decimal(19,0)") * F.col("predicted").cast("decimal(19,0)")).over(run)
    # kappa = (n*hits - chance) / (n*n - chance), all exact integers until the division
    n_dec = n.cast("decimal(19,0)")
    top = (n_dec * F.sum("hits").over(run).cast("decimal(19,0)") - chance).cast("double")
    bottom = (n_dec * n_dec - chance).cast("double")
    hits = F.col("hits").cast("double")
    return per_class.select(
        *keys,
        "class",
        "support",
        (F.sum("hits").over(run).cast("double") / n).alias("accuracy"),
        F.when(bottom != 0, top / bottom).alias("kappa"),
        F.when(F.col("predicted") > 0, hits / F.col("predicted")).alias("precision"),
        F.when(F.col("support") > 0, hits / F.col("support")).alias("recall"),
        (2 * hits / (F.col("support") + F.col("predicted"))).alias("f1"),
    )


def regression_scores(pred: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MAE, MSE, RMSE and R² per run in one map-side aggregate."""
    err, y = F.col("error"), F.col("actual")
    sums = pred.filter(F.col("prediction").isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(err).cast("double").alias("se"),
        F.sum(err * err).cast("double").alias("sq"),
        F.sum(y).cast("double").alias("sy"),
        F.sum(y * y).cast("double").alias("syy"),
    )
    spread = F.col("syy") - F.col("sy") * F.col("sy") / F.col("rows")
    return sums.select(
        *keys,
        "rows",
        (F.col("se") / F.col("rows")).alias("mae"),
        (F.col("sq") / F.col("rows")).alias("mse"),
        F.sqrt(F.col("sq") / F.col("rows")).alias("rmse"),
        F.when(spread != 0, 1 - F.col("sq") / spread).alias("r2"),
    )

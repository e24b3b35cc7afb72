"""Squared-loss SGD with drift resets, in parallel inside one stream, by speculative replay.

The rows after a reset are run in parallel blocks as if no drift came. The first accepted drift among their errors settles the
rows up to it, and only the tail from it is run anew, with a fresh model. A run looks at ``first_rows`` rows after the
reset; without a drift there it is repeated over twice as many, so that rows are run a bounded number of times on
average, however far apart drifts are. What stays sequential is the detector, which sees one number a row. A stream that
drifted ``speculated`` times goes on row by row in one ordered run: speculation gains nothing where drifts are frequent, and
the number of jobs does not grow with the number of drifts.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.adwin import Adwin, Gate
from tidemark.operators.blocked_sgd import BLOCK_ROWS, sgd_regression
from tidemark.operators.learners import SQUARED, Linear
from tidemark.operators.prequential import OUTPUTS, Detection, TestThenTrain
from tidemark.plans.blocked import Scan, prefix_scan
from tidemark.plans.ordered import run_ordered
from tidemark.session import materialize, scratch_path

FIRST_ROWS = 1 << 15
SPECULATED = 3


class _FirstDrift:
    """Marks the first drift that the gate accepts, and none after it."""

    def __init__(self, detection: Detection):
        self.detection = detection
        self.detector: Adwin | None = None
        self.gate = Gate(detection.cooldown, detection.min_rows)
        self.found = False

    def step(self, row: tuple) -> tuple:
        n, error, last, segment = row
        if self.found:
            return (False,)
        if self.detector is None:
            after = self.detection.delta_after
            self.detector = Adwin(self.detection.delta if after is None or not segment else after)
            self.gate.last = last
        self.found = bool(self.detector.update(error)) and self.gate.accepts(n)
        return (self.found,)

    def to_state(self) -> dict[str, Any]:
        return {"found": self.found, "last": self.gate.last, "detector": self.detector and self.detector.to_state()}

    def from_state(self, state: dict[str, Any]) -> None:
        self.found, self.gate.last = state["found"], state["last"]
        if state["detector"]:
            self.detector = Adwin()
            self.detector.from_state(state["detector"])


class _GoOn(TestThenTrain):
    """The row form from a reset on."""

    def step(self, row: tuple) -> tuple:
        n, features, actual, last, segment = row
        if not self.n:
            self.n, self.segment, self.gate.last = n - 1, segment, last
            if self.detection.delta_after is not None:
                self.detector = Adwin(self.detection.delta_after)
        return super().step((n, features, actual))


def sgd_with_resets(
    instances: DataFrame,
    keys: Sequence[str],
    order: str = "instance_id",
    detection: Detection = Detection(),
    eta: float = 0.01,
    schedule: str = "inverse",
    power: float = 0.25,
    block_rows: int = BLOCK_ROWS,
    first_rows: int = FIRST_ROWS,
    speculated: int = SPECULATED,
) -> DataFrame:
    """The rows that ``prequential`` gives for the squared-loss learner with ``detection``, features taken as they are.

    Columns: keys, ``order``, ``prediction``, ``actual``, ``error``, ``drift``, ``segment``. A row without a prediction has no error.
    Rounds follow one another: one for each of the first ``speculated`` drifts, and one for each doubling between them.
    All streams take part in a round, each with its own range of rows. Key columns must not be null.
    """
    keys = list(keys)
    rows = instances.select(*keys, order, "features", F.col("actual").cast("double").alias("actual"))
    placed = materialize(prefix_scan(rows, keys, order, {"n": Scan("count", F.lit(True))}), "placed")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    bounds = placed.groupBy(*keys).agg(F.max("n").alias("size")).select(
        *keys, "size", F.lit(1).cast("long").alias("start"), zero.alias("last"), zero.alias("segment"),
        F.lit(first_rows).cast("long").alias("horizon"),
    )
    bounds = materialize(bounds, "bounds")
    base, rounds = scratch_path(placed.sparkSession, "settled"), 0
    schema, frequent = None, []
    while not bounds.isEmpty():
        inside = (F.col("n") >= F.col("start")) & (F.col("n") < F.col("start") + F.col("horizon"))
        tail = placed.join(bounds.select(*keys, "start", "horizon"), keys).filter(inside)
        run = sgd_regression(tail.select(*keys, "n", "features", "actual"), keys, "n", eta, schedule, power, block_rows)
        scored = materialize(run.withColumn("error", F.abs(F.col("prediction") - F.col("actual"))), "scored")
        fed = scored.filter("error is not null").join(bounds.select(*keys, "last", "segment"), keys)
        marked = run_ordered(
            fed, keys, "n", ["n", "error", "last", "segment"],
            T.StructType([T.StructField("drift", T.BooleanType())]), lambda _: _FirstDrift(detection),
        )
        first = marked.filter("drift").groupBy(*keys).agg(F.min("n").alias("at"))
        judged = bounds.join(first, keys, "left")
        seen_all = F.col("start") + F.col("horizon") > F.col("size")
        judged = materialize(judged.withColumn("upto", F.when(F.col("at").isNotNull(), F.col("at")).when(seen_all, F.col("size"))), "judged")
        drift = F.coalesce(F.col("n") == F.col("at"), F.lit(False))
        settled = scored.join(judged.filter("upto is not null").select(*keys, "last", "segment", "at", "upto"), keys)
        settled = settled.filter("n > last and n <= upto").select(
            *keys, "n", "prediction", "actual", "error", drift.alias("drift"), (F.col("segment") + drift.cast("long")).alias("segment")
        )
        settled.write.parquet(f"{base}/round={rounds}")
        schema, rounds = settled.schema, rounds + 1
        begins = F.col("at") + (0 if detection.train_on_drift else 1)
        reset = judged.filter("at < size").select(
            *keys, "size", begins.alias("start"), F.col("at").alias("last"), F.col("segment") + 1, F.lit(first_rows).cast("long")
        )
        frequent.append(materialize(reset.toDF(*bounds.columns).filter(F.col("segment") >= speculated), "frequent"))
        reset = reset.toDF(*bounds.columns).filter(F.col("segment") < speculated)
        longer = judged.filter("upto is null").select(*keys, "size", "start", "last", "segment", F.col("horizon") * 2)
        bounds = materialize(longer.union(reset).toDF(*bounds.columns), "bounds")
    spark = placed.sparkSession
    if not rounds:
        empty = placed.withColumn("prediction", F.lit(None).cast("double")).withColumn("error", F.lit(None).cast("double"))
        return empty.select(*keys, order, "prediction", "actual", "error", F.lit(False).alias("drift"), none.alias("segment"))
    onward = frequent[0]
    for more in frequent[1:]:
        onward = onward.unionByName(more)
    fed = placed.join(onward.select(*keys, "start", "last", "segment"), keys).filter("n >= start").withColumnRenamed("segment", "before")
    went = run_ordered(
        fed, keys, "n", ["n", "features", "actual", "last", "before"], OUTPUTS,
        lambda _: _GoOn("regression", lambda: Linear(SQUARED, eta, schedule, power), detection, False),
    ).filter("n > last").select(*keys, "n", "prediction", "actual", "error", "drift", "segment")
    went.write.parquet(f"{base}/round={rounds}")
    rounds += 1
    done = spark.read.schema(schema).parquet(*[f"{base}/round={r}" for r in range(rounds)])
    named = placed.select(*keys, "n", order)
    return done.join(named, [*keys, "n"]).select(*keys, order, "prediction", "actual", "error", "drift", "segment")

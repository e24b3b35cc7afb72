"""Test-then-train evaluation: predict, score, detect drift, reset, train."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.vectors import LARGEST
from tidemark.operators import lockstep
from tidemark.operators.adwin import COOLDOWN, DELTA, MIN_ROWS, Adwin, Gate
from tidemark.operators.learners import BINARY, check_requests, create_learner
from tidemark.operators.preprocess import WARMUP_ROWS
from tidemark.plans.ordered import run_ordered

OUTPUTS = T.StructType(
    [
        T.StructField("prediction", T.DoubleType()),
        T.StructField("error", T.DoubleType()),
        T.StructField("drift", T.BooleanType()),
        T.StructField("segment", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Detection:
    """Detector settings. After a reset ``delta_after`` applies; ``train_on_drift`` off leaves the
    drift row out of training and lets the next row train unscored."""

    delta: float = DELTA
    delta_after: float | None = None
    cooldown: int = COOLDOWN
    min_rows: int = MIN_ROWS
    train_on_drift: bool = True


TOY_DETECTION = Detection(delta=0.001, delta_after=0.002, cooldown=0, min_rows=0, train_on_drift=False)


class Scaler:
    """Running min-max of one row's features; rows before ``warmup`` pass unscaled."""

    def __init__(self, warmup: int = WARMUP_ROWS):
        self.n, self.warmup = 0, warmup
        self.low: list = []
        self.high: list = []

    def apply(self, x: Sequence[float]) -> list[float]:
        self.n += 1
        if not self.low:
            self.low, self.high = [None] * len(x), [None] * len(x)
        out = []
        for i, v in enumerate(x):
            known = v is not None and v == v
            if known:
                if self.low[i] is None or v < self.low[i]:
                    self.low[i] = v
                if self.high[i] is None or v > self.high[i]:
                    self.high[i] = v
            if known and self.n >= self.warmup:
                v = (v - self.low[i]) / ((self.high[i] - self.low[i]) or 1.0)
                known = v == v
            out.append(min(max(v, -LARGEST), LARGEST) if known else 0.0)
        return out


class TestThenTrain:
    """State of one run: scaler, learner, detector, gate, segment number."""

    __test__ = False

    def __init__(
        self, task: str, make_learner: Callable[[], Any], detection: Detection | None, normalize: bool = True
    ):
        self.task, self.make_learner, self.detection = task, make_learner, detection
        self.learner = make_learner()
        self.scaler = Scaler() if normalize else None
        self.n, self.segment = 0, 0
        self.detector = Adwin(detection.delta) if detection else None
        self.gate = Gate(detection.cooldown, detection.min_rows) if detection else None

    def step(self, row: tuple) -> tuple:
        _, features, actual = row
        self.n += 1
        x = self.scaler.apply(features) if self.scaler else list(features)
        prediction = self.learner.predict(x)
        if prediction is None:
            self.learner.learn(x, actual)
            return None, None, False, self.segment
        if self.task == "classification":
            error = float(int(prediction) != int(actual))
        else:
            error = abs(prediction - actual)
        drift = False
        if self.detector is not None and self.detector.update(error) and self.gate.accepts(self.n):
            drift = True
            self.segment += 1
            self.learner = self.make_learner()
            after = self.detection.delta_after
            self.detector = Adwin(self.detection.delta if after is None else after)
        if not drift or self.detection.train_on_drift:
            self.learner.learn(x, actual)
        return float(prediction), error, drift, self.segment

    def to_state(self) -> dict[str, Any]:
        return {
            "n": self.n,
            "segment": self.segment,
            "learner": self.learner.to_state(),
            "scaler": vars(self.scaler) if self.scaler else None,
            "detector": self.detector.to_state() if self.detector else None,
            "last": self.gate.last if self.gate else None,
        }

    def from_state(self, state: dict[str, Any]) -> None:
        self.n, self.segment = state["n"], state["segment"]
        self.learner.from_state(state["learner"])
        if self.scaler:
            vars(self.scaler).update(state["scaler"])
        if self.detector:
            self.detector.from_state(state["detector"])
            self.gate.last = state["last"]


def prequential(
    instances: DataFrame,
    keys: Sequence[str],
    order: str = "instance_id",
    detection: Detection | None = Detection(),
    normalize: bool = True,
    learner: Callable[[Mapping[str, Any]], Any] | None = None,
    slice_rows: int | None = None,
    classes: Sequence[int] = BINARY,
) -> DataFrame:
    """Run one learner per key over its instances (``features``, ``actual``).

    ``keys`` must hold ``task`` and ``model`` unless ``learner`` is given. ``classes`` lists the labels of
    the classification streams; a label beyond them is an error. Keys run in parallel; inside
    a key the feedback from drift to learner makes the order binding, so a long stream goes through
    slices with saved state (see :mod:`tidemark.plans.ordered`); without slices, the keys of a task run side by side as
    arrays (:mod:`tidemark.operators.lockstep`), with the same result to the digit. For parallel work inside one
    stream use the blocked squared-loss learner or the chunked trees.
    """

    def make(key: Mapping[str, Any]) -> TestThenTrain:
        task = key.get("task", "regression")
        build = (lambda: learner(key)) if learner else (lambda: create_learner(task, key["model"], classes))
        return TestThenTrain(task, build, detection, normalize)

    rows = instances.select(*keys, order, "features", F.col("actual").cast("double").alias("actual"))
    # the learners of the registry run many keys side by side
    together = None if learner or sorted(classes) != list(BINARY) else lockstep.runner(make, keys, order, detection, normalize)
    out = run_ordered(
        rows, keys, order, [order, "features", "actual"], OUTPUTS, make, slice_rows, together=together, unused=["features"]
    )
    return out.drop("features")


def compare_learners(
    instances: DataFrame, models: DataFrame, keys: Sequence[str] = ("dataset", "task"), **options: Any
) -> DataFrame:
    """Run every learner of ``models`` (task, model) on every stream of its task, in one job.

    Unknown requests are an error. Every row is multiplied in place by its task's learners; nothing is joined.
    """
    check_requests(models)
    asked = models.select("task", "model").distinct().collect()  # checked: at most the registry's rows
    names = F.create_map(
        *[c for t in sorted({r["task"] for r in asked}) for c in (F.lit(t), F.array(*[F.lit(r["model"]) for r in asked if r["task"] == t]))]
    )
    wanted = instances.withColumn("model", F.explode(names[F.col("task")])) if asked else instances.limit(0).withColumn("model", F.lit(""))
    return prequential(wanted, [*keys, "model"], **options)

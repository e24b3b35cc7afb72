"""Online learners with small keyed state, and the registry of learner names."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.keyed_trees import KeyedForest, KeyedTree

ENSEMBLE_SIZE = 10
NEIGHBOURS = 5
MEMORY_ROWS = 1000

SQUARED, HINGE, PERCEPTRON, PASSIVE_AGGRESSIVE = "squared", "hinge", "perceptron", "passive_aggressive"


class Linear:
    """Linear model, one update per row. Labels are 0 and 1 for the classification losses; others are an error.

    The step is ``eta`` (``constant``) or ``eta / t**power`` (``inverse``); passive-aggressive takes
    the closed-form step bounded by ``c`` (Crammer et al. 2006). No prediction before the first row.
    """

    def __init__(
        self, loss: str, eta: float = 0.01, schedule: str = "inverse", power: float = 0.25, c: float = 1.0
    ):
        self.loss, self.eta, self.schedule, self.power, self.c = loss, eta, schedule, power, c
        self.w: list[float] = []
        self.b, self.t = 0.0, 0

    def score(self, x: Sequence[float]) -> float:
        total = 0.0
        for w, v in zip(self.w, x):
            total += w * v
        return total + self.b

    def predict(self, x: Sequence[float]) -> float | None:
        if self.t == 0:
            return None
        score = self.score(x)
        return score if self.loss == SQUARED else float(score > 0)

    def learn(self, x: Sequence[float], y: float) -> None:
        if not self.w:
            self.w = [0.0] * len(x)
        self.t += 1
        score = self.score(x)
        rate = self.eta if self.schedule == "constant" else self.eta / self.t**self.power
        if self.loss == SQUARED:
            step = -rate * (score - y)
        else:
            if y not in (0, 1):
                raise ValueError(f"label {y} is neither 0 nor 1: declare the classes")
            sign = 1.0 if y > 0.5 else -1.0
            margin = sign * score
            if self.loss == HINGE:
                step = rate * sign if margin < 1 else 0.0
            elif self.loss == PERCEPTRON:
                step = rate * sign if margin <= 0 else 0.0
            else:
                norm = 1.0
                for v in x:
                    norm += v * v
                step = sign * min(self.c, max(0.0, 1.0 - margin) / norm)
        if step:
            self.w = [w + step * v for w, v in zip(self.w, x)]
            self.b += step

    def to_state(self) -> dict[str, Any]:
        return dict(vars(self))

    def from_state(self, state: dict[str, Any]) -> None:
        vars(self).update(state)


class OneVersusRest:
    """Several classes: one linear model per declared class, highest score wins, ties go to the smaller label."""

    def __init__(self, loss: str, classes: Sequence[int], **options: Any):
        self.loss, self.options = loss, options
        self.models = {int(c): Linear(loss, **options) for c in sorted(classes)}

    def predict(self, x: Sequence[float]) -> float | None:
        if not next(iter(self.models.values())).t:
            return None
        return float(max(sorted(self.models), key=lambda c: self.models[c].score(x)))

    def learn(self, x: Sequence[float], y: float) -> None:
        if y not in self.models:
            raise ValueError(f"label {y} is not among the declared classes {list(self.models)}")
        for label, model in self.models.items():
            model.learn(x, float(label == int(y)))

    def to_state(self) -> dict[str, Any]:
        return {"models": {str(c): m.to_state() for c, m in self.models.items()}}

    def from_state(self, state: dict[str, Any]) -> None:
        self.models = {}
        for label, saved in state["models"].items():
            self.models[int(label)] = Linear(self.loss, **self.options)
            self.models[int(label)].from_state(saved)


class Neighbours:
    """k nearest among the last ``memory`` rows; vote (ties to the smaller label) or mean."""

    def __init__(self, task: str, k: int = NEIGHBOURS, memory: int = MEMORY_ROWS):
        self.task, self.k, self.memory = task, k, memory
        self.rows: list[list] = []
        self.held: np.ndarray | None = None
        self.first = 0

    def predict(self, x: Sequence[float]) -> float | None:
        if not self.rows:
            return None
        size = len(self.rows)
        if self.held is None or len(self.held) != len(x):
            self._hold(len(x))
        distance = np.zeros(size)
        for column, v in zip(self.held, x):
            gap = column[self.first : self.first + size] - v
            distance += gap * gap
        if size > self.k:
            # all that may be among the nearest, in order of age; equal distances go to the older row
            reach = np.partition(distance, self.k - 1)[self.k - 1]
            near = np.flatnonzero(~(distance > reach))
            near = near[np.argsort(distance[near], kind="stable")][: self.k]
        else:
            near = np.argsort(distance, kind="stable")
        labels = [self.rows[i][1] for i in near.tolist()]
        if self.task == "regression":
            return sum(labels) / len(labels)
        return float(min(set(labels), key=lambda c: (-labels.count(c), c)))

    def _hold(self, features: int) -> None:
        """The features of the rows as columns, with room for as many again."""
        self.first, size = 0, len(self.rows)
        self.held = np.empty((features, 2 * size + 64))
        for i, (x, _) in enumerate(self.rows):
            self.held[:, i] = x

    def learn(self, x: Sequence[float], y: float) -> None:
        self.rows.append([list(x), y])
        if self.held is not None:
            at = self.first + len(self.rows) - 1
            if at < self.held.shape[1] and len(self.held) == len(x):
                self.held[:, at] = x
            else:
                self.held = None
        if len(self.rows) > self.memory:
            dropped = len(self.rows) - self.memory
            del self.rows[:dropped]
            self.first += dropped

    def to_state(self) -> dict[str, Any]:
        return {"rows": self.rows}

    def from_state(self, state: dict[str, Any]) -> None:
        self.rows, self.held = state["rows"], None


BINARY = (0, 1)


def _linear_classes(loss: str, classes: Sequence[int], **options: Any) -> Any:
    """The binary form for the labels 0 and 1, one model per class for any other list."""
    if sorted(classes) == list(BINARY):
        return Linear(loss, **options)
    return OneVersusRest(loss, classes, **options)


KEYED: dict[tuple[str, str], Callable[[Sequence[int]], Any]] = {
    ("classification", "sgd"): lambda classes: _linear_classes(HINGE, classes),
    ("classification", "perceptron"): lambda classes: _linear_classes(PERCEPTRON, classes, eta=1.0, schedule="constant"),
    ("classification", "passive_aggressive"): lambda classes: _linear_classes(PASSIVE_AGGRESSIVE, classes),
    ("classification", "knn"): lambda _: Neighbours("classification"),
    ("classification", "hoeffding_tree"): lambda _: KeyedTree("classification"),
    ("classification", "arf"): lambda _: KeyedForest("classification", ENSEMBLE_SIZE),
    ("regression", "fimtdd"): lambda _: KeyedTree("regression"),
    ("regression", "arf"): lambda _: KeyedForest("regression", ENSEMBLE_SIZE),
    ("regression", "sgd"): lambda _: Linear(SQUARED),
    ("regression", "sgd_toy"): lambda _: Linear(SQUARED, eta=0.0001, schedule="constant"),
    ("regression", "knn"): lambda _: Neighbours("regression"),
}
CHUNKED = {
    ("classification", "hoeffding_tree"): 1,
    ("classification", "arf"): ENSEMBLE_SIZE,
    ("regression", "fimtdd"): 1,
    ("regression", "arf"): ENSEMBLE_SIZE,
}
# The predefined experiment matrix (dataset, task, model).
EXPERIMENTS = (
    ("electricity", "classification", "hoeffding_tree"),
    ("electricity", "classification", "arf"),
    ("electricity", "classification", "knn"),
    ("bike", "regression", "fimtdd"),
    ("bike", "regression", "arf"),
    ("bike", "regression", "knn"),
)


def create_learner(task: str, model: str, classes: Sequence[int] = BINARY) -> Any:
    """A fresh learner with row-by-row updates for the declared ``classes``; unknown names are an error."""
    try:
        return KEYED[(task, model)](classes)
    except KeyError:
        raise ValueError(f"unknown {task} learner: {model}") from None


def registry(spark: SparkSession) -> DataFrame:
    """All (task, model) pairs, served by keyed state, and the form for one huge stream where there is one."""
    rows = [(t, m, "chunked" if (t, m) in CHUNKED else None) for t, m in KEYED]
    return spark.createDataFrame(rows, "task string, model string, large_form string")


def unsupported(requests: DataFrame) -> DataFrame:
    """Requested (task, model) pairs that no learner serves."""
    # the registry has a fixed number of rows
    return requests.join(F.broadcast(registry(requests.sparkSession)), ["task", "model"], "left_anti")


def check_requests(requests: DataFrame) -> None:
    bad = unsupported(requests.select("task", "model").distinct()).take(20)
    if bad:
        raise ValueError("no such learner: " + ", ".join(f"{r['task']}:{r['model']}" for r in bad))


def parse_experiments(specs: DataFrame, spec: str = "spec") -> DataFrame:
    """``dataset:task:model`` strings to columns; other shapes are dropped."""
    parts = F.split(F.col(spec), ":")
    return specs.filter(F.size(parts) == 3).select(
        parts[0].alias("dataset"), parts[1].alias("task"), parts[2].alias("model")
    )


def experiment_matrix(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(EXPERIMENTS), "dataset string, task string, model string")

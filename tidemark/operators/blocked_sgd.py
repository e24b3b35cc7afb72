"""Squared-loss SGD in parallel inside one stream, with the result of the row-by-row run.

One step maps the weights ``v`` (intercept last) to ``v - r (z.v - y) z``, an affine map. Affine maps
compose, so each block is reduced to one map in parallel, the maps of a key are folded in block
order (one row per block), and every block is replayed in parallel from its entry weights.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.learners import SQUARED, Linear
from tidemark.plans.blocked import Scan, prefix_scan
from tidemark.plans.ordered import run_ordered

BLOCK_ROWS = 100_000
VECTOR = T.ArrayType(T.DoubleType())


class _Compose:
    """Composite map of a full block, given out with the block's last row."""

    def __init__(self, eta: float, schedule: str, power: float, block_rows: int):
        self.eta, self.schedule, self.power, self.block_rows = eta, schedule, power, block_rows
        self.matrix = self.shift = None

    def step(self, row: tuple) -> tuple:
        pos, features, y = row
        z = np.array([*features, 1.0])
        if self.matrix is None:
            self.matrix, self.shift = np.eye(len(z)), np.zeros(len(z))
        rate = self.eta if self.schedule == "constant" else self.eta / pos**self.power
        self.matrix -= rate * np.outer(z, z @ self.matrix)
        self.shift -= rate * (z @ self.shift - y) * z
        if pos % self.block_rows:
            return (None,)
        return ([*self.matrix.ravel(), *self.shift],)


class _Fold:
    """Weights after each block."""

    def __init__(self) -> None:
        self.v: list[float] | None = None

    def step(self, row: tuple) -> tuple:
        _, flat = row
        d = int((-1 + (1 + 4 * len(flat)) ** 0.5) / 2 + 0.5)
        matrix, shift = np.array(flat[: d * d]).reshape(d, d), np.array(flat[d * d :])
        v = np.zeros(d) if self.v is None else np.array(self.v)
        self.v = [float(e) for e in matrix @ v + shift]
        return (self.v,)

    def to_state(self) -> dict[str, Any]:
        return {"v": self.v}

    def from_state(self, state: dict[str, Any]) -> None:
        self.v = state["v"]


class _Entries:
    """Weights of the row-by-row run after each full block."""

    def __init__(self, eta: float, schedule: str, power: float, block_rows: int):
        self.model, self.block_rows = Linear(SQUARED, eta, schedule, power), block_rows

    def step(self, row: tuple) -> tuple:
        pos, features, y = row
        self.model.learn(features, y)
        return (None if pos % self.block_rows else [*self.model.w, self.model.b],)

    def to_state(self) -> dict[str, Any]:
        return self.model.to_state()

    def from_state(self, state: dict[str, Any]) -> None:
        self.model.from_state(state)


class _Replay:
    def __init__(self, eta: float, schedule: str, power: float):
        self.model = Linear(SQUARED, eta, schedule, power)
        self.started = False

    def step(self, row: tuple) -> tuple:
        pos, features, y, entry = row
        if not self.started:
            self.started = True
            self.model.t = pos - 1
            if entry is not None:
                self.model.w, self.model.b = list(entry[:-1]), entry[-1]
        prediction = self.model.predict(features)
        self.model.learn(features, y)
        return (prediction,)


def sgd_regression(
    instances: DataFrame,
    keys: Sequence[str],
    order: str = "instance_id",
    eta: float = 0.01,
    schedule: str = "inverse",
    power: float = 0.25,
    block_rows: int = BLOCK_ROWS,
    exact: bool = False,
) -> DataFrame:
    """Test-then-train predictions of the squared-loss learner without drift resets.

    Columns: keys, ``order``, ``prediction`` (null for a key's first row), ``actual``. Keys that fit one
    block skip the composing step.

    Composed maps round differently than single steps: the predictions are those of the row-by-row run to about twelve digits.
    ``exact`` learns (without predicting) each key's rows in order for the weights between its blocks, which gives every digit.
    """
    keys = list(keys)
    rows = instances.select(*keys, order, "features", F.col("actual").cast("double").alias("actual"))
    placed = prefix_scan(rows, keys, order, {"pos": Scan("count", F.lit(True))}).withColumn(
        "part", F.expr(f"(pos - 1) div {block_rows}")
    )
    ends = placed.groupBy(*keys).agg(F.max("part").alias("__end")).filter("__end > 0")
    inner = placed.join(ends, keys).filter("part < __end")
    if exact:
        weights = run_ordered(
            inner,
            keys,
            "pos",
            ["pos", "features", "actual"],
            T.StructType([T.StructField("entry", VECTOR)]),
            lambda _: _Entries(eta, schedule, power, block_rows),
        )
        weights = weights.filter("entry is not null").withColumn("part", F.expr(f"pos div {block_rows}"))
    else:
        weights = _composed(inner, keys, eta, schedule, power, block_rows)
    replayed = run_ordered(
        placed.join(weights.select(*keys, "part", "entry"), [*keys, "part"], "left"),
        [*keys, "part"],
        "pos",
        ["pos", "features", "actual", "entry", order],
        T.StructType([T.StructField("prediction", T.DoubleType())]),
        lambda _: _ReplayRows(eta, schedule, power),
        bounded=True,
    )
    return replayed.select(*keys, order, "prediction", "actual")


def _composed(inner: DataFrame, keys: list[str], eta: float, schedule: str, power: float, block_rows: int) -> DataFrame:
    """Entry weights of each block but the first, from the maps of the blocks before it."""
    maps = run_ordered(
        inner,
        [*keys, "part"],
        "pos",
        ["pos", "features", "actual"],
        T.StructType([T.StructField("map", VECTOR)]),
        lambda _: _Compose(eta, schedule, power, block_rows),
        bounded=True,
    ).filter("map is not null")
    return run_ordered(
        maps.select(*keys, "part", "map"),
        keys,
        "part",
        ["part", "map"],
        T.StructType([T.StructField("entry", VECTOR)]),
        lambda _: _Fold(),
        bounded=True,
    ).select(*keys, (F.col("part") + 1).alias("part"), "entry")


class _ReplayRows(_Replay):
    def step(self, row: tuple) -> tuple:
        return super().step(row[:4])

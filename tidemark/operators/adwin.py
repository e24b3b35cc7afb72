"""Adaptive windowing on an error stream (Bifet and Gavaldà, SDM 2007), and the drift gate."""

from __future__ import annotations

from collections.abc import Sequence
from math import log, sqrt
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.blocked import Scan, prefix_scan
from tidemark.plans.ordered import run_ordered

DELTA = 0.01
CLOCK = 32
MAX_BUCKETS = 5
MIN_SIDE = 5
MIN_WIDTH = 10
COOLDOWN = 2000
MIN_ROWS = 100


class Adwin:
    """Exponential histogram of (sum, squared deviations); O(log n) state.

    ``grain`` is the number of values behind one insertion: 1 for raw values, more for
    pre-aggregated groups. A smaller ``delta`` gives fewer alarms.
    """

    def __init__(self, delta: float = DELTA, clock: int = CLOCK, grain: int = 1):
        self.delta, self.clock, self.grain = delta, clock, grain
        self.levels: list[list[list[float]]] = [[]]  # level k: buckets of grain * 2**k values, oldest first
        self.width, self.total, self.m2, self.seen = 0, 0.0, 0.0, 0

    def update(self, total: float, m2: float = 0.0) -> int:
        """Insert one group; 0 without an alarm, else 1 or -1 as the newer mean is higher or lower."""
        g = self.grain
        if self.width:
            gap = total / g - self.total / self.width
            self.m2 += m2 + self.width * g * gap * gap / (self.width + g)
        else:
            self.m2 = m2
        self.width += g
        self.total += total
        self.levels[0].append([total, m2])
        size = g
        for k, buckets in enumerate(self.levels):
            if len(buckets) <= MAX_BUCKETS:
                break
            (s0, q0), (s1, q1) = buckets.pop(0), buckets.pop(0)
            gap = (s0 - s1) / size
            if k + 1 == len(self.levels):
                self.levels.append([])
            self.levels[k + 1].append([s0 + s1, q0 + q1 + size * gap * gap / 2])
            size *= 2
        ticks = self.seen // self.clock
        self.seen += g
        if self.seen // self.clock == ticks or self.width <= MIN_WIDTH:
            return 0
        direction = 0
        while (found := self._cut()) != 0:
            direction = found
            self._drop_oldest()
        return direction

    def _cut(self) -> int:
        n, n0, s0 = self.width, 0, 0.0
        if n <= MIN_WIDTH:
            return 0
        bound = log(2.0 * log(n) / self.delta)
        spread = self.m2 / n
        for k in range(len(self.levels) - 1, -1, -1):
            size = self.grain << k
            for total, _ in self.levels[k]:
                n0 += size
                s0 += total
                n1 = n - n0
                if n1 < MIN_SIDE:
                    return 0
                if n0 < MIN_SIDE:
                    continue
                inverse = 1.0 / n0 + 1.0 / n1
                gap = (self.total - s0) / n1 - s0 / n0
                if abs(gap) > sqrt(2.0 * inverse * spread * bound) + 2.0 / 3.0 * inverse * bound:
                    return 1 if gap > 0 else -1
        return 0

    def _drop_oldest(self) -> None:
        size = self.grain << (len(self.levels) - 1)
        total, m2 = self.levels[-1].pop(0)
        self.width -= size
        self.total -= total
        gap = total / size - self.total / self.width if self.width else 0.0
        self.m2 = max(0.0, self.m2 - m2 - size * self.width * gap * gap / (self.width + size))
        while len(self.levels) > 1 and not self.levels[-1]:
            self.levels.pop()

    def to_state(self) -> dict[str, Any]:
        return dict(vars(self))

    def from_state(self, state: dict[str, Any]) -> None:
        vars(self).update(state)


class Gate:
    """Accept an alarm after ``min_rows`` rows and ``cooldown`` rows since the last accepted one."""

    def __init__(self, cooldown: int = COOLDOWN, min_rows: int = MIN_ROWS):
        self.cooldown, self.min_rows, self.last = cooldown, min_rows, 0

    def accepts(self, n: int) -> bool:
        if n > self.min_rows and n - self.last >= self.cooldown:
            self.last = n
            return True
        return False


class _AdwinMachine:
    def __init__(self, delta: float, clock: int, grain: int, cooldown: int, min_rows: int):
        self.options = (delta, clock, grain)
        self.detector = Adwin(*self.options)
        self.gate = Gate(cooldown, min_rows)

    def step(self, row: tuple) -> tuple:
        order, n, total, m2 = row
        if total is None:
            return 0, False
        direction = self.detector.update(total, m2)
        drift = bool(direction) and self.gate.accepts(n)
        if drift:
            self.detector = Adwin(*self.options)
        return direction, drift

    def to_state(self) -> dict[str, Any]:
        return {"detector": self.detector.to_state(), "last": self.gate.last}

    def from_state(self, state: dict[str, Any]) -> None:
        self.detector.from_state(state["detector"])
        self.gate.last = state["last"]


def detect_drift(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    order: str = "instance_id",
    delta: float = DELTA,
    clock: int = CLOCK,
    grain: int = 1,
    cooldown: int = COOLDOWN,
    min_rows: int = MIN_ROWS,
    slice_rows: int | None = None,
) -> DataFrame:
    """Alarms and accepted drifts of every key's ``value`` stream (null values are skipped).

    Returns keys, ``order``, ``n`` (values so far), ``direction`` and ``drift``: one row per value, or
    one per ``grain`` values. With a large grain the groups are built by a map-side aggregate, so
    the sequential part of a huge stream sees ``1/grain`` of its rows; cuts then fall between
    groups. A last group with fewer than ``grain`` values is not judged.
    """
    keys = list(keys)
    values = df.select(*keys, order, value.cast("double").alias("__v")).filter("__v is not null")
    ranked = prefix_scan(values, keys, order, {"n": Scan("count", F.lit(True))})
    if grain == 1:
        groups = ranked.select(*keys, order, "n", F.col("__v").alias("total"), F.lit(0.0).alias("m2"))
    else:
        groups = (
            ranked.groupBy(*keys, F.expr(f"(n - 1) div {grain}").alias("__g"))
            .agg(
                F.max(order).alias(order),
                F.max("n").alias("n"),
                F.count(F.lit(1)).alias("__c"),
                F.sum("__v").alias("total"),
                (F.var_pop("__v") * F.count(F.lit(1))).alias("m2"),
            )
            .filter(F.col("__c") == grain)
            .select(*keys, order, "n", "total", "m2")
        )
    outputs = T.StructType([T.StructField("direction", T.IntegerType()), T.StructField("drift", T.BooleanType())])
    out = run_ordered(
        groups,
        keys,
        order,
        [order, "n", "total", "m2"],
        outputs,
        lambda _: _AdwinMachine(delta, clock, grain, cooldown, min_rows),
        slice_rows,
    )
    return out.drop("total", "m2")

"""Adaptive windowing inside one long stream, in parallel blocks.

As long as nothing is cut, the buckets of the exponential histogram depend on the number of values alone: which values a
bucket spans follows from the bucket counts at some earlier place and the number of values since, and its sum is the
difference of two running sums. So the histogram at the start of any later block is known, provided that no alarm comes
before it, from some five look-ups per doubling of the window. All blocks ahead of a settled place are replayed from such histograms at
once; blocks up to the first with an alarm are settled, and the next round starts behind it from the histogram
that this block ended with. Without alarms a round looks twice as far; where already the first block had one, blocks become twice
as long, so that a stream full of alarms costs what the row form costs and few rounds more.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.adwin import CLOCK, COOLDOWN, DELTA, MAX_BUCKETS, MIN_ROWS, Adwin, Gate
from tidemark.plans.blocked import Scan, prefix_scan
from tidemark.plans.ordered import run_ordered
from tidemark.session import materialize, scratch_path

BLOCK_ROWS = 1 << 15
FIRST_BLOCKS = 8
MOST_ROWS = 4_000_000  # of a block
STATE = "counts array<long>, start long, reset long, last long"


def layout(counts: Sequence[int], start: int, values: int) -> list[int]:
    """Ends of the buckets, oldest first, after ``values`` further insertions without a cut; ``start`` leads the list.

    ``counts[k]`` buckets of 2**k values each were there before, the window began behind value ``start``.
    """
    begins, at = [0] * len(counts), start
    for k in range(len(counts) - 1, -1, -1):
        begins[k] = at
        at += counts[k] << k
    kept, k = [], 0
    while k < len(counts) or values:
        held = (counts[k] if k < len(counts) else 0) + values
        first = begins[k] if k < len(counts) else start
        values = max(0, (held - MAX_BUCKETS + 1) // 2)  # merges of two: each leaves MAX_BUCKETS - 1 buckets
        first += values << (k + 1)
        kept.append([first + ((i + 1) << k) for i in range(held - 2 * values)])
        k += 1
    return [start, *[end for ends in reversed(kept) for end in ends]]


@F.pandas_udf(T.ArrayType(T.LongType()))
def _layout(counts: pd.Series, start: pd.Series, values: pd.Series) -> pd.Series:
    return pd.Series([layout([int(c) for c in cs], int(s), int(v)) for cs, s, v in zip(counts, start, values)])


def restored(marks: Sequence[Sequence[float]], seen: int, delta: float, clock: int) -> Adwin:
    """The detector whose buckets lie between the ``marks`` (place, running sum, running sum of squares)."""
    detector = Adwin(delta, clock)
    detector.seen = seen
    for (n0, s0, q0), (n1, s1, q1) in zip(marks, marks[1:]):
        size, total = int(n1 - n0), s1 - s0
        level = size.bit_length() - 1
        while len(detector.levels) <= level:
            detector.levels.append([])
        detector.levels[level].append([total, max(0.0, q1 - q0 - total * total / size)])
        detector.width += size
    if detector.width:
        detector.total = marks[-1][1] - marks[0][1]
        detector.m2 = max(0.0, marks[-1][2] - marks[0][2] - detector.total * detector.total / detector.width)
    return detector


class _Replay:
    """One block: its first row brings the histogram, its last one takes it along."""

    def __init__(self, delta: float, clock: int, cooldown: int, min_rows: int):
        self.options = (delta, clock)
        self.detector = Adwin(*self.options)
        self.gate = Gate(cooldown, min_rows)

    def step(self, row: tuple) -> tuple:
        n, _, value, marks, reset, last, closing = row
        if marks is not None:
            self.detector = restored(marks, n - reset, *self.options)
            self.gate.last = last
            return None, None, None
        direction = self.detector.update(value)
        drift = bool(direction) and self.gate.accepts(n)
        if drift:
            self.detector = Adwin(*self.options)
        if not closing:
            return direction, drift, None
        found = self.detector
        state = {
            "counts": [len(b) for b in found.levels], "start": n - found.width, "reset": n - found.seen, "last": self.gate.last
        }
        return direction, drift, json.dumps(state)

    def to_state(self) -> dict[str, Any]:
        return {"detector": self.detector.to_state(), "last": self.gate.last}

    def from_state(self, state: dict[str, Any]) -> None:
        self.detector.from_state(state["detector"])
        self.gate.last = state["last"]


def detect_drift_blocks(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    order: str = "instance_id",
    delta: float = DELTA,
    clock: int = CLOCK,
    cooldown: int = COOLDOWN,
    min_rows: int = MIN_ROWS,
    block_rows: int = BLOCK_ROWS,
    first_blocks: int = FIRST_BLOCKS,
) -> DataFrame:
    """The rows of ``adwin.detect_drift``: keys, ``order``, ``n``, ``direction`` and ``drift`` for every value that is not null.

    Sums are differences of running sums: exact for whole numbers, else they may differ from the row form in the last
    digits. Values are taken relative to the whole part of their key's mean, so that large offsets cost no digits.
    """
    keys = list(keys)
    values = df.select(*keys, order, value.cast("double").alias("__raw")).filter("__raw is not null")
    centre = values.groupBy(*keys).agg(F.floor(F.avg("__raw")).cast("double").alias("__centre"))
    shifted = values.join(centre, keys).select(*keys, order, (F.col("__raw") - F.col("__centre")).alias("value"))
    scans = {
        "n": Scan("count", F.lit(True)),
        "p": Scan("sum", F.col("value")),
        "q": Scan("sum", F.col("value") * F.col("value")),
    }
    placed = materialize(prefix_scan(shifted, keys, order, scans), "placed")
    spark = placed.sparkSession
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    states = placed.groupBy(*keys).agg(F.max("n").alias("size")).select(
        *keys, "size", zero.alias("at"), F.lit(block_rows).cast("long").alias("rows"),
        F.lit(first_blocks).cast("long").alias("blocks"), F.array().cast("array<long>").alias("counts"),
        zero.alias("start"), zero.alias("reset"), zero.alias("last"),
    )
    states = materialize(states, "states")
    outputs = T.StructType(
        [
            T.StructField("direction", T.IntegerType()), T.StructField("drift", T.BooleanType()),
            T.StructField("state", T.StringType()),
        ]
    )
    inputs = ["n", order, "value", "marks", "reset", "last", "closing"]
    base, rounds, schema = scratch_path(spark, "settled"), 0, None
    while not states.isEmpty():
        count = F.least(F.col("blocks"), F.ceil((F.col("size") - F.col("at")) / F.col("rows")))
        blocks = states.select(
            *keys, "at", "rows", "counts", "start", "reset", "last", F.explode(F.sequence(zero, count - 1)).alias("block")
        ).withColumn("n", F.col("at") + F.col("block") * F.col("rows"))
        bounds = blocks.select(
            *keys, "block", "n", "reset", "last", F.explode(_layout("counts", "start", F.col("n") - F.col("at"))).alias("place")
        )
        sums = placed.select(*keys, F.col("n").alias("place"), "p", "q")
        none_yet = F.lit(0.0)  # before the first value
        mark = F.array(F.col("place").cast("double"), F.coalesce("p", none_yet), F.coalesce("q", none_yet))
        seeds = bounds.join(sums, [*keys, "place"], "left").groupBy(*keys, "block", "n", "reset", "last").agg(
            F.sort_array(F.collect_list(mark)).alias("marks")
        )
        ahead = placed.join(states.select(*keys, "at", "rows", "blocks", "size"), keys)
        ahead = ahead.filter((F.col("n") > F.col("at")) & (F.col("n") <= F.col("at") + F.col("rows") * F.col("blocks")))
        rows = ahead.select(
            *keys, ((F.col("n") - F.col("at") - 1) / F.col("rows")).cast("long").alias("block"), "n", order, "value",
            F.lit(None).cast("array<array<double>>").alias("marks"), none.alias("reset"), none.alias("last"),
            (((F.col("n") - F.col("at")) % F.col("rows") == 0) | (F.col("n") == F.col("size"))).alias("closing"),
        )
        fed = rows.unionByName(seeds.withColumn("closing", F.lit(False)), allowMissingColumns=True)
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        ran = run_ordered(
            fed, [*keys, "block"], "n", inputs, outputs, lambda _: _Replay(delta, clock, cooldown, min_rows), bounded=True, tasks=tasks
        ).filter("direction is not null")
        ran = materialize(ran.select(*keys, "block", "n", order, "direction", "drift", "state"), "ran")
        alarm = F.min(F.when(F.col("direction") != 0, F.col("block")))
        judged = ran.groupBy(*keys).agg(alarm.alias("hit"), F.max("block").alias("top"))
        judged = materialize(judged.withColumn("upto", F.coalesce("hit", "top")), "judged")
        settled = ran.join(judged.select(*keys, "upto"), keys).filter("block <= upto")
        settled = settled.select(*keys, order, "n", "direction", "drift")
        settled.write.parquet(f"{base}/round={rounds}")
        schema, rounds = settled.schema, rounds + 1
        ends = ran.filter("state is not null").select(
            *keys, F.col("block").alias("upto"), F.col("n").alias("end"), F.from_json("state", STATE).alias("s")
        )
        after = states.select(*keys, "size", "rows", "blocks").join(judged, keys).join(ends, [*keys, "upto"]).filter("end < size")
        # blocks only ever grow: frequent alarms cost a number of rounds that grows with the logarithm of the length
        rows_next = F.when(F.col("hit").isNull(), F.col("rows")).otherwise(F.least(F.col("rows") * 2, F.lit(max(MOST_ROWS, block_rows))))
        blocks_next = F.when(F.col("hit").isNull(), F.col("blocks") * 2).otherwise(F.lit(first_blocks))
        states = materialize(
            after.select(
                *keys, "size", F.col("end").alias("at"), rows_next.cast("long").alias("rows"),
                blocks_next.cast("long").alias("blocks"), "s.counts", "s.start", "s.reset", "s.last",
            ),
            "states",
        )
    if not rounds:
        return placed.select(*keys, order, "n", F.lit(0).alias("direction"), F.lit(False).alias("drift"))
    return spark.read.schema(schema).parquet(*[f"{base}/round={r}" for r in range(rounds)])

"""Cumulative metrics by blocks against the window form, and queries that need no more than them."""

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.catalog import queries
from tidemark.operators import cumulative, metrics

KEYS = ["dataset", "task", "model"]
SCHEMA = "dataset string, task string, model string, instance_id long, prediction double, error {}, drift boolean"


def rows(kind, seed, drift_share):
    rng = random.Random(seed)
    out = []
    for model, n in (("long", 400), ("short", 3), ("none", 0), ("blank", 5)):
        for task in ("classification", "regression"):
            for i in range(1, n + 1):
                p = None if model == "blank" or rng.random() < 0.1 else 1.0
                cents = rng.choice([0, 100]) if task == "classification" else rng.randrange(5) * 10**9 + rng.randrange(1000)
                e = None if p is None or rng.random() < 0.05 else cents
                e = None if e is None else Decimal(e).scaleb(-2) if kind == "decimal(12,2)" else e if kind == "int" else e / 100
                out.append(("d", task, model, i, p, e % 1000 if e is not None and kind == "int" else e, rng.random() < drift_share))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize(
    "kind,warmup,block,drift_share",
    [
        ("decimal(12,2)", 40, 7, 0.02),
        ("decimal(12,2)", 3, 64, 0.1),
        ("decimal(12,2)", 0, 7, 0.3),
        ("double", 40, 7, 0.02),
        ("double", 3, 1000, 0.0),
        ("int", 40, 5, 0.02),
    ],
)
def test_equals_the_window_form(spark, kind, warmup, block, drift_share):
    pred = spark.createDataFrame(rows(kind, block + warmup, drift_share), SCHEMA.format(kind))
    columns = [*KEYS, "instance_id", "cumulative_accuracy", "cumulative_mae"]
    mine = cumulative.cumulative_metrics(pred, KEYS, warmup_rows=warmup, block_rows=block).select(columns)
    wanted = metrics.prequential_metrics(pred, KEYS, warmup_rows=warmup, block_rows=block).select(columns)
    mine, wanted = ({tuple(r[:4]): r[4:] for r in df.collect()} for df in (mine, wanted))
    assert mine.keys() == wanted.keys() and mine
    for at, values in wanted.items():
        for a, b in zip(mine[at], values):
            assert a == b if kind != "double" or b is None else math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-9), (at, mine[at], values)


def test_sums_carried_in_two_parts(spark):
    big = Decimal("99999999999.99")
    pred = spark.range(1, 1200, 1, 1).select(
        F.lit("d").alias("dataset"), F.lit("regression").alias("task"), F.lit("m").alias("model"), F.col("id").alias("instance_id"),
        F.lit(1.0).alias("prediction"), F.lit(big).cast("decimal(13,2)").alias("error"), F.lit(False).alias("drift"),
    )
    got = cumulative.cumulative_metrics(pred, KEYS, block_rows=50).collect()
    assert cumulative.PART < 1199 * int(big * 100)
    assert len(got) == 1199 and all(math.isclose(r.cumulative_mae, float(big), rel_tol=1e-12) for r in got)


def test_shift_queries_leave_the_rolling_columns_out(spark, sf_small):
    known = set(queries._derived)
    for name in [key for key in known if key[2] == "metric_log" and key[1] == sf_small]:
        queries._derived.pop(name)
    try:
        assert queries.shift_boxstats(spark, sf_small).count() >= 0
        assert not [key for key in queries._derived if key[1] == sf_small and key[2] == "metric_log"]
    finally:
        queries._derived.clear()

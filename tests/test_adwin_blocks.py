"""Detection in parallel blocks gives the alarms of the row form."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import adwin
from tidemark.operators.adwin_blocks import detect_drift_blocks, layout, restored


def test_layout_follows_the_histogram():
    rng = random.Random(3)
    detector, values = adwin.Adwin(), []
    for n in range(1, 3000):
        values.append(float(rng.random() < (0.2 if n % 900 < 450 else 0.7)))
        detector.update(values[-1])
        if n % 37:
            continue
        counts, start = [len(b) for b in detector.levels], n - detector.width
        quiet = adwin.Adwin(delta=1e-300)
        quiet.from_state({**detector.to_state(), "levels": [[list(b) for b in k] for k in detector.levels], "delta": 1e-300})
        ahead = rng.randrange(400)
        for _ in range(ahead):
            quiet.update(0.5)
        sizes = [1 << k for k in range(len(quiet.levels) - 1, -1, -1) for _ in quiet.levels[k]]
        ends = layout(counts, start, ahead)
        assert [b - a for a, b in zip(ends, ends[1:])] == sizes and ends[0] == start and ends[-1] == n + ahead
        marks = [[e, sum(values[:e]), sum(v * v for v in values[:e])] for e in layout(counts, start, 0)]
        again = restored(marks, detector.seen, adwin.DELTA, adwin.CLOCK)
        assert [[s for s, _ in k] for k in again.levels] == [[s for s, _ in k] for k in detector.levels]
        assert again.total == detector.total and again.m2 == pytest.approx(detector.m2)


@pytest.mark.parametrize("cooldown", [0, 300])
def test_equals_the_row_form(spark, cooldown):
    rng = random.Random(8)
    rows = []
    for key, size, step, offset in (("a", 4000, 1300, 0), ("b", 300, 90, 0), ("c", 1, 5, 0), ("d", 2500, 10**6, 0), ("e", 3000, 1100, 10**6)):
        for i in range(1, size + 1):
            v = rng.random() < (0.6 if i // step % 2 else 0.1)
            rows.append((key, i * 7, None if i % 50 == 3 else float(v) + offset))
    df = spark.createDataFrame(rows, "k string, instance_id long, e double")
    options = {"cooldown": cooldown, "min_rows": 50}
    want = sorted(tuple(r) for r in adwin.detect_drift(df, ["k"], F.col("e"), **options).collect())
    out = detect_drift_blocks(df, ["k"], F.col("e"), block_rows=200, first_blocks=3, **options)
    assert sorted(tuple(r) for r in out.collect()) == want
    assert sum(1 for r in want if r[3]) >= 3


def test_empty_stream(spark):
    df = spark.createDataFrame([], "k string, instance_id long, e double")
    out = detect_drift_blocks(df, ["k"], F.col("e"))
    assert out.count() == 0 and out.columns == ["k", "instance_id", "n", "direction", "drift"]


def test_frequent_alarms_cost_few_rounds(spark, monkeypatch):
    from tidemark.operators import adwin_blocks

    rng = random.Random(3)
    rows = [("a", i, float((i // 300) % 2 * 40 + rng.randrange(5))) for i in range(12000)]
    frame = spark.createDataFrame(rows, "k string, instance_id long, v double")
    options = {"cooldown": 100, "min_rows": 10}
    want = sorted(map(tuple, adwin.detect_drift(frame, ["k"], F.col("v"), **options).filter("direction != 0").collect()))
    rounds, whole = [], adwin_blocks.run_ordered
    monkeypatch.setattr(adwin_blocks, "run_ordered", lambda *a, **b: rounds.append(1) or whole(*a, **b))
    out = adwin_blocks.detect_drift_blocks(frame, ["k"], F.col("v"), block_rows=64, first_blocks=2, **options)
    assert sorted(map(tuple, out.filter("direction != 0").collect())) == want
    assert len(want) > 30 and len(rounds) <= 16

"""Speculative replay gives the rows of the row-by-row run, with its drifts and resets."""

import random

import pytest

from tidemark.operators.learners import SQUARED, Linear
from tidemark.operators.prequential import Detection, prequential
from tidemark.operators.speculative import sgd_with_resets


@pytest.mark.parametrize("train", [True, False])
def test_equals_the_row_form(spark, train):
    rng = random.Random(5)
    rows = []
    for key, size, shifts in (("a", 1000, (500,)), ("c", 1, ()), ("d", 700, (699,))):
        sign = 1.0
        for i in range(1, size + 1):
            sign = -sign if i in shifts else sign
            x = [rng.random(), rng.random()]
            rows.append((key, i * 1000, x, sign * (4 * x[0] - 2 * x[1] + 1) + rng.gauss(0, 0.05)))
    frame = spark.createDataFrame(rows, "user string, instance_id long, features array<double>, actual double")
    detection = Detection(cooldown=400, min_rows=50, delta_after=0.02, train_on_drift=train)
    exact = prequential(frame, ["user"], detection=detection, normalize=False, learner=lambda _: Linear(SQUARED, eta=0.1))
    want = {(r["user"], r["instance_id"]): r for r in exact.collect()}
    found = sgd_with_resets(frame, ["user"], detection=detection, eta=0.1, block_rows=100, first_rows=300).collect()
    assert len(found) == len(want) == len(rows)
    for r in found:
        w = want[r["user"], r["instance_id"]]
        assert (r["drift"], r["segment"]) == (w["drift"], w["segment"])
        assert (r["prediction"] is None) == (w["prediction"] is None)
        if w["prediction"] is not None:
            assert r["prediction"] == pytest.approx(w["prediction"]) and r["error"] == pytest.approx(w["error"])
    assert sum(r["drift"] for r in want.values()) >= 2


def test_empty_stream(spark):
    frame = spark.createDataFrame([], "user string, instance_id long, features array<double>, actual double")
    out = sgd_with_resets(frame, ["user"])
    assert out.count() == 0
    assert out.columns == ["user", "instance_id", "prediction", "actual", "error", "drift", "segment"]


def test_frequent_drifts_cost_no_round_each(spark, monkeypatch):
    from tidemark.operators import speculative

    rng, rows = random.Random(8), []
    for i in range(1, 3001):
        x = [rng.random(), rng.random()]
        rows.append(("a", i, x, (-1) ** (i // 150) * (4 * x[0] + 1) + rng.gauss(0, 0.05)))
    frame = spark.createDataFrame(rows, "user string, instance_id long, features array<double>, actual double")
    detection = Detection(cooldown=100, min_rows=50)
    exact = prequential(frame, ["user"], detection=detection, normalize=False, learner=lambda _: Linear(SQUARED, eta=0.1))
    want = {r["instance_id"]: r for r in exact.collect()}
    runs, whole = [], speculative.sgd_regression
    monkeypatch.setattr(speculative, "sgd_regression", lambda *a: runs.append(1) or whole(*a))
    found = sgd_with_resets(frame, ["user"], detection=detection, eta=0.1, block_rows=100, first_rows=300).collect()
    assert sum(r["drift"] for r in want.values()) > 8 and len(runs) <= 8
    assert sorted(r["instance_id"] for r in found) == list(range(1, 3001))
    for r in found:
        w = want[r["instance_id"]]
        assert (r["drift"], r["segment"]) == (w["drift"], w["segment"])
        assert r["prediction"] == (w["prediction"] and pytest.approx(w["prediction"]))

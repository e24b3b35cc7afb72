"""Detector, learners and the keyed run against slow, obvious versions."""

import math
import random
from functools import partial

import pytest
from pyspark.sql import functions as F

from tidemark.operators import adwin, blocked_sgd, learners, neighbours
from tidemark.operators.prequential import TOY_DETECTION, Detection, Scaler, TestThenTrain, prequential


class SlowAdwin:
    """Keeps every value; buckets are lists of raw values and all statistics are recomputed."""

    def __init__(self, delta=0.01, clock=32):
        self.delta, self.clock, self.buckets, self.seen = delta, clock, [], 0

    def update(self, x):
        self.buckets.append([x])
        size = 1
        while True:
            same = [i for i, b in enumerate(self.buckets) if len(b) == size]
            if len(same) <= 5:
                break
            i = same[0]
            self.buckets[i : i + 2] = [self.buckets[i] + self.buckets[i + 1]]
            size *= 2
        self.seen += 1
        alarm = False
        if self.seen % self.clock == 0:
            while self.cut():
                alarm = True
                self.buckets.pop(0)
        return alarm

    def cut(self):
        values = [v for b in self.buckets for v in b]
        n = len(values)
        if n <= 10:
            return False
        mean = sum(values) / n
        variance = sum((v - mean) ** 2 for v in values) / n
        bound = math.log(2 * math.log(n) / self.delta)
        n0 = 0
        for b in self.buckets:
            n0 += len(b)
            n1 = n - n0
            if n1 < 5:
                return False
            if n0 < 5:
                continue
            inverse = 1 / n0 + 1 / n1
            gap = abs(sum(values[:n0]) / n0 - sum(values[n0:]) / n1)
            if gap > math.sqrt(2 * inverse * variance * bound) + 2 / 3 * inverse * bound:
                return True
        return False


@pytest.mark.parametrize("seed", range(4))
def test_adwin_equals_slow_version(seed):
    rng = random.Random(seed)
    values = [rng.random() < 0.2 for _ in range(700)] + [rng.random() < 0.6 for _ in range(500)]
    values += [rng.gauss(3, 1) for _ in range(300)]
    fast, slow = adwin.Adwin(), SlowAdwin()
    for v in values:
        assert bool(fast.update(float(v))) == slow.update(float(v))
        assert fast.width == sum(len(b) for b in slow.buckets)
    assert fast.total == pytest.approx(sum(v for b in slow.buckets for v in b))


def test_adwin_behaviour():
    quiet = adwin.Adwin()
    assert not any(quiet.update(1.0) for _ in range(5000))
    rng = random.Random(1)
    stepped = adwin.Adwin()
    alarms = [i for i in range(4000) if stepped.update(float(rng.random() < (0.2 if i < 2000 else 0.5)))]
    assert alarms and 2000 < alarms[0] < 2300
    assert all((a + 1) % 32 == 0 for a in alarms)


def test_adwin_grain_finds_the_same_step(spark):
    rng = random.Random(2)
    rows = [("a", i, float(rng.random() < (0.2 if i <= 4000 else 0.6))) for i in range(1, 8001)]
    df = spark.createDataFrame(rows, "k string, instance_id long, e double")
    for grain in (1, 32, 128):
        found = adwin.detect_drift(df, ["k"], F.col("e"), grain=grain).filter("drift").collect()
        assert len(found) == 1 and 4000 < found[0].instance_id < 4400


def test_gate():
    gate = adwin.Gate()
    assert [n for n in range(224, 12001, 224) if gate.accepts(n)] == [2016, 4032, 6048, 8064, 10080]
    kept = [3168, 5280, 7904, 10720, 13184, 15328, 17504, 19552, 22048, 24864, 27360, 29376, 31776, 34048, 36768, 39104, 41376]
    gate = adwin.Gate()
    assert all(gate.accepts(n) for n in kept) and all(n % adwin.CLOCK == 0 for n in kept)


def rows_for(task, n=600, keys=("a", "b")):
    rng = random.Random(7)
    out = []
    for k in keys:
        for i in range(1, n + 1):
            x = [rng.random(), rng.random() * 5]
            flip = i > n // 2
            y = float((x[0] > 0.5) != flip) if task == "classification" else 3 * x[0] * (-1 if flip else 1)
            out.append(("d", task, k, i, x, y))
    rng.shuffle(out)
    return out


SCHEMA = "dataset string, task string, user string, instance_id long, features array<double>, actual double"


@pytest.mark.parametrize("task,model", [k for k in learners.KEYED if k[1] != "knn"] + [("classification", "knn")])
@pytest.mark.parametrize("slice_rows", [None, 170])
def test_keyed_run_equals_loop(spark, task, model, slice_rows):
    detection = Detection(cooldown=100)
    rows = rows_for(task, 400)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("model", F.lit(model))
    out = prequential(df, ["dataset", "task", "model", "user"], detection=detection, slice_rows=slice_rows)
    got = {(r.user, r.instance_id): (r.prediction, r.error, r.drift, r.segment) for r in out.collect()}
    assert len(got) == len(rows)
    for user in ("a", "b"):
        run = TestThenTrain(task, lambda: learners.create_learner(task, model), detection)
        for _, _, u, i, x, y in sorted((r for r in rows if r[2] == user), key=lambda r: r[3]):
            assert got[(u, i)] == run.step((i, x, y))


def test_drift_resets_the_run():
    run = TestThenTrain("classification", lambda: learners.create_learner("classification", "sgd"), Detection(cooldown=500))
    rng, segments = random.Random(3), []
    for i in range(1, 3001):
        x = [rng.random(), rng.random()]
        segments.append(run.step((i, x, float((x[0] > x[1]) != (i > 1500))))[3])
    # the detector also fires while the first model improves, so count from the change on
    assert segments[-1] > segments[1499]
    assert all(b - a in (0, 1) for a, b in zip(segments, segments[1:]))


def test_toy_run_skips_the_drift_row_and_trains_the_next():
    run = TestThenTrain("regression", lambda: learners.create_learner("regression", "sgd_toy"), TOY_DETECTION, normalize=False)
    rng, rows = random.Random(4), []
    for i in range(1, 2001):
        x = rng.random()
        rows.append(run.step((i, [x], 20 * x if i <= 1000 else -50 * x)))
    drifts = [i for i, r in enumerate(rows) if r[2]]
    assert rows[0][0] is None and drifts
    assert all(rows[i + 1][0] is None for i in drifts if i + 1 < len(rows))


def test_no_detection(spark):
    df = spark.createDataFrame(rows_for("regression", 300), SCHEMA).withColumn("model", F.lit("sgd"))
    out = prequential(df, ["dataset", "task", "model", "user"], detection=None)
    assert out.filter("drift or segment != 0").count() == 0


@pytest.mark.parametrize("n", [99, 100, 101])
def test_scaler_warmup(n):
    scaler = Scaler()
    for i in range(1, n):
        scaler.apply([float(i), 5.0])
    assert scaler.apply([float(n), 5.0]) == ([float(n), 5.0] if n < 100 else [1.0, 0.0])


def test_scaler_missing_values():
    scaler = Scaler(warmup=1)
    assert scaler.apply([float("nan"), None, float("inf")])[:2] == [0.0, 0.0]
    assert scaler.apply([2.0, 1.0, 3.0])[0] == 0.0


def test_state_survives_a_round_trip():
    import json

    for task, model in learners.KEYED:
        make = partial(learners.create_learner, task, model)
        a, b = (TestThenTrain(task, make, Detection(cooldown=50)) for _ in range(2))
        rng = random.Random(9)
        for i in range(1, 120):
            a.step((i, [rng.random(), rng.random()], float(rng.randrange(2))))
        b.from_state(json.loads(json.dumps(a.to_state())))
        for i in range(120, 200):
            row = (i, [rng.random(), rng.random()], float(rng.randrange(2)))
            assert a.step(row) == b.step(row)


CLASSES = (0, 1, 2)


def test_one_versus_rest_learns_three_classes():
    model, rng, hits = learners.OneVersusRest(learners.PASSIVE_AGGRESSIVE, CLASSES), random.Random(1), 0
    for i in range(1500):
        y = rng.randrange(3)
        x = [float(y == c) + rng.gauss(0, 0.1) for c in range(3)]
        hits += i >= 500 and model.predict(x) == y
        model.learn(x, float(y))
    assert hits > 950
    copy = learners.OneVersusRest(learners.PASSIVE_AGGRESSIVE, CLASSES)
    copy.from_state(model.to_state())
    assert copy.predict([1.0, 0.0, 0.0]) == model.predict([1.0, 0.0, 0.0])


@pytest.mark.parametrize("schedule", ["inverse", "constant"])
@pytest.mark.parametrize("block", [50, 1000])
def test_blocked_sgd_equals_loop(spark, schedule, block):
    rows = rows_for("regression", 420)
    df = spark.createDataFrame(rows, SCHEMA)
    out = blocked_sgd.sgd_regression(df, ["user"], schedule=schedule, block_rows=block)
    got = {(r.user, r.instance_id): r.prediction for r in out.collect()}
    assert len(got) == len(rows)
    for user in ("a", "b"):
        model = learners.Linear(learners.SQUARED, schedule=schedule)
        for _, _, _, i, x, y in sorted((r for r in rows if r[2] == user), key=lambda r: r[3]):
            want = model.predict(x)
            assert got[(user, i)] is None if want is None else got[(user, i)] == pytest.approx(want, rel=1e-9, abs=1e-12)
            model.learn(x, y)


@pytest.mark.parametrize("task", ["classification", "regression"])
@pytest.mark.parametrize("with_segment", [False, True])
def test_knn_equals_brute_force(spark, task, with_segment):
    rows = rows_for(task, 150, keys=("a",))
    df = spark.createDataFrame(rows, SCHEMA).withColumn("segment", F.expr("instance_id div 60"))
    out = neighbours.knn(df, ["user"], task, memory=25, tile_rows=40, segment="segment" if with_segment else None)
    got = {r.instance_id: r.prediction for r in out.collect()}
    data = sorted((r[3], r[4], r[5]) for r in rows)
    for i, x, _ in data:
        near = [d for d in data if i - 25 <= d[0] < i and (not with_segment or d[0] // 60 == i // 60)]
        near.sort(key=lambda d: (sum((a - b) ** 2 for a, b in zip(d[1], x)), d[0]))
        labels = [d[2] for d in near[:5]]
        if not labels:
            assert got[i] is None
        elif task == "regression":
            assert got[i] == pytest.approx(sum(labels) / len(labels))
        else:
            assert got[i] == min(set(labels), key=lambda c: (-labels.count(c), c))


def test_registry(spark):
    with pytest.raises(ValueError):
        learners.create_learner("classification", "fimtdd")
    asked = spark.createDataFrame([("classification", "fimtdd"), ("regression", "arf"), ("regression", "perceptron")], "task string, model string")
    assert sorted(r.model for r in learners.unsupported(asked).collect()) == ["fimtdd", "perceptron"]
    with pytest.raises(ValueError, match="classification:fimtdd"):
        learners.check_requests(asked)
    specs = spark.createDataFrame([("bike:regression:arf",), ("bad",), ("a:b:c:d",)], "spec string")
    assert [tuple(r) for r in learners.parse_experiments(specs).collect()] == [("bike", "regression", "arf")]
    assert learners.experiment_matrix(spark).count() == 6


@pytest.mark.parametrize("model", ["sgd", "perceptron", "passive_aggressive"])
def test_registry_serves_declared_classes(model):
    learner, rng, hits = learners.create_learner("classification", model, (3, 5, 9)), random.Random(2), 0
    for i in range(1500):
        y = rng.choice((3, 5, 9))
        x = [float(y == c) + rng.gauss(0, 0.1) for c in (3, 5, 9)]
        hits += i >= 500 and learner.predict(x) == y
        learner.learn(x, float(y))
    assert hits > 950
    for asked in ((0, 1), (3, 5)):
        with pytest.raises(ValueError):
            learners.create_learner("classification", model, asked).learn([1.0], 9.0)


@pytest.mark.parametrize("task", ["classification", "regression"])
def test_neighbours_keep_order_of_age_and_state(task):
    from tidemark.operators.learners import Neighbours

    rng = random.Random(4)
    model, rows = Neighbours(task, 5, 40), []
    for i in range(400):
        x, y = [rng.randrange(4) / 3, rng.randrange(4) / 3], float(rng.randrange(3))
        scored = sorted((sum((a - b) * (a - b) for a, b in zip(f, x)), j, v) for j, (f, v) in enumerate(rows[-40:]))
        near = [v for _, _, v in scored[:5]]
        want = None if not near else sum(near) / len(near) if task == "regression" else min(set(near), key=lambda c: (-near.count(c), c))
        assert model.predict(x) == want
        model.learn(x, y)
        rows.append((x, y))
        if i % 90 == 50:
            saved, model = model.to_state(), Neighbours(task, 5, 40)
            model.from_state(saved)

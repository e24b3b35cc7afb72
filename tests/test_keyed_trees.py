"""Row-by-row trees and forests: concepts, drift, saved state, and all learners through the registry."""

import json
import random

import pytest

from tidemark.operators import learners
from tidemark.operators.keyed_trees import KeyedForest, KeyedTree

PAIRS = list(learners.KEYED)


def rows(n, task, flip_at=None, seed=3):
    rng = random.Random(seed)
    for i in range(n):
        x = [rng.random() for _ in range(3)]
        high = (x[1] > 0.5) != (flip_at is not None and i >= flip_at)
        yield x, float(high) if task == "classification" else (10.0 if high else 1.0) + x[0]


def errors(learner, data, task):
    out = []
    for x, y in data:
        guess = learner.predict(x)
        out.append(None if guess is None else float(guess != y) if task == "classification" else abs(guess - y))
        learner.learn(x, y)
    return out


def mean(values):
    return sum(values) / len(values)


@pytest.mark.parametrize("task, limit", [("classification", 0.08), ("regression", 0.7)])
def test_tree_and_forest_learn(task, limit):
    for learner in (KeyedTree(task), KeyedForest(task, 5)):
        found = errors(learner, rows(1500, task), task)
        assert found[0] is None and mean(found[1000:]) < limit


def test_forest_members_are_replaced_after_drift():
    task = "classification"
    forest = KeyedForest(task, 5)
    found = errors(forest, rows(4000, task, flip_at=2000), task)
    assert mean(found[3500:]) < 0.2 < mean(found[2000:2050])
    assert any(m["made"] >= 5 for m in forest.members)


@pytest.mark.parametrize("task, model", PAIRS)
def test_every_learner_restarts_from_its_state(task, model):
    data = list(rows(400, task, flip_at=250))
    one, two = learners.create_learner(task, model), learners.create_learner(task, model)
    errors(one, data[:300], task)
    two.from_state(json.loads(json.dumps(one.to_state())))
    assert errors(one, data[300:], task) == errors(two, data[300:], task)


def test_registry_serves_the_whole_matrix(spark):
    learners.check_requests(learners.experiment_matrix(spark))
    assert {(t, m) for _, t, m in learners.EXPERIMENTS} <= set(PAIRS)
    assert learners.registry(spark).count() == len(PAIRS)

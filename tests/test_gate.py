"""The gate by pointer doubling against one pass over the alarms."""

import random

import pytest

from tidemark.operators import gate
from tidemark.operators.adwin import Gate


def brute(rows, cooldown, min_rows):
    gates, out = {}, []
    for key, at in sorted(rows):
        out.append((key, at, gates.setdefault(key, Gate(cooldown, min_rows)).accepts(at)))
    return out


@pytest.mark.parametrize("cooldown, min_rows", [(50, 10), (7, 100), (1, 0), (1000, 1)])
def test_equals_one_pass(spark, cooldown, min_rows):
    rng = random.Random(cooldown)
    rows = {(k, at) for k, share in (("dense", 1.0), ("thin", 0.02), ("gaps", 0.3)) for at in range(1, 900) if rng.random() < share}
    rows = [r for r in rows if r[0] != "gaps" or r[1] % 300 < 60]
    df = spark.createDataFrame(sorted(rows, key=lambda r: hash(r)), "k string, instance_id int").repartition(3)
    got = gate.gate_alarms(df, ["k"], cooldown=cooldown, min_rows=min_rows)
    assert got.columns == ["k", "instance_id", "accepted"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, cooldown, min_rows)


def test_empty_and_logarithmic_rounds(spark, monkeypatch):
    assert gate.gate_alarms(spark.createDataFrame([], "k string, instance_id long"), ["k"]).collect() == []
    labels, kept = [], gate.materialize
    monkeypatch.setattr(gate, "materialize", lambda df, label: (labels.append(label), kept(df, label))[1])
    df = spark.range(1, 1001).selectExpr("'a' as k", "id * 10 as instance_id")
    got = gate.gate_alarms(df, ["k"], cooldown=10, min_rows=0)
    assert got.filter("accepted").count() == 1000
    assert labels.count("accepted") <= 10

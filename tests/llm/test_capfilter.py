import numpy as np
import pytest

from tidemark.llm import capfilter
from tidemark.llm.capfilter import CapFilters


def brute(vectors, cosine=0.9):
    unit = [None if v is None or not len(v) or None in v or not np.isfinite(v).all() or not np.any(v)
            else np.array(v, dtype=np.float32).astype(float) for v in vectors]
    size = len(unit)
    link = np.zeros((size, size), dtype=bool)
    for i in range(size):
        for j in range(size):
            a, b = unit[i], unit[j]
            if i != j and a is not None and b is not None and len(a) == len(b):
                link[i, j] = a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= cosine
    label = list(range(size))
    for _ in range(size):
        new = [min([label[i], *(label[j] for j in np.flatnonzero(link[i]))]) for i in range(size)]
        if new == label:
            break
        label = new
    return link.sum(axis=1), label


@pytest.mark.parametrize("chunk", [16, 1024])
def test_matches_brute_force(spark, chunk):
    rng = np.random.default_rng(4)
    vectors = [None, [], [0.0] * 64, [None] + [1.0] * 63, [float("nan")] + [1.0] * 63, [float("inf")] * 64, [1.0, 0.0]]
    vectors += [v.tolist() for v in rng.standard_normal((60, 64))]
    center = rng.standard_normal(64)
    vectors += [(center + 0.2 * rng.standard_normal(64)).tolist() for _ in range(70)]
    for _ in range(10):
        base = rng.standard_normal(64)
        vectors += [(base + 0.15 * rng.standard_normal(64)).tolist() for _ in range(3)] + [base.tolist(), (2 * base).tolist()]
        vectors += [base.tolist()] * 2
    frame = spark.createDataFrame(
        [(i, v, 0, "x") for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, uid int, keys string"
    )
    got = {r["vec_id"]: r for r in capfilter.near_vectors(frame, CapFilters(), chunk).collect()}
    links, labels = brute(vectors)
    assert [got[i]["n_links"] for i in range(len(vectors))] == links.tolist()
    assert [got[i]["component_id"] for i in range(len(vectors))] == labels
    assert [got[i]["kept"] for i in range(len(vectors))] == [label == i for i, label in enumerate(labels)]


def test_recall_at_the_threshold():
    rng = np.random.default_rng(6)
    x = rng.standard_normal((1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.standard_normal(x.shape)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    y = 0.9 * x + np.sqrt(1 - 0.81) * z / np.linalg.norm(z, axis=1, keepdims=True)
    spec = CapFilters()
    met = np.zeros(len(x), dtype=bool)
    for number in range(spec.rounds):
        (r, k), (s, m) = spec.decode(x, number), spec.decode(y, number)
        pairs = set(zip(r.tolist(), k.tolist())) & set(zip(s.tolist(), m.tolist()))
        met[[row for row, _ in pairs]] = True
    assert met.mean() >= 0.97


def test_empty_table(spark):
    assert capfilter.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_vectors_of_lengths_with_one_remainder(spark, monkeypatch):
    monkeypatch.setattr(capfilter, "LENGTHS", 8)
    rng = np.random.default_rng(1)
    short, long = rng.standard_normal(8), rng.standard_normal(16)
    rows = [(0, short.tolist()), (1, (2 * short).tolist()), (2, long.tolist()), (3, (3 * long).tolist()), (4, (-short).tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in capfilter.near_vectors(frame, CapFilters(codewords=16)).collect()}
    assert got == {0: (1, 0), 1: (1, 0), 2: (1, 2), 3: (1, 2), 4: (0, 4)}

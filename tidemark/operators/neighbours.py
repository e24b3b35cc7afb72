"""Sliding-memory nearest neighbours, tile by tile."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.learners import MEMORY_ROWS, NEIGHBOURS
from tidemark.plans.blocked import Scan, prefix_scan, with_halo

TILE_ROWS = 4096
BLOCK_ROWS = 256  # rows whose distances to their memory are one matrix product
SLACK = 1e-11  # bound of the product's error, relative to the squared norms


def nearest(points: np.ndarray, parts: np.ndarray, own: np.ndarray, k: int, memory: int) -> Iterator[np.ndarray]:
    """For each position of ``own`` (ascending) the k nearest of the ``memory`` positions before it in the same part.

    Ties go to the older position. Matrix products give distances up to rounding; whatever may be among the k nearest by
    them is compared by its exact distance.
    """
    norms = np.einsum("ij,ij->i", points, points)
    for first in range(0, len(own), BLOCK_ROWS):
        rows = own[first : first + BLOCK_ROWS]
        low = max(0, rows[0] - memory)
        near = np.arange(low, rows[-1])
        known = (near < rows[:, None]) & (near >= rows[:, None] - memory) & (parts[near] == parts[rows][:, None])
        may = known
        sums = norms[near] + norms[rows][:, None]
        if len(near) > k and np.isfinite(sums).all():
            gaps = np.where(known, sums - 2.0 * (points[rows] @ points[near].T), np.inf)
            limit = np.partition(gaps, k - 1, axis=1)[:, k - 1 : k]
            slack = SLACK * np.where(known, sums, 0.0).max(axis=1, keepdims=True)
            may = known & (gaps <= limit + 2.0 * slack)
        for i, chosen in zip(rows, may):
            found = near[chosen]
            gap = points[found] - points[i]
            yield found[np.argsort(np.einsum("ij,ij->i", gap, gap), kind="stable")[:k]]


def knn(
    instances: DataFrame,
    keys: Sequence[str],
    task: str,
    order: str = "instance_id",
    k: int = NEIGHBOURS,
    memory: int = MEMORY_ROWS,
    segment: str | None = None,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Prediction from the k nearest of the ``memory`` rows before each row (``features``, ``actual``).

    Ties in distance go to the older row, ties in the vote to the smaller label; the first row has no
    prediction. With ``segment`` only rows of the same segment are remembered, as after a model
    reset. A tile carries its own look-back, so rows meet only inside a task, at most
    ``tile_rows + memory`` at a time, and no pair of rows is ever shuffled.
    """
    keys = list(keys)
    extra = [segment] if segment else []
    rows = instances.select(*keys, order, "features", F.col("actual").cast("double").alias("actual"), *extra)
    placed = prefix_scan(rows, keys, order, {"n": Scan("count", F.lit(True))})
    tiled = with_halo(placed, "n", memory, max(tile_rows, memory))
    schema = T.StructType(
        [
            *[rows.schema[c] for c in [*keys, order]],
            T.StructField("prediction", T.DoubleType()),
            T.StructField("actual", T.DoubleType()),
        ]
    )

    def vote(labels: np.ndarray) -> float:
        values, counts = np.unique(labels, return_counts=True)
        return float(values[np.argmax(counts)])

    def predict(tile: pd.DataFrame) -> pd.DataFrame:
        tile = tile.sort_values("n", ignore_index=True)
        points, actual = np.stack(tile["features"].to_numpy()), tile["actual"].to_numpy()
        parts = tile[segment].to_numpy() if segment else np.zeros(len(tile))
        own = np.flatnonzero(tile["__own"].to_numpy())
        found: list[float | None] = []
        for best in nearest(points, parts, own, k, memory):
            if len(best) == 0:
                found.append(None)
            else:
                found.append(float(actual[best].mean()) if task == "regression" else vote(actual[best]))
        out = tile.loc[own, [*keys, order, "actual"]]
        return out.assign(prediction=pd.Series(found, index=out.index, dtype="float64").astype(object).where(lambda s: s.notna(), None))[
            [*keys, order, "prediction", "actual"]
        ]

    return tiled.groupBy(*keys, "__tile").applyInPandas(predict, schema)

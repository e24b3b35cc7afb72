"""Chunk boundaries depend on the position alone."""

import pytest
from pyspark.sql import functions as F

from tidemark.plans.chunks import chunk_count, chunk_of


@pytest.mark.parametrize("first, most", [(1, 1), (1, 4), (3, 5), (10, 10), (10, 35), (7, 1000)])
def test_chunks(spark, first, most):
    rows = spark.range(1, 301).select(F.col("id"), chunk_of(F.col("id"), first, most).alias("c")).collect()
    chunks = [r.c for r in sorted(rows, key=lambda r: r.id)]
    assert chunks[0] == 0 and all(0 <= b - a <= 1 for a, b in zip(chunks, chunks[1:]))
    sizes = [chunks.count(c) for c in range(chunks[-1] + 1)]
    assert sizes[:2] == [first, first]
    assert max(sizes) <= max(first, most)
    for n in (1, first, first + 1, 50, 299, 300):
        assert chunk_count(n, first, most) == chunks[n - 1] + 1
    assert chunk_count(0, first, most) == 0

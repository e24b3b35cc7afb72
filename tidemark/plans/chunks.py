"""Chunk boundaries of a stream as a function of the row position alone.

Chunks end at ``first``, 2 ``first``, 4 ``first``, ... until a chunk would exceed ``most`` rows; from there on every
chunk has ``most``. More rows, or other streams beside, never move an earlier boundary, and the number of
chunks grows with the logarithm of the length (linearly only beyond ``most``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ends(first: int, most: int) -> list[int]:
    ends, size = [first], first
    while size <= most:
        ends.append(ends[-1] + size)
        size *= 2
    return ends


def chunk_of(position: Column, first: int, most: int) -> Column:
    """Number (from 0) of the chunk that holds the row at ``position`` (from 1)."""
    ends = _ends(first, most)
    doubled = sum(((position > end).cast("int") for end in ends[:-1]), F.lit(0))
    beyond = F.floor((position - ends[-1] - 1) / most) + len(ends)
    return F.when(position <= ends[-1], doubled).otherwise(beyond).cast("int")


def chunk_count(longest: int, first: int, most: int) -> int:
    ends = _ends(first, most)
    if longest <= ends[-1]:
        return sum(longest > end for end in ends[:-1]) + 1 if longest else 0
    return len(ends) + -(-(longest - ends[-1]) // most)

"""Exact ranks and blocks of equal size for streams whose order values are sparse, repeated jumps or timestamps.

Blocks cut by dividing the order value (``plans.blocked.with_block``) need dense ids: with ids a billion apart every row
is a block of its own. Here rows are dealt to tasks by ranges of (keys, order), sorted there and stored; a row's rank is
its place in its task plus the rows of its key in earlier tasks. Only one row per (key, task) crosses from task to task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.blocked import BLOCK, block_rows_of
from tidemark.session import materialize

AT, TASK = "__at", "__task"
TASK_BITS = 33  # monotonically_increasing_id numbers the rows of a task from its number times 2^33


def with_rank(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], rank: str = "rank") -> DataFrame:
    """Add ``rank``: 1, 2, ... within the non-null ``keys`` by ``order`` (null values first).

    Rows of equal keys and order values are numbered in an arbitrary but stored order.
    """
    keys = list(keys)
    columns = [*[F.col(k) for k in keys], *[F.col(o) if isinstance(o, str) else o for o in order]]
    placed = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    stored = materialize(placed.withColumn(AT, F.monotonically_increasing_id()), "ranked")
    stored = stored.withColumn(TASK, F.shiftright(AT, TASK_BITS))
    counts = stored.groupBy(*keys, TASK).agg(F.min(AT).alias("__first"), F.count(F.lit(1)).alias("__rows"))
    earlier = Window.partitionBy(*keys).orderBy(TASK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *keys, TASK, (F.coalesce(F.sum("__rows").over(earlier), F.lit(0)) - F.col("__first") + 1).alias("__offset")
    )
    joined = stored.join(offsets.hint("shuffle_hash"), [*keys, TASK])
    return joined.select(*df.columns, (F.col(AT) + F.col("__offset")).alias(rank))


def rank_blocks(
    df: DataFrame, keys: Sequence[str], order: str, block_rows: int | None = None, rank: str | None = None
) -> DataFrame:
    """``df`` with a block column of exactly ``block_rows`` rows per block (but the last of a key).

    The scans of ``plans.blocked`` and the metrics use the blocks of such a frame, whatever its order values are, and
    carry from block to block in two levels. ``rank`` names a column to keep the rank in.
    """
    size = block_rows or block_rows_of(df)
    ranked = with_rank(df, keys, [order], rank or "__rank")
    blocked = ranked.withColumn(BLOCK, F.expr(f"(`{rank or '__rank'}` - 1) div {size}"))
    return blocked if rank else blocked.drop("__rank")

"""Online normalisation: running statistics per feature, min-max scaling, missing values."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.vectors import fill, scale
from tidemark.operators.forest import features_matrix
from tidemark.plans.blocked import BLOCK, Scan, attach, prefix_scan, with_block

WARMUP_ROWS = 100
WIDE = 16


def _known(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def running_range(
    df: DataFrame,
    keys: Sequence[str],
    n_features: int,
    order: str = "instance_id",
    features: str = "features",
    sticky_nan: bool = False,
    block_rows: int | None = None,
) -> DataFrame:
    """Add ``n``, ``lo_i`` and ``hi_i``: rows, minimum and maximum so far, current row included.

    All features go through one sorted pass over the array, so rows are not multiplied by the number
    of features. NaN is skipped; with ``sticky_nan`` a NaN poisons its feature's range for good.
    """
    scans = {"n": Scan("count", F.lit(True))}
    for i in range(n_features):
        x = F.col(features)[i]
        scans[f"lo_{i}"] = Scan("min", _known(x))
        scans[f"hi_{i}"] = Scan("max", _known(x))
        if sticky_nan:
            scans[f"nan_{i}"] = Scan("max", F.isnan(x).cast("int"))
    out = prefix_scan(df, keys, order, scans, block_rows)
    if sticky_nan:
        for i in range(n_features):
            poisoned = F.col(f"nan_{i}") == 1
            out = out.withColumns(
                {c: F.when(poisoned, F.lit(float("nan"))).otherwise(F.col(c)) for c in (f"lo_{i}", f"hi_{i}")}
            ).drop(f"nan_{i}")
    return out


def normalize_stream(
    df: DataFrame,
    keys: Sequence[str],
    n_features: int,
    order: str = "instance_id",
    features: str = "features",
    warmup_rows: int = WARMUP_ROWS,
    sticky_nan: bool = False,
    block_rows: int | None = None,
    position: str | None = None,
) -> DataFrame:
    """Replace ``features`` by its scaled form: raw during the first ``warmup_rows - 1`` rows, then
    min-max with the range seen so far; missing cells become 0.

    Up to ``WIDE`` features are scanned as columns; longer vectors as arrays. The scan of columns numbers the rows of the keys
    from 1; ``position`` names a column that keeps the number (the pass over arrays does not count missing vectors and has none).
    """
    if n_features > WIDE and not sticky_nan:
        if position:
            raise ValueError(f"rows are numbered up to {WIDE} features")
        return _normalize_wide(df, keys, n_features, order, features, warmup_rows, block_rows)
    ranged = running_range(df, keys, n_features, order, features, sticky_nan, block_rows)
    cells = [
        fill(
            F.when(F.col("n") < warmup_rows, F.col(features)[i]).otherwise(
                scale(F.col(features)[i], F.col(f"lo_{i}"), F.col(f"hi_{i}"))
            )
        )
        for i in range(n_features)
    ]
    number = [F.col("n").alias(position)] if position else []
    return ranged.withColumn(features, F.array(*cells)).select(*df.columns, *number)


def _normalize_wide(
    df: DataFrame, keys: Sequence[str], n_features: int, order: str, features: str, warmup_rows: int, block_rows: int | None
) -> DataFrame:
    """Block ranges come from a map-side aggregate per (block, feature); inside a block, which holds a
    bounded number of rows, the running range is a cumulative minimum over a matrix."""
    keys = list(keys)
    src = with_block(df, order, block_rows)
    cells = src.select(*keys, BLOCK, F.posexplode(features).alias("__f", "__x"))
    known = _known(F.col("__x"))
    ranges = cells.groupBy(*keys, BLOCK, "__f").agg(
        F.min(known).alias("__lo"), F.max(known).alias("__hi"), F.count(F.lit(1)).alias("__rows")
    )
    earlier = Window.partitionBy(*keys, "__f").orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carried = ranges.select(
        *keys,
        BLOCK,
        "__f",
        F.min("__lo").over(earlier).alias("__lo"),
        F.max("__hi").over(earlier).alias("__hi"),
        F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__seen"),
    )
    # one element per feature
    carry = carried.groupBy(*keys, BLOCK).agg(
        F.sort_array(F.collect_list(F.struct("__f", "__lo", "__hi"))).alias("__r"), F.max("__seen").alias("__seen")
    ).select(*keys, BLOCK, "__seen", F.col("__r.__lo").alias("__lo"), F.col("__r.__hi").alias("__hi"))

    columns = df.columns

    def scaled(block: pa.Table) -> pa.Table:
        block = block.take(pa.array(np.argsort(block[order].to_numpy(), kind="stable")))
        x = features_matrix(block[features], n_features)
        low, high = (features_matrix(block[c].slice(0, 1), n_features) for c in ("__lo", "__hi"))
        low = np.fmin.accumulate(np.vstack([low, x]))[1:]
        high = np.fmax.accumulate(np.vstack([high, x]))[1:]
        span = np.where(high == low, 1.0, high - low)
        n = block["__seen"][0].as_py() + np.arange(1, len(x) + 1)
        with np.errstate(invalid="ignore"):
            z = np.where((n < warmup_rows)[:, None], x, (x - low) / span)
        ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * n_features)
        lists = pa.ListArray.from_arrays(ends, pa.array(np.nan_to_num(z, nan=0.0).ravel()))
        target = block.schema.field(features).type
        return block.set_column(block.schema.get_field_index(features), features, lists.cast(target)).select(columns)

    return attach(src, carry, [*keys, BLOCK]).groupBy(*keys, BLOCK).applyInArrow(scaled, df.schema)


def running_moments(
    df: DataFrame, keys: Sequence[str], value: Column, order: str = "instance_id", block_rows: int | None = None
) -> DataFrame:
    """Add the running mean and the running sum of squared deviations (``m2``) of ``value``.

    From count, sum and sum of squares; give an exact type (integer, decimal) for large streams.
    """
    out = prefix_scan(
        df,
        keys,
        order,
        {
            "n": Scan("count", value.isNotNull()),
            "__s": Scan("sum", value),
            "__q": Scan("sum", value * value),
        },
        block_rows,
    )
    s, q, n = F.col("__s").cast("double"), F.col("__q").cast("double"), F.col("n")
    return out.withColumns({"running_mean": s / n, "running_m2": q - s * s / n}).drop("__s", "__q")

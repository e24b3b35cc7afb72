"""The cumulative metrics of :mod:`tidemark.operators.metrics` alone, block by block as arrays.

The analyses around drifts judge a run by its cumulative accuracy or mean absolute error. Without the other columns, a row takes
no window: a block of rows leaves one row of totals, the totals are carried from block to block, and a second pass over
the same shuffle adds the running sums.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.metrics import WARMUP_ROWS
from tidemark.plans.blocked import BLOCK, DEFAULT_BLOCK_ROWS, with_block

# Whole errors are summed as longs in a block (32,768 rows of at most 13 digits), and carried in two parts of this size.
DIGITS = 13
PART = 10**15


def _scale(error: T.DataType) -> int | None:
    """Digits after the point of errors whose sums are exact, None for doubles."""
    if isinstance(error, T.DecimalType) and error.precision <= DIGITS:
        return error.scale
    return 0 if isinstance(error, (T.ByteType, T.ShortType, T.IntegerType)) else None


def _in_order(block: pa.Table, order: str) -> np.ndarray:
    return np.argsort(block[order].to_numpy(), kind="stable")


def _columns(block: pa.Table, place: np.ndarray) -> list[np.ndarray]:
    """Evaluated, drift, error, error known; the keys, equal in all rows, are not sorted along."""
    e = block["__e"]
    return [
        a.to_numpy()[place]
        for a in (block["__v"], block["drift"].fill_null(False), e.fill_null(0), e.is_valid())
    ]


def _totals(block: pa.Table, order: str, warmup: int) -> dict[str, object]:
    """What later blocks need of a block: counts, the rows since its last drift, and what counts towards the open segment.

    With a drift, ``err`` and ``counted`` hold one sum, behind the warm-up of the last one. Without, an entry for each number of
    rows (0, 1, ..., the warm-up) that may still be left out at the block's start.
    """
    evaluated, drift, e, known = _columns(block, _in_order(block, order))
    at = np.flatnonzero(drift)
    first = at[-1] if len(at) else 0
    x, there = e[first:][evaluated[first:]], known[first:][evaluated[first:]].astype(np.int64)
    left = np.array([min(warmup, len(x))]) if len(at) else np.arange(min(warmup, len(x)) + 1)

    def after(values: np.ndarray) -> list:
        sums = np.append(np.cumsum(values[::-1])[::-1], values.dtype.type(0))
        return sums[left].tolist()

    return {
        "t_n": int(evaluated.sum()),
        "t_ok": int((evaluated & known & (e == 0)).sum()),
        "t_d": len(at),
        "tail": len(x) if len(at) else None,
        "err": after(np.where(there > 0, x, x.dtype.type(0))),
        "counted": after(there),
    }


def _running(block: pa.Table, place: np.ndarray, carry: dict[str, object], warmup: int, unit: int) -> dict[str, np.ndarray]:
    """Evaluated rows so far, right ones, counted ones of the segment and the sum of their errors, for each row."""
    evaluated, drift, e, known = _columns(block, place)
    n = carry["c_n"] + np.cumsum(evaluated)
    right = carry["c_ok"] + np.cumsum(evaluated & known & (e == 0))
    segment = carry["c_d"] + np.cumsum(drift)
    bounds = np.unique(np.concatenate([[0], np.flatnonzero(drift), [len(n)]]))
    counted, total = np.zeros(len(n), dtype=np.int64), np.zeros(len(n))
    for start, end in zip(bounds[:-1], bounds[1:]):
        own = slice(start, end)
        opened = drift[start]
        begun = n[start] - evaluated[start] if opened else carry["c_start"]
        counts = evaluated[own] & known[own] & ((segment[own] == 0) | (n[own] - begun > warmup))
        counted[own] = np.cumsum(counts) + (0 if opened else carry["c_counted"])
        sums = np.cumsum(np.where(counts, e[own], e.dtype.type(0)))
        if not opened:
            sums = sums + carry["c_low"]
        total[own] = sums / unit
        if not opened and carry["c_high"]:
            total[own] += carry["c_high"] * (PART / unit)
    return {"n": n, "right": right, "counted": counted, "total": total, "evaluated": evaluated}


def _carries(totals: DataFrame, keys: Sequence[str], warmup: int, exact: bool) -> DataFrame:
    """State of each run before each of its blocks; one row per block."""
    earlier = Window.partitionBy(*keys).orderBy(BLOCK)
    before = earlier.rowsBetween(Window.unboundedPreceding, -1)
    known = totals.withColumns({f"c_{c}": F.coalesce(F.sum(f"t_{c}").over(before), F.lit(0)) for c in ("n", "ok", "d")})
    start = F.col("c_n") + F.col("t_n") - F.col("tail")
    known = known.withColumn("c_start", F.coalesce(F.last(start, ignorenulls=True).over(before), F.lit(0)))
    waiting = F.when((F.col("c_d") > 0) & F.col("tail").isNull(), F.greatest(F.lit(warmup) - F.col("c_n") + F.col("c_start"), F.lit(0)))

    def entry(name: str) -> Column:
        place = F.least(F.coalesce(waiting, F.lit(0)), F.size(name) - 1).cast("int")
        return F.get(F.col(name), place)

    open_ = Window.partitionBy(*keys, F.col("c_d") + F.col("t_d")).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    err = entry("err").cast("decimal(20,0)") if exact else entry("err")
    ends = known.withColumns({"end_err": F.sum(err).over(open_), "end_counted": F.sum(entry("counted")).over(open_)})
    carried = F.coalesce(F.lag("end_err").over(earlier), F.lit(0).cast("decimal(30,0)" if exact else "double"))
    ends = ends.withColumns({"c_err": carried, "c_counted": F.coalesce(F.lag("end_counted").over(earlier), F.lit(0))})
    if exact:
        high = F.expr(f"cast(c_err div {PART} as bigint)")
        parts = {"c_high": high, "c_low": (F.col("c_err") - high.cast("decimal(20,0)") * F.lit(PART)).cast("long")}
    else:
        parts = {"c_high": F.lit(0).cast("long"), "c_low": F.col("c_err")}
    return ends.withColumns(parts).select(*keys, BLOCK, "c_n", "c_ok", "c_d", "c_start", "c_counted", "c_high", "c_low")


def cumulative_metrics(
    pred: DataFrame,
    keys: Sequence[str],
    order: str = "instance_id",
    warmup_rows: int = WARMUP_ROWS,
    block_rows: int | None = None,
) -> DataFrame:
    """``cumulative_accuracy`` and ``cumulative_mae`` of ``metrics.prequential_metrics`` for every evaluated row."""
    keys = list(keys)
    scale = _scale(pred.schema["error"].dataType)
    exact = scale is not None
    unit = 10**scale if exact else 1
    error = (F.col("error") * F.lit(unit)).cast("long") if exact else F.col("error").cast("double")
    rows = pred.select(*keys, order, F.col("prediction").isNotNull().alias("__v"), F.col("drift"), error.alias("__e"))
    if block_rows is not None and block_rows > DEFAULT_BLOCK_ROWS:
        raise ValueError(f"blocks hold at most {DEFAULT_BLOCK_ROWS} rows")
    # a larger spark.tidemark.blockRows is for rows that stay in the JVM
    rows = with_block(rows, order, block_rows or DEFAULT_BLOCK_ROWS)
    # both passes read this shuffle
    rows = rows.repartition(*keys, BLOCK)
    block_keys = [T.StructField(k, pred.schema[k].dataType) for k in keys] + [T.StructField(BLOCK, T.LongType())]
    sums = T.ArrayType(T.LongType() if exact else T.DoubleType())
    counts = [T.StructField(c, T.LongType()) for c in ("t_n", "t_ok", "t_d", "tail")]
    left = T.StructType([*block_keys, *counts, T.StructField("err", sums), T.StructField("counted", T.ArrayType(T.LongType()))])

    def summed(block: pa.Table) -> pa.Table:
        own = {c: block[c][0].as_py() for c in (*keys, BLOCK)}
        return pa.Table.from_pylist([own | _totals(block, order, warmup_rows)], schema=target_of(block, left))

    def target_of(block: pa.Table, schema: T.StructType) -> pa.Schema:
        plain = {T.LongType(): pa.int64(), T.DoubleType(): pa.float64(), sums: pa.list_(pa.int64() if exact else pa.float64()), T.ArrayType(T.LongType()): pa.list_(pa.int64())}
        return pa.schema([(f.name, block.schema.field(f.name).type if f.name in block.schema.names else plain[f.dataType]) for f in schema])

    totals = rows.groupBy(*keys, BLOCK).applyInArrow(summed, left)
    carry = _carries(totals, keys, warmup_rows, exact)
    scored = T.StructType(
        [*block_keys[:-1], pred.schema[order], *[T.StructField(c, T.DoubleType()) for c in ("cumulative_accuracy", "cumulative_mae")]]
    )
    scored = T.StructType([T.StructField(f.name, f.dataType, True) for f in scored])
    if "task" not in keys:
        raise ValueError("the keys must name the task")

    def measured(block: pa.Table, state: pa.Table) -> pa.Table:
        target = target_of(block, scored)
        if not block.num_rows:
            return target.empty_table()
        place = _in_order(block, order)
        run = _running(block, place, state.to_pylist()[0], warmup_rows, unit)
        kept = np.flatnonzero(run["evaluated"])
        nothing = pa.nulls(len(kept), pa.float64())
        if block["task"][0].as_py() == "classification":
            values = [pa.array(run["right"][kept] / run["n"][kept]), nothing]
        else:
            total, counted = run["total"][kept], run["counted"][kept]
            mean = np.divide(total, counted, out=np.zeros(len(kept)), where=counted > 0)
            values = [nothing, pa.array(mean, mask=counted == 0)]
        own = [pa.repeat(block[k][0], len(kept)) for k in keys]
        return pa.table([*own, block[order].take(pa.array(place[kept])), *values], schema=target)

    return rows.groupBy(*keys, BLOCK).cogroup(carry.groupBy(*keys, BLOCK)).applyInArrow(measured, scored)

"""Ordered scans over streams whose single key may hold most of the rows.

A plain ``Window.partitionBy(key)`` sends a whole stream to one task. Here every key is cut
into blocks of consecutive order values; a block holds at most ``block_rows`` rows because the
order column is unique per key. Work inside blocks runs in parallel and only one row per block
crosses from block to block.

Key columns must not be null (they are equi-join keys).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = "__blk"
TILE = "__tile"
OWN = "__own"
DEFAULT_BLOCK_ROWS = 1 << 15
GROUP = "__grp"
GROUP_BLOCKS = 1024


@dataclass(frozen=True)
class Scan:
    """One running aggregate.

    kind: ``sum``, ``count`` (rows where ``value`` is true), ``min``, ``max`` or ``last``
    (latest non-null value). ``exclusive`` leaves the current row out.
    """

    kind: str
    value: Column
    exclusive: bool = False


def block_rows_of(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.tidemark.blockRows", str(DEFAULT_BLOCK_ROWS)))


def with_block(df: DataFrame, order: str, block_rows: int | None = None) -> DataFrame:
    size = block_rows or block_rows_of(df)
    return df.withColumn(BLOCK, F.expr(f"cast(`{order}` as bigint) div {size}"))


def _total(scan: Scan, order: str) -> Column:
    if scan.kind == "sum":
        return F.sum(scan.value)
    if scan.kind == "count":
        return F.count_if(scan.value)
    if scan.kind == "min":
        return F.min(scan.value)
    if scan.kind == "max":
        return F.max(scan.value)
    if scan.kind == "last":
        return F.max(F.when(scan.value.isNotNull(), F.struct(F.col(order).alias("o"), scan.value.alias("v"))))
    raise ValueError(f"unknown scan kind {scan.kind!r}")


def _merge_totals(scan: Scan, total: Column) -> Column:
    """Aggregate that merges the totals of several blocks."""
    if scan.kind in ("sum", "count"):
        return F.sum(total)
    return F.min(total) if scan.kind == "min" else F.max(total)


def carries(totals: DataFrame, keys: Sequence[str], scans: Mapping[str, Scan], grouped: bool) -> DataFrame:
    """Add ``__c_<name>``, the merged ``__t_<name>`` of the earlier blocks of the keys, to a row per (keys, block).

    One level is a window with a row per block. ``grouped`` (for dense blocks, see ``plans.ranked``) carries in two levels:
    from group to group of ``GROUP_BLOCKS`` blocks, and inside a group from block to block, so that no window sees more
    than the blocks of a group or the groups of a key.
    """
    keys = list(keys)

    def before(frame: DataFrame, by: list[str], order: str, prefix: str) -> DataFrame:
        earlier = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return frame.withColumns({f"{prefix}{n}": _merge_totals(s, F.col(f"__t_{n}")).over(earlier) for n, s in scans.items()})

    if not grouped:
        return before(totals, keys, BLOCK, "__c_")
    parts = totals.withColumn(GROUP, F.expr(f"`{BLOCK}` div {GROUP_BLOCKS}"))
    sums = parts.groupBy(*keys, GROUP).agg(*[_merge_totals(s, F.col(f"__t_{n}")).alias(f"__t_{n}") for n, s in scans.items()])
    outer = before(sums, keys, GROUP, "__o_").drop(*[f"__t_{n}" for n in scans])
    inner = before(attach(parts, outer, [*keys, GROUP]), [*keys, GROUP], BLOCK, "__c_")

    def merged(scan: Scan, name: str) -> Column:
        far, near = F.col(f"__o_{name}"), F.col(f"__c_{name}")
        if scan.kind in ("sum", "count"):
            return F.coalesce(far + near, far, near)
        if scan.kind == "min":
            return F.least(far, near)
        return F.coalesce(near, far) if scan.kind == "last" else F.greatest(far, near)

    out = inner.withColumns({f"__c_{n}": merged(s, n) for n, s in scans.items()})
    return out.drop(GROUP, *[f"__o_{n}" for n in scans])


def _running(scan: Scan, upto_now, before_now) -> Column:
    frame = before_now if scan.exclusive else upto_now
    if scan.kind == "sum":
        return F.sum(scan.value).over(frame)
    if scan.kind == "count":
        return F.count_if(scan.value).over(frame)
    if scan.kind == "min":
        return F.min(scan.value).over(frame)
    if scan.kind == "max":
        return F.max(scan.value).over(frame)
    return F.last(scan.value, ignorenulls=True).over(frame)


def _combine(scan: Scan, carry: Column, inside: Column) -> Column:
    if scan.kind == "count":
        return F.coalesce(carry, F.lit(0)) + F.coalesce(inside, F.lit(0))
    if scan.kind == "sum":
        return F.coalesce(carry + inside, carry, inside)
    if scan.kind == "min":
        return F.least(carry, inside)
    if scan.kind == "max":
        return F.greatest(carry, inside)
    return F.coalesce(inside, carry["v"])


def attach(rows: DataFrame, carry: DataFrame, on: Sequence[str]) -> DataFrame:
    """Join one carry row per block to the block's rows.

    The hint pins the plan: both sides hashed by (keys, block), the carries as build side. Left
    alone, a broadcast may leave the rows partitioned by key only, which puts a whole stream into
    one task for the windows that follow.
    """
    return rows.join(carry.hint("shuffle_hash"), list(on))


def prefix_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    scans: Mapping[str, Scan],
    block_rows: int | None = None,
    keep_block: bool = False,
) -> DataFrame:
    """Add one running aggregate column per entry of ``scans``.

    The block totals aggregate map-side, so the only full shuffle is the one by (keys, block),
    which the join with the carries and the in-block window share. A frame that has blocks already (``ranked.rank_blocks``, for
    sparse ids or timestamps) keeps them and carries in two levels.
    """
    keys = list(keys)
    src = df if BLOCK in df.columns else with_block(df, order, block_rows)
    totals = src.groupBy(*keys, BLOCK).agg(*[_total(s, order).alias(f"__t_{n}") for n, s in scans.items()])
    carry = carries(totals, keys, scans, BLOCK in df.columns).select(*keys, BLOCK, *[f"__c_{n}" for n in scans])
    inside = Window.partitionBy(*keys, BLOCK).orderBy(order)
    upto_now = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before_now = inside.rowsBetween(Window.unboundedPreceding, -1)
    joined = attach(src, carry, [*keys, BLOCK])
    out = joined.withColumns({f"__r_{n}": _running(s, upto_now, before_now) for n, s in scans.items()})
    kept = [c for c in src.columns if c not in scans and (keep_block or c != BLOCK or BLOCK in df.columns)]
    return out.select(
        *kept, *[_combine(s, F.col(f"__c_{n}"), F.col(f"__r_{n}")).alias(n) for n, s in scans.items()]
    )


def segment_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    segment: str,
    scans: Mapping[str, Scan],
    block_rows: int | None = None,
    keep_block: bool = False,
    grouped: bool = False,
) -> DataFrame:
    """Like :func:`prefix_scan`, restarting whenever the non-decreasing ``segment`` changes.

    Only the first segment of a block can have begun in an earlier block, so a single carry per
    (keys, block) is enough and the rows keep the partitioning by (keys, block). ``grouped``: see :func:`carries`.
    """
    keys = list(keys)
    src = df if BLOCK in df.columns else with_block(df, order, block_rows)
    totals = src.groupBy(*keys, BLOCK, segment).agg(*[_total(s, order).alias(f"__t_{n}") for n, s in scans.items()])
    carry = carries(totals, [*keys, segment], scans, grouped).groupBy(*keys, BLOCK).agg(
        F.min(segment).alias("__open"), *[F.min_by(f"__c_{n}", segment).alias(f"__c_{n}") for n in scans]
    )
    inside = Window.partitionBy(*keys, BLOCK, segment).orderBy(order)
    upto_now = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before_now = inside.rowsBetween(Window.unboundedPreceding, -1)
    joined = attach(src, carry, [*keys, BLOCK])
    out = joined.withColumns({f"__r_{n}": _running(s, upto_now, before_now) for n, s in scans.items()})
    is_open = F.col(segment) == F.col("__open")
    kept = [c for c in src.columns if c not in scans and (keep_block or c != BLOCK or BLOCK in df.columns)]
    return out.select(
        *kept,
        *[
            _combine(s, F.when(is_open, F.col(f"__c_{n}")), F.col(f"__r_{n}")).alias(n)
            for n, s in scans.items()
        ],
    )


def with_halo(df: DataFrame, dense: str, halo: int, block_rows: int | None = None) -> DataFrame:
    """Assign rows to tiles of the dense 1-based position ``dense`` and copy each tile's last
    ``halo`` rows into the next tile, so a look-back of ``halo`` rows never leaves its tile.

    ``__own`` is false on the copies; drop them after the windowed step.
    """
    size = max(block_rows or block_rows_of(df), halo)
    home = F.expr(f"(`{dense}` - 1) div {size}")
    in_tail = F.pmod(F.col(dense) - 1, F.lit(size)) >= size - halo
    tiles = F.when(in_tail, F.array(home, home + 1)).otherwise(F.array(home))
    tiled = df.withColumn("__home", home).withColumn(TILE, F.explode(tiles))
    return tiled.withColumn(OWN, F.col(TILE) == F.col("__home")).drop("__home")


def rolling(
    df: DataFrame,
    keys: Sequence[str],
    dense: str,
    rows: int,
    sums: Mapping[str, Column],
    block_rows: int | None = None,
) -> DataFrame:
    """Sums over the last ``rows`` rows, current one included, in constant work per row.

    A sliding frame re-adds the whole window for every row. Integers and decimals use a running sum
    minus itself ``rows`` positions earlier, which is exact. For doubles that would cancel, so
    positions are cut into chunks of ``rows`` instead: a window is the tail of one chunk plus the
    head of the next, that is two running sums and one shift.
    """
    keys = list(keys)
    # one shuffle by tile serves all windows below
    tiled = with_halo(df, dense, rows, block_rows).repartition(*keys, TILE)
    order = Window.partitionBy(*keys, TILE).orderBy(dense)
    types = df.select(*[v.alias(n) for n, v in sums.items()]).schema
    if all(isinstance(f.dataType, (T.IntegralType, T.DecimalType)) for f in types.fields):
        upto_now = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        run = tiled.withColumns({f"__a_{n}": F.sum(v).over(upto_now) for n, v in sums.items()})
        out = run.withColumns({f"__b_{n}": F.lag(f"__a_{n}", rows).over(order) for n in sums})
        merged = {n: F.coalesce(F.col(f"__a_{n}") - F.col(f"__b_{n}"), F.col(f"__a_{n}")) for n in sums}
    else:
        chunk = Window.partitionBy(*keys, TILE, "__chunk")
        head = chunk.orderBy(dense).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        tail = chunk.orderBy(F.col(dense).desc()).rowsBetween(Window.unboundedPreceding, -1)
        cut = tiled.withColumn("__chunk", F.expr(f"(`{dense}` - 1) div {rows}"))
        tails = cut.withColumns({f"__b_{n}": F.sum(v).over(tail) for n, v in sums.items()})
        heads = tails.withColumns({f"__a_{n}": F.sum(v).over(head) for n, v in sums.items()})
        out = heads.withColumns({f"__b_{n}": F.lag(f"__b_{n}", rows).over(order) for n in sums})
        merged = {
            n: F.coalesce(F.col(f"__a_{n}") + F.col(f"__b_{n}"), F.col(f"__a_{n}"), F.col(f"__b_{n}")) for n in sums
        }
    return out.filter(OWN).select(*df.columns, *[c.alias(n) for n, c in merged.items()])


def rolling_distinct(
    df: DataFrame,
    keys: Sequence[str],
    dense: str,
    rows: int,
    values: Mapping[str, str],
    block_rows: int | None = None,
) -> DataFrame:
    """Number of distinct values of a column among the last ``rows`` rows, in constant work per row.

    A row opens a value unless the value was seen less than ``rows`` positions earlier, and closes it
    ``rows`` positions later unless it was seen again by then; the count is opens minus closes.
    """
    keys = list(keys)
    tiled = with_halo(df, dense, rows - 1, block_rows).repartition(*keys, TILE)
    position = F.col(dense)
    for name, column in values.items():
        same = Window.partitionBy(*keys, TILE, column).orderBy(dense)
        before, after = F.lag(dense).over(same), F.lead(dense).over(same)
        tiled = tiled.withColumns(
            {
                f"__open_{name}": (before.isNull() | (position - before >= rows)).cast("int"),
                f"__shut_{name}": (after.isNull() | (after - position >= rows)).cast("int"),
            }
        )
    order = Window.partitionBy(*keys, TILE).orderBy(dense)
    shut = tiled.withColumns({f"__shut_{n}": F.lag(f"__shut_{n}", rows, 0).over(order) for n in values})
    upto_now = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = shut.withColumns({n: F.sum(F.col(f"__open_{n}") - F.col(f"__shut_{n}")).over(upto_now) for n in values})
    return counted.filter(OWN).select(*df.columns, *values)

"""Chunk-synchronous Hoeffding trees, FIMT-DD trees and adaptive random forests.

A stream is cut into chunks. The rows of a chunk are predicted by the trees as they stood before it
(test-then-train at chunk grain), then added to per-leaf histograms, from which leaves are split
(Domingos and Hulten 2000; Ikonomovska et al. 2011; Gomes et al. 2017). The work inside a chunk is
one parallel pass over blocks of its rows (``forest``), however large; chunks double in size up to a ceiling and depend
on the row position only (``plans.chunks``), so more rows or other streams never change earlier output. A
tree grows by at most one level per chunk, to 60 levels at most (node numbers are longs). A tree is two small tables:

``splits``: keys, member, node, feature, threshold (children of node i are 2i+1 and 2i+2)
``stats``: keys, member, node, f, bin, cls, w, sy, syy

``f`` -1 holds a leaf's total mass and -2 a member's record (rows seen, rows right). Features must
lie in [0, 1]; values outside fall into the first or last bin.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import forest
from tidemark.operators.adwin import DELTA, Adwin, Gate
from tidemark.plans.blocked import BLOCK, Scan, block_rows_of, prefix_scan
from tidemark.plans.chunks import chunk_count, chunk_of
from tidemark.plans.ordered import ARROW
from tidemark.session import materialize, scratch_path


@dataclass(frozen=True)
class TreeOptions:
    task: str = "classification"
    members: int = 1
    bins: int = 16
    grace_rows: int = 200
    split_delta: float = 1e-7
    tie: float = 0.05
    first_rows: int = 1000
    most_rows: int = 4_000_000
    poisson_mean: float = 6.0
    seed: int = 1
    detect: bool = True
    detector_delta: float = DELTA
    detector_grain: int = 100
    cooldown: int = 2000

    def __post_init__(self) -> None:
        if self.detect and (self.first_rows % self.detector_grain or self.most_rows % self.detector_grain):
            raise ValueError("chunk sizes must be multiples of the detector's grain")


def bin_of(x: Column, bins: int) -> Column:
    return F.least(F.greatest(F.floor(x * bins), F.lit(0)), F.lit(bins - 1)).cast("int")


def poisson_weight(mean: float, *keys: Column) -> Column:
    """Poisson draw from a hash of ``keys``: the same on every partitioning."""
    u = F.pmod(F.xxhash64(*keys), F.lit(1 << 52)) / F.lit(float(1 << 52))
    draw, p, total = F.lit(0), math.exp(-mean), 0.0
    for k in range(int(mean + 8 * math.sqrt(mean)) + 2):
        total += p
        draw = draw + (u >= total).cast("int")
        p *= mean / (k + 1)
    return draw


def feature_subset(n_features: int, chosen: int, *keys: Column | str) -> Column:
    """Exactly ``chosen`` of the features 0, 1, ..., drawn by a hash of ``keys``."""
    ranked = F.transform(
        F.sequence(F.lit(0), F.lit(n_features - 1)), lambda p: F.struct(F.xxhash64(*keys, p).alias("h"), p.alias("p"))
    )
    return F.transform(F.slice(F.array_sort(ranked), 1, chosen), lambda c: c["p"])


def _xlogx(x: Column) -> Column:
    return F.when(x > 0, x * F.log2(x)).otherwise(F.lit(0.0))


def split_gains(stats: DataFrame, keys: Sequence[str], bins: int, task: str) -> DataFrame:
    """Gain of every cut (after bin ``cut``) of every feature of every leaf.

    ``stats`` has one row per (keys, f, bin, cls) with ``w`` (and ``sy``, ``syy`` for regression). A
    bin's mass goes to the left side of all cuts at or after it; the right side is the total minus
    the left. Entropy gain in bits, or reduction of the standard deviation.
    """
    keys = [*keys, "f"]
    lefts = (
        stats.withColumn("cut", F.explode(F.sequence(F.col("bin"), F.lit(bins - 1))))
        .groupBy(*keys, "cut", "cls")
        .agg(F.sum("w").alias("w"), F.sum("sy").alias("sy"), F.sum("syy").alias("syy"))
    )
    # everything lies left of the cut after the last bin
    whole = Window.partitionBy(*keys, "cls")
    paired = lefts.withColumns(
        {f"t_{c}": F.max(F.when(F.col("cut") == bins - 1, F.col(c))).over(whole) for c in ("w", "sy", "syy")}
    )
    right = F.col("t_w") - F.col("w")
    sides = paired.groupBy(*keys, "cut").agg(
        F.sum("w").alias("l"),
        F.sum(_xlogx(F.col("w"))).alias("l_log"),
        F.sum(_xlogx(F.col("t_w")) - _xlogx(right)).alias("r_less"),
        F.sum("sy").alias("l_y"),
        F.sum("syy").alias("l_yy"),
    )
    end = F.col("cut") == bins - 1
    per = Window.partitionBy(*keys)
    total = sides.withColumns(
        {
            "t": F.max(F.when(end, F.col("l"))).over(per),
            "t_log": F.max(F.when(end, F.col("l_log"))).over(per),
            "t_y": F.max(F.when(end, F.col("l_y"))).over(per),
            "t_yy": F.max(F.when(end, F.col("l_yy"))).over(per),
        }
    ).filter(~end & (F.col("l") < F.col("t")))
    l, t = F.col("l"), F.col("t")
    r = t - l
    if task == "classification":
        before = F.log2(t) - F.col("t_log") / t
        left = F.log2(l) - F.col("l_log") / l
        right_ = F.log2(r) - (F.col("t_log") - F.col("r_less")) / r
    else:

        def deviation(n: Column, y: Column, yy: Column) -> Column:
            return F.sqrt(F.greatest(yy / n - (y / n) * (y / n), F.lit(0.0)))

        before = deviation(t, F.col("t_y"), F.col("t_yy"))
        left = deviation(l, F.col("l_y"), F.col("l_yy"))
        right_ = deviation(r, F.col("t_y") - F.col("l_y"), F.col("t_yy") - F.col("l_yy"))
    return total.select(*keys, "cut", t.alias("n"), (before - l / t * left - r / t * right_).alias("gain"))


def best_cuts(gains: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Best cut per feature; ties to the first cut."""
    best = F.max_by(F.struct("cut", "gain"), F.struct(F.col("gain"), -F.col("cut"))).alias("b")
    return gains.groupBy(*keys, "f", "n").agg(best).select(*keys, "f", "n", "b.cut", "b.gain")


def decide_splits(stats: DataFrame, keys: Sequence[str], o: TreeOptions) -> DataFrame:
    """Leaves to split now: node, feature, cut."""
    node = [*keys, "member", "node"]
    # a leaf's histogram is bounded, and everything below groups within a leaf: one shuffle
    stats = stats.repartition(*node)
    cells = stats.filter("f >= 0")
    best = best_cuts(split_gains(cells, node, o.bins, o.task), node)
    place = Window.partitionBy(*node).orderBy(F.col("gain").desc(), "f")
    ranked = best.withColumn("__p", F.row_number().over(place)).filter("__p <= 2")
    top = ranked.groupBy(*node).agg(
        F.max("n").alias("n"),
        F.max(F.when(F.col("__p") == 1, F.col("f"))).alias("feature"),
        F.max(F.when(F.col("__p") == 1, F.col("cut"))).alias("cut"),
        F.max(F.when(F.col("__p") == 1, F.col("gain"))).alias("g1"),
        F.coalesce(F.max(F.when(F.col("__p") == 2, F.col("gain"))), F.lit(0.0)).alias("g2"),
    )
    if o.task == "classification":
        classes = stats.filter("f = -1").groupBy(*node).agg(F.count_distinct("cls").alias("__k"))
        top = top.join(classes, node)
        span = F.log2(F.greatest(F.col("__k"), F.lit(2)))
        margin = F.col("g1") - F.col("g2")
    else:
        span, margin = F.lit(1.0), 1 - F.col("g2") / F.col("g1")
    bound = F.sqrt(span * span * F.lit(math.log(1 / o.split_delta)) / (2 * F.col("n")))
    ready = (F.col("n") >= o.grace_rows) & (F.col("g1") > 0) & ((margin > bound) | (bound < o.tie))
    # node numbers stay below 2**61
    return top.filter(ready & (F.col("node") < (1 << 60))).select(*node, "feature", "cut")


def apply_splits(stats: DataFrame, decided: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Statistics after the splits: of a split leaf only the histogram of the split feature stays, as
    the starting mass of the two new leaves. Rows are summed by the next reader."""
    met = stats.join(decided, [*keys, "member", "node"], "left")
    stays = F.col("feature").isNull()
    child = F.col("node") * 2 + F.when(F.col("bin") <= F.col("cut"), 1).otherwise(2)
    return met.filter(stays | (F.col("f") == F.col("feature"))).select(
        *keys,
        "member",
        F.when(stays, F.col("node")).otherwise(child).alias("node"),
        F.when(stays, F.col("f")).otherwise(-1).alias("f"),
        F.when(stays, F.col("bin")).otherwise(0).alias("bin"),
        "cls",
        "w",
        "sy",
        "syy",
    )


def _nodes(stats: DataFrame, splits: DataFrame, keys: Sequence[str], o: TreeOptions) -> DataFrame:
    """One row per node: its split, or a leaf's guess; node -1 holds a member's vote."""
    member = [*keys, "member"]
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("feature", "int"), ("threshold", "double"))]
    known = stats.filter("f < 0").select(*member, "node", "f", "cls", "w", "sy", *nothing)
    inner = splits.select(
        *member,
        "node",
        F.lit(0).alias("f"),
        F.lit(0).alias("cls"),
        *[F.lit(None).cast("double").alias(c) for c in ("w", "sy")],
        "feature",
        "threshold",
    )
    by_class = (
        known.unionByName(inner)
        .repartition(*member, "node")
        .groupBy(*member, "node", "f", "cls")
        .agg(*[F.sum(c).alias(c) for c in ("w", "sy")], *[F.max(c).alias(c) for c in ("feature", "threshold")])
    )
    is_mass = F.col("f") == -1
    if o.task == "classification":
        guess = -F.max(F.when(is_mass, F.struct(F.col("w"), (-F.col("cls").cast("double")).alias("c"))))["c"]
    else:
        guess = F.sum(F.when(is_mass, F.col("sy"))) / F.sum(F.when(is_mass, F.col("w")))
    return by_class.groupBy(*member, "node").agg(
        guess.alias("g"),
        F.max("feature").alias("feature"),
        F.max("threshold").alias("threshold"),
        F.max(F.when(F.col("f") == -2, F.col("sy") / F.col("w"))).alias("vote"),
    )


ROW, CELL, GROUP = 0, 1, 2


def block_rows(n_features: int, o: TreeOptions) -> int:
    """Rows that one call works on: about two million feature values, in whole groups of the detector."""
    return o.detector_grain * max(1, (1 << 21) // max(n_features, 16) // o.detector_grain)


def learn_chunk(rows: DataFrame, nodes: DataFrame, keys: Sequence[str], order: str, o: TreeOptions, n_features: int) -> DataFrame:
    """Predict the rows of a chunk and sum what its trees learn from them, block by block.

    A block of a key's rows meets the nodes of its trees. ``kind`` tells the rows that come out: ``ROW`` a row with prediction
    and error, ``CELL`` a partial sum of a leaf's histogram (or a member's record), ``GROUP`` a full group of errors of a
    member for its detector (-1: the whole run). Rows without ``actual`` are predicted, not learned.
    """
    keys = list(keys)
    size = block_rows(n_features, o)
    placed = rows.withColumn("__block", F.expr(f"(n - 1) div {size}"))
    found = placed.select(*keys, "__block").distinct().withColumn("__h", F.xxhash64(F.lit(o.seed), *keys))
    met = found.join(nodes, keys, "left")
    met = met.select(*[F.col(c).alias(c) for c in met.columns])
    schema = T.StructType(
        [
            T.StructField("kind", T.IntegerType()),
            *[rows.schema[c] for c in (*keys, order, "n", "actual")],
            *[T.StructField(c, T.DoubleType()) for c in ("prediction", "error")],
            T.StructField("member", T.IntegerType()),
            T.StructField("node", T.LongType()),
            *[T.StructField(c, T.IntegerType()) for c in ("f", "bin", "cls")],
            *[T.StructField(c, T.DoubleType()) for c in ("w", "sy", "syy")],
        ]
    )
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    chosen = min(n_features, int(math.sqrt(n_features)) + 1) if o.members > 1 else n_features
    classify = o.task == "classification"

    def run(block: pa.Table, model: pa.Table) -> pa.Table:
        block = block.sort_by("n")
        target = pa.schema([(f.name, block.schema.field(f.name).type if f.name in block.schema.names else ARROW[f.dataType]) for f in schema])
        if not block.num_rows:
            return target.empty_table()
        grown, votes = forest.forest(model, o.members)
        start = model["__h"][:1].to_numpy().view(np.uint64)
        n, x = block["n"].to_numpy(), forest.features_matrix(block["features"], n_features)
        y, labelled = block["actual"].fill_null(0.0).to_numpy(), block["actual"].is_valid().to_numpy()
        at = np.stack([tree.leaves(x) for tree in grown], axis=1)
        guesses = np.stack([tree.guess[at[:, m]] for m, tree in enumerate(grown)], axis=1)
        prediction = forest.majority(guesses, votes) if classify else forest.average(guesses)

        def errors(guess: np.ndarray) -> np.ndarray:
            missed = (guess != y).astype(np.float64) if classify else np.abs(guess - y)
            return np.where(labelled & ~np.isnan(guess), missed, np.nan)

        def table(kind: int, **columns: np.ndarray | pa.ChunkedArray) -> pa.Table:
            rows_ = len(next(iter(columns.values())))
            columns |= {"kind": np.full(rows_, kind)} | {k: pa.repeat(block[k][0], rows_) for k in keys}
            arrays = [
                pa.nulls(rows_, f.type) if f.name not in columns
                else columns[f.name] if isinstance(columns[f.name], (pa.Array, pa.ChunkedArray))
                else pa.array(columns[f.name], type=f.type, from_pandas=True)
                for f in target
            ]
            return pa.table(arrays, schema=target)

        error = errors(prediction)
        out = [table(ROW, prediction=prediction, error=error, **{c: block[c] for c in (order, "n", "actual")})]
        if o.detect:
            g = forest.grain_groups(n, error, o.detector_grain)
            out.append(table(GROUP, member=np.full(len(g["n"]), -1), **g))
        learned = np.flatnonzero(labelled)
        for m, tree in enumerate(grown):
            member = np.full(1, m)
            if o.members > 1:
                missed = errors(guesses[:, m])
                known = ~np.isnan(missed)
                if o.detect:
                    g = forest.grain_groups(n, missed, o.detector_grain)
                    out.append(table(GROUP, member=np.repeat(member, len(g["n"])), **g))
                if known.any():
                    right = np.sum(missed[known] == 0) if classify else known.sum()
                    record = {"node": -1, "f": -2, "bin": 0, "cls": 0, "w": float(known.sum()), "sy": float(right), "syy": 0.0}
                    out.append(table(CELL, member=member, **{c: np.array([v]) for c, v in record.items()}))
                w = forest.poisson_weights(o.poisson_mean, forest.hash_int(member, forest.hash_long(n, start)))
                used = learned[w[learned] > 0]
            else:
                w, used = np.ones(len(n)), learned
            subsets = forest.feature_subsets(n_features, chosen, forest.hash_long(tree.node, forest.hash_int(member, start)))
            cls = y[used].astype(np.int32) if classify else np.zeros(len(used), dtype=np.int32)
            for cells in forest.histograms(tree, at[used, m], x[used], y[used], w[used], subsets, o.bins, cls):
                out.append(table(CELL, member=np.repeat(member, len(cells["w"])), **cells))
        return pa.concat_tables(out)

    return placed.groupBy(*keys, "__block").cogroup(met.groupBy(*keys, "__block")).applyInArrow(run, schema)


def _detect(groups: DataFrame, state: DataFrame | None, keys: Sequence[str], o: TreeOptions) -> DataFrame:
    """First alarm of the chunk (or null) and detector state per key and member; member -1 is the whole run.

    A member's groups of a chunk are few (its rows by the detector's grain), and one call feeds them in order. Runs without a
    full group in this chunk keep their state.
    """
    member = [*keys, "member"]
    groups = groups.select(*member, "n", F.col("sy").alias("total"), F.col("syy").alias("m2"))
    schema = T.StructType(
        [*[groups.schema[c] for c in member], T.StructField("state", T.StringType()), T.StructField("drift_n", T.LongType())]
    )

    def feed(fed: pa.Table, saved: pa.Table | None) -> pa.Table:
        known = saved is not None and saved.num_rows > 0
        source = fed if fed.num_rows else saved
        gated = source["member"][0].as_py() < 0
        detector = Adwin(o.detector_delta, grain=o.detector_grain)
        gate = Gate(o.cooldown) if gated else Gate(0, 0)
        if known:
            last = json.loads(saved["state"][0].as_py())
            detector.from_state(last["detector"])
            gate.last = last["last"]
        first = None
        fed = fed.sort_by("n")
        for n, total, m2 in zip(*(fed[c].to_pylist() for c in ("n", "total", "m2"))):
            if detector.update(total, m2) and gate.accepts(n):
                detector = Adwin(o.detector_delta, grain=o.detector_grain)
                first = n if first is None else first
        values = [pa.array([json.dumps({"detector": detector.to_state(), "last": gate.last})]), pa.array([first], pa.int64())]
        return pa.table([*[source[c].slice(0, 1) for c in member], *values], names=schema.names)

    if state is None:
        return groups.groupBy(*member).applyInArrow(lambda fed: feed(fed, None), schema)
    saved = state.select(*member, "state")
    return groups.groupBy(*member).cogroup(saved.groupBy(*member)).applyInArrow(feed, schema)


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, and no tasks for them."""
    return spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema]).filter(F.lit(False))


def _flagged(rows: DataFrame, drifts: DataFrame, ends: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``drift`` and ``segment``, the number of drifts up to the row, by a look-up in the block of its position ``n``.

    A run has one drift per chunk at most, so the blocks of all runs (to the last position ``last``) with the drifts in and before them
    are a small table, and the rows need no window.
    """
    block = F.expr(f"(n - 1) div {block_rows_of(rows)}")
    found = drifts.groupBy(*keys, block.alias(BLOCK)).agg(F.collect_list("n").alias("__own"))
    blocks = ends.select(*keys, F.explode(F.expr(f"sequence(0L, (last - 1) div {block_rows_of(rows)})")).alias(BLOCK))
    blocks = blocks.join(found, [*keys, BLOCK], "left")
    blocks = blocks.withColumn("__own", F.coalesce("__own", F.array().cast("array<bigint>")))
    earlier = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("__before", F.coalesce(F.sum(F.size("__own")).over(earlier), F.lit(0)).cast("long"))
    met = rows.withColumn(BLOCK, block).join(blocks, [*keys, BLOCK])
    upto = F.when(F.size("__own") > 0, F.size(F.filter("__own", lambda d: d <= F.col("n")))).otherwise(0)
    flags = {"drift": F.array_contains("__own", F.col("n")), "segment": F.col("__before") + upto}
    return met.withColumns(flags).select(*rows.columns, "drift", "segment")


def prequential_trees(
    instances: DataFrame,
    keys: Sequence[str],
    n_features: int,
    o: TreeOptions = TreeOptions(),
    order: str = "instance_id",
    position: str | None = None,
) -> DataFrame:
    """Predictions, errors, drift flags and segments of one tree (or forest) per key.

    ``instances``: keys, ``order``, ``features`` (array in [0, 1]), ``actual``. A drift is flagged on the
    last row of the group that raised it; the trees start anew with the next chunk. ``position`` names a column that
    numbers the rows of a key from 1 in ``order`` (``normalize_stream`` has it); without, a scan more numbers them.
    """
    keys = list(keys)
    spark = instances.sparkSession
    columns = [*keys, order, "features", F.col("actual").cast("double").alias("actual")]
    if position:
        numbered = instances.select(*columns, F.col(position).cast("long").alias("n"))
    else:
        # read twice, for block totals and for the rows: what the instances are made of is worked once
        rows = materialize(instances.select(*columns), "tree-instances")
        numbered = prefix_scan(rows, keys, order, {"n": Scan("count", F.lit(True))})
    base = scratch_path(spark, "trees")
    numbered.withColumn("chunk", chunk_of(F.col("n"), o.first_rows, o.most_rows)).write.partitionBy("chunk").parquet(f"{base}/rows")
    placed = spark.read.schema(numbered.schema).parquet(f"{base}/rows")
    ends = materialize(placed.groupBy(*keys).agg(F.max("n").alias("last")), "tree-ends")
    longest = ends.agg(F.max("last")).first()[0] or 0
    placed = placed.select(numbered.columns)
    member = [*keys, "member"]
    fields = [placed.schema[k] for k in keys] + [
        T.StructField("member", T.IntegerType()),
        T.StructField("node", T.LongType()),
    ]
    splits = _empty(
        spark, T.StructType([*fields, T.StructField("feature", T.IntegerType()), T.StructField("threshold", T.DoubleType())])
    )
    stats = _empty(
        spark,
        T.StructType(
            [
                *fields,
                *[T.StructField(c, T.IntegerType()) for c in ("f", "bin", "cls")],
                *[T.StructField(c, T.DoubleType()) for c in ("w", "sy", "syy")],
            ]
        ),
    )
    state, drifts, cell = None, None, [*member, "node", "f", "bin", "cls"]
    count = chunk_count(longest, o.first_rows, o.most_rows)
    for chunk in range(count):
        part = spark.read.schema(placed.schema).parquet(f"{base}/rows/chunk={chunk}")
        scored = learn_chunk(part, _nodes(stats, splits, keys, o), keys, order, o, n_features)
        scored.write.partitionBy("kind").parquet(f"{base}/scored/chunk={chunk}")
        if chunk + 1 == count and not o.detect:
            break
        scored = spark.read.schema(scored.schema).parquet(f"{base}/scored/chunk={chunk}")
        merged = (
            stats.unionByName(scored.filter(F.col("kind") == CELL).select(stats.columns))
            .groupBy(*cell)
            .agg(*[F.sum(c).alias(c) for c in ("w", "sy", "syy")])
        )
        stats = materialize(merged, "tree-stats")
        decided = materialize(decide_splits(stats, keys, o), "tree-splits")
        # most chunks split something and replace nothing: each join left out is some jobs less in the next chunk
        grown = not decided.isEmpty()
        if grown:
            stats = apply_splits(stats, decided, keys)
            splits = splits.unionByName(
                decided.select(*member, "node", "feature", ((F.col("cut") + 1) / o.bins).alias("threshold"))
            )
        replaced = False
        if o.detect:
            state = materialize(_detect(scored.filter(F.col("kind") == GROUP), state, keys, o), "tree-detector")
            gone = state.filter("drift_n is not null")
            replaced = not gone.isEmpty()
        if replaced:
            found = gone.filter("member = -1").select(*keys, F.col("drift_n").alias("n"))
            drifts = found if drifts is None else drifts.unionByName(found)
            reset = gone.filter("member = -1").select(*keys, F.explode(F.sequence(F.lit(0), F.lit(o.members - 1))).alias("member"))
            reset = reset.unionByName(gone.filter("member >= 0").select(*member)).distinct()
            stats = stats.join(reset, member, "left_anti")
            splits = splits.join(reset, member, "left_anti")
        if grown or replaced:
            # else each chunk's plan holds those of all chunks before
            splits = materialize(splits, "tree-nodes")
    scored_schema = T.StructType(
        [*placed.schema.fields, T.StructField("prediction", T.DoubleType()), T.StructField("error", T.DoubleType())]
    )
    plain = [*keys, order, "actual", "prediction", "error"]
    if not count:
        empty = _empty(spark, scored_schema).select(*plain)
        return empty.withColumns({"drift": F.lit(False), "segment": F.lit(0).cast("long")})
    out = spark.read.schema(scored_schema).parquet(*[f"{base}/scored/chunk={c}/kind={ROW}" for c in range(count)])
    if drifts is None:
        return out.select(*plain).withColumns({"drift": F.lit(False), "segment": F.lit(0).cast("long")})
    return _flagged(out.select(*plain, "n"), drifts, ends, keys).drop("n")

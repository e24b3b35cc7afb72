"""Linear learners in parallel inside one stream, chunk-synchronous.

Within a chunk the weights stay fixed: its rows are predicted with them (test-then-train at chunk
grain) and their update steps are summed by one map-side aggregate, to be applied before the next
chunk. With one row per chunk this is the row-by-row learner. Chunks double in size, so a single huge
stream costs a number of parallel passes over its parts that grows with the logarithm of its length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.learners import HINGE, PASSIVE_AGGRESSIVE, PERCEPTRON, SQUARED
from tidemark.plans.blocked import Scan, prefix_scan
from tidemark.plans.chunks import chunk_count, chunk_of
from tidemark.session import materialize, scratch_path

SALTS = 64
FIRST_ROWS = 1000
MOST_ROWS = 4_000_000


def step_size(loss: str, score: Column, y: Column, squared_norm: Column, eta: float, c: float = 1.0) -> Column:
    """Factor by which a row's features (and the intercept's 1) enter the weights."""
    if loss == SQUARED:
        return -eta * (score - y)
    declared = F.when(y.isin(0, 1), y).otherwise(F.raise_error(F.lit("labels must be 0 and 1 in the chunked form")))
    sign = F.when(declared > 0.5, 1.0).otherwise(-1.0)
    margin = sign * score
    if loss == HINGE:
        return F.when(margin < 1, eta * sign).otherwise(0.0)
    if loss == PERCEPTRON:
        return F.when(margin <= 0, eta * sign).otherwise(0.0)
    if loss == PASSIVE_AGGRESSIVE:
        return sign * F.least(F.lit(c), F.greatest(F.lit(0.0), 1 - margin) / squared_norm)
    raise ValueError(f"unknown loss {loss!r}")


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def chunked_linear(
    instances: DataFrame,
    keys: Sequence[str],
    loss: str,
    order: str = "instance_id",
    eta: float = 0.01,
    c: float = 1.0,
    first_rows: int = FIRST_ROWS,
    most_rows: int = MOST_ROWS,
    mean_step: bool = True,
) -> DataFrame:
    """Predictions of the chunk-synchronous learner (no prediction in a key's first ``first_rows`` rows).

    The chunks (``plans.chunks``) depend on the row position only: a longer stream, or other streams beside,
    never change earlier predictions.

    ``mean_step`` divides a chunk's summed step by its rows, which keeps large chunks stable.
    """
    keys = list(keys)
    spark = instances.sparkSession
    rows = instances.select(
        *keys, order, F.concat("features", F.array(F.lit(1.0))).alias("z"), F.col("actual").cast("double").alias("actual")
    )
    placed = materialize(prefix_scan(rows, keys, order, {"n": Scan("count", F.lit(True))}), "linear-rows")
    longest = placed.agg(F.max("n")).first()[0] or 0
    base = scratch_path(spark, "linear")
    placed.withColumn("chunk", chunk_of(F.col("n"), first_rows, most_rows)).write.partitionBy("chunk").parquet(f"{base}/rows")
    weights = spark.createDataFrame(
        [], T.StructType([*[placed.schema[k] for k in keys], T.StructField("w", T.ArrayType(T.DoubleType()))])
    )
    out_schema = None
    count = chunk_count(longest, first_rows, most_rows)
    for chunk in range(count):
        part = spark.read.schema(placed.schema).parquet(f"{base}/rows/chunk={chunk}")
        # one weight row per key, copied to every salt: a large stream meets it on many partitions
        salted = weights.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = part.withColumn("__salt", F.pmod("n", F.lit(SALTS)).cast("int")).join(salted, [*keys, "__salt"], "left")
        scored = met.withColumn("score", F.when(F.col("w").isNotNull(), _dot(F.col("w"), F.col("z")))).drop("__salt", "w")
        scored.write.parquet(f"{base}/scored/chunk={chunk}")
        out_schema = scored.schema
        if chunk + 1 == count:
            break
        done = spark.read.schema(out_schema).parquet(f"{base}/scored/chunk={chunk}")
        step = step_size(loss, F.coalesce("score", F.lit(0.0)), F.col("actual"), _dot(F.col("z"), F.col("z")), eta, c)
        moved = (
            done.select(*keys, step.alias("step"), F.posexplode("z").alias("f", "x"))
            .groupBy(*keys, "f")
            .agg(F.sum(F.col("step") * F.col("x")).alias("d"), F.count(F.lit(1)).alias("rows"))
        )
        delta = F.col("d") / F.col("rows") if mean_step else F.col("d")
        before = weights.select(*keys, F.posexplode("w").alias("f", "v"))
        after = before.unionByName(moved.select(*keys, "f", delta.alias("v"))).groupBy(*keys, "f").agg(F.sum("v").alias("v"))
        # one element per feature
        packed = after.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("f", "v"))).alias("p"))
        weights = materialize(packed.select(*keys, F.col("p.v").alias("w")), "linear-weights")
    if not count:
        empty = T.StructType([*placed.schema.fields, T.StructField("score", T.DoubleType())])
        out = spark.createDataFrame([], empty)
    else:
        out = spark.read.schema(out_schema).parquet(*[f"{base}/scored/chunk={i}" for i in range(count)])
    shown = F.col("score") if loss == SQUARED else F.when(F.col("score").isNotNull(), (F.col("score") > 0).cast("double"))
    return out.select(*keys, order, shown.alias("prediction"), "actual")

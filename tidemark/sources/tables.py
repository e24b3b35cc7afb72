"""Instance, prediction and feature tables derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.metrics import absolute_error, zero_one_error
from tidemark.plans.blocked import Scan, prefix_scan
from tidemark.session import size_shuffles

KEYS = ["dataset", "task", "model"]
AMOUNT = "decimal(12,2)"


_rows: dict[tuple[str, str], int] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; the shuffles that follow are sized by its rows, which the files' footers tell."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    path = f"{sf_dir}/{name}.parquet"
    df = spark.read.parquet(path)
    key = (spark.sparkContext.applicationId, path)
    if key not in _rows:
        _rows[key] = df.count()
    size_shuffles(spark, _rows[key])
    return df


def _event_features() -> Column:
    k = F.get_json_object("props", "$.k").cast("double")
    return F.array(k / 100.0, F.hour("ts") / 24.0)


def instances_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a regression stream: the value is the target."""
    return table(spark, sf_dir, "events").select(
        F.lit("events").alias("dataset"),
        F.lit("regression").alias("task"),
        (F.col("event_id") + 1).alias("instance_id"),
        _event_features().alias("features"),
        F.col("value").alias("target"),
        "user_id",
    )


def instances_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a classification stream: is the value above 50?"""
    return table(spark, sf_dir, "events").select(
        F.lit("events").alias("dataset"),
        F.lit("classification").alias("task"),
        (F.col("event_id") + 1).alias("instance_id"),
        _event_features().alias("features"),
        (F.col("value") > 50).cast("int").alias("label"),
        "user_id",
    )


def instances_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a second, larger regression stream, in whole currency units."""
    return table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("dataset"),
        F.lit("regression").alias("task"),
        (F.col("o_orderkey") + 1).alias("instance_id"),
        F.round("o_totalprice").alias("target"),
    )


def _previous(df: DataFrame, keys: list[str], value: Column, model: str) -> DataFrame:
    scanned = prefix_scan(df, keys, "instance_id", {"prediction": Scan("last", value, exclusive=True)})
    return scanned.withColumn("model", F.lit(model))


def predictions(spark: SparkSession, sf_dir: str, drift_every: int = 2500) -> DataFrame:
    """Persistence forecasts (previous target; previous target of the same user) with known drifts.

    The first row of a stream has no prediction, so the null path is always exercised. Amounts are
    decimals, so sums of errors are exact however the rows are partitioned.
    """
    reg = instances_regression(spark, sf_dir).drop("features").withColumn("actual", F.col("target").cast(AMOUNT))
    cls = instances_classification(spark, sf_dir).drop("features").withColumn("actual", F.col("label").cast(AMOUNT))
    orders = instances_orders(spark, sf_dir).withColumn("actual", F.col("target").cast(AMOUNT))
    columns = [*KEYS, "instance_id", "prediction", "actual"]
    out = None
    for part in (
        _previous(reg, ["dataset", "task"], F.col("actual"), "last"),
        _previous(reg, ["dataset", "task", "user_id"], F.col("actual"), "last_user"),
        _previous(cls, ["dataset", "task"], F.col("actual"), "last"),
        _previous(cls, ["dataset", "task", "user_id"], F.col("actual"), "last_user"),
        _previous(orders, ["dataset", "task"], F.col("actual"), "last"),
    ):
        part = part.select(*columns)
        out = part if out is None else out.unionByName(part)
    miss = F.when(F.col("task") == "classification", zero_one_error(F.col("prediction"), F.col("actual")))
    return out.withColumns(
        {
            "error": F.coalesce(miss, absolute_error(F.col("prediction"), F.col("actual"))).cast(AMOUNT),
            "drift": F.col("prediction").isNotNull() & (F.col("instance_id") % drift_every == 0),
        }
    )


def feature_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as a classification stream with 64 features."""
    return table(spark, sf_dir, "embeddings").select(
        F.lit("embeddings").alias("dataset"),
        F.lit("classification").alias("task"),
        (F.col("vec_id") + 1).alias("instance_id"),
        F.col("embedding").cast("array<double>").alias("features"),
        "label",
    )

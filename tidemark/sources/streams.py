"""Instance streams: message format, stream readers and writers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

MESSAGE = T.StructType(
    [
        T.StructField("instance_id", T.LongType()),
        T.StructField("features", T.ArrayType(T.DoubleType())),
        T.StructField("label", T.IntegerType()),
        T.StructField("target", T.DoubleType()),
        T.StructField("dataset", T.StringType()),
        T.StructField("task", T.StringType()),
        T.StructField("drift_injected", T.BooleanType()),
    ]
)
TOY_MESSAGE = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])


def encode(df: DataFrame) -> DataFrame:
    """One JSON message per row; absent fields are left out."""
    fields = [f.name for f in MESSAGE.fields if f.name in df.columns]
    return df.select(F.to_json(F.struct(*fields)).alias("value"))


def decode(df: DataFrame, schema: T.StructType = MESSAGE, value: str = "value") -> DataFrame:
    parsed = F.from_json(F.col(value).cast("string"), schema, {"allowNonNumericNumbers": "true"})
    return df.select(parsed.alias("m")).select("m.*")


def actual() -> Column:
    """Label or target, whichever the task has."""
    return F.coalesce(F.col("label").cast("double"), F.col("target"))


def toy_instances(df: DataFrame, order: str) -> DataFrame:
    """``x``, ``y`` pairs as regression instances with one feature."""
    return df.select(F.col(order).alias("instance_id"), F.array("x").alias("features"), F.col("y").alias("actual"))


def kafka_options(topic: str, servers: str, starting: str = "latest", max_per_trigger: int | None = None) -> dict[str, str]:
    options = {"subscribe": topic, "kafka.bootstrap.servers": servers, "startingOffsets": starting}
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def kafka_sink_options(topic: str, servers: str) -> dict[str, str]:
    return {"topic": topic, "kafka.bootstrap.servers": servers, "kafka.acks": "all", "kafka.retries": "3"}


def read_topic(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Messages of a topic. Offsets live in the query's checkpoint."""
    return decode(spark.readStream.format("kafka").options(**options).load())


def read_files(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "json", files_per_trigger: int | None = None, **options: str
) -> DataFrame:
    """The same stream from a folder that files are added to."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def cap(df: DataFrame, max_instances: int | None, order: str = "instance_id") -> DataFrame:
    """Only the first ``max_instances`` of each stream, by id."""
    return df if max_instances is None else df.filter(F.col(order) <= max_instances)


def select_datasets(df: DataFrame, dataset: str = "both") -> DataFrame:
    return df if dataset == "both" else df.filter(F.col("dataset") == dataset)


def publish(df: DataFrame, options: Mapping[str, str]) -> DataStreamWriter:
    return encode(df).writeStream.format("kafka").options(**options)

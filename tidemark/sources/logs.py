"""Metric logs (CSV) and run summaries (JSON): writers and tolerant readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import MISSING, run_file_name, run_of_path
from tidemark.operators.compare import METRICS

# Columns of the two log formats, in file order.
LOG_COLUMNS = {
    "classification": ("cumulative_accuracy", "window_accuracy"),
    "regression": ("cumulative_mae", "cumulative_mse", "window_mae"),
}
CORRUPT = "_corrupt_record"
EVENT = T.StructType(
    [
        T.StructField("instance_id", T.LongType()),
        T.StructField("detector", T.StringType()),
        T.StructField("timestamp", T.StringType()),
    ]
)
SUMMARY = T.StructType(
    [
        T.StructField("total_instances", T.LongType()),
        T.StructField("drift_events", T.LongType()),
        T.StructField("drift_details", T.ArrayType(EVENT)),
        *[T.StructField(m, T.DoubleType()) for m in METRICS],
    ]
)


def write_metric_logs(log: DataFrame, root: str) -> None:
    """One CSV folder per run, named after it; missing values as N/A."""
    for task, columns in LOG_COLUMNS.items():
        rows = log.filter(F.col("task") == task).select(
            run_file_name(F.col("dataset"), F.col("task"), F.col("model"), "_metrics.csv").alias("run"),
            "instance",
            *columns,
        )
        rows.write.mode("append").option("header", True).option("nullValue", MISSING).partitionBy("run").csv(root)


def write_run_summaries(summary: DataFrame, root: str) -> None:
    """One JSON object per run."""
    named = summary.withColumn(
        "run", run_file_name(F.col("dataset"), F.col("task"), F.col("model"), "_metrics_results.json")
    )
    kept = [c for c in summary.columns if c not in ("dataset", "task", "model")]
    # the reader takes one object per file
    one = named.repartition("run").sortWithinPartitions("run").select("run", *kept)
    one.write.option("maxRecordsPerFile", 1).mode("append").partitionBy("run").json(root)


def write_drift_events(events: DataFrame, root: str) -> None:
    """One JSON folder per run with one object per drift, as ``metrics.drift_events`` gives them: a list of any length."""
    named = run_file_name(F.col("dataset"), F.col("task"), F.col("model"), "_drift_events_results.json")
    rows = events.select(named.alias("run"), "instance_id", "detector", "timestamp")
    rows.write.mode("append").partitionBy("run").json(f"{root}/drift_events")


def read_drift_events(spark: SparkSession, root: str) -> DataFrame:
    """All drift events written beside the summaries: dataset, task, model, instance_id, detector, timestamp, file."""
    read = _with_run(spark.read.schema(EVENT).json(f"{root}/drift_events/*_drift_events_results.json"))
    model = F.regexp_replace("model", "_drift_events$", "")
    at = F.to_timestamp("timestamp").alias("timestamp")
    return read.select("dataset", "task", model.alias("model"), "instance_id", "detector", at, "file")


def _with_run(df: DataFrame) -> DataFrame:
    path = F.col("_metadata.file_path")
    return df.select("*", path.alias("file")).withColumns(run_of_path(F.col("file")))


def read_metric_logs(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """All logs below ``root`` as one table, and the lines that could not be read.

    Files are read per task with that task's columns; columns of the other task are null.
    """
    good, rejects = None, None
    for task, columns in LOG_COLUMNS.items():
        schema = T.StructType(
            [
                T.StructField("instance", T.LongType()),
                *[T.StructField(c, T.DoubleType()) for c in columns],
                T.StructField(CORRUPT, T.StringType()),
            ]
        )
        lines = _with_run(
            spark.read.schema(schema)
            .option("header", True)
            .option("nullValue", MISSING)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("ignoreCorruptFiles", True)
            .option("pathGlobFilter", "*.csv")
            # a bad cell must reject the line whichever columns a query reads
            .option("columnPruning", False)
            .csv(f"{root}/*_{task}_*_metrics.csv")
        )
        # a model may be named like the other task
        lines = lines.filter(F.col("task") == task)
        # Spark refuses queries on the corrupt column alone, so the test also reads a data column
        parsed = F.coalesce(F.col("instance"), F.lit(0)) >= F.lit(-(1 << 62))
        read = lines.filter(F.col(CORRUPT).isNull() & parsed).drop(CORRUPT)
        bad = lines.filter(F.col(CORRUPT).isNotNull() & parsed).select("file", CORRUPT)
        good = read if good is None else good.unionByName(read, allowMissingColumns=True)
        rejects = bad if rejects is None else rejects.unionByName(bad)
    return good, rejects


def unread_files(spark: SparkSession, root: str) -> DataFrame:
    """Files below ``root`` that neither reader takes: ``file``. Only names are listed, no content is read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    known = "_(classification|regression)_[^/]*_metrics\\.csv(/|$)|_results\\.json(/|$)"
    return listed.select(F.col("path").alias("file")).filter(~F.col("file").rlike(known))


def _read_summaries(spark: SparkSession, root: str) -> DataFrame:
    schema = T.StructType([*SUMMARY.fields, T.StructField(CORRUPT, T.StringType())])
    read = _with_run(
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(f"{root}/*_results.json")
    )
    # Spark refuses queries on the corrupt column alone, so the test also reads a data column
    return read.filter(F.coalesce(F.col("total_instances"), F.lit(0)) >= F.lit(-(1 << 62)))


def read_run_summaries(spark: SparkSession, root: str) -> DataFrame:
    """Summaries below ``root``, one row per run; ``rejected_summaries`` has the files that are no JSON."""
    return _read_summaries(spark, root).filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejected_summaries(spark: SparkSession, root: str) -> DataFrame:
    """Files that should hold a summary but are no JSON, with their text."""
    return _read_summaries(spark, root).filter(F.col(CORRUPT).isNotNull()).select("file", CORRUPT)


def drift_details(summaries: DataFrame) -> DataFrame:
    """The nested event lists as flat drift events; ``read_drift_events`` has those stored as a table of their own."""
    return summaries.select("dataset", "task", "model", "file", F.explode("drift_details").alias("d")).select(
        "dataset", "task", "model", "d.instance_id", "d.detector", F.to_timestamp("d.timestamp").alias("timestamp"), "file"
    )


EXPERIMENT = (
    "dataset string, task string, model string, user_id long, drift_detection boolean, "
    "results struct<total_instances: long, drift_events: long, cumulative_accuracy: double, window_accuracy: double, "
    "cumulative_mae: double, cumulative_mse: double, window_mae: double, window_mse: double>, timestamp string"
)
COMPARED = (
    "dataset string, task string, model string, runs long, total_instances long, drift_events long, "
    "cumulative_accuracy double, cumulative_mae double"
)


def write_experiment_records(summary: DataFrame, path: str, detection: bool) -> None:
    """One JSON record per run: its request, its results and the time."""
    results = F.struct("total_instances", "drift_events", *METRICS)
    summary.select(
        "dataset",
        "task",
        "model",
        "user_id",
        F.lit(detection).alias("drift_detection"),
        results.alias("results"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
    ).write.json(path)


def read_experiment_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EXPERIMENT).json(path)


def write_comparison(records: DataFrame, path: str) -> None:
    """CSV with one line per (dataset, task, model): its streams together, means weighted by their instances."""
    def mean(name: str):
        value = F.col(f"results.{name}")
        counted = F.when(value.isNotNull(), F.col("results.total_instances"))
        return F.round(F.sum(value * counted) / F.sum(counted), 9).alias(name)

    records.groupBy("dataset", "task", "model").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("results.total_instances").alias("total_instances"),
        F.sum("results.drift_events").alias("drift_events"),
        mean("cumulative_accuracy"),
        mean("cumulative_mae"),
    ).write.option("header", True).option("nullValue", MISSING).csv(path)


def read_comparison(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COMPARED).option("header", True).option("nullValue", MISSING).csv(path)

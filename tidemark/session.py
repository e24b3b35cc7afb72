"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Input rows behind one shuffle partition, and the bytes that adaptive execution may join into one or a scan reads at once.
SHUFFLE_ROWS = 50_000
TASK_BYTES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m", "spark.sql.files.maxPartitionBytes": "16m"}
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.tidemark.localRoot", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.tidemark.localRoot", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier call returned."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def size_shuffles(spark: SparkSession, rows: int) -> None:
    """Let the number of tasks grow with an input of ``rows`` rows, so that what one task sorts does not.

    By default adaptive execution joins a shuffle into about one partition per core, up to 64 MB of it packed, which are
    gigabytes of rows once a window sorts them. Settings are only ever tightened. Writers keep a file open for each of a few runs, without sorting.
    """
    wanted = -(-rows // SHUFFLE_ROWS)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    for name, most in TASK_BYTES.items():
        if _bytes(spark.conf.get(name)) > _bytes(most):
            spark.conf.set(name, most)
    if int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) <= 0:
        spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "64")


def _bytes(size: str) -> int:
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back.

    Cuts lineage in storage that outlives any executor, and gives the planner the real size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""Sizes of shuffles and scans."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.session import SHUFFLE_ROWS, size_shuffles
from tidemark.sources.tables import table

NAMES = (
    "spark.sql.shuffle.partitions",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes",
    "spark.sql.files.maxPartitionBytes",
    "spark.sql.maxConcurrentOutputFileWriters",
)


def test_tasks_grow_with_the_rows(spark):
    before = {n: spark.conf.get(n) for n in NAMES}
    try:
        size_shuffles(spark, 10)
        assert spark.conf.get(NAMES[0]) == before[NAMES[0]]
        size_shuffles(spark, 40 * SHUFFLE_ROWS)
        assert int(spark.conf.get(NAMES[0])) == 40
        rows = spark.range(40 * SHUFFLE_ROWS).select(F.col("id"), (F.col("id") % 4096).alias("blk"))
        ranked = rows.withColumn("n", F.row_number().over(Window.partitionBy("blk").orderBy("id")))
        # joined by adaptive execution, but to no more than a few megabytes of rows
        tasks = ranked.select("n", F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        assert max(r["count"] for r in tasks) <= 8 * SHUFFLE_ROWS
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def test_settings_are_only_tightened(spark):
    before = {n: spark.conf.get(n) for n in NAMES}
    try:
        for n, v in zip(NAMES, ("77", "1000k", "2MB", "3")):
            spark.conf.set(n, v)
        size_shuffles(spark, 10)
        assert [spark.conf.get(n) for n in NAMES] == ["77", "1000k", "2MB", "3"]
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def test_a_table_sizes_the_shuffles(spark, tmp_path):
    before = {n: spark.conf.get(n) for n in NAMES}
    try:
        spark.range(9 * SHUFFLE_ROWS).write.parquet(f"{tmp_path}/events.parquet")
        table(spark, str(tmp_path), "events")
        assert int(spark.conf.get(NAMES[0])) == 9
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)

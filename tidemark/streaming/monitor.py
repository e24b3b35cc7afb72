"""Live streams: progress as a table, interval triggers, an end after an idle time, and refreshed views of the log.

A listener keeps the progress of every micro-batch and writes it, a bounded number of rows at a time, to a parquet
table; the rate and the totals of the running streams are queries on that table. A live run uses a
processing-time trigger and ends once no row has come for a while.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.operators.compare import processing_rate
from tidemark.plans.blocked import Scan, prefix_scan

PROGRESS = "query string, run string, batch long, at timestamp, num_rows long, rows_per_second double, batch_ms long"
FLUSH_ROWS = 1000
IDLE_SECONDS = 30.0


class ProgressTable(StreamingQueryListener):
    """Appends one row per micro-batch to the parquet table at ``path``.

    Rows wait in memory until ``flush_rows`` are there, a query ends, or ``flush`` is called.
    """

    def __init__(self, spark: SparkSession, path: str, flush_rows: int = FLUSH_ROWS):
        self.spark, self.path, self.flush_rows = spark, path, flush_rows
        self.held: list[tuple] = []
        self.lock = threading.Lock()
        self.ended = threading.Event()

    def onQueryStarted(self, event: Any) -> None:
        self.ended.clear()

    def onQueryProgress(self, event: Any) -> None:
        p = event.progress
        row = (p.name or str(p.id), str(p.runId), p.batchId, p.timestamp, p.numInputRows, p.processedRowsPerSecond, p.batchDuration)
        with self.lock:
            self.held.append(row)
            full = len(self.held) >= self.flush_rows
        if full:
            self.flush()

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        self.ended.set()

    def flush(self) -> None:
        with self.lock:
            rows, self.held = self.held, []
        if rows:
            frame = self.spark.createDataFrame(rows, PROGRESS.replace("at timestamp", "at string"))
            frame = frame.withColumn("at", F.to_timestamp("at"))
            frame.coalesce(1).write.mode("append").parquet(self.path)

    def table(self) -> DataFrame:
        """All progress so far."""
        self.flush()
        return self.spark.read.schema(PROGRESS).parquet(self.path)


def progress_snapshots(progress: DataFrame) -> DataFrame:
    """(query, at, instances): the rows each query has read so far, once per micro-batch; a restarted run goes on counting."""
    batches = progress.groupBy("query", "batch").agg(F.max("at").alias("at"), F.max("num_rows").alias("num_rows"))
    counted = prefix_scan(batches, ["query"], "batch", {"instances": Scan("sum", F.col("num_rows"))})
    return counted.select("query", "at", "instances")


def live_rate(progress: DataFrame) -> DataFrame:
    """One row per query: instances so far and the rate between its two latest micro-batches."""
    rates = processing_rate(progress_snapshots(progress), ["query"])
    return rates.groupBy("query").agg(F.max("instances").alias("instances"), F.max_by("rate", "at").alias("rate"), F.max("at").alias("at"))


def run_until_idle(
    df: DataFrame,
    path: str,
    checkpoint: str,
    interval: str = "5 seconds",
    idle_seconds: float = IDLE_SECONDS,
    partition_by: Sequence[str] = (),
    name: str | None = None,
    poll_seconds: float = 0.5,
    refresh: Callable[[StreamingQuery], None] | None = None,
) -> None:
    """Append the stream ``df`` to a parquet table, a micro-batch per ``interval``, until no row has come for ``idle_seconds``.

    The idle time counts from the end of the last micro-batch with rows (or from the start); a micro-batch under way is
    never cut. ``refresh`` is called at every poll, e.g. to query the table anew. A failed stream raises here.
    """
    writer = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    query = writer.trigger(processingTime=interval).start(path)
    seen, since = -1, time.monotonic()
    try:
        while not query.awaitTermination(poll_seconds):
            status = query.status
            busy = status["isTriggerActive"] and status["isDataAvailable"]  # empty triggers come and go all the time
            filled = [p.batchId for p in query.recentProgress if p.numInputRows]
            if busy or (filled and filled[-1] != seen):
                seen, since = filled[-1] if filled else seen, time.monotonic()
            if refresh:
                refresh(query)
            if time.monotonic() - since >= idle_seconds:
                return
    finally:
        query.stop()

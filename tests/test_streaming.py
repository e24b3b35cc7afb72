"""Streaming run: equal to the batch run, across restarts and repeated files."""

from pyspark.sql import functions as F

from tidemark.operators import metrics
from tidemark.operators.prequential import Detection, prequential
from tidemark.sources import streams
from tidemark.streaming.prequential import Sequencer, drain, stream_metrics, upsert_batches, waiting_metrics

KEYS = ["dataset", "task", "model"]


def instances(spark, sf):
    return spark.read.parquet(f"{sf}/events.parquet").select(
        F.lit("events").alias("dataset"),
        F.lit("regression").alias("task"),
        (F.col("event_id") + 1).alias("instance_id"),
        F.array((F.col("user_id") % 7).cast("double"), F.hour("ts").cast("double")).alias("features"),
        F.col("value").alias("target"),
    )


def test_stream_equals_batch_across_restart(spark, sf_small, tmp_path):
    rows, root = instances(spark, sf_small), str(tmp_path)
    batch = prequential(
        rows.withColumn("actual", F.col("target")).withColumn("model", F.lit("sgd")), KEYS, detection=Detection(cooldown=200)
    )
    want = {
        r.instance: r
        for r in metrics.metrics_log(metrics.prequential_metrics(batch, KEYS), every=50).collect()
    }

    def run():
        received = streams.decode(streams.read_files(spark, f"{root}/in", "value string", "text", files_per_trigger=1))
        capped = streams.cap(streams.select_datasets(received, "events"), 900)
        logged = stream_metrics(
            capped.select("dataset", "task", F.lit("sgd").alias("model"), "instance_id", "features", streams.actual().alias("actual")),
            KEYS,
            detection=Detection(cooldown=200),
            log_every=50,
        )
        drain(logged, f"{root}/out", f"{root}/checkpoint", partition_by=["dataset"])

    for low, high in ((1, 400), (301, 1000)):  # the second file repeats 100 rows
        part = rows.filter(F.col("instance_id").between(low, high))
        streams.encode(part).coalesce(1).write.mode("append").text(f"{root}/in")
        run()
    got = spark.read.parquet(f"{root}/out").collect()
    assert sorted(r.instance for r in got) == list(range(50, 901, 50))
    for r in got:
        w = want[r.instance]
        assert (r.n, r.segment) == (w.n, w.segment)
        for c in ("cumulative_mae", "window_mae", "window_mse"):
            a, b = getattr(r, c), getattr(w, c)
            assert (a is None) == (b is None) and (a is None or abs(a - b) < 1e-9 * max(1, abs(b)))


def test_repeated_batches_replace_themselves(spark, sf_small, tmp_path):
    root = str(tmp_path)
    streams.encode(instances(spark, sf_small)).write.text(f"{root}/in")
    received = streams.decode(spark.readStream.text(f"{root}/in"))
    upsert_batches(received, f"{root}/out", f"{root}/checkpoint")
    upsert_batches(received, f"{root}/out", f"{root}/checkpoint")
    assert spark.read.parquet(f"{root}/out").count() == 1000


def test_order_of_files_and_micro_batches_changes_nothing(spark, sf_small, tmp_path):
    rows, logs = instances(spark, sf_small), {}
    # four files whose ids interleave, and a replayed part
    mixed = rows.union(rows.filter("instance_id % 10 = 3")).repartition(4, F.col("instance_id") % 7)
    streams.encode(mixed).write.text(f"{tmp_path}/in")
    for files in (1, 4):
        received = streams.decode(
            streams.read_files(spark, f"{tmp_path}/in", "value string", "text", files_per_trigger=files)
        )
        runs = received.select(
            "dataset", "task", F.lit("sgd").alias("model"), "instance_id", "features", streams.actual().alias("actual")
        )
        drain(stream_metrics(runs, KEYS, detection=None, log_every=1), f"{tmp_path}/out{files}", f"{tmp_path}/cp{files}")
        got = spark.read.parquet(f"{tmp_path}/out{files}")
        logs[files] = {r.instance: (r.n, r.cumulative_mae, r.window_mse) for r in got.collect()}
        assert got.agg(F.max("duplicate_rows"), F.max("late_rows")).first()[1] == 0
    assert logs[1] == logs[4] and sorted(logs[1]) == list(range(2, 1001))


def test_sequencer_counts_late_and_duplicate_rows():
    queue, seen = Sequencer(1, hold_rows=3), []

    def feed(*ids):
        for i in ids:
            queue.push(i, [i])
        seen.extend(i for i, _ in queue.ready())

    feed(2, 1, 1, 4)
    assert seen == [1, 2] and queue.duplicate_rows == 1
    feed(4, 6, 7, 8)  # four rows wait behind 3: it is given up, and so is nothing else
    assert seen == [1, 2, 4] and queue.duplicate_rows == 2
    restored = Sequencer(1, hold_rows=3)
    restored.from_state(queue.to_state())
    queue = restored
    feed(3, 3, 5)
    assert seen == [1, 2, 4, 5, 6, 7, 8] and (queue.late_rows, queue.duplicate_rows) == (1, 3)
    feed(11)
    assert [i for i, _ in queue.flush()] == [11] and queue.skipped == [[9, 10]]
    free = Sequencer(None)
    for i in (5, 3):
        free.push(i, [i])
    assert [i for i, _ in free.ready()] == [3, 5]
    free.push(4, [4])
    assert list(free.ready()) == [] and free.late_rows == 1


def test_no_number_of_early_rows_gives_a_gap_up(spark, tmp_path):
    last = 120_000

    def run(ids):
        rows = ids.select(
            F.lit("d").alias("dataset"),
            F.lit("regression").alias("task"),
            F.col("id").alias("instance_id"),
            F.array(F.lit(1.0)).alias("features"),
            (F.col("id") % 10).cast("double").alias("target"),
        )
        # the first id is read last: all others wait, more of them than the former cap
        streams.encode(rows).coalesce(1).write.mode("append").text(f"{tmp_path}/in")
        received = streams.decode(streams.read_files(spark, f"{tmp_path}/in", "value string", "text", files_per_trigger=4))
        runs = received.select(
            "dataset", "task", F.lit("sgd").alias("model"), "instance_id", "features", streams.actual().alias("actual")
        )
        drain(stream_metrics(runs, KEYS, detection=None, log_every=last), f"{tmp_path}/out", f"{tmp_path}/cp")
        return waiting_metrics(spark, f"{tmp_path}/cp", KEYS, detection=None, log_every=last).collect()

    # id 1 is missing: it is given up only for what is asked about the waiting rows
    assert [(r.instance, r.n) for r in run(spark.range(last, 1, -1))] == [(last, last - 2)]
    assert run(spark.range(1, 2)) == []
    assert [(r.instance, r.n, r.late_rows) for r in spark.read.parquet(f"{tmp_path}/out").collect()] == [(last, last - 1, 0)]


def test_a_live_run_logs_by_time_reports_progress_and_ends_when_idle(spark, sf_small, tmp_path):
    from tidemark.streaming.monitor import ProgressTable, live_rate, progress_snapshots, run_until_idle

    rows, root = instances(spark, sf_small), str(tmp_path)
    for low in (1, 301, 601):
        streams.encode(rows.filter(F.col("instance_id").between(low, low + 299))).coalesce(1).write.mode("append").text(f"{root}/in")
    received = streams.decode(streams.read_files(spark, f"{root}/in", "value string", "text", files_per_trigger=1))
    runs = received.select("dataset", "task", F.lit("sgd").alias("model"), "instance_id", "features", streams.actual().alias("actual"))
    logged = stream_metrics(runs, KEYS, detection=None, log_every=500, log_seconds=0)
    progress, views = ProgressTable(spark, f"{root}/progress"), []
    spark.streams.addListener(progress)
    try:
        run_until_idle(
            logged, f"{root}/out", f"{root}/checkpoint", interval="500 milliseconds", idle_seconds=6, name="live",
            refresh=lambda query: views.append(query.id),
        )
        assert progress.ended.wait(20)
    finally:
        spark.streams.removeListener(progress)
    assert views
    got = sorted(r.instance for r in spark.read.parquet(f"{root}/out").collect())
    assert got[-1] == 900 and 500 in got and len(got) <= 4  # one row by count, the others at the end of a micro-batch
    table = progress.table()
    assert table.agg(F.sum("num_rows")).first()[0] == 900
    snapshots = sorted(r.instances for r in progress_snapshots(table).collect())
    assert snapshots[-1] == 900
    row, = live_rate(table).collect()
    assert (row["query"], row["instances"]) == ("live", 900) and row["rate"] >= 0


def test_an_idle_stream_without_rows_ends(spark, tmp_path):
    import time

    from tidemark.streaming.monitor import run_until_idle

    (tmp_path / "in").mkdir()
    began = time.time()
    run_until_idle(spark.readStream.text(f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/cp", interval="200 milliseconds", idle_seconds=2)
    assert 2 <= time.time() - began < 40


def test_waiting_rows_share_entries_of_the_state():
    import random

    from tidemark.streaming.prequential import StateRows

    class Store(dict):
        calls = 0

        def _count(self):
            Store.calls += 1

        def getValue(self, key):
            self._count()
            return self.get(key)

        def updateValue(self, key, value):
            self._count()
            self[key] = value

        def removeKey(self, key):
            self._count()
            self.pop(key, None)

        def iterator(self):
            return iter(list(self.items()))

    store, ids = Store(), list(range(1, 5001))
    late, early = ids[:2500], ids[2500:]
    random.Random(2).shuffle(early)
    queue, seen = Sequencer(1, held=StateRows(store)), []
    for part in (early[:1000], early[1000:], late):
        for i in part:
            queue.push(i, [i])
        seen += [(o, r) for o, r in queue.ready(skip=False)]
        if part is not late:
            assert sorted(queue.held) == sorted(early[: len(queue.held)])
        queue.held.settle()
        saved = queue.to_state()
        queue = Sequencer(1, held=StateRows(store))
        queue.from_state(saved)
    assert seen == [(i, [i]) for i in ids] and not store and not queue.held
    assert Store.calls < 500

"""The test-then-train run and its metrics as a stateful streaming query.

State lives in the state store under (dataset, task, model[, entity]). Rows that come before their
predecessors wait there, one entry a row, however many they are and whatever the cut into micro-batches; ids seen
before change nothing and are counted, so a replayed file changes nothing. What still waits behind a gap when the
input is drained is scored by ``waiting_metrics``.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Callable, Iterator, Mapping, MutableMapping, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.metrics import LOG_EVERY, WARMUP_ROWS, WINDOW_ROWS
from tidemark.operators.prequential import Detection, TestThenTrain
from tidemark.session import STATE_STORE

METRIC_FIELDS = T.StructType(
    [
        T.StructField("instance", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("segment", T.LongType()),
        T.StructField("cumulative_accuracy", T.DoubleType()),
        T.StructField("window_accuracy", T.DoubleType()),
        T.StructField("cumulative_mae", T.DoubleType()),
        T.StructField("cumulative_mse", T.DoubleType()),
        T.StructField("window_mae", T.DoubleType()),
        T.StructField("window_mse", T.DoubleType()),
        T.StructField("late_rows", T.LongType()),
        T.StructField("duplicate_rows", T.LongType()),
    ]
)


class RunningMetrics:
    """Counts and sums of one run, and the last errors in a ring."""

    def __init__(self, window_rows: int = WINDOW_ROWS, warmup_rows: int = WARMUP_ROWS):
        self.window_rows, self.warmup_rows = window_rows, warmup_rows
        self.n = self.n_correct = self.segment = self.segment_row = self.counted = 0
        self.error = self.square = 0.0
        self.recent: deque[float] = deque(maxlen=window_rows)

    def update(self, error: float, drift: bool) -> None:
        self.n += 1
        self.n_correct += error == 0
        if drift:
            self.segment += 1
            self.segment_row = self.counted = 0
            self.error = self.square = 0.0
        self.segment_row += 1
        if self.segment == 0 or self.segment_row > self.warmup_rows:
            self.counted += 1
            self.error += error
            self.square += error * error
        self.recent.append(error)

    def row(self, task: str, instance: int) -> tuple:
        w = len(self.recent)
        if task == "classification":
            values = (self.n_correct / self.n, sum(e == 0 for e in self.recent) / w, None, None, None, None)
        else:
            mean = (self.error / self.counted, self.square / self.counted) if self.counted else (None, None)
            values = (None, None, *mean, sum(self.recent) / w, sum(e * e for e in self.recent) / w)
        return (instance, self.n, self.segment, *values)

    def to_state(self) -> dict[str, Any]:
        return {**vars(self), "recent": list(self.recent)}

    def from_state(self, state: dict[str, Any]) -> None:
        vars(self).update(state)
        self.recent = deque(state["recent"], maxlen=self.window_rows)


ENTRY_IDS = 64


class StateRows(MutableMapping):
    """The waiting rows of one key in a map state, ``ENTRY_IDS`` neighbouring ids to an entry: a call to the state store
    costs far more than a row. Entries touched since the last ``settle`` are in memory, all others are not."""

    def __init__(self, state: Any, stored: int = 0):
        self.state, self.stored = state, stored  # ``stored``: rows held, in memory and in the map state
        self.open: dict[int, dict[str, Any]] = {}  # rows as text if they come from the map state
        self.changed: set[int] = set()
        self.anything = stored > 0  # whether the map state may have entries

    def _entry(self, order: int) -> dict[str, Any]:
        number = order // ENTRY_IDS
        if number not in self.open:
            found = self.state.getValue((number,)) if self.anything else None
            self.open[number] = json.loads(found[0]) if found else {}
        return self.open[number]

    def __contains__(self, order: int) -> bool:
        return self.stored > 0 and str(order) in self._entry(order)

    def __getitem__(self, order: int) -> list:
        if not self.stored:
            raise KeyError(order)
        row = self._entry(order)[str(order)]
        return json.loads(row) if isinstance(row, str) else row

    def __setitem__(self, order: int, row: list) -> None:
        entry = self._entry(order)
        self.stored += str(order) not in entry
        entry[str(order)] = row
        self.changed.add(order // ENTRY_IDS)

    def __delitem__(self, order: int) -> None:
        del self._entry(order)[str(order)]
        self.stored -= 1
        self.changed.add(order // ENTRY_IDS)

    def __len__(self) -> int:
        return self.stored

    def __iter__(self) -> Iterator[int]:
        closed = [json.loads(v) for (k,), (v,) in self.state.iterator() if k not in self.open] if self.anything else []
        return iter(np.array([int(o) for entry in (*self.open.values(), *closed) for o in entry], dtype=np.int64).tolist())

    def settle(self) -> None:
        for number in self.changed:
            rows = {o: row if isinstance(row, str) else json.dumps(row) for o, row in self.open[number].items()}
            if rows:
                self.state.updateValue((number,), (json.dumps(rows),))
                self.anything = True
            elif self.anything:
                self.state.removeKey((number,))
        self.open, self.changed = {}, set()


class Sequencer:
    """Puts the rows of one key in order: early rows wait until the ids before them have come.

    With ``start`` ids are expected to be dense from there on. A gap is given up when ``flush`` is called, or when
    more than ``hold_rows`` rows (if given) wait behind it at a ``ready`` that may ``skip``; ids that come after all are
    counted as late, ids seen before as duplicates, and neither is processed. Without ``start`` nothing waits: rows go
    on as they come, in ascending order within a micro-batch, and what lies behind is counted.
    """

    def __init__(
        self, start: int | None = 1, hold_rows: int | None = None, held: MutableMapping[int, list] | None = None
    ):
        self.start, self.hold_rows = start, hold_rows
        self.last: int | None = None if start is None else start - 1
        self.held: MutableMapping[int, list] = {} if held is None else held
        self.skipped: list[list[int]] = []  # ranges of ids that were given up
        self.late_rows = self.duplicate_rows = 0

    def push(self, order: int, row: list) -> None:
        if order in self.held:
            self.duplicate_rows += 1
        elif self.last is not None and order <= self.last:
            gap = next((g for g in self.skipped if g[0] <= order <= g[1]), None)
            if gap is None and self.start is not None and order >= self.start:
                self.duplicate_rows += 1
                return
            self.late_rows += 1
            if gap is not None:  # a second copy of a late row is a duplicate
                self.skipped.remove(gap)
                self.skipped += [g for g in ([gap[0], order - 1], [order + 1, gap[1]]) if g[0] <= g[1]]
        else:
            self.held[order] = row

    def ready(self, skip: bool = True) -> Iterator[tuple[int, list]]:
        """Rows whose turn has come."""
        if self.start is None:
            yield from self.flush()
            return
        while self.held:
            row = self.held.pop(self.last + 1, None)
            if row is not None:
                self.last += 1
                yield self.last, row
            elif skip and self.hold_rows is not None and len(self.held) > self.hold_rows:
                self._skip(min(self.held))
            else:
                return

    def _skip(self, first: int) -> None:
        self.skipped.append([self.last + 1, first - 1])
        self.last = first - 1

    def flush(self) -> Iterator[tuple[int, list]]:
        """All waiting rows in order, gaps given up."""
        for order in sorted(self.held):
            if self.start is not None and order != self.last + 1:
                self._skip(order)
            self.last = order
            yield order, self.held.pop(order)

    def to_state(self) -> dict[str, Any]:
        """All but rows that the state store holds itself: of those, the number."""
        kept = {k: v for k, v in vars(self).items() if k not in ("start", "hold_rows", "held")}
        if isinstance(self.held, StateRows):
            return {**kept, "stored": self.held.stored}
        return {**kept, "held": [[k, v] for k, v in self.held.items()]}

    def from_state(self, state: dict[str, Any]) -> None:
        vars(self).update({k: v for k, v in state.items() if k not in ("held", "stored")})
        if isinstance(self.held, StateRows):
            self.held.stored, self.held.anything = state["stored"], state["stored"] > 0
        else:
            self.held = {k: v for k, v in state.get("held", ())}


def _process(
    key: tuple, task: str, rows: Iterator[tuple[int, list]], run: Any, metrics: RunningMetrics, queue: Sequencer, log_every: int
) -> Iterator[tuple]:
    """The log rows of ``rows``, which pass through the run in order."""
    for order, (features, actual) in rows:
        prediction, error, drift, _ = run.step((order, features, actual))
        if prediction is not None:
            metrics.update(error, drift)
            if order % log_every == 0:
                yield (*key, *metrics.row(task, order), queue.late_rows, queue.duplicate_rows)


def _log_frame(keys: Sequence[str], out: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(out, columns=[*keys, *METRIC_FIELDS.names]).astype(object)


class _Run(StatefulProcessor):
    """One key: run state and metrics, saved as one JSON value after each micro-batch, and waiting rows by id."""

    def __init__(
        self,
        keys: Sequence[str],
        make: Callable[[Mapping[str, Any]], Any],
        log_every: int,
        start: int | None,
        hold_rows: int | None,
        patience_ms: int | None,
        log_seconds: float | None,
    ):
        self.keys, self.make, self.log_every, self.log_seconds = list(keys), make, log_every, log_seconds
        self.start, self.hold_rows, self.patience_ms = start, hold_rows, patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.saved = handle.getValueState("run", T.StructType([T.StructField("state", T.StringType())]))
        self.waiting = handle.getMapState("waiting", "id long", "row string")
        if self.log_seconds is not None:
            self.logged = handle.getValueState("logged", "at long, instance long")

    def _load(self, named: dict[str, Any]) -> tuple[Any, RunningMetrics, Sequencer]:
        run, metrics = self.make(named), RunningMetrics()
        queue = Sequencer(self.start, self.hold_rows, StateRows(self.waiting))
        if self.saved.exists():
            state = json.loads(self.saved.get()[0])
            run.from_state(state["run"])
            metrics.from_state(state["metrics"])
            queue.from_state(state["queue"])
        return run, metrics, queue

    def _save(self, run: Any, metrics: RunningMetrics, queue: Sequencer) -> None:
        queue.held.settle()
        state = {"run": run.to_state(), "metrics": metrics.to_state(), "queue": queue.to_state()}
        self.saved.update((json.dumps(state),))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        named = dict(zip(self.keys, key))
        run, metrics, queue = self._load(named)

        def logged(turn: Iterator[tuple[int, list]]) -> list[tuple]:
            return list(_process(key, named["task"], turn, run, metrics, queue, self.log_every))

        out = []
        # frames are worked off one after the other; only what came too early is kept, and no gap is given up before the last
        for frame in rows:
            cells = (frame["instance_id"].tolist(), frame["features"].tolist(), frame["actual"].tolist())
            for order, features, actual in zip(*cells):
                queue.push(order, [[float(v) for v in features], actual])
            if self.start is not None:
                out += logged(queue.ready(skip=False))
                queue.held.settle()
        out += logged(queue.ready())
        if queue.held and self.patience_ms is not None:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.patience_ms)
        if self.log_seconds is not None:
            out += self._timed(key, named["task"], out, metrics, queue, timerValues.getCurrentProcessingTimeInMs())
        self._save(run, metrics, queue)
        yield _log_frame(self.keys, out)

    def _timed(self, key: tuple, task: str, out: list[tuple], metrics: RunningMetrics, queue: Sequencer, now: int) -> list[tuple]:
        """One more log row if the last one is over ``log_seconds`` old and rows have been scored since."""
        last = self.logged.get() if self.logged.exists() else (now, 0)
        if out and out[-1][len(key)] == queue.last:
            last = (now, queue.last)
        elif metrics.n and queue.last > last[1] and now - last[0] >= 1000 * self.log_seconds:
            self.logged.update((now, queue.last))
            return [(*key, *metrics.row(task, queue.last), queue.late_rows, queue.duplicate_rows)]
        self.logged.update(last)
        return []

    def handleExpiredTimer(self, key: tuple, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        named = dict(zip(self.keys, key))
        run, metrics, queue = self._load(named)
        out = list(_process(key, named["task"], queue.flush(), run, metrics, queue, self.log_every))
        self._save(run, metrics, queue)
        yield _log_frame(self.keys, out)

    def close(self) -> None:
        pass


class Persistence:
    """Predicts the previous target; the baseline every learner has to beat."""

    def __init__(self) -> None:
        self.previous: float | None = None

    def predict(self, x: Sequence[float]) -> float | None:
        return self.previous

    def learn(self, x: Sequence[float], y: float) -> None:
        self.previous = y

    def to_state(self) -> dict[str, Any]:
        return {"previous": self.previous}

    def from_state(self, state: dict[str, Any]) -> None:
        self.previous = state["previous"]


class FixedDrift:
    """Wraps a run so that drifts come from a schedule of ids instead of a detector."""

    def __init__(self, run: TestThenTrain, every: int):
        self.run, self.every = run, every

    def step(self, row: tuple) -> tuple:
        prediction, error, _, segment = self.run.step(row)
        return prediction, error, prediction is not None and row[0] % self.every == 0, segment

    def to_state(self) -> dict[str, Any]:
        return self.run.to_state()

    def from_state(self, state: dict[str, Any]) -> None:
        self.run.from_state(state)


def _default_run(detection: Detection | None, classes: Sequence[int]) -> Callable[[Mapping[str, Any]], TestThenTrain]:
    from tidemark.operators.learners import create_learner

    def default(key: Mapping[str, Any]) -> TestThenTrain:
        return TestThenTrain(key["task"], lambda: create_learner(key["task"], key["model"], classes), detection)

    return default


def stream_metrics(
    instances: DataFrame,
    keys: Sequence[str],
    make: Callable[[Mapping[str, Any]], Any] | None = None,
    detection: Detection | None = Detection(),
    log_every: int = LOG_EVERY,
    start: int | None = 1,
    hold_rows: int | None = None,
    patience_ms: int | None = None,
    classes: Sequence[int] = (0, 1),
    log_seconds: float | None = None,
) -> DataFrame:
    """Metric-log rows of a stream of instances (``instance_id``, ``features``, ``actual``).

    ``start``: the first id of a key whose ids are dense, or None if they are not (then rows are taken in arrival
    order); ``hold_rows`` and ``patience_ms`` (processing time): when a gap in the ids is given up, never if both are
    None. Log rows carry the numbers of late and duplicate rows so far. With ``log_seconds`` (processing time) a micro-batch
    also ends with a log row if the last one is older and rows came since; ids must be dense then.
    """
    instances.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    types = [instances.schema[k] for k in keys]
    return instances.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=_Run(
            keys, make or _default_run(detection, classes), log_every, start, hold_rows, patience_ms, log_seconds
        ),
        outputStructType=T.StructType([*types, *METRIC_FIELDS.fields]),
        outputMode="Append",
        timeMode="None" if patience_ms is None and log_seconds is None else "ProcessingTime",
    )


def drain(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()) -> None:
    """Process what is there now, append it to a parquet table and stop."""
    writer = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.trigger(availableNow=True).start(path)
    query.awaitTermination()


def waiting_metrics(
    spark: SparkSession,
    checkpoint: str,
    keys: Sequence[str],
    make: Callable[[Mapping[str, Any]], Any] | None = None,
    detection: Detection | None = Detection(),
    log_every: int = LOG_EVERY,
    classes: Sequence[int] = (0, 1),
) -> DataFrame:
    """Log rows of the rows that still wait behind a gap when a drained stream has stopped, the gaps given up.

    Reads the state under ``checkpoint`` and leaves it as it is: if the missing ids come with a later drain, they are
    processed as if this had not been asked. The other parameters are those of ``stream_metrics``.
    """
    build, names = make or _default_run(detection, classes), list(keys)

    def state(variable: str) -> DataFrame:
        return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", variable).load()

    own = [F.col("key")[k].alias(k) for k in names]
    held = F.from_json(F.col("user_map_value.row"), T.MapType(T.StringType(), T.StringType()))
    rows = state("waiting").select(*own, F.explode(held).alias("id", "cell")).withColumn("id", F.col("id").cast("long"))
    runs = state("run").select(*own, F.lit(None).cast("long").alias("id"), F.col("value.state").alias("cell"))
    both = runs.join(rows.select(*names).distinct(), names, "left_semi").unionByName(rows)
    placed = both.repartition(*names).sortWithinPartitions(*[F.col(k) for k in names], F.col("id").asc_nulls_first())

    def finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = parts = None
        for frame in frames:
            out: list[tuple] = []
            for *k, order, cell in zip(*(frame[c].tolist() for c in [*names, "id", "cell"])):
                if tuple(k) != key:  # the state of a key comes before its rows
                    key, saved = tuple(k), json.loads(cell)
                    named = dict(zip(names, key))
                    parts = build(named), RunningMetrics(), Sequencer()
                    for part, name in zip(parts, ("run", "metrics", "queue")):
                        part.from_state(saved[name])
                    continue
                out += _process(key, named["task"], iter([(int(order), json.loads(cell))]), *parts, log_every)
            yield _log_frame(names, out)

    types = [placed.schema[k] for k in names]
    return placed.mapInPandas(finish, T.StructType([*types, *METRIC_FIELDS.fields]))


def upsert_batches(df: DataFrame, path: str, checkpoint: str) -> None:
    """The same through ``foreachBatch``: one folder per batch id, so a repeated batch replaces itself."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    query = (
        df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(save).trigger(availableNow=True).start()
    )
    query.awaitTermination()

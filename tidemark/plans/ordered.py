"""Ordered per-key state for steps whose result feeds back into the next row.

Rows of a key are streamed in order through a small state machine, one Arrow batch at a time, so a
task's memory does not grow with the key. A key with more than ``slice_rows`` rows is worked off in
several Spark jobs: each job takes one slice of positions, restores the key's state from the table
the job before wrote to the shared folder, and writes its own. A lost executor repeats one slice.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.blocked import Scan, prefix_scan
from tidemark.session import scratch_path

STATE = "__state"
DEFAULT_SLICE_ROWS = 4_000_000
# Rows and keys of a task that runs its keys side by side: enough keys for arrays, and not more rows than a sort holds well.
TOGETHER_ROWS, TOGETHER_KEYS = 250_000, 2_000


class Machine(Protocol):
    """Keyed state: ``step`` takes one input row and returns the output values of that row."""

    def step(self, row: tuple) -> tuple: ...

    def to_state(self) -> dict[str, Any]: ...

    def from_state(self, state: dict[str, Any]) -> None: ...


ARROW = {
    T.LongType(): pa.int64(),
    T.IntegerType(): pa.int32(),
    T.DoubleType(): pa.float64(),
    T.BooleanType(): pa.bool_(),
    T.StringType(): pa.string(),
    T.ArrayType(T.DoubleType()): pa.list_(pa.float64()),
}


def _runner(
    make: Callable[[dict], Machine], keys: list[str], inputs: list[str], outputs: T.StructType, with_state: bool
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    n_keys, n_in, n_out = len(keys), len(inputs), len(outputs.fields)
    out_types = [ARROW[f.dataType] for f in outputs.fields]
    given = [*keys, *inputs]
    names = [*given, *[f.name for f in outputs.fields]] + ([STATE] if with_state else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: tuple | None = None
        machine: Machine | None = None
        stepped = False
        types: list[pa.DataType] | None = None

        def closing_row() -> pa.RecordBatch:
            row = (*current, *(None,) * (n_in + n_out), json.dumps(machine.to_state()))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

        for batch in batches:
            if types is None:
                types = [batch.schema.field(c).type for c in given] + out_types
                types += [pa.string()] if with_state else []
            states = batch.column(STATE).to_pylist() if with_state else None
            cells = [batch.column(c).to_pylist() for c in given]
            own, rows = zip(*cells[:n_keys]), zip(*cells[n_keys:])
            out: list[tuple] = []
            for i, (key, row) in enumerate(zip(own, rows)):
                if key != current:
                    if with_state and stepped:
                        yield closing_row()
                    current, machine, stepped = key, make(dict(zip(keys, key))), False
                if with_state and states[i] is not None:
                    machine.from_state(json.loads(states[i]))
                    continue
                out.append(machine.step(row))
                stepped = True
            if not out:
                continue
            # the input columns go on as they came; rows that held a state are no rows of the stream
            fed = batch.filter(batch.column(STATE).is_null()) if with_state else batch
            arrays = [fed.column(c) for c in given] + [pa.array(c, t) for c, t in zip(zip(*out), out_types)]
            if with_state:
                arrays.append(pa.nulls(len(out), pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, names=names)
        if with_state and stepped:
            yield closing_row()

    return run


def run_ordered(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    inputs: Sequence[str],
    outputs: T.StructType,
    make: Callable[[dict], Machine],
    slice_rows: int | None = None,
    bounded: bool = False,
    tasks: int | None = None,
    together: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None,
    unused: Sequence[str] = (),
) -> DataFrame:
    """Feed ``inputs`` of every key through ``make(key)`` in ``order``.

    Returns keys, inputs and the machine's outputs. ``inputs[0]`` must be ``order``. ``bounded`` says
    that no key can exceed ``slice_rows`` (the key is a block), which saves counting. ``tasks`` sets the number of tasks of
    bounded keys, which are else few for few bytes, however much work the rows are. ``together`` does the same for many keys side
    by side and is taken if no key needs slices; it leaves out the inputs ``unused``.
    """
    keys, inputs = list(keys), list(inputs)
    if inputs[0] != order:
        raise ValueError("the first input must be the order column")
    spark = df.sparkSession
    size = slice_rows or int(spark.conf.get("spark.tidemark.sliceRows", str(DEFAULT_SLICE_ROWS)))
    rows = df.select(*keys, *inputs)
    plain = T.StructType([*rows.schema.fields, *outputs.fields])
    counted = None if bounded else rows.groupBy(*keys).count().agg(F.max("count"), F.count("count"), F.sum("count")).first()
    longest = counted[0] or 0 if counted else 0
    if together is not None and counted and longest <= size:
        parts = min(-(-(counted[2] or 0) // TOGETHER_ROWS), -(-counted[1] // TOGETHER_KEYS))
        dealt = rows.repartition(tasks or max(parts, 2 * spark.sparkContext.defaultParallelism), *keys)
        left = T.StructType([f for f in plain.fields if f.name not in unused])
        return dealt.sortWithinPartitions(*keys, order).mapInArrow(together, _nullable(left))
    if longest <= size:
        dealt = rows.repartition(tasks, *keys) if tasks else rows.repartition(*keys)
        ordered = dealt.sortWithinPartitions(*keys, order)
        return ordered.mapInArrow(_runner(make, keys, inputs, outputs, False), _nullable(plain))

    sliced = prefix_scan(rows, keys, order, {"__pos": Scan("count", F.lit(True))})
    sliced = sliced.withColumn("__slice", F.floor((F.col("__pos") - 1) / size).cast("int")).drop("__pos")
    base = scratch_path(spark, "ordered")
    sliced.write.partitionBy("__slice").parquet(f"{base}/in")
    stateful = _nullable(T.StructType([*plain.fields, T.StructField(STATE, T.StringType())]))
    previous = None
    for part in range(-(-longest // size)):
        rows_in = spark.read.schema(rows.schema).parquet(f"{base}/in/__slice={part}").withColumn(
            STATE, F.lit(None).cast("string")
        )
        if previous is not None:
            restored = previous.filter(F.col(STATE).isNotNull()).select(
                *keys,
                *[
                    F.col(c) if c != order else F.lit(None).cast(rows.schema[c].dataType).alias(order)
                    for c in inputs
                ],
                STATE,
            )
            rows_in = rows_in.unionByName(restored)
        # nulls sort first, so the restored state precedes the key's rows
        ordered = rows_in.repartition(*keys).sortWithinPartitions(*[F.col(k) for k in keys], F.col(order).asc_nulls_first())
        ordered.mapInArrow(_runner(make, keys, inputs, outputs, True), stateful).write.parquet(f"{base}/out/part={part}")
        previous = spark.read.schema(stateful).parquet(f"{base}/out/part={part}")
    done = spark.read.schema(stateful).parquet(*[f"{base}/out/part={p}" for p in range(-(-longest // size))])
    return done.filter(F.col(STATE).isNull()).drop(STATE)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])

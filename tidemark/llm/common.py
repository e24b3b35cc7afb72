"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import materialize


BATCH_BYTES = 4 << 20
ROWS_PER_TASK = 1_000_000


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of Python stages by bytes: 10,000 long texts at once would fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def spread(df: DataFrame, emitted: int) -> DataFrame:
    """``df`` over as many tasks as keep each below ``ROWS_PER_TASK`` of the ``emitted`` rows it is exploded to."""
    return df.repartition(max(1, -(-emitted // ROWS_PER_TASK)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """Only the columns the operators read, whatever else ``docs`` carries."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text of an Arrow column; null counts as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def mapped(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with a function from one record batch to an iterator of column lists."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    small_batches(df.sparkSession)
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for columns in function(batch):
                    arrays = [pa.array(c, type=f.type, from_pandas=False) for c, f in zip(columns, target)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return df.mapInArrow(run, schema)


def sorted_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Column arrays that hold whole runs of equal ``keys`` (non-null longs) from batches sorted by them.

    A run that crosses batches is kept until it ends, so memory is a batch plus the longest run.
    """
    held: list[dict[str, np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = {
            name: batch.column(i).to_numpy(zero_copy_only=False) for i, name in enumerate(batch.schema.names)
        }
        change = np.zeros(batch.num_rows, dtype=bool)
        for key in keys:
            change[1:] |= columns[key][1:] != columns[key][:-1]
        if held and all(held[-1][key][-1] == columns[key][0] for key in keys):
            first = int(np.argmax(change)) if change.any() else batch.num_rows
        else:
            first = 0
        if first == batch.num_rows:
            held.append(columns)
            continue
        last = int(np.flatnonzero(change)[-1]) if change.any() else 0
        last = max(first, last)
        held.append({name: values[:last] for name, values in columns.items()})
        whole = {name: np.concatenate([part[name] for part in held]) for name in columns}
        if len(whole[keys[0]]):
            yield whole
        held = [{name: values[last:] for name, values in columns.items()}]
    if held:
        yield {name: np.concatenate([part[name] for part in held]) for name in held[0]}


def run_bounds(columns: dict[str, np.ndarray], keys: list[str]) -> list[tuple[int, int]]:
    """First and past-the-last row of each run of two or more rows."""
    size = len(columns[keys[0]])
    change = np.ones(size, dtype=bool)
    change[1:] = False
    for key in keys:
        change[1:] |= columns[key][1:] != columns[key][:-1]
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:], size)
    many = ends - starts > 1
    return list(zip(starts[many].tolist(), ends[many].tolist()))


def min_labels(link: np.ndarray) -> np.ndarray:
    """Smallest position reachable by links, for each row of a symmetric boolean matrix."""
    size = len(link)
    link = link | np.eye(size, dtype=bool)
    labels = np.arange(size)
    while True:
        nearest = np.where(link, labels[None, :], size).min(axis=1)
        nearest = nearest[nearest]
        if np.array_equal(nearest, labels):
            return labels
        labels = nearest


__all__ = [
    "mapped",
    "materialize",
    "min_labels",
    "run_bounds",
    "small_batches",
    "sorted_runs",
    "spread",
    "table",
    "text_bytes",
    "texts",
]

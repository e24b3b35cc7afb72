"""What the two text classifiers share: the labelled sample, term selection, corpus statistics, features."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mapped, materialize, small_batches, text_bytes

SAMPLE = 4096  # labelled rows a classifier is fitted on, at most

Analyzer = Callable[[bytes], dict[bytes, int]]


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; a null doc_id is not held out (it has no label)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def sample_labelled(docs: DataFrame, labels: DataFrame, label: str, size: int = SAMPLE) -> DataFrame:
    """(doc_id, y, text) of at most ``size`` labelled documents outside the held-out fold, by doc_id hash.

    Null labels and null doc_ids are not used; a doc_id with several labels takes the largest. The ids are
    chosen from the small label table among those in ``docs``, and only they are broadcast. Equal texts count
    once, with the largest label.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(label).cast("int").alias("y"))
    present = docs.select(F.col("doc_id").cast("long").alias("id"))
    chosen = known.join(present, "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(size)
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string"))
    rows = rows.join(F.broadcast(chosen), "id")
    return rows.groupBy("text").agg(F.min("id").alias("doc_id"), F.max("y").alias("y"))


def term_rows(sample: DataFrame, analyze: Analyzer) -> DataFrame:
    """(doc_id, y, terms, counts) of the sample."""

    def run(batch: pa.RecordBatch):
        found = [analyze(t) for t in text_bytes(batch.column(2))]
        yield [batch.column(0), batch.column(1), [list(f) for f in found], [list(f.values()) for f in found]]

    schema = "doc_id long, y int, terms array<binary>, counts array<int>"
    return mapped(sample.select("doc_id", "y", "text"), run, schema)


def term_labels(rows: DataFrame) -> DataFrame:
    """(term, pos, neg): in how many sampled documents of each label a term occurs."""
    spread = rows.select("y", F.explode("terms").alias("term"))
    return spread.groupBy("term").agg(
        F.sum(F.when(F.col("y") == 1, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col("y") == 1, 0).otherwise(1)).alias("neg"),
    )


def document_frequency(docs: DataFrame, vocabulary: list[bytes], analyze: Analyzer) -> tuple[int, np.ndarray]:
    """Number of documents and of those that hold each term of a bounded vocabulary, over all ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, counts, rows = shared.value, Counter(), 0
        for batch in batches:
            for text in text_bytes(batch.column(0)):
                counts.update(number[t] for t in analyze(text).keys() & number.keys())
                rows += 1
        counts[-1] = rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), type=pa.int32()), pa.array(list(counts.values()), type=pa.int64())],
            names=["term", "n"],
        )

    counted = docs.select(F.col("text").cast("string")).mapInArrow(run, "term int, n long")
    found = {r["term"]: r["n"] for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    frequency = np.array([found.get(i, 0) for i in range(len(vocabulary))], dtype=np.float64)
    return int(found.get(-1, 0)), frequency


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)


def materialize_terms(sample: DataFrame, analyze: Analyzer) -> DataFrame:
    """The sample's term counts as a table, read by every step of a fit."""
    return materialize(term_rows(sample, analyze), "sample-terms")


def restricted(rows: DataFrame, numbers: dict[bytes, int]) -> list[tuple[int, int, dict[int, int]]]:
    """The sampled documents (id, y, count by term number), only with terms of a bounded vocabulary."""
    shared = rows.sparkSession.sparkContext.broadcast(numbers)

    def run(batch: pa.RecordBatch):
        known, at, counts = shared.value, [], []
        for terms, found in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            pairs = [(known[t], n) for t, n in zip(terms, found) if t in known]
            at.append([p[0] for p in pairs])
            counts.append([p[1] for p in pairs])
        yield [batch.column(0), batch.column(1), at, counts]

    schema = "doc_id long, y int, at array<int>, counts array<int>"
    return [(r["doc_id"], r["y"], dict(zip(r["at"], r["counts"]))) for r in mapped(rows, run, schema).collect()]

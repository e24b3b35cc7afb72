"""From raw documents to packed training bins: filter, deduplicate, decontaminate, pack.

Every stage takes (spark, docs, sf_dir) and works on all that the one before kept. Stages but the last return the
columns of ``documents``; the last returns where each piece of each document lies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import binpack, invindex, quality, simhash, toxicity
from tidemark.llm.common import materialize, table

LEAST_QUALITY = 0.3
MOST_TOXICITY = 0.5


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches ``LEAST_QUALITY``."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.filter(quality.score_column(docs, model) >= LEAST_QUALITY)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below ``MOST_TOXICITY``."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.score_column(docs, model) < MOST_TOXICITY)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints (four-word shingles) linked at four or fewer differing bits."""
    return simhash.keep_one(docs, simhash.SimHash(words=4, radius=4))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return invindex.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bins: doc_id, piece, start, length, bin_id, position."""
    return binpack.pack(binpack.measured(docs))


STAGES = [
    ("quality", good_quality),
    ("toxicity", not_toxic),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

ORACLE_SQL = None  # learned models and greedy packing have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

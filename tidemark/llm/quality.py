"""Quality by voting of the nearest labelled documents in a latent-semantic space of writing style.

Terms are the shapes of white-space words (runs of upper, lower and digit characters shortened to one, other characters
kept) and a mark for a word that repeats the one before. TF-IDF vectors of at most ``sample`` labelled documents
(document frequencies counted over all documents) are reduced by a truncated singular value decomposition.
The reduced unit vectors, bounded by ``sample`` times ``dims``, are broadcast; every document takes the exact cosine
product with all of them in blocks, and its nearest ones vote with weights that fall with the distance.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import labelled
from tidemark.llm.common import mapped, small_batches, text_bytes, texts

TERMS = 1024
DIMS = 32
NEIGHBOURS = 25
SHARPNESS = 8
LEAST_DOCUMENTS = 5
REPEAT = b"\x00="

_KIND = bytes(
    65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 48 if 48 <= c <= 57 else c for c in range(256)
)
_RUN = re.compile(rb"([Aa0])\1+|(.)\2{2,}", re.S)


def analyze(text: bytes) -> dict[bytes, int]:
    """Counts of word shapes, and of words equal to the word before."""
    counts: Counter[bytes] = Counter()
    for kinds, count in Counter(text.translate(_KIND).split()).items():
        counts[_RUN.sub(lambda m: (m[1] or m[2]), kinds)[:16]] += count
    tokens = text.split()
    repeats = sum(map(eq, tokens, tokens[1:]))
    if repeats:
        counts[REPEAT] = repeats
    return counts


@dataclass
class QualityModel:
    numbers: dict[bytes, int]
    idf: np.ndarray
    basis: np.ndarray  # (terms, dims)
    examples: np.ndarray  # (examples, dims), unit rows
    labels: np.ndarray
    k: int

    def vectors(self, found: list[dict[int, int]]) -> np.ndarray:
        matrix = np.zeros((len(found), len(self.idf)))
        for i, counts in enumerate(found):
            matrix[i, list(counts)] = list(counts.values())
        return labelled.unit_rows(matrix * self.idf)

    def score(self, batch: list[bytes]) -> np.ndarray:
        """Weighted share of label 1 among the nearest examples; the plain share for texts without terms."""
        prior = float(self.labels.mean()) if len(self.labels) else 0.5
        scores = np.full(len(batch), prior)
        if not len(self.labels):
            return scores
        for start in range(0, len(batch), 512):
            counts = [analyze(t) for t in batch[start : start + 512]]
            known = [{self.numbers[t]: c[t] for t in c.keys() & self.numbers.keys()} for c in counts]
            latent = labelled.unit_rows(self.vectors(known) @ self.basis)
            cosine = np.round(latent @ self.examples.T, 9)
            k = min(self.k, len(self.labels))
            least = np.partition(cosine, -k, axis=1)[:, -k]
            weight = np.where(cosine >= np.maximum(least, 1e-9)[:, None], cosine, 0) ** SHARPNESS
            total = weight.sum(axis=1)
            some = total > 0
            scores[start : start + 512][some] = (weight @ self.labels)[some] / total[some]
        return np.clip(scores, 0, 1)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    sample: int = labelled.SAMPLE,
    terms: int = TERMS,
    dims: int = DIMS,
    k: int = NEIGHBOURS,
) -> QualityModel:
    """A model of ``label`` (1: good). Without usable labels every score is 0.5."""
    chosen = labelled.materialize_terms(labelled.sample_labelled(docs, labels, label, sample), analyze)
    common = labelled.term_labels(chosen).withColumn("n", F.col("pos") + F.col("neg"))
    top = common.filter(F.col("n") >= LEAST_DOCUMENTS).orderBy(F.desc("n"), "term").limit(terms).collect()
    vocabulary = sorted(bytes(r["term"]) for r in top)
    count, frequency = labelled.document_frequency(docs, vocabulary, analyze)
    idf = np.log((1 + count) / (1 + frequency)) + 1
    numbers = {t: i for i, t in enumerate(vocabulary)}
    rows = sorted(labelled.restricted(chosen, numbers), key=lambda r: r[0])
    model = QualityModel(
        numbers, idf, np.zeros((len(idf), 0)), np.zeros((0, 0)), np.array([r[1] for r in rows], dtype=np.float64), k
    )
    matrix = model.vectors([r[2] for r in rows])
    values, vectors = np.linalg.eigh(matrix.T @ matrix)
    model.basis = vectors[:, ::-1][:, :dims][:, values[::-1][:dims] > 1e-9]
    model.examples = labelled.unit_rows(matrix @ model.basis)
    return model


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """One row (doc_id, score) per row of ``docs``; null and empty texts get the share of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch):
        yield [batch.column(0), shared.value.score(text_bytes(batch.column(1)))]

    return mapped(texts(docs), run, "doc_id long, score double")


def score_column(docs: DataFrame, model: QualityModel) -> Column:
    """The score of the column ``text`` of ``docs``, for filters that keep all other columns."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(column: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score([(t or "").encode() for t in column]))

    return scored(docs["text"].cast("string"))

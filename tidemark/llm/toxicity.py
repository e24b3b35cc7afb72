"""Toxicity by the nearest labelled examples, searched exactly by TF-IDF cosine in a block-max inverted index.

Fitting: at most ``sample`` labelled documents become examples. Terms are words, word beginnings, and marks for terms
that occur twice or four times; those that tell the labels apart by a chi-square test are kept (at most
``terms``). One more term of fixed weight stands in every document, so that a document with a single weak
term lies near those without any. Inverse document frequencies count all
documents. The examples' postings are cut into blocks with the largest weight of each term per block; a
query sums those maxima to an upper bound per block and visits blocks in falling order until the k-th best
similarity exceeds every bound left, which is exact. Examples stand in the order of their heaviest term, so that a block
holds like ones and its bound is tight; of equal vectors only the first k + 1 are indexed, since ties go to the first and no
further one can be a neighbour. Votes weigh 1/distance; a logistic curve fitted to leave-one-out votes of all examples
makes them probabilities. Index and examples are bounded by the parameters and broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import labelled
from tidemark.llm.common import mapped, small_batches, text_bytes, texts
from tidemark.llm.invindex import words

TERMS = 1024
CHI_SQUARE = 30.0  # some one in ten million by chance
NEIGHBOURS = 15
BLOCK = 16
VISIT_FIRST = 2
SLACK = 1e-8  # similarities are rounded to nine digits, bounds are not
SOFTEN = 0.05
PREFIXES = (4, 5, 6, 7, 8)
LEVELS = (2, 4)
COMMON_WEIGHT = 8.0


class Known:
    """The words and word beginnings that a fitted model asks for."""

    def __init__(self, terms: Iterable[bytes] = ()):
        plain = {t.partition(b"#")[0] for t in terms}
        starts = {t[:-1] for t in plain if t.endswith(b"*")}
        self.words = frozenset(t for t in plain if not t.endswith(b"*"))
        self.starts = {n: frozenset(s for s in starts if len(s) == n) for n in PREFIXES}


def analyze(text: bytes, known: Known | None = None) -> dict[bytes, int]:
    """Counts of words and of the beginnings (a trailing star) of longer words; ``term#2`` marks repeated terms.

    With ``known`` terms only those and their marks are counted.
    """
    single: dict[bytes, int] = {}
    for word in words(text):
        single[word] = single.get(word, 0) + 1
    counts = dict(single) if known is None else {w: single[w] for w in single.keys() & known.words}
    for size in PREFIXES:
        starts = None if known is None else known.starts[size]
        for word, count in single.items():
            start = word[:size]
            if (starts is None or start in starts) and len(word) > size:
                start += b"*"
                counts[start] = counts.get(start, 0) + count
    for term, count in list(counts.items()):
        for level in LEVELS:
            if count >= level:
                counts[term + b"#%d" % level] = 1
    return counts


@dataclass
class BlockMaxIndex:
    """Unit example vectors as postings by term, with the largest weight of each term in each block."""

    rows: np.ndarray  # all postings, term by term, each in row order
    weights: np.ndarray
    cuts: np.ndarray  # (terms, blocks + 1): where each block's postings of a term begin
    bounds: np.ndarray  # (terms, blocks)
    size: int

    @classmethod
    def build(cls, matrix: np.ndarray) -> BlockMaxIndex:
        size, terms = matrix.shape
        blocks = max(1, -(-size // BLOCK))
        term, row = np.nonzero(matrix.T)
        weights = matrix[row, term]
        bounds = np.zeros((terms, blocks))
        np.maximum.at(bounds, (term, row // BLOCK), weights)
        places = np.arange(terms)[:, None] * size + np.minimum(np.arange(blocks + 1) * BLOCK, size)[None, :]
        return cls(row, weights, np.searchsorted(term * size + row, places), bounds, size)

    def _scores(self, terms: np.ndarray, values: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        low, high = self.cuts[terms[:, None], blocks], self.cuts[terms[:, None], blocks + 1]
        count = (high - low).ravel()
        ahead = np.cumsum(count) - count
        at = np.repeat(low.ravel() - ahead, count) + np.arange(int(count.sum()))
        value = np.repeat(np.repeat(values, len(blocks)), count)
        return np.bincount(self.rows[at], weights=value * self.weights[at], minlength=self.size)

    def nearest(self, terms: np.ndarray, values: np.ndarray, k: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` best (rows, similarities > 0), of equal ones the first rows.

        Blocks are scored in falling order of their bounds, two, four, eight, ... at a time, until the next bound is below
        the k-th best similarity so far.
        """
        if not self.size:
            return np.empty(0, dtype=np.int64), np.empty(0)
        bounds = values @ self.bounds[terms]
        order = np.argsort(-bounds, kind="stable")
        order = order[bounds[order] > 0]
        scores = np.zeros(self.size)
        done, step, least = 0, VISIT_FIRST, 0.0
        while done < len(order):
            wanted = order[done : done + step]
            wanted = wanted[bounds[wanted] >= least - SLACK]
            if not len(wanted):
                break
            scores += np.round(self._scores(terms, values, wanted), 9)
            if 0 <= skip < self.size:
                scores[skip] = 0
            least = np.partition(scores, -k)[-k] if k <= self.size else 0.0
            done, step = done + step, step * 2
        best = np.argsort(-scores, kind="stable")[:k]
        best = best[scores[best] > 0]
        return best, scores[best]


@dataclass
class ToxicityModel:
    numbers: dict[bytes, int]
    idf: np.ndarray
    index: BlockMaxIndex
    labels: np.ndarray
    doc_ids: np.ndarray
    slope: float
    shift: float
    k: int

    known: Known = field(default_factory=Known)
    plain: tuple[float, np.ndarray, np.ndarray] | None = None  # the answer for texts without a term

    def vector(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        counts = analyze(text, self.known)
        return weigh({self.numbers[t]: counts[t] for t in counts.keys() & self.numbers.keys()}, self.idf)

    def vote(self, rows: np.ndarray, similarity: np.ndarray) -> float:
        if not len(rows):
            return 0.0
        weight = 1 / (1 - np.minimum(similarity, 1) + SOFTEN)
        return float(weight @ self.labels[rows] / weight.sum())

    def calibrated(self, vote: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * vote + self.shift, -50, 50))))

    def score(self, text: bytes) -> tuple[float, np.ndarray, np.ndarray]:
        """Probability, and the evidence: example rows with their similarities."""
        terms, values = self.vector(text)
        if len(terms) == 1 and self.plain is not None:
            return self.plain
        rows, similarity = self.index.nearest(terms, values, self.k)
        return self.calibrated(self.vote(rows, similarity)), rows, similarity


def weigh(counts: dict[int, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted term numbers and unit TF-IDF weights; the term that all documents hold comes last."""
    terms = np.array([*sorted(counts), len(idf)], dtype=np.int64)
    values = np.append([1 + np.log(counts[t]) for t in terms[:-1].tolist()] * idf[terms[:-1]], COMMON_WEIGHT)
    return terms, values / np.linalg.norm(values)


def similar_order(matrix: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Rows by their heaviest term but the common one, then by its weight, then by id; rows without a term last."""
    own = matrix[:, :-1]
    if not own.size:
        return np.argsort(ids, kind="stable")
    heaviest = own.max(axis=1)
    term = np.where(heaviest > 0, own.argmax(axis=1), own.shape[1])
    return np.lexsort((ids, -heaviest, term))


def first_of_equal(matrix: np.ndarray, count: int) -> np.ndarray:
    """Numbers of the rows that have fewer than ``count`` equal rows before them."""
    seen: dict[bytes, int] = {}
    kept = []
    for i, row in enumerate(matrix):
        key = row.tobytes()
        seen[key] = seen.get(key, 0) + 1
        if seen[key] <= count:
            kept.append(i)
    return np.array(kept, dtype=np.int64)


def logistic(votes: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton steps on smoothed targets; a little damping keeps them finite."""
    pos = labels.sum()
    target = np.where(labels == 1, (pos + 1) / (pos + 2), 1 / (len(labels) - pos + 2))
    x = np.stack([votes, np.ones(len(votes))], axis=1)
    weights = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -50, 50)))
        gradient = x.T @ (p - target) + 1e-3 * weights
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        weights -= np.clip(np.linalg.solve(hessian, gradient), -4, 4)
    if weights[0] <= 0:  # the votes tell nothing: nearly the share of label 1 for all
        share = (pos + 1) / (len(labels) + 2)
        return 1e-6, float(np.log(share / (1 - share)))
    return float(weights[0]), float(weights[1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    sample: int = labelled.SAMPLE,
    terms: int = TERMS,
    k: int = NEIGHBOURS,
) -> ToxicityModel:
    """A model of ``label`` (1: toxic). Without usable labels every score is 0.5."""
    chosen = labelled.materialize_terms(labelled.sample_labelled(docs, labels, label, sample), analyze)
    sizes = chosen.agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")).first()
    pos, neg = float(sizes["pos"] or 0), float(sizes["neg"] or 0)
    held, other = F.col("pos") + F.col("neg"), F.lit(pos + neg) - F.col("pos") - F.col("neg")
    gap = F.col("pos") * (F.lit(neg) - F.col("neg")) - F.col("neg") * (F.lit(pos) - F.col("pos"))
    chi = F.lit(pos + neg) * gap * gap / (F.lit(max(pos * neg, 1.0)) * held * F.greatest(other, F.lit(0.5)))
    ranked = labelled.term_labels(chosen).withColumn("chi", chi).filter(F.col("chi") >= CHI_SQUARE)
    top = ranked.orderBy(F.desc("chi"), "term").limit(terms).collect()
    vocabulary = sorted(bytes(r["term"]) for r in top)
    known = Known(vocabulary)
    count, frequency = labelled.document_frequency(docs, vocabulary, partial(analyze, known=known))
    idf = np.log((1 + count) / (1 + frequency)) + 1e-3
    numbers = {t: i for i, t in enumerate(vocabulary)}
    rows = sorted(labelled.restricted(chosen, numbers), key=lambda r: r[0])
    matrix = np.zeros((len(rows), len(vocabulary) + 1))
    for i, (_, _, counts) in enumerate(rows):
        at, values = weigh(counts, idf)
        matrix[i, at] = values
    order = similar_order(matrix, np.array([r[0] for r in rows], dtype=np.int64))
    matrix, rows = matrix[order], [rows[i] for i in order]
    y = np.array([r[1] for r in rows], dtype=np.float64)
    kept = first_of_equal(matrix, k + 1)
    ids = np.array([r[0] for r in rows], dtype=np.int64)
    model = ToxicityModel(numbers, idf, BlockMaxIndex.build(matrix[kept]), y[kept], ids[kept], 1.0, 0.0, k, known)
    place = {int(i): at for at, i in enumerate(kept)}
    votes = np.zeros(len(rows))
    for i, row in enumerate(matrix):
        at = np.flatnonzero(row)
        votes[i] = model.vote(*model.index.nearest(at, row[at], k, skip=place.get(i, -1)))
    if len(rows):
        model.slope, model.shift = logistic(votes, y)
    model.plain = model.score(b"")
    return model


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """One row per row of ``docs``: doc_id, score, and the evidence (example doc_ids and similarities).

    Null and empty texts have no evidence and get the score of a text without any; so do texts without a term
    of the vocabulary. Equal texts get equal scores.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch):
        found = [shared.value.score(t) for t in text_bytes(batch.column(1))]
        near = [shared.value.doc_ids[rows].tolist() for _, rows, _ in found]
        yield [batch.column(0), [f[0] for f in found], near, [f[2].tolist() for f in found]]

    schema = "doc_id long, score double, evidence array<long>, similarities array<double>"
    return mapped(texts(docs), run, schema)


def score_column(docs: DataFrame, model: ToxicityModel) -> Column:
    """The score of the column ``text`` of ``docs``, for filters that keep all other columns."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(column: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score((t or "").encode())[0] for t in column], dtype="float64")

    return scored(docs["text"].cast("string"))

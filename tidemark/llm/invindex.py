"""Benchmark decontamination over a distributed positional inverted index.

The index is cut by documents: a task packs consecutive documents into segments of a bounded number of words and
stores one row per segment, with the sorted positions (posting list) of every benchmark term in it, the
document starts and the term counts. Document frequencies come from the stored counts. A phrase is searched
in a segment by intersecting the offset-adjusted posting lists from its rarest term on, so most phrases end
after one or two short lists; no posting leaves its segment and nothing is shuffled.

The benchmark's terms and phrases are broadcast in slices of at most ``SLICE_WORDS`` words. A larger benchmark
takes several slices over the same stored index, whose matches are merged per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, text_bytes, texts

WINDOW = 10
SEGMENT_WORDS = 1 << 20  # a segment ends with the document that reaches this
SLICE_WORDS = 1 << 21
SLACK = 0

# Word characters are 0-9, a-z (A-Z lower-cased first) and everything beyond ASCII.
_CLEAN = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words(text: bytes) -> list[bytes]:
    return text.translate(_CLEAN).split()


INDEX_SCHEMA = (
    "doc_ids array<long>, rows array<long>, starts array<int>, terms array<int>, counts array<int>, "
    "documents array<int>, positions array<int>"
)


def build_index(docs: DataFrame, vocabulary: list[bytes], segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """Stored segments of ``docs`` with the postings of ``vocabulary`` (term number: its place in the list).

    Per segment: ``doc_ids``, ``rows`` (the column ``uid`` of ``docs``) and ``starts`` (word position of each document, and the end), ``terms`` that
    occur, their ``counts``, the number of ``documents`` that hold each, and all ``positions``, term by term.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast({term: i for i, term in enumerate(vocabulary)})

    def segment(ids: list, rows: list, parts: list[np.ndarray]) -> pa.RecordBatch:
        starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        codes = np.concatenate(parts) if parts else np.empty(0, dtype=np.int32)
        at = np.flatnonzero(codes >= 0)
        order = np.argsort(codes[at], kind="stable")
        positions = at[order]
        terms, first, counts = np.unique(codes[positions], return_index=True, return_counts=True)
        doc = np.searchsorted(starts, positions, side="right")
        fresh = np.ones(len(positions), dtype=np.int64)
        fresh[1:] = doc[1:] != doc[:-1]
        fresh[first] = 1
        holding = np.add.reduceat(fresh, first) if len(first) else first
        cells = [ids, rows, starts, terms, counts, holding, positions]
        kinds = [pa.int64()] * 2 + [pa.int32()] * 5
        arrays = [
            pa.array([c if isinstance(c, list) else c.astype(np.int32)], type=pa.list_(k))
            for c, k in zip(cells, kinds)
        ]
        return pa.RecordBatch.from_arrays(
            arrays, names=["doc_ids", "rows", "starts", "terms", "counts", "documents", "positions"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        ids, rows, parts, size = [], [], [], 0
        for batch in batches:
            columns = batch.column(0).to_pylist(), text_bytes(batch.column(1)), batch.column(2).to_pylist()
            for doc_id, text, row in zip(*columns):
                found = words(text)
                parts.append(np.fromiter((number(w, -1) for w in found), dtype=np.int32, count=len(found)))
                ids.append(doc_id)
                rows.append(row)
                size += len(found)
                if size >= segment_words:
                    yield segment(ids, rows, parts)
                    ids, rows, parts, size = [], [], [], 0
        if ids:
            yield segment(ids, rows, parts)

    return materialize(docs.select("doc_id", "text", "uid").mapInArrow(run, INDEX_SCHEMA), "postings")


def document_frequency(index: DataFrame) -> DataFrame:
    """(term, documents): in how many documents each term occurs, summed over the stored segments."""
    pairs = index.select(F.explode(F.arrays_zip("terms", "documents")).alias("p"))
    return pairs.groupBy(F.col("p.terms").alias("term")).agg(F.sum("p.documents").alias("documents"))


class Phrases:
    """Different phrases of one slice as (term, offset) lists, rarest term first, and the items they occur in."""

    def __init__(self, windows: dict[tuple[int, ...], set[int]], frequency: dict[int, int]):
        self.plans: list[tuple[list[tuple[int, int]], int, list[int]]] = []
        for window, items in windows.items():
            steps = sorted(((t, o) for o, t in enumerate(window)), key=lambda s: (frequency.get(s[0], 0), s[1]))
            if frequency.get(steps[0][0], 0):
                self.plans.append((steps, len(window), sorted(items)))


def _offsets(lists: dict[int, np.ndarray], steps: list[tuple[int, int]], slack: int) -> np.ndarray | None:
    """Starts whose terms stand at their offsets, each at most ``slack`` words later than in the phrase."""
    starts: np.ndarray | None = None
    for term, offset in steps:
        held = lists.get(term)
        if held is None:
            return None
        if starts is None:
            starts = held - offset
            if slack:
                starts = np.unique((starts[:, None] - np.arange(slack + 1)[None, :]).ravel())
        else:
            place = np.searchsorted(held, starts + offset)
            near = held[np.minimum(place, len(held) - 1)]
            starts = starts[(near >= starts + offset) & (near <= starts + offset + slack)]
        if not len(starts):
            return None
    return starts


MATCH_SCHEMA = "row long, doc_id long, n_words long, first array<int>, last array<int>, items array<int>"


def search(index: DataFrame, phrases: Phrases, slack: int = SLACK) -> DataFrame:
    """Exact (``slack`` 0) or proximity matches: one row per document, with the word ranges hit and item numbers.

    A match never crosses documents.
    """
    shared = index.sparkSession.sparkContext.broadcast(phrases.plans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for line in range(batch.num_rows):
                doc_ids, rows, starts, terms, counts, positions = (c[line].values for c in batch.columns)
                starts = starts.to_numpy().astype(np.int64)
                ends = np.cumsum(counts.to_numpy())[:-1]
                lists = dict(zip(terms.to_pylist(), np.split(positions.to_numpy().astype(np.int64), ends)))
                matches: dict[int, tuple[list[int], list[int], set[int]]] = {}
                for steps, length, items in shared.value:
                    found = _offsets(lists, steps, slack)
                    if found is None:
                        continue
                    doc = np.searchsorted(starts, found, side="right") - 1
                    last = found + length + slack
                    inside = (found >= starts[np.maximum(doc, 0)]) & (found >= 0)
                    inside &= found + length <= starts[np.minimum(doc + 1, len(starts) - 1)]
                    for d, a, b in zip(doc[inside].tolist(), found[inside].tolist(), last[inside].tolist()):
                        held = matches.setdefault(d, ([], [], set()))
                        held[0].append(int(a - starts[d]))
                        held[1].append(int(min(b, starts[d + 1]) - starts[d]))
                        held[2].update(items)
                size = len(doc_ids)
                none: tuple = ([], [], set())
                hits = [matches.get(d, none) for d in range(size)]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows,
                        doc_ids,
                        pa.array(np.diff(starts), type=pa.int64()),
                        pa.array([h[0] for h in hits], type=pa.list_(pa.int32())),
                        pa.array([h[1] for h in hits], type=pa.list_(pa.int32())),
                        pa.array([sorted(h[2]) for h in hits], type=pa.list_(pa.int32())),
                    ],
                    names=["row", "doc_id", "n_words", "first", "last", "items"],
                )

    cells = index.select("doc_ids", "rows", "starts", "terms", "counts", "positions")
    return cells.mapInArrow(run, MATCH_SCHEMA)


def _slices(benchmark: DataFrame, slice_words: int) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Benchmark items (id, words) streamed to the driver in slices of a bounded number of words."""
    held, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    for row in rows.filter("text is not null").toLocalIterator():
        found = words(row["text"].encode())
        if not found:
            continue
        held.append((row["item_id"], found))
        size += len(found)
        if size >= slice_words:
            yield held
            held, size = [], 0
    if held or not size:
        yield held


def matches(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slack: int = SLACK, slice_words: int = SLICE_WORDS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, ``first``/``last`` (word ranges hit), ``item_ids``.

    A phrase is ``window`` consecutive item words; an item of fewer words, but not none, is one phrase. Item
    ids are distinct and sorted as strings; items with a null id match under the empty id. Null and wordless
    texts have no words and no hits. Repeated rows each get their row. An empty benchmark hits nothing.
    """
    slices = _slices(benchmark, slice_words)
    items, following = next(slices), next(slices, None)
    numbered = texts(docs).withColumn("uid", F.monotonically_increasing_id())
    if following is not None:  # the slices' matches of a document meet by its number
        numbered = materialize(numbered, "numbered")
    found = None
    while items is not None:
        vocabulary = sorted({w for _, ws in items for w in ws})
        number = {w: i for i, w in enumerate(vocabulary)}
        windows: dict[tuple[int, ...], set[int]] = {}
        for place, (_, ws) in enumerate(items):
            codes = [number[w] for w in ws]
            for start in range(max(1, len(codes) - window + 1)):
                windows.setdefault(tuple(codes[start : start + window]), set()).add(place)
        index = build_index(numbered, vocabulary)
        frequency = {r["term"]: r["documents"] for r in document_frequency(index).toLocalIterator()}
        names = docs.sparkSession.sparkContext.broadcast(["" if i is None else str(i) for i, _ in items])
        part = _named(search(index, Phrases(windows, frequency), slack), names)
        found = part if found is None else _merge(found, part)
        items, following = following, next(slices, None)
    return found.drop("row")


def _named(found: DataFrame, names) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [sorted({names.value[i] for i in items}) for items in batch.column(5).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(ids, type=pa.list_(pa.string()))],
                names=[*batch.schema.names[:5], "item_ids"],
            )

    schema = MATCH_SCHEMA.replace("items array<int>", "item_ids array<string>")
    return found.mapInArrow(run, schema)


def _merge(one: DataFrame, two: DataFrame) -> DataFrame:
    """Matches of two slices of the benchmark, by document."""
    return one.union(two).groupBy("row", "doc_id", "n_words").agg(
        F.flatten(F.collect_list("first")).alias("first"),
        F.flatten(F.collect_list("last")).alias("last"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
    )


def contamination(found: DataFrame) -> DataFrame:
    """Digest of ``matches``: words hit by any phrase, number and hash of the items, and the verdict."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit, digest = [], []
            for first, last, items in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
                total, end = 0, 0
                for a, b in sorted(zip(first, last)):
                    total += max(0, b - max(a, end))
                    end = max(end, b)
                hit.append(total)
                digest.append(hashlib.sha256(",".join(items).encode()).hexdigest())
            counts = pa.array([len(i) for i in batch.column(4).to_pylist()], type=pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(hit, type=pa.int64()), counts, pa.array(digest),
                 pa.array([n > 0 for n in hit])],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    schema = (
        "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    )
    return found.select("doc_id", "n_words", "first", "last", "item_ids").mapInArrow(run, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold a benchmark phrase; all columns are kept.

    The verdict of a doc_id holds for all its rows; rows with a null doc_id are judged by their own text.
    """
    def clean(rows: DataFrame, key: Column) -> DataFrame:
        keyed = rows.select(key.alias("doc_id"), rows["text"].alias("text"))
        found = contamination(matches(keyed, benchmark, window)).filter("contaminated")
        hit = materialize(found.select(F.col("doc_id").alias("hit_id")).distinct(), "hits")
        return rows.join(hit, key == F.col("hit_id"), "left_anti")

    own, unnamed = docs.filter("doc_id is not null"), docs.filter("doc_id is null")
    kept = clean(own, own["doc_id"].cast("long"))
    # hashes of texts must not meet ids: rows without an id are judged apart
    return kept if unnamed.isEmpty() else kept.unionByName(clean(unnamed, F.xxhash64(unnamed["text"])))

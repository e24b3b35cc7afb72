"""Spelling variants: words one edit apart, found over bit-sliced position indexes.

A word is cut into three parts; one edit leaves two of them as they are, so near words share a key (the word
without one part) and Spark groups words by key. Inside a task the index words of many keys form a tile with one bitset per
(position, letter). A query is matched against a whole tile at once: the recurrences keep the set of words without an
error so far and the sets with one replaced, one additional or one lacking letter, whose positions are shifted by one.

A pair may share several keys; it counts at the first of them, told from the lengths of its common prefix and suffix.
A key with more than ``CROWD`` words is cut further, by single letters of its open part. Those keys are bounded by
the square of the alphabet, so no group grows with the vocabulary and no pair is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, small_batches, sorted_runs, texts

LETTERS = "[A-Za-zÀ-ÿ]"
PARTS = 3
CROWD = 4096  # index words of one key beyond which it is cut by letters
TILE_WORDS, TILE_LETTERS = 2048, 1 << 15  # bounds of one tile; a single longer word is a tile
QUERY_CELLS = 1 << 18  # 64-bit cells of one state of the recurrence


def word_counts(docs: DataFrame, letters: int = 7, least: int = 2, damage: int | None = 31) -> DataFrame:
    """(word, n) of the words of at least ``letters`` letters that occur ``least`` times or more.

    A word is a maximal run of letters, lower-cased in A-Z only. With ``damage`` a run loses one letter where the
    crc32 of ``<doc_id>:<run>`` is divisible by it (planted misspellings). A null text has no words, a null doc_id is
    an empty string before the colon; rows with equal ids all count.
    """
    run = F.explode(F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{max(1, letters)},}}"), F.lit(0)))
    rows = texts(docs).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), run.alias("run"))
    rows = rows.select("doc", F.translate("run", ascii_uppercase, ascii_lowercase).alias("word"))
    if damage:
        rows = rows.withColumn("h", F.crc32(F.concat("doc", F.lit(":"), "word")))
        cut = (F.col("h") % F.length("word")).cast("int")
        lacking = F.concat(F.substring("word", F.lit(1), cut), F.substring("word", cut + 2, F.length("word")))
        rows = rows.withColumn("word", F.when(F.col("h") % damage == 0, lacking).otherwise(F.col("word")))
    counts = rows.filter(F.length("word") >= letters).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= least)


def _edge(size: Column, part: int) -> Column:
    return F.floor(size * part / PARTS).cast("int")


def _key(size: Column, part: Column, low: Column, high: Column) -> Column:
    """Key of ``word`` for queries of ``size`` letters that may differ between ``low`` and ``high``."""
    tail = (size - high).cast("int")
    head = F.substring("word", F.lit(1), low)
    return F.xxhash64(size, part, low, high, head, F.substring("word", F.length("word") - tail + 1, tail))


def _coarse(words: DataFrame) -> DataFrame:
    """One row per (word, query length it may be near to, part): ``asks`` marks the rows that are queries as well."""
    own = F.length("word")
    sized = words.withColumn("own", own).withColumn("size", F.explode(F.array(own - 1, own, own + 1)))
    rows = []
    for part in range(PARTS):
        rows.append(F.struct(F.lit(part).alias("part"), _edge(F.col("size"), part).alias("low"), _edge(F.col("size"), part + 1).alias("high")))
    cut = sized.filter("size > 0").withColumn("p", F.explode(F.array(*rows))).select("word", "n", "own", "size", "p.*")
    cut = cut.filter("low + size - high <= own")
    return cut.withColumn("key", _key(F.col("size"), F.col("part"), F.col("low"), F.col("high")))


def _fine(rows: DataFrame) -> DataFrame:
    """Rows of crowded keys, once per letter of their open part."""
    letter = rows.withColumn("low", F.explode(F.sequence(F.col("low"), F.col("high") - 1)))
    letter = letter.withColumn("high", F.col("low") + 1).filter("low + size - high <= own")
    return letter.withColumn("key", F.xxhash64("key", _key(F.col("size"), F.col("part"), F.col("low"), F.col("high"))))


def code_points(words: list[str], width: int) -> np.ndarray:
    """Code points of each word, filled with zeros to ``width``."""
    return np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width)


class Tile:
    """Bitsets over some words: bit v of the slice of (position, letter) is set if word v has that letter there."""

    def __init__(self, words: list[str]):
        self.size = np.array([len(w) for w in words])
        self.cells = -(-len(words) // 64)
        self.points = code_points(words, max(1, int(self.size.max())))
        at, place = np.nonzero(self.points)
        code = (place.astype(np.uint64) << np.uint64(32)) | self.points[at, place]
        self.codes, row = np.unique(code, return_inverse=True)
        bits = np.zeros((len(self.codes) + 1, self.cells * 64), dtype=bool)
        bits[row, at] = True
        self.slices = self._packed(bits)  # the last row is empty: no word has that letter there

    def _packed(self, bits: np.ndarray) -> np.ndarray:
        return np.packbits(bits, axis=-1, bitorder="little").view(np.uint64)

    def _where(self, condition: np.ndarray) -> np.ndarray:
        bits = np.zeros(self.cells * 64, dtype=bool)
        bits[: len(condition)] = condition
        return self._packed(bits)

    def _match(self, letters: np.ndarray, place: int) -> np.ndarray:
        """For each letter the words that have it at ``place``."""
        if place < 0:
            return np.zeros((len(letters), self.cells), dtype=np.uint64)
        code = np.uint64(place << 32) | letters.astype(np.uint64)
        found = np.searchsorted(self.codes, code)
        hit = (found < len(self.codes)) & (self.codes[np.minimum(found, len(self.codes) - 1)] == code)
        return self.slices[np.where(hit, found, len(self.codes))]

    def near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, word) one edit apart; ``queries`` are code points, all of one length."""
        size = queries.shape[1]
        same = np.full((len(queries), self.cells), ~np.uint64(0))
        same &= self._where(np.ones(len(self.size), dtype=bool))
        replaced, lacking = np.zeros_like(same), np.zeros_like(same)
        longer = same & self._where(self.size > 0)
        for i in range(size):
            letters = queries[:, i]
            here = self._match(letters, i)
            there = self._where(self.size > i)
            replaced = (replaced & here) | (same & ~here & there)
            lacking = (lacking & self._match(letters, i - 1)) | same
            same = same & here
            longer = (longer & self._match(letters, i + 1)) | (same & self._where(self.size > i + 1))
        found = replaced & self._where(self.size == size)
        found |= longer & self._where(self.size == size + 1)
        found |= lacking & self._where(self.size == size - 1)
        query, cell = np.nonzero(found)
        bits = np.unpackbits(found[query, cell].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        entry, bit = np.nonzero(bits)
        return query[entry], cell[entry] * 64 + bit


def _common(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Length of the common beginning of each pair of rows of code points."""
    width = min(left.shape[1], right.shape[1])
    return np.logical_and.accumulate((left[:, :width] == right[:, :width]) & (left[:, :width] > 0), axis=1).sum(axis=1)


def _tiles(sizes: np.ndarray, keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold whole runs of ``keys``, as many as fit a tile."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    ends = np.r_[starts[1:], len(keys)]
    letters = np.r_[0, np.cumsum(sizes)]
    first = 0
    for i in range(len(starts)):
        last = i + 1 == len(starts)
        if last or ends[i + 1] - starts[first] > TILE_WORDS or letters[ends[i + 1]] - letters[starts[first]] > TILE_LETTERS:
            yield int(starts[first]), int(ends[i])
            first = i + 1


def _near_in(columns: dict[str, np.ndarray], start: int, end: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Accepted pairs (query row, index row) among the rows of one tile; all of one query length."""
    size = int(columns["size"][start])
    asks = start + np.flatnonzero(columns["own"][start:end] == size)
    if not len(asks):
        return
    step = start
    letters = np.r_[0, np.cumsum(columns["own"][start:end])]
    while step < end:  # more than one round only for a run of keys beyond a tile
        stop = int(np.searchsorted(letters, letters[step - start] + TILE_LETTERS, side="right")) - 1 + start
        stop = min(end, max(step + 1, stop), step + TILE_WORDS)
        words = columns["word"][step:stop].tolist()
        tile = Tile(words)
        back = code_points([w[::-1] for w in words], tile.points.shape[1])
        chunk = max(1, QUERY_CELLS // max(tile.cells, size // 8 + 1))
        for at in range(0, len(asks), chunk):
            rows = asks[at : at + chunk]
            queries = columns["word"][rows].tolist()
            points = code_points(queries, size)
            query, word = tile.near(points)
            same = columns["key"][rows[query]] == columns["key"][step + word]
            query, word = query[same], word[same]
            if not len(query):
                continue
            before = _common(points[query], tile.points[word])
            after = _common(code_points([q[::-1] for q in queries], size)[query], back[word])
            row = rows[query]
            first = np.full(len(query), -1)
            for part in reversed(range(PARTS)):
                low, high = size * part // PARTS, size * (part + 1) // PARTS
                first = np.where((low <= before) & (size - high <= after), part, first)
            low = size * columns["part"][row] // PARTS
            letter = np.maximum(low, size - 1 - after)
            kept = (first == columns["part"][row]) & (~columns["fine"][row] | (columns["low"][row] == letter))
            yield row[kept], step + word[kept]
        step = stop


def near_words(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(word, n_near, form_n, form) for each of the distinct ``words`` (word, n) with a near word.

    ``form`` is the near word with the largest n, the smallest in code-point order among equals.
    """
    small_batches(words.sparkSession)
    rows = _coarse(words)
    crowded = rows.groupBy("key").count().filter(F.col("count") > crowd).select("key")
    crowded = materialize(crowded, "crowded")
    plain = rows.withColumn("fine", F.lit(False))
    if not crowded.isEmpty():
        fine = _fine(rows.join(crowded, "key", "left_semi")).withColumn("fine", F.lit(True))
        plain = plain.join(crowded, "key", "left_anti").unionByName(fine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in sorted_runs(batches, ["size", "key"]):
            borders = np.flatnonzero(np.r_[True, columns["size"][1:] != columns["size"][:-1], True])
            found = []
            for begin, stop in zip(borders[:-1], borders[1:]):
                for start, end in _tiles(columns["own"][begin:stop], columns["key"][begin:stop]):
                    found += list(_near_in(columns, int(begin) + start, int(begin) + end))
            if not found:
                continue
            query, near = (np.concatenate([pair[i] for pair in found]) for i in (0, 1))
            if len(query):
                yield pa.RecordBatch.from_pydict(best(columns, query, near))

    def best(columns: dict[str, np.ndarray], query: np.ndarray, near: np.ndarray) -> dict:
        """Per query row the number of its near words and the best of them."""
        table = pa.table({"query": query, "n": columns["n"][near], "near": pa.array(columns["word"][near], pa.string())})
        table = table.sort_by([("query", "ascending"), ("n", "descending"), ("near", "ascending")])
        rows = table["query"].to_numpy()
        starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        firsts = table.take(pa.array(starts))
        return {
            "word": pa.array(columns["word"][rows[starts]], pa.string()),
            "n_near": np.diff(np.r_[starts, len(rows)]).astype(np.int64),
            "form_n": firsts["n"].combine_chunks(),
            "form": firsts["near"].combine_chunks(),
        }

    placed = plain.select("size", "key", "part", "low", "fine", "own", "word", "n")
    placed = placed.repartition("key").sortWithinPartitions("size", "key")
    found = placed.mapInArrow(run, "word string, n_near long, form_n long, form string")
    top = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), top.alias("top"))
    return merged.select("word", "n_near", (-F.col("top.less")).alias("form_n"), F.col("top.form").alias("form"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain word, form, form of the form, ... by doubling the steps each round.

    ``forms`` (word, form) holds only words with a form. Chains have no cycle, since n grows along them.
    """
    links = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        after = links.select(F.col("word").alias("root"), F.col("root").alias("after"))
        moved = links.join(after, "root", "left").select("word", F.coalesce("after", "root").alias("root"), F.col("after").isNotNull().alias("moved"))
        moved = materialize(moved, "roots")
        links = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return links


def variants(words: DataFrame, ratio: int = 10, crowd: int = CROWD) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each of the distinct ``words`` (word, n).

    A word's form is its near word of largest n if that is at least ``ratio`` times the word's n. Null words are left
    out; an empty table gives an empty result. Words of any length are taken, whole; further columns are ignored.
    """
    words = materialize(words.select("word", F.col("n").cast("long").alias("n")).filter("word is not null and word <> ''"), "words")
    near = near_words(words, crowd).withColumnRenamed("form_n", "most")
    joined = words.join(near, "word", "left").withColumn("has", F.coalesce(F.col("most") >= ratio * F.col("n"), F.lit(False)))
    joined = materialize(
        joined.select(
            "word",
            F.when(F.col("has"), F.col("form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(F.col("has"), F.col("most")).alias("form_n"),
        ),
        "near",
    )
    ends = roots(joined.filter("form is not null"))
    return joined.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

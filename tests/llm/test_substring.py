import random

import numpy as np
import pytest

from tidemark.llm import substring


def brute(docs, window=20):
    """Rows of plain word lists; equal (doc_id, text) rows are one document."""
    rows = [(substring.LAST if i is None else i, t, (t or "").split()) for i, t in docs]
    seen = {}
    for i, t, words in rows:
        for p in range(len(words) - window + 1):
            key = tuple(words[p : p + window])
            seen[key] = min(seen.get(key, (i, "", p, t)), (i, "", p, t), key=lambda k: (k[0], k[2]))
    out = []
    for (i, t, words), (doc_id, _) in zip(rows, docs):
        gone = set()
        for p in range(len(words) - window + 1):
            first = seen[tuple(words[p : p + window])]
            if (first[0], first[2]) < (i, p):
                gone |= set(range(p, p + window))
        out.append((doc_id, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return sorted(out, key=str)


def result(spark, docs, parts=3, **options):
    df = spark.createDataFrame([(i, t, "x", 7) for i, t in docs], "doc_id long, text string, kept string, goal int").repartition(parts)
    found = substring.remove_repeats(df, **options).collect()
    for r in found:
        spans = [(s["start"], s["length"]) for s in r["spans"]]
        assert sum(n for _, n in spans) == r["n_removed"]
        assert all(a + n < b for (a, n), (b, _) in zip(spans, spans[1:]))  # maximal: no two of them touch
    return sorted([(r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in found], key=str)


def corpus(rng, count, words=120):
    passages = [[f"p{rng.randrange(50)}" for _ in range(rng.randrange(5, 60))] for _ in range(6)]
    docs = [(1000, None), (1001, ""), (1002, " \t\n"), (None, "null id " * 30), (1003, "Ünïcode ÿ " * 40)]
    for i in range(count):
        text = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(words))]
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(text) + 1)
            text[at:at] = rng.choice(passages)
        docs.append((i - 3, rng.choice([" ", "  ", "\n", "\x0b"]).join(text)))
    return docs


@pytest.mark.parametrize("window", [20, 3, 1])
def test_equals_brute_force(spark, window):
    docs = corpus(random.Random(window), 60)
    assert result(spark, docs, window=window) == brute(docs, window)


def test_many_chunks_buckets_and_places(spark, monkeypatch):
    docs = corpus(random.Random(9), 80)
    monkeypatch.setattr(substring, "BUCKET_BYTES", 500)
    monkeypatch.setattr(substring, "PLACE_BYTES", 900)
    assert result(spark, docs, parts=8) == brute(docs)


def test_long_text_of_one_word_and_a_group_of_copies(spark):
    docs = [(0, "a " * 50000), (1, "a " * 30)] + [(2 + i, "copy of a passage that is long enough to be found again by its words in any other text " * 2) for i in range(300)]
    assert result(spark, docs) == brute(docs)


def test_repeated_rows_and_doc_ids(spark):
    text, other = " ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    docs = [(5, text), (5, text), (6, other), (6, "x " + other), (7, other)]
    found = {}
    for doc_id, _, removed, kept in result(spark, docs):
        found.setdefault(doc_id, []).append((removed, kept))
    assert found[5] == [(0, text), (0, text)]
    assert sorted(r for r, _ in found[6]) == [0, 40] and found[7] == [(40, "")]
    assert result(spark, [], window=20) == []


def test_packing_round_trip():
    rng = np.random.default_rng(2)
    columns = {n: np.sort(rng.integers(0, 1 << (8 * w - 1), 999).astype(f"<u{w}")) for n, w in substring.FIELDS}
    columns["tag"][:] = 0
    back = substring.unpack(substring.pack(columns, substring.FIELDS), 999, substring.FIELDS)
    assert all(np.array_equal(back[n], columns[n]) for n in columns)

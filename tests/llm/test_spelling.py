import random
import re
import zlib
from collections import Counter

import pytest

from tidemark.llm import spelling


def brute_words(docs, letters=7, least=2, damage=31):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall(f"{spelling.LETTERS}+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if damage and h % damage == 0:
                cut = h % len(word)
                word = word[:cut] + word[cut + 1 :]
            if len(word) >= letters:
                counts[word] += 1
    return {w: n for w, n in counts.items() if n >= least}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, ratio=10):
    forms, rows = {}, {}
    for w, n in counts.items():
        mates = [v for v in counts if near(w, v)]
        top = min(mates, key=lambda v: (-counts[v], v), default=None)
        if top and counts[top] >= ratio * n:
            forms[w] = top
        rows[w] = len(mates)
    out = []
    for w, n in counts.items():
        root = w
        while root in forms:
            root = forms[root]
        form = forms.get(w)
        out.append((w, form, root, n, rows[w], counts[form] if form else None))
    return sorted(out, key=str)


def result(spark, counts, **options):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    return sorted([tuple(r) for r in spelling.variants(df, **options).collect()], key=str)


@pytest.fixture(scope="module")
def vocabulary():
    rng = random.Random(3)
    words = set()
    for _ in range(60):
        base = "".join(rng.choice("abcÀé") for _ in range(rng.randrange(7, 15)))
        words.add(base)
        for _ in range(12):
            w = list(rng.choice(sorted(words)[-30:]) if rng.random() < 0.3 else base)
            at = rng.randrange(len(w))
            kind = rng.randrange(3)
            if kind == 0:
                w[at] = rng.choice("abcÀé")
            elif kind == 1:
                w.insert(at, rng.choice("abcÀé"))
            else:
                del w[at]
            words.add("".join(w))
    return {w: rng.choice([2, 3, 20, 25, 250, 3000]) for w in sorted(words)}


@pytest.mark.parametrize("crowd", [4096, 8, 0])
def test_variants_equal_brute_force(spark, vocabulary, crowd):
    assert result(spark, vocabulary, crowd=crowd) == brute(vocabulary)


@pytest.mark.parametrize("crowd", [4096, 0])
def test_short_repeated_and_very_long_words(spark, crowd):
    long = "ab" * (3000 if crowd else 30)
    counts = {w: n for n, w in enumerate(["a", "b", "aa", "ab", "aaa", "aab", "aaaa", "aaaaa", "aaaaab", "ÿ", "z" * 9, "z" * 10, long, long[1:], long + "c", "b" + long], 1)}
    assert result(spark, counts, ratio=2, crowd=crowd) == brute(counts, 2)


def test_tiles_are_cut_without_loss(spark, monkeypatch, vocabulary):
    from tidemark.llm.spelling import Tile, code_points

    words = sorted(vocabulary)
    tile = Tile(words)
    for size in (8, 9):
        asked = [w for w in words if len(w) == size]
        query, word = tile.near(code_points(asked, size))
        found = {(asked[q], words[v]) for q, v in zip(query.tolist(), word.tolist())}
        assert found == {(a, b) for a in asked for b in words if near(a, b)}


def test_query_on_documents_with_nulls_and_clashing_columns(spark):
    docs = [(1, "Abandon abandon, ABANDON abandonx1 ÀBANDON Àbandon"), (2, None), (None, "abandon abandon"), (3, ""), (3, "abandons abandons")]
    docs += [(10 + i, "abandon wonderful Wonderful wonderfull straße×÷ÿ straße×÷ÿ " * 3) for i in range(40)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, word string, n int")
    counts = brute_words(docs)
    assert {r["word"]: r["n"] for r in spelling.word_counts(df).collect()} == counts
    got = sorted([tuple(r) for r in spelling.variants(spelling.word_counts(df)).collect()], key=str)
    assert got == brute(counts) and any(r[1] for r in got)
    assert spelling.variants(spelling.word_counts(df.limit(0))).collect() == []

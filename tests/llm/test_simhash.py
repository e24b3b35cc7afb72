import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash
from tidemark.llm.components import connected_components


def brute_print(text, words=4):
    tokens = (text or "").encode().lower().split()
    shingles = [b" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))] if tokens else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_roots(size, linked):
    root = list(range(size))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(size):
        for j in range(i):
            if linked(i, j):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(size)]


def edited(tokens, rng, edits):
    out = list(tokens)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**6)}"
    return " ".join(out)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    texts = [None, "", " \t\n", "One", "one", "a b c", "Straße ÀÉ É", "word " * 30000]
    for _ in range(12):
        base = [f"w{rng.randrange(5000)}" for _ in range(300)]
        texts += [edited(base, rng, n) for n in (0, 0, 1, 1, 2, 4, 8, 20)]
    return [(i * 3, t) for i, t in enumerate(texts)]


def test_contract_against_brute_force(spark, corpus):
    docs = spark.createDataFrame([(*r, "x", 1) for r in corpus], "doc_id long, text string, w0 string, uid int")
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    prints = [brute_print(t) for _, t in corpus]
    roots = brute_roots(len(corpus), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    assert len(got) == len(corpus)
    for (doc, _), print_, root in zip(corpus, prints, roots):
        assert got[doc]["w0"] % 2**64 == print_
        assert got[doc]["component_id"] == corpus[root][0]


@pytest.mark.parametrize("chunk", [4, 2048])
def test_hot_keys_lose_no_link(spark, chunk):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 3, dtype=np.uint64)
    words = []
    for b in base:
        for _ in range(40):
            flips = rng.choice(64, rng.integers(1, 5), replace=False)
            words.append(int(b) ^ sum(1 << int(f) for f in flips))
    words = list(dict.fromkeys(words))
    signed = [w - 2**64 if w >= 2**63 else w for w in words]
    unique = spark.createDataFrame(list(zip(range(len(words)), signed)), "uid long, w0 long")
    got = {r["node"]: r["root"] for r in simhash.group_fingerprints(unique, simhash.SimHash(), chunk).collect()}
    roots = brute_roots(len(words), lambda i, j: (words[i] ^ words[j]).bit_count() <= 4)
    assert [got.get(i, i) for i in range(len(words))] == roots


def test_empty_table_and_null_ids(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.keep_one(none).count() == 0
    nulls = spark.createDataFrame([(None, "a"), (None, "a"), (4, "a"), (4, "a"), (9, "a")], "doc_id long, text string")
    assert [r["component_id"] for r in simhash.near_duplicates(nulls).collect()] == [4] * 5
    assert Counter(r["doc_id"] for r in simhash.keep_one(nulls).collect()) == {None: 2, 4: 1}


def test_keep_one_takes_the_first_of_each_component(spark):
    rng = random.Random(8)
    rows = []
    for group in range(10):
        base = [f"w{rng.randrange(9000)}" for _ in range(400)]
        rows += [(len(rows) + k, edited(base, rng, k), f"s{group}") for k in (0, 0, 1, 1, 2, 6)]
        rows = [(i, *r[1:]) for i, r in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    prints = [brute_print(r[1]) for r in rows]
    roots = brute_roots(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(roots))
    assert 10 <= len(set(roots)) < 50


def test_rows_of_one_id_keep_the_smallest_text_hash(spark):
    rows = [(3, f"text {i % 4} of several words here", str(i)) for i in range(8)] + [(4, "another one of more words", "x")]
    got = []
    for parts in (1, 5):
        docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(parts)
        got.append(sorted(tuple(r) for r in simhash.keep_one(docs).collect()))
    least = min(range(4), key=lambda i: spark.sql(f"select xxhash64('text {i} of several words here')").first()[0])
    assert got[0] == got[1] == [(3, f"text {least} of several words here", str(least)), (4, "another one of more words", "x")]


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, v) for v in range(101, 160)] + [(7, 7)]
    frame = spark.createDataFrame(edges, "src long, dst long")
    got = {r["node"]: r["root"] for r in connected_components(frame).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, **{i: 100 for i in range(100, 160)}}

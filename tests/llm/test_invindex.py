import hashlib
import random
import re

import pytest

from tidemark.llm import invindex


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(text, items, size=10):
    tokens, hit, found = words(text), set(), set()
    for item_id, item in items:
        ws = words(item)
        for p in range(max(1, len(ws) - size + 1)) if ws else ():
            window = ws[p : p + size]
            for i in range(len(tokens) - len(window) + 1):
                if tokens[i : i + len(window)] == window:
                    hit |= set(range(i, i + len(window)))
                    found.add("" if item_id is None else str(item_id))
    return len(tokens), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(7)
    vocabulary = ["the"] * 6 + [f"w{i}" for i in range(25)] + ["É", "été", "Å1"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 4, 9, 10, 11, 25])))) for i in range(25)]
    items += [(7, "the the the the the the the the the the the the"), (90, None), (91, ", . !"), (None, "w1-W2"), (5, items[5][1])]
    docs = []
    for i in range(120):
        tokens = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 80))]
        if i % 3 == 0:
            item = items[rng.randrange(25)][1].upper().replace(" ", rng.choice([", ", "\n", " "]))
            tokens.insert(rng.randrange(len(tokens) + 1), item)
        docs.append((i, " ".join(tokens)))
    docs += [(None, items[3][1]), (500, None), (501, ""), (502, "..."), (3, docs[0][1]), (503, "the " * 3000)]
    return docs, items


def frames(spark, tables):
    docs, items = tables
    docs = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, row int, items string")
    return docs.repartition(3), spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, doc_id int")


@pytest.mark.parametrize("slice_words", [1 << 20, 60])
def test_contract_against_brute_force(spark, tables, monkeypatch, slice_words):
    docs, items = frames(spark, tables)
    found = invindex.contamination(invindex.matches(docs, items, slice_words=slice_words)).collect()
    got = sorted((r["doc_id"] is None, r["doc_id"], *r[1:]) for r in found)
    expect = sorted((i is None, i, *brute(t, tables[1])) for i, t in tables[0])
    assert got == expect


def test_small_segments_and_proximity(spark):
    docs = spark.createDataFrame([(i, f"a{i} b{i} gap c{i} tail") for i in range(40)], "doc_id long, text string")
    docs = docs.selectExpr("doc_id", "text", "doc_id + 100 as uid").coalesce(1)
    vocabulary = [b"a7", b"b7", b"c7", b"tail"]
    index = invindex.build_index(docs, vocabulary, segment_words=30)
    assert index.count() > 3
    frequency = {r["term"]: r["documents"] for r in invindex.document_frequency(index).collect()}
    assert frequency == {0: 1, 1: 1, 2: 1, 3: 40}
    phrases = invindex.Phrases({(0, 1, 2): {0}}, frequency)
    assert all(not r["items"] for r in invindex.search(index, phrases).collect())
    near = {r["doc_id"]: r for r in invindex.search(index, phrases, slack=1).collect()}
    assert len(near) == 40 and [i for i in near if near[i]["items"]] == [7] and near[7]["row"] == 107


def test_empty_tables(spark, tables):
    docs, items = frames(spark, tables)
    assert invindex.contamination(invindex.matches(docs.limit(0), items)).count() == 0
    none = invindex.contamination(invindex.matches(docs, items.limit(0))).collect()
    assert len(none) == len(tables[0]) and not any(r["contaminated"] for r in none)


def test_decontaminate_keeps_columns_and_clean_rows(spark, tables):
    docs, items = frames(spark, tables)
    kept = invindex.decontaminate(docs, items)
    assert kept.columns == docs.columns
    clean = [i for i, t in tables[0] if not brute(t, tables[1])[4]]
    assert sorted(kept.collect(), key=str) == sorted((r for r in docs.collect() if r["doc_id"] in clean), key=str)


def test_a_null_row_is_not_taken_for_the_document_whose_id_is_its_hash(spark):
    passage = " ".join(f"b{i}" for i in range(12))
    items = spark.createDataFrame([("q1", passage)], "item_id string, text string")
    rows = [(42, passage), (None, None), (None, "clean words"), (None, f"x {passage} y"), (7, "clean")]
    kept = invindex.decontaminate(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(None, None), (None, "clean words"), (7, "clean")], key=str)

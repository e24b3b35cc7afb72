import random

import numpy as np
import pytest

from tidemark.llm import labelled, quality, toxicity

EXTRA = "doc_id long, text string, score double, y int, terms string"


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(9)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgkl" for b in "aeiou" for c in ("n", "r", "st", "mmer")]
    docs, labels = [], []
    for i in range(900):
        tokens = [rng.choice(vocabulary) for _ in range(rng.randrange(20, 120))]
        toxic, good = int(i % 6 == 0), int(i % 5 != 0)
        if toxic:
            for _ in range(4):
                tokens.insert(rng.randrange(len(tokens)), rng.choice(["vilefool", "rottenpest", "vilewretch"]))
        if not good:
            tokens = [t.upper() + "!!" for t in tokens] if i % 2 else [t for t in tokens for _ in range(6)]
        docs.append((i, " ".join(tokens), 0.5, 1, "x"))
        labels.append((i, good, toxic))
    docs += [(5000, None, 0.1, 0, "x"), (5001, "", 0.1, 0, "x"), (5002, " \n", 0.1, 0, "x"), (None, docs[7][1], 0.1, 0, "x")]
    docs += [docs[3], (5003, "bast " * 30000, 0.0, 0, "x")]
    labels += [(5000, None, 1), (None, 1, 1), (7, None, None), (123456, 0, 0)]
    return (
        spark.createDataFrame(docs, EXTRA),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        {r[0]: r for r in labels[:900]},
    )


def held(spark, docs):
    frame = docs.select("doc_id", labelled.held_out(docs["doc_id"]).alias("h"))
    return {r["doc_id"] for r in frame.filter("h").collect()}


@pytest.mark.parametrize("module, at, cut", [(quality, 1, 0.3), (toxicity, 2, 0.5)])
def test_held_out_accuracy_and_odd_rows(spark, corpus, module, at, cut):
    docs, labels, truth = corpus
    model = module.fit(docs, labels)
    rows = module.score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    fold = held(spark, docs)
    judged = [(r["score"] >= cut) == truth[r["doc_id"]][at] for r in rows if r["doc_id"] in fold and r["doc_id"] in truth]
    assert len(judged) > 100 and np.mean(judged) >= 0.97
    blank = {r["score"] for r in rows if r["doc_id"] in (5000, 5001, 5002)}
    assert len(blank) == 1
    kept = docs.withColumn("s", module.score_column(docs, model))
    assert sorted(r["s"] for r in kept.collect()) == sorted(r["score"] for r in rows)


def test_labels_of_the_held_out_fold_are_not_learned(spark, corpus):
    docs, labels, _ = corpus
    fold = held(spark, docs)
    sample = labelled.sample_labelled(docs, labels, "toxic").collect()
    assert not fold & {r["doc_id"] for r in sample} and len({r["text"] for r in sample}) == len(sample)
    assert labelled.sample_labelled(docs, labels, "toxic", 50).count() <= 50


@pytest.mark.parametrize("module", [quality, toxicity])
def test_empty_tables(spark, corpus, module):
    docs, labels, _ = corpus
    model = module.fit(docs, labels.limit(0))
    assert {r["score"] for r in module.score(docs, model).collect()} == {0.5}
    none = docs.limit(0)
    assert module.score(none, module.fit(none, labels)).count() == 0


def test_block_max_search_is_exact():
    rng = np.random.default_rng(1)
    matrix = rng.random((700, 40)) * (rng.random((700, 40)) < 0.15)
    matrix[::3] = matrix[0]
    matrix = labelled.unit_rows(matrix)
    index = toxicity.BlockMaxIndex.build(matrix)
    for query in labelled.unit_rows(rng.random((30, 40)) * (rng.random((30, 40)) < 0.2)):
        terms = np.flatnonzero(query)
        rows, similarity = index.nearest(terms, query[terms], 9)
        exact = np.sort(matrix @ query)[::-1][:9]
        assert np.allclose(similarity, exact[exact > 0], atol=1e-8)
        assert np.allclose(matrix[rows] @ query, similarity, atol=1e-8)


def test_document_frequency_counts_all_rows(spark, corpus):
    docs, _, _ = corpus
    vocabulary = [b"ban", b"nothing", b"vile*"]
    count, frequency = labelled.document_frequency(docs, vocabulary, toxicity.analyze)
    texts = [(r["text"] or "").encode() for r in docs.collect()]
    assert count == len(texts)
    assert frequency.tolist() == [sum(t in toxicity.analyze(x) for x in texts) for t in vocabulary]


def test_toxicity_scores_equal_plain_search(spark, corpus):
    docs, labels, _ = corpus
    model = toxicity.fit(docs, labels)
    sample = {r["doc_id"]: r for r in labelled.sample_labelled(docs, labels, "toxic").collect()}

    def dense(text):
        vector = np.zeros(len(model.idf) + 1)
        for term, count in toxicity.analyze((text or "").encode()).items():
            if term in model.numbers:
                vector[model.numbers[term]] = (1 + np.log(count)) * model.idf[model.numbers[term]]
        vector[-1] = toxicity.COMMON_WEIGHT
        return vector / np.linalg.norm(vector)

    examples = np.array([dense(sample[i]["text"]) for i in model.doc_ids.tolist()])
    everything = np.array([dense(r["text"]) for r in sample.values()])
    assert len(examples) < len(everything)
    for row in docs.select("text").collect():
        query = dense(row["text"])
        similarity = np.round(examples @ query, 7)
        best = np.argsort(-similarity, kind="stable")[: model.k]
        assert np.allclose(np.sort(everything @ query)[::-1][: model.k], similarity[best], atol=1e-6)
        weight = 1 / (1 - np.minimum(similarity[best], 1) + toxicity.SOFTEN)
        y = np.array([sample[i]["y"] for i in model.doc_ids[best].tolist()])
        want = 1 / (1 + np.exp(-(model.slope * (weight @ y / weight.sum()) + model.shift)))
        assert model.score((row["text"] or "").encode())[0] == pytest.approx(want, abs=1e-4)


def test_block_max_search_prunes_and_breaks_ties_by_row():
    rng = np.random.default_rng(4)
    matrix = np.zeros((600, 31))
    matrix[np.arange(600), rng.integers(0, 30, 600)] = rng.random(600)
    matrix[:, -1] = 1.0
    matrix = labelled.unit_rows(matrix)
    matrix = matrix[toxicity.similar_order(matrix, np.arange(600))]
    index = toxicity.BlockMaxIndex.build(matrix)
    scored = []
    plain = toxicity.BlockMaxIndex._scores
    index._scores = lambda terms, values, blocks: scored.append(len(blocks)) or plain(index, terms, values, blocks)
    for i in range(0, 600, 7):
        terms = np.flatnonzero(matrix[i])
        rows, _ = index.nearest(terms, matrix[i][terms], 9)
        assert rows.tolist() == np.argsort(-np.round(matrix @ matrix[i], 9), kind="stable")[:9].tolist()
    assert sum(scored) < 0.5 * len(range(0, 600, 7)) * index.bounds.shape[1]

"""Every stage against a plain version of its rule, on the smallest tables."""

import re
from collections import Counter
from itertools import combinations

import xxhash

import corpus_pipeline
from tidemark.llm import quality, toxicity
from tidemark.llm.common import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def fingerprint(text):
    tokens = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(tokens[i : i + 4]) for i in range(max(1, len(tokens) - 3))] if tokens else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def windows(text):
    tokens = words(text)
    return {tuple(tokens[i : i + 10]) for i in range(max(1, len(tokens) - 9))} if tokens else set()


def test_stages(spark, sf_small):
    docs = table(spark, sf_small, "documents")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (10**9, None, "en", None, 0), (10**9 + 1, "", "en", "s", 0)], docs.schema
    )
    docs = docs.union(odd).union(docs.orderBy("doc_id").limit(3))
    labels = table(spark, sf_small, "labels")
    stages = dict(corpus_pipeline.STAGES)

    before = docs.collect()
    model = quality.fit(docs, labels)
    kept = stages["quality"](spark, docs, sf_small)
    assert kept.columns == COLUMNS
    expect = Counter(r for r in before if model.score([(r["text"] or "").encode()])[0] >= 0.3)
    assert Counter(kept.collect()) == expect

    model = toxicity.fit(docs, labels)
    kept = stages["toxicity"](spark, docs, sf_small)
    expect = Counter(r for r in before if model.score((r["text"] or "").encode())[0] < 0.5)
    assert kept.columns == COLUMNS and Counter(kept.collect()) == expect

    kept = stages["near_duplicates"](spark, docs, sf_small)
    assert kept.columns == COLUMNS
    prints = {r["doc_id"]: fingerprint(r["text"]) for r in before if r["doc_id"] is not None}
    root = {i: i for i in prints}
    for a, b in combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 4 and root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            root = {i: low if r == high else r for i, r in root.items()}
    stay = Counter(r["doc_id"] for r in kept.collect())
    assert stay == Counter({**{r: 1 for r in set(root.values())}, None: 1})

    kept = stages["decontamination"](spark, docs, sf_small)
    benchmark = [windows(r["text"]) for r in table(spark, sf_small, "benchmark").collect()]
    short = {w for item in benchmark for w in item if len(w) < 10}
    full = {w for item in benchmark for w in item if len(w) == 10}

    def hit(text):
        tokens = words(text)
        return bool(full & windows(text)) or any(
            tuple(tokens[i : i + len(w)]) == w for w in short for i in range(len(tokens) - len(w) + 1)
        )

    assert kept.columns == COLUMNS
    assert Counter(kept.collect()) == Counter(r for r in before if not hit(r["text"]))

    bins = stages["packing"](spark, docs, sf_small).collect()
    sizes = Counter()
    for r in before:
        sizes[r["doc_id"]] += len((r["text"] or "").encode().split())
    packed = Counter()
    for r in bins:
        packed[r["doc_id"]] += r["length"]
    assert packed == sizes


def test_run(spark, sf_small):
    out = corpus_pipeline.run(spark, sf_small)
    assert out.columns == ["doc_id", "piece", "start", "length", "bin_id", "position"]
    ids = {r["doc_id"] for r in out.collect()}
    assert ids and ids < {r["doc_id"] for r in table(spark, sf_small, "documents").collect()}


def test_empty_tables(spark, sf_small, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, sf_small, name).limit(0).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

import random
import zlib

import numpy as np
import pytest

from tidemark.llm import tokenpack

public_tokenizers = pytest.importorskip("public_tokenizers")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("size", [0, 1, 127, 128, 129, 5000])
def test_file_round_trip(size):
    rng = np.random.default_rng(size)
    ids = rng.integers(0, 300, size).astype(np.uint32)
    if size:
        ids[rng.integers(0, size, size // 20 + 1)] = rng.integers(0, 2**32, size // 20 + 1)
    payload = tokenpack.write_file([None, 7], np.array([size // 2, size - size // 2]), ids)
    file = tokenpack.PackedFile(payload)
    assert file.doc_ids == [None, 7] and file.sizes.tolist() == [size // 2, size - size // 2]
    assert np.array_equal(file.ids(), ids)
    for _ in range(20):
        a, b = sorted(rng.integers(0, size + 1, 2))
        assert np.array_equal(file.ids(int(a), int(b)), ids[a:b])


def test_skewed_ids_are_small():
    ids = np.full(128 * 100, 5, dtype=np.uint32)
    ids[::50] = 2**31
    assert len(tokenpack.write_file([1], np.array([len(ids)]), ids)) < len(ids)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    return lambda text: [*tokenizer.encode(text, add_special_tokens=False).ids, 2]


ODD = [
    None, "", "  \n", "Don't STOP's 'tis it''s", "a<|endoftext|>b <|ENDOFTEXT|>", "x\x1cy z\x85w q\xa0r", "ΣΑΣ ẞ İ",
    "é é", "½ ²3 12a", "é­x", "µ ÀÇÉ ß", "　 日本語 text", "!!'s ...don", "😀 a😀b", "\x00 \x1f.",
]


def test_encoder_equals_library(library):
    rng = random.Random(2)
    alphabet = "aAbBsStTé' .,!<|>12\n\t́ÀΣ😀\x1c"
    batch = [t or "" for t in ODD] + ["".join(rng.choice(alphabet) for _ in range(60)) for _ in range(400)]
    encoder = tokenpack.Encoder(VOCABULARY, 2)
    encoder.LIMIT = 200
    for start in range(0, len(batch), 50):
        ids, sizes = encoder.encode(batch[start : start + 50])
        got = np.split(ids, np.cumsum(sizes)[:-1])
        for text, part in zip(batch[start : start + 50], got):
            assert part.tolist() == library(text), repr(text)


def test_a_full_store_keeps_the_common_chunks(library):
    """Words of every text are asked for once, however many rare ones pass; emptying the store would ask again."""
    rng = random.Random(3)
    common = ["".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(40)]
    batches = [
        [" ".join(common + ["".join(rng.choice("ijklmnop") for _ in range(9)) for _ in range(60)] + common)] for _ in range(12)
    ]
    encoder = tokenpack.Encoder(VOCABULARY, 2)
    encoder.LIMIT = 200
    asked, word = [], encoder._word
    encoder._word = lambda chunk: asked.append(chunk) or word(chunk)
    for batch in batches:
        ids, sizes = encoder.encode(batch)
        assert ids.tolist() == library(batch[0]) and sizes.tolist() == [len(ids)]
    assert max(asked.count(c) for c in common) == 1 and len(encoder.chunks) <= 200 + 100


def test_documents_in_order(spark, library, monkeypatch):
    rows = [(None, "null id"), *((i, t) for i, t in enumerate(ODD)), (3, "again"), (999, "long word " * 20000)]
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, start string, ids int")
    got = tokenpack.read_ids(spark, tokenpack.write_ids(docs.repartition(3), VOCABULARY)).collect()
    assert len(got) == len(rows)
    got.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in rows), key=lambda i: -1 if i is None else i)
    start = 0
    texts = {i: {tuple(library(t or "")) for j, t in rows if i == j} for i, _ in rows}
    for r in got:
        assert r["start"] == start and tuple(r["ids"]) in texts[r["doc_id"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes())
        start += r["n_tokens"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert tokenpack.read_ids(spark, tokenpack.write_ids(docs, VOCABULARY)).count() == 0

import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import trie


def rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]  # % as in SQL, towards zero
    return out


def brute(convs):
    """Node by node; totals go up one parent after another."""
    ids, members, parent, words = {}, [], [], []
    for c, turns in convs.items():
        at = None
        for d in range(len(turns) + 1):
            key = (at, turns[d - 1] if d else None)
            if key not in ids:
                ids[key] = len(members)
                members.append([])
                parent.append(at)
                words.append(len(turns[d - 1][1].encode().split()) if d else 0)
            at = ids[key]
            members[at].append((c, d))
    kids = [0] * len(members)
    for up in parent[1:]:
        kids[up] += 1
    leaves, saved = [0] * len(members), [0] * len(members)
    for i in range(len(members)):
        at = i
        while at is not None:
            leaves[at] += not kids[i]
            saved[at] += (len(members[i]) - 1) * words[i]
            at = parent[at]
    out = []
    for i, held in enumerate(members):
        ends = ",".join(str(c) for c, d in sorted(held) if len(convs[c]) == d)
        least = None if parent[i] is None else min(members[parent[i]])[0]
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(held)[0], held[0][1], least, len(held), kids[i], leaves[i], saved[i], digest))
    return sorted(out, key=str)


def result(spark, rows):
    schema = "conv_id long, turn long, role string, text string, node string, depth string"
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], schema)
    return sorted([tuple(r) for r in trie.prefix_trie(*trie.rebuilt_turns(df)).collect()], key=str)


def test_equals_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for c in range(-5, 130):
        if c % 20 == 0 and c % 40:
            continue  # an absent base
        for t in range(rng.randrange(1, 6)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "b c", "d  e\tf", "", None])))
    rows += [(131, None, "user", "null turn first"), (131, 0, "user", "a"), (None, 0, "user", "no conversation")]
    assert result(spark, rows) == brute(rebuilt(rows))


def test_long_conversation_and_a_group_of_copies(spark):
    rows = [(1000, t, "user", f"word {t % 3}") for t in range(700)]
    rows += [(c, t, "user", f"same words {t}") for c in range(40) for t in range(4)]
    rows += [(2000 + c, t, "user", f"word {t % 3}") for c in range(3) for t in range(300 + c)]
    assert result(spark, rows) == brute(rebuilt(rows))


def test_empty_and_turnless(spark):
    assert result(spark, []) == []
    turnless = next(c for c in range(1, 200) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3)
    assert result(spark, [(turnless, 0, "user", "a")]) == brute({turnless: []})


@pytest.mark.parametrize("shape", ["path", "star", "caterpillar", "random"])
def test_subtree_totals_of_any_shape_in_few_rounds(spark, shape, monkeypatch):
    rng = random.Random(1)
    size = 200
    parent = {"path": lambda i: i - 1, "star": lambda i: 0, "caterpillar": lambda i: i - 1 if i % 2 else max(0, i - 2), "random": lambda i: rng.randrange(i)}[shape]
    up = [None] + [parent(i) for i in range(1, size)]
    depth, paths = [0] * size, {}
    for i in range(1, size):
        depth[i] = depth[up[i]] + 1
    kids = {i: [j for j in range(size) if up[j] == i] for i in range(size)}
    line = lambda i: ([] if i is None else [*line(up[i]), i])
    for i in range(size):
        paths[i] = line(i)
    under = {i: [j for j in range(size) if i in paths[j]] for i in range(size)}
    nodes = spark.createDataFrame(
        [(i, i, depth[i], len(under[i]), 0, not kids[i], i * i) for i in range(size)],
        "node long, conv_id long, depth long, weight long, top long, childless boolean, value long",
    )
    steps = spark.createDataFrame(
        [(i, d, n, paths[i][d + 1] if d + 1 < len(paths[i]) else None) for i in range(size) for d, n in enumerate(paths[i])],
        "conv_id long, depth long, node long, next long",
    )
    rounds = []
    kept = trie.materialize
    monkeypatch.setattr(trie, "materialize", lambda df, label: (rounds.append(label), kept(df, label))[1])
    got = {r["node"]: r["value"] for r in trie.subtree_totals(nodes, steps, ["value"]).collect()}
    assert got == {i: sum(j * j for j in under[i]) for i in range(size)}
    assert rounds.count("split") <= 9  # log2(200) + 1


def test_digests_of_long_lists(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE_BYTES", 50)
    members = spark.range(5000).select((F.col("id") % 3).alias("node"), (F.col("id") - 2500).alias("conv_id"))
    got = {r["node"]: r["sha256"] for r in trie.listed_digests(members).collect()}
    for node in range(3):
        ids = ",".join(str(i - 2500) for i in range(5000) if i % 3 == node)
        assert got[node] == hashlib.sha256(ids.encode()).hexdigest()

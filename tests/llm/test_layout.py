"""Packing, sharding and archives."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import binpack, maglev, warc


def brute_fit(length, source, cluster, capacity):
    bins = []
    placed = []
    for n, s, c in zip(length, source, cluster):
        fitting = [b for b in bins if b["left"] >= n and s not in b["s"] and c not in b["c"]]
        best = min(fitting, key=lambda b: b["left"], default=None)
        if best is None:
            best = {"left": capacity, "s": set(), "c": set()}
            bins.append(best)
        placed.append((best["left"], n))
        best["left"] -= n
        best["s"].add(s)
        best["c"].add(c)
    return placed, len(bins)


@pytest.mark.parametrize("seed", range(4))
def test_best_fit_takes_the_tightest_compatible_bin(seed):
    rng = np.random.default_rng(seed)
    size = 600
    length = np.sort(rng.integers(1, 101, size))[::-1].copy()
    source, cluster = rng.integers(-5, 90, size) * (rng.random(size) < 0.6), rng.integers(0, 300, size)
    bins, offsets = binpack.best_fit(length, source, cluster, 100)
    expect, count = brute_fit(length.tolist(), source.tolist(), cluster.tolist(), 100)
    assert [(100 - o, n) for o, n in zip(offsets.tolist(), length.tolist())] == expect
    assert len(set(bins.tolist())) == count


def test_pack_keeps_everything(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["w%d" % rng.randrange(9)] * rng.randrange(0, 90)), rng.choice(["a", "b", None]), i) for i in range(800)]
    rows += [(None, "x y", "a", 0), (None, "x y", "a", 0), (7, "z " * 5000, "c", 0), (8, None, "c", 0), (9, "A b", "d", 1), (10, "a  B", "e", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, piece long")
    got = binpack.pack(binpack.measured(docs), capacity=64, group=100).collect()
    words = Counter()
    for i, text, *_ in rows:
        words[i] += len((text or "").split())
    packed = Counter()
    room, spans = Counter(), defaultdict(list)
    for r in got:
        packed[r["doc_id"]] += r["length"]
        if r["bin_id"] is None:
            assert r["length"] == 0
        else:
            room[r["bin_id"]] += r["length"]
            spans[r["bin_id"]].append((r["position"], r["length"], r["doc_id"]))
    assert packed == words and {r["doc_id"] for r in got} == {r[0] for r in rows}
    assert max(room.values()) <= 64
    source = {i: s for i, _, s, _ in rows}
    for held in spans.values():
        end = 0
        for position, length, _ in sorted(held):
            assert position == end
            end += length
        owners = [d for _, _, d in held if d is not None]
        assert len({source[d] for d in owners}) == len(owners)
        assert not {9, 10} <= set(owners)
    assert binpack.pack(binpack.measured(docs.limit(0))).count() == 0


def brute_table(shards, size):
    import hashlib

    order = []
    for name in shards:
        w = hashlib.sha256(name.encode()).digest()
        start, skip = int.from_bytes(w[:8], "little") % size, int.from_bytes(w[8:16], "little") % (size - 1) + 1
        order.append([(start + j * skip) % size for j in range(size)])
    table = {}
    while len(table) < size:
        for shard in range(len(shards)):
            if len(table) < size:
                table[next(s for s in order[shard] if s not in table)] = shard
    return [table[s] for s in range(size)]


def test_lookup_table():
    for count, size in ((1, 2), (3, 7), (7, 101), (16, 499)):
        shards = [f"s{i}" for i in range(count)]
        table = maglev.lookup_table(shards, size)
        assert table.tolist() == brute_table(shards, size)
        held = np.bincount(table, minlength=count)
        assert held.max() - held.min() <= 1
    many = [f"n{i}" for i in range(100)]
    moved = np.mean(maglev.lookup_table(many) != maglev.lookup_table(many[:-1]))
    assert moved < 0.05
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            maglev.lookup_table(bad)
    with pytest.raises(ValueError):
        maglev.lookup_table(["a"], 100)


def test_placement(spark, tmp_path):
    rows = [(i, "t", "old") for i in range(2000)] + [(None, None, "old")] * 3 + [(5, "again", "old")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, shard string")
    shards = [f"s{i}" for i in range(11)]
    placed = maglev.place(frame, "doc_id", shards, 1009)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    got = placed.collect()
    assert len(got) == len(rows) and {r["shard"] for r in got} == set(shards)
    assert len({r["shard"] for r in got if r["doc_id"] is None}) == 1
    assert len({r["shard"] for r in got if r["doc_id"] == 5}) == 1
    assert maglev.place(frame.limit(0), "doc_id", shards).count() == 0
    maglev.write_shards(frame, "doc_id", shards, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(rows)


PAGES = "page_id long, url string, html string, digest string"


def pages(spark, count=700):
    rows = [(i, f"http://x/{i}", "<p>é" + "y" * (i % 50) + "</p>\r\n\r\nWARC/1.1\n", "d") for i in range(count)]
    rows += [(None, None, None, "d"), (3, "http://x/other", "", "d"), (4, "http://x/4", "copy", "d"), (4, "http://x/4", "copy", "d")]
    return spark.createDataFrame(rows, PAGES)


def test_archives_round_trip(spark, tmp_path):
    frame = pages(spark)
    warc.write_archives(frame, str(tmp_path / "w"), records=100)
    back = warc.read_archives(spark, str(tmp_path / "w"))
    found = Counter((r["url"], r["html"], r["digest"], r["length"]) for r in back.collect())
    record = warc.replica(frame).collect()
    expect = Counter((r["url"] or "", r["digest"], r["length"]) for r in record)
    assert Counter({(u, d, n): c for (u, _, d, n), c in found.items()}) == expect
    html = Counter((r["url"] or "", r["html"] or "") for r in frame.collect())
    assert Counter({k: 0 for k in html}) | Counter(x[:2] for x in found.elements()) == html
    for file in {r["file"] for r in back.select("file").distinct().collect()}:
        rows = sorted((r["offset"], r["length"]) for r in back.filter(back.file == file).collect())
        assert all(a[0] + a[1] == b[0] for a, b in zip(rows, rows[1:])) and rows[0][0] == 0


def test_audit_finds_exactly_the_damage(spark):
    from pyspark.sql import functions as F

    frame = pages(spark)
    html = F.when(F.col("page_id").isin(0, 17, 555, 699), F.lit("bad")).otherwise(F.col("html"))
    html = F.when(F.col("page_id").isNull(), "was null").otherwise(html)
    other = frame.withColumn("html", html).filter("page_id is null or page_id not in (100, 101)")
    more = spark.createDataFrame([(9000, "http://x/new", "n", "d")], PAGES)
    got = warc.audit(warc.replica(frame), warc.replica(other.union(more))).collect()
    status = {(r["page_id"], r["url"]): r["status"] for r in got}
    expect = {(i, f"http://x/{i}"): "changed" for i in (0, 17, 555, 699)}
    expect |= {(i, f"http://x/{i}"): "missing" for i in (100, 101)}
    expect |= {(None, None): "changed", (9000, "http://x/new"): "extra"}
    assert status == expect
    first = {r["page_id"]: r for r in got}
    assert first[None]["offset"] == 0 and first[0]["offset"] == first[None]["length"]
    assert warc.audit(warc.replica(frame), warc.replica(frame)).count() == 0
    assert warc.audit(warc.replica(frame.limit(0)), warc.replica(frame.limit(0))).count() == 0
    assert warc.audit(warc.replica(frame.limit(0)), warc.replica(frame.limit(5))).count() == 5


def test_repeated_records_are_audited(spark):
    frame = pages(spark, 5)
    one = frame.limit(8).dropDuplicates(["page_id", "url"])
    got = warc.audit(warc.replica(frame), warc.replica(one)).collect()
    assert [(r["page_id"], r["status"]) for r in got] == [(4, "changed")]


def test_audit_reads_the_stored_bytes(spark, tmp_path):
    frame = pages(spark)
    for side in ("one", "two"):
        warc.write_archives(frame, str(tmp_path / side), records=100)
    paths = [str(tmp_path / side) for side in ("one", "two")]
    assert warc.audit_archives(spark, *paths, frame).count() == 0
    # 704 records by (page_id, url): the null id first, and an extra record for the ids 3 and 4 (twice)
    files = sorted(r["file"] for r in warc.read_archives(spark, paths[0]).groupBy("file").count().filter("count = 100").collect())
    assert len(files) == 7
    target, = (tmp_path / "two" / "archive=2").glob("part-*")
    data = bytearray(target.read_bytes())
    at, length, *_ = list(warc.parse_records(bytes(data)))[41]
    data[at + length - 6] ^= 1  # one bit of the payload of record 41 of file 2
    target.write_bytes(data)
    (crc,) = (tmp_path / "two" / "archive=2").glob(".part-*.crc")
    crc.write_bytes(checksums(data))
    row, = warc.audit_archives(spark, *paths, frame).collect()
    assert (row["archive"], row["record_no"], row["offset"], row["length"], row["status"]) == (2, 41, at, length, "changed")
    assert row["page_id"] == 241 - 4 and row["url"] == f"http://x/{row['page_id']}"


def checksums(data, size=512):
    """The checksum file that Hadoop keeps beside a local file."""
    sums = [zlib.crc32(bytes(data[i : i + size])) for i in range(0, len(data), size)]
    return b"crc\0" + size.to_bytes(4, "big") + b"".join(c.to_bytes(4, "big") for c in sums)


def archive_rows(spark, path):
    rows = warc.read_archives(spark, path).collect()
    return Counter((r["record_id"], r["digest"], r["length"]) for r in rows), rows


def test_compressed_archives_of_several_files_with_many_copies(spark, tmp_path, monkeypatch):
    frame = pages(spark, 120)
    hot = spark.createDataFrame([(7, "http://x/hot", "z" * 300, "d")] * 250 + [(8, None, None, "d"), (9, "http://x/9", "", "d")], PAGES)
    frame = frame.union(hot)
    warc.write_archives(frame, str(tmp_path / "plain"), records=100)
    monkeypatch.setattr(warc, "FILE_BYTES", 8000)
    warc.write_archives(frame, str(tmp_path / "packed"), records=100, compressed=True)
    monkeypatch.setattr(warc, "MOST_CUTS", 0)  # more file starts than are searched in memory
    warc.write_archives(frame, str(tmp_path / "joined"), records=100)
    want, _ = archive_rows(spark, str(tmp_path / "plain"))
    assert sum(want.values()) == frame.count() and max(want.values()) == 250
    for other in ("packed", "joined"):
        got, rows = archive_rows(spark, str(tmp_path / other))
        assert got == want
        assert any("archive=1-" in r["file"] for r in rows)
        assert warc.audit_archives(spark, str(tmp_path / "plain"), str(tmp_path / other), frame).count() == 0


def test_damage_to_a_packed_byte_reaches_one_record():
    plain = [f"WARC/1.1\r\nWARC-Record-ID: <{i}>\r\nContent-Length: 400\r\n\r\n{str(i) * 400}\r\n\r\n".encode() for i in range(3)]
    data = b"".join(warc._packed(record) + b"\0" for record in plain)
    whole = list(warc.stored_records(data))
    assert [r[3] for r in whole] == ["<0>", "<1>", "<2>"] and [r[1] for r in whole] == [len(r) for r in plain]
    start, end = len(warc._packed(plain[0])) + 1, len(warc._packed(plain[0] + b"")) + 1 + len(warc._packed(plain[1])) + 1
    for at in range(start, end):
        broken = bytearray(data)
        broken[at] ^= 4
        found = list(warc.stored_records(bytes(broken)))
        kept = {r[4] for r in found}
        assert whole[0][4] in kept and whole[2][4] in kept
        # bits that carry nothing (time and system in the header, padding before the trailer) leave the record as it is
        assert whole[1][4] not in kept or start + 4 <= at < start + 10 or at == end - 9
    assert [r[1] for r in warc.stored_records(data[:-5])][:2] == [len(r) for r in plain[:2]]


def test_long_records_take_several_members(monkeypatch):
    monkeypatch.setattr(warc, "MEMBER_BYTES", 100)
    record = b"WARC/1.1\r\nWARC-Record-ID: <a>\r\nContent-Length: 1000\r\n\r\n" + b"0123456789" * 100 + b"\r\n\r\n"
    (found,) = warc.stored_records(warc._packed(record) + b"\0")
    assert found[1] == len(record) and len(found[5]) == 1000


def test_descent_stays_below_differing_nodes(spark):
    from pyspark.sql import functions as F

    rows = spark.range(3000).select(
        F.col("id").cast("string").alias("record_id"), F.struct("id").alias("name"), F.lit(0).cast("long").alias("archive"),
        F.col("id").alias("record_no"), F.lit(0).cast("long").alias("offset"), F.lit(1).cast("long").alias("length"),
        F.sha2(F.col("id").cast("string"), 256).alias("digest"),
    )
    lost = rows.filter("record_no != 1234").withColumn("record_no", F.col("record_no") - (F.col("record_no") > 1234).cast("int"))
    one, two = warc.trees(rows, lost)
    assert one[-1].count() == two[-1].count() == 1
    first, second, compared = warc.descend(one, two)
    assert [r["record_id"] for r in first.collect()] == ["1234"] and second.count() == 0
    for level, (a, b) in enumerate(reversed(compared)):
        assert a.count() + b.count() < (600 if level == 0 else 400)
        if level + 1 < len(one):  # nothing below a node that has an equal is read
            equal = one[level + 1].join(two[level + 1].select("start", "hash"), ["start", "hash"], "left_semi")
            assert a.join(equal.select(F.col("start").alias(f"up_{level + 1}")), f"up_{level + 1}", "left_semi").count() == 0

"""WARC archives and the audit of replicas by hash trees.

``write_archives`` stores pages as archives of consecutive records, ``read_archives`` reads them file by file, and
``audit_archives`` compares two replicas from the bytes of their files. Each replica has a tree of its own over its ordered offset
ranges. A range of level k starts at a record whose id hashes to a multiple of ``FANOUT**k`` and ends before the
next one, in whatever file that lies. So the ids cut the ranges, and a record that one replica lost moves no range but
its own. A node's hash covers places, lengths and hashes of its children. The audit compares the two roots, and reads
level by level only what lies below nodes without an equal in the other replica, down to the damaged records.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, small_batches
from tidemark.plans.blocked import Scan, prefix_scan

FANOUT = 16
ARCHIVE = FANOUT**3  # records of one archive
FILE_BYTES = 64 << 20  # an archive with more bytes of records is cut into several files
MEMBER_BYTES = 8 << 20  # longer records take several gzip members
MOST_CUTS = 100_000  # file starts that are searched in memory; with more, rows meet their places in a join
_POSITION = (1 << 33) - 1  # row number within its partition, in monotonically_increasing_id
_PLACE_BITS = 24  # record number within its archive, in a position
KEY = ["page_id", "url", "hash"]


def _identity(page_id: Column, url: Column) -> Column:
    return F.md5(F.concat_ws("\n", page_id.cast("string"), url.cast("string")))


def record(page_id: Column, url: Column, html: Column) -> Column:
    """The WARC/1.1 resource record of a page as text; its UTF-8 bytes are the record. Nulls count as empty."""
    body = F.coalesce(html.cast("string"), F.lit(""))
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "),
        F.regexp_replace(F.coalesce(url.cast("string"), F.lit("")), "[\r\n]", ""),
        F.lit("\r\nWARC-Record-ID: <urn:md5:"),
        _identity(page_id, url),
        F.lit(">\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(header, body, F.lit("\r\n\r\n"))


def replica(pages: DataFrame) -> DataFrame:
    """(page_id, url, length, digest) of the records of ``pages``; texts leave each task only as digests."""
    whole = record(F.col("page_id"), F.col("url"), F.col("html"))
    return pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        F.octet_length(whole).cast("long").alias("length"),
        F.sha2(whole, 256).alias("digest"),
    )


def _numbered(rows: DataFrame, order: list[str], sums: list[str]) -> DataFrame:
    """``rows`` with ``<sum>_before`` for each of ``sums``: its total over all earlier rows by ``order``."""
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(placed.withColumn("mid", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("part", F.shiftright("mid", 33))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("mid").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("part").agg(*[F.sum(c).alias(c) for c in sums])
    ahead = totals.select("part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_ahead") for c in sums])
    joined = placed.join(F.broadcast(ahead), "part")  # a row per task
    before = [(F.col(f"{c}_ahead") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(f"{c}_before") for c in sums]
    return joined.select(*rows.columns, *before)


def _leaves(stored: DataFrame) -> DataFrame:
    """One row per record id of a replica: position of its first record, summed length, hash, name and place.

    The hash of repeated records covers their number, sum, least and largest digest.
    """
    mixed = F.sum(F.xxhash64("digest").cast("decimal(38,0)"))
    several = F.sha2(F.concat_ws(":", F.count(F.lit(1)), mixed, F.min("digest"), F.max("digest")), 256)
    return stored.groupBy("record_id").agg(
        F.min(F.shiftleft("archive", _PLACE_BITS) + F.col("record_no")).alias("position"),
        F.sum("length").alias("length"),
        F.when(F.count(F.lit(1)) == 1, F.min("digest")).otherwise(several).alias("hash"),
        F.min("name").alias("name"),
        F.min(F.struct("archive", "record_no", "offset")).alias("place"),
    )


def _tree(leaves: DataFrame, depth: int) -> list[DataFrame]:
    """The levels of a replica's tree, leaves first; the last one is the root (no row for an empty replica).

    Every node has start (of its range; the leaf's id hash at level 0), hash, length, position and up_1, ..., the starts of
    the ranges it lies in.
    """
    drawn = F.xxhash64("record_id").bitwiseAND(F.lit((1 << 63) - 1))
    rows = leaves.withColumn("start", drawn).withColumn("tree", F.lit(0))
    cuts = {
        f"up_{k}": Scan("last", F.when(F.col("start") % F.lit(FANOUT**k) == 0, F.col("start"))) for k in range(1, depth)
    }
    if cuts:
        rows = prefix_scan(rows, ["tree"], "position", cuts)
    ups = [F.coalesce(f"up_{k}", F.lit(-1)).alias(f"up_{k}") for k in range(1, depth)]
    named = [*leaves.columns, "start", *ups, F.lit(-1).cast("long").alias(f"up_{depth}")]
    levels = [materialize(rows.select(*named), "tree")]
    for k in range(1, depth + 1):
        child = F.struct("position", F.concat_ws(":", "start", "length", "hash").alias("h"))
        joined = F.concat_ws("|", F.transform(F.sort_array(F.collect_list(child)), lambda c: c["h"]))
        above = [f"up_{j}" for j in range(k + 1, depth + 1)]
        level = levels[-1].groupBy(F.col(f"up_{k}").alias("start"), *above).agg(
            F.sha2(joined, 256).alias("hash"), F.sum("length").alias("length"), F.min("position").alias("position")
        )
        levels.append(materialize(level, "tree"))
    return levels


def _without_equal(nodes: DataFrame, others: DataFrame) -> DataFrame:
    return nodes.join(others.select("start", "hash", "length"), ["start", "hash", "length"], "left_anti")


def descend(one: list[DataFrame], two: list[DataFrame]) -> tuple[DataFrame, DataFrame, list[tuple[DataFrame, DataFrame]]]:
    """The leaves of both trees that have no equal in the other, and the nodes that were compared on each level.

    A node with an equal has the same records in both replicas, so nothing below it is looked at. Below the others, a
    record of both replicas is never below a node with an equal in one of them alone.
    """
    compared = [(one[-1], two[-1])]
    found = _without_equal(*compared[0]), _without_equal(*reversed(compared[0]))
    for k in range(len(one) - 2, -1, -1):
        up = f"up_{k + 1}"
        below = tuple(
            materialize(tree[k].join(nodes.select(F.col("start").alias(up)).distinct(), up, "left_semi"), "below")
            for tree, nodes in zip((one, two), found)
        )  # stored, since each level is read for both replicas
        compared.append(below)
        found = _without_equal(*below), _without_equal(*reversed(below))
    return *found, compared


def trees(one: DataFrame, two: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """The trees of two replicas (record_id, name, archive, record_no, offset, length, digest), of equal depth."""
    leaves = [materialize(_leaves(side), "leaves") for side in (one, two)]
    most, depth = max(side.count() for side in leaves), 1
    while FANOUT**depth < most:
        depth += 1
    return _tree(leaves[0], depth), _tree(leaves[1], depth)


def _differences(one: DataFrame, two: DataFrame) -> DataFrame:
    """name, place in replica one (null if it lacks the record), length, status and both hashes of what differs."""
    first, second, _ = descend(*trees(one, two))
    a = first.select("record_id", F.col("name").alias("name_a"), "place", "length", F.col("hash").alias("digest_a"))
    b = second.select("record_id", F.col("name").alias("name_b"), F.col("hash").alias("digest_b"))
    status = F.when(F.col("digest_b").isNull(), "missing").when(F.col("digest_a").isNull(), "extra").otherwise("changed")
    return a.join(b, "record_id", "full_outer").select(
        "record_id", F.coalesce("name_a", "name_b").alias("name"), "place", "length", status.alias("status"), "digest_a", "digest_b"
    )


_PLACES = ["place.archive", "place.record_no", "place.offset", "length", "status", "digest_a", "digest_b"]


def audit(one: DataFrame, two: DataFrame) -> DataFrame:
    """Records that differ between two replicas (as from ``replica``), found from the roots down.

    page_id, url, archive, record_no and offset (the place in archives of replica one's records by page_id, url and digest;
    null if it lacks the record), length, status (changed, missing, extra) and both hashes. Equal replicas give no row.
    Null ids and urls are a record id of their own; repeated records of one id are one leaf.
    """

    def placed(side: DataFrame) -> DataFrame:
        rows = side.select("page_id", "url", "digest", "length", F.lit(1).alias("one"))
        rows = _numbered(rows, ["page_id", "url", "digest"], ["one", "length"])
        archive = F.floor(F.col("one_before") / ARCHIVE).cast("long").alias("archive")
        rows = rows.select(*side.columns, archive, "one_before", "length_before")
        bases = rows.groupBy("archive").agg(F.min("length_before").alias("base"))
        return rows.join(bases, "archive").select(
            F.to_json(F.struct("page_id", "url")).alias("record_id"), F.struct("page_id", "url").alias("name"), "archive",
            (F.col("one_before") % ARCHIVE).alias("record_no"), (F.col("length_before") - F.col("base")).alias("offset"),
            "length", "digest",
        )

    return _differences(placed(one), placed(two)).select("name.page_id", "name.url", *_PLACES)


def audit_archives(spark: SparkSession, one: str, two: str, pages: DataFrame) -> DataFrame:
    """The columns of ``audit`` for two replicas written by ``write_archives``, from the bytes of their files.

    archive, record_no, offset and length are the place among the records of replica one's archive, as if not compressed (the
    first record, where an id repeats); null if it lacks the record. ``pages`` (page_id, url) names the record ids that
    were found, which are hashes. A record whose id is not among them has a null page_id and the url of its header.
    """

    def stored(path: str, label: str) -> DataFrame:
        read = materialize(read_archives(spark, path, html=False), label)
        label_of = F.regexp_extract("file", r"archive=([0-9-]+)/", 1)
        begins = F.coalesce(F.get(F.split(label_of, "-"), F.lit(1)).cast("long"), F.lit(0))
        read = read.withColumn("archive", F.split(label_of, "-")[0].cast("long")).withColumn("begins", begins)
        earlier = Window.partitionBy("archive").orderBy("begins").rowsBetween(Window.unboundedPreceding, -1)
        files = read.groupBy("archive", "begins").agg(F.sum("length").alias("bytes"))
        files = files.select("archive", "begins", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("base"))
        return read.join(files, ["archive", "begins"]).select(
            "record_id", F.struct(F.lit(None).cast("long").alias("page_id"), "url").alias("name"), "archive",
            (F.col("begins") + F.col("record_no")).alias("record_no"), (F.col("base") + F.col("offset")).alias("offset"),
            "length", "digest",
        )

    found = materialize(_differences(stored(one, "replica-one"), stored(two, "replica-two")), "differences")
    names = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"))
    names = names.withColumn("record_id", F.concat(F.lit("<urn:md5:"), _identity(F.col("page_id"), F.col("url")), F.lit(">")))
    names = names.join(found.select("record_id"), "record_id", "left_semi").distinct().withColumn("known", F.lit(True))
    return found.join(names, "record_id", "left").select(
        "page_id", F.when(F.col("known"), F.col("url")).otherwise(F.col("name.url")).alias("url"), *_PLACES
    )


def _runs(ids: DataFrame, records: int) -> DataFrame:
    """Where each distinct (page_id, url, hash) goes: its copies as runs (index, n) with the label of their file.

    A run lies in one archive and one file; only keys with more copies than fit there have several.
    """
    ranked = _numbered(ids.withColumn("bytes", F.col("n") * F.col("length")), KEY, ["n"])
    last = F.col("n_before") + F.col("n") - 1
    cut = F.explode(F.sequence(F.floor(F.col("n_before") / records), F.floor(last / records))).alias("archive")
    runs = ranked.select(*KEY, "length", F.col("n_before").alias("at"), last.alias("last"), cut)
    runs = runs.withColumn("at", F.greatest("at", F.col("archive") * records))
    runs = runs.withColumn("last", F.least("last", (F.col("archive") + 1) * records - 1))
    step = F.greatest(F.lit(1), F.floor(F.lit(FILE_BYTES) / F.col("length")))
    runs = runs.withColumn("step", step).withColumn("index", F.explode(F.sequence("at", "last", "step")))
    runs = runs.withColumn("n", F.least(F.col("step"), F.col("last") - F.col("index") + 1))
    earlier = Window.partitionBy("archive").orderBy("index").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("n") * F.col("length")).over(earlier), F.lit(0))
    runs = runs.withColumn("file", F.floor(before / FILE_BYTES))
    begins = F.min("index").over(Window.partitionBy("archive", "file")) - F.col("archive") * records
    label = F.when(begins == 0, F.col("archive").cast("string")).otherwise(F.concat_ws("-", "archive", begins))
    first = begins + F.col("archive") * records == F.col("index")
    return runs.select(*KEY, "index", "n", label.alias("label"), first.alias("first"))


def _sortable(page_id: int | None, url: str | None, digest: int) -> tuple:
    """A key in the order of Spark's columns: nulls first, texts by their bytes."""
    return page_id is not None, page_id or 0, url is not None, (url or "").encode(), digest


def _packed(record: bytes) -> bytes:
    """A record as gzip members, without the last byte, which is zero and is added by the writer."""
    members = []
    for at in range(0, max(1, len(record)), MEMBER_BYTES):
        packer = zlib.compressobj(4, zlib.DEFLATED, 31)
        members.append(packer.compress(record[at : at + MEMBER_BYTES]) + packer.flush())
    return b"".join(members)[:-1]


def write_archives(pages: DataFrame, path: str, records: int = ARCHIVE, compressed: bool = False) -> None:
    """WARC archives of ``records`` records each under ``path`` (the last one may have fewer), written by Spark's committer.

    Records are cut by their exact rank by (page_id, url); archive k is the file in ``archive=k``. One with more than
    ``FILE_BYTES`` goes on in ``archive=k-m``, from its record m on. ``compressed`` makes each record a gzip member (a longer one
    than ``MEMBER_BYTES`` several), so that damage to a byte reaches one record only. Only ids and hashes are ranked; texts are
    shuffled once, packed, to the files. A key with more copies than fit a file is shuffled once and repeated there.
    """
    if records >= 1 << _PLACE_BITS:
        raise ValueError(f"an archive must have fewer than {1 << _PLACE_BITS} records")
    spark = pages.sparkSession
    whole = record(F.col("page_id"), F.col("url"), F.col("html"))
    placed = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), whole.alias("value"))
    placed = placed.withColumn("hash", F.xxhash64("value"))
    ids = placed.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("value")).cast("long").alias("length"))
    runs = materialize(_runs(ids, records), "runs")
    cuts = runs.filter("first")
    n_files = cuts.count()
    spread = runs.groupBy(*KEY).agg(F.count(F.lit(1)).alias("runs")).filter("runs > 1")
    few, renamed = n_files <= MOST_CUTS, [F.col(k).alias(f"{k}_") for k in KEY]
    same = F.lit(True)
    for k in KEY:
        same &= F.col(k).eqNullSafe(F.col(f"{k}_"))
    if spread.isEmpty():
        rows = placed if few else placed.join(runs.select(*renamed, "label"), same).drop(*[f"{k}_" for k in KEY])
        many = None
    else:
        kept = materialize(spread.select(*renamed), "copies")
        single = placed.join(kept, same, "left_anti")
        rows = single if few else single.join(runs.select(*renamed, "label"), same).drop(*[f"{k}_" for k in KEY])
        one = placed.join(kept, same, "left_semi").groupBy(*KEY).agg(F.min("value").alias("value"))
        many = one.join(runs.select(*renamed, "n", "label"), same).drop(*[f"{k}_" for k in KEY])
        many = many.select(*KEY, "value", "label", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).drop("col")
    starts, labels = [], []
    if few:  # at most MOST_CUTS rows
        for r in sorted(cuts.select(*KEY, "index", "label").toLocalIterator(), key=lambda r: r["index"]):
            starts.append(_sortable(*r[:3]))
            labels.append(r["label"])
    shared = spark.sparkContext.broadcast((starts, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, labels = shared.value
        for batch in batches:
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            keys = [columns[k].to_pylist() for k in KEY]
            if "label" in columns:
                found = columns["label"].to_pylist()
            else:
                found = [labels[bisect_right(starts, _sortable(*k)) - 1] for k in zip(*keys)]
            values = columns["value"].cast(pa.binary())
            values = [_packed(v.as_py()) for v in values] if compressed else [v.as_py()[:-1] for v in values]
            arrays = [pa.array(k, t) for k, t in zip(keys, (pa.int64(), pa.string(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(found, pa.string()), pa.array(values, pa.binary())], names=names)

    names = [*KEY, "archive", "value"]
    schema = "page_id long, url string, hash long, archive string, value binary"
    small_batches(spark)
    files = rows.mapInArrow(run, schema)
    if many is not None:
        files = files.unionByName(many.mapInArrow(run, schema))
    files = files.repartition("archive").sortWithinPartitions("archive", *KEY).select("archive", F.col("value").cast("string"))
    files.write.partitionBy("archive").option("lineSep", "\x00" if compressed else "\n").text(path)


_LENGTH = re.compile(rb"(?im)^Content-Length:\s*(\d+)")
_ID = re.compile(rb"(?im)^WARC-Record-ID:[ \t]*([^\r\n]*)")
_URI = re.compile(rb"(?im)^WARC-Target-URI:[ \t]*([^\r\n]*)")


def parse_records(data: bytes) -> Iterator[tuple[int, int, str, str, bytes]]:
    """(offset, length, uri, digest, payload) of the records of an archive; a broken tail is one last record."""
    at = 0
    while at < len(data):
        head = data.find(b"\r\n\r\n", at)
        size = _LENGTH.search(data, at, head) if head >= 0 else None
        end = head + 4 + int(size[1]) + 4 if size else len(data)
        end = min(end, len(data))
        uri = _URI.search(data, at, head) if head >= 0 else None
        whole = data[at:end]
        payload = data[head + 4 : max(head + 4, end - 4)] if size else b""
        yield at, end - at, uri[1].decode("utf-8", "replace") if uri else "", hashlib.sha256(whole).hexdigest(), payload
        at = end


_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00"  # how each gzip member of these archives begins


def _inflated(data: bytes, at: int, size: int = 1 << 16) -> tuple[bytes, int] | None:
    """The content and the end of the gzip member at ``at``; None if it is damaged."""
    member, parts = zlib.decompressobj(31), []
    try:
        while not member.eof:
            if at >= len(data):
                return None
            parts.append(member.decompress(data[at : at + size]))
            at = min(at + size, len(data)) - len(member.unused_data)
    except zlib.error:
        return None
    return b"".join(parts), at


def _salvaged(member: bytes, size: int = 256) -> bytes:
    """What can still be read of a damaged gzip member."""
    reader, parts = zlib.decompressobj(-15), []
    try:
        for at in range(10, len(member), size):
            parts.append(reader.decompress(member[at : at + size]))
    except zlib.error:
        pass
    return b"".join(parts)


def stored_records(data: bytes) -> Iterator[tuple[int, int, str, str, str, bytes]]:
    """(offset, length, uri, record id, digest, payload) of a file's records, plain or of gzip members.

    Offsets and lengths count the bytes as if not compressed. A damaged member is a record with what is still
    readable of it, and with the digest of the member's bytes; the records after it are read as ever.
    """

    def parsed(plain: bytes, base: int, digest: str | None = None) -> Iterator[tuple[int, int, str, str, str, bytes]]:
        for at, n, uri, own, payload in parse_records(plain):
            found = _ID.search(plain, at, max(at, at + n - len(payload)))
            yield base + at, n, uri, found[1].decode("utf-8", "replace") if found else "", digest or own, payload

    if not data.startswith(_MEMBER[:2]):
        yield from parsed(data, 0)
        return
    at, base, plain = 0, 0, []
    while at < len(data):
        member = _inflated(data, at)
        if member:
            plain.append(member[0])
            at = member[1]
            continue
        good = b"".join(plain)
        yield from parsed(good, base)
        base, plain = base + len(good), []
        end = data.find(_MEMBER, at + 1)
        end = len(data) if end < 0 else end
        broken = data[at:end]
        left = _salvaged(broken)
        uri, found = _URI.search(left), _ID.search(left)
        name = [m[1].decode("utf-8", "replace") if m else "" for m in (uri, found)]
        yield base, len(left), *name, hashlib.sha256(broken).hexdigest(), left
        base, at = base + len(left), end
    yield from parsed(b"".join(plain), base)


def read_archives(spark: SparkSession, path: str, html: bool = True) -> DataFrame:
    """(file, record_no, offset, length, url, record_id, digest[, html]) of the archives under ``path``, file by file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = data.as_py()
                for part in _chunks(stored_records(data), 256):
                    offset, length, uri, ids, digest, payload = zip(*(r for _, r in part))
                    columns = [
                        pa.array([file] * len(part)), pa.array([i for i, _ in part], type=pa.int64()),
                        pa.array(offset, type=pa.int64()), pa.array(length, type=pa.int64()), pa.array(uri),
                        pa.array(ids), pa.array(digest),
                    ]
                    if html:
                        columns.append(pa.array([p.decode("utf-8", "replace") for p in payload]))
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["file", "record_no", "offset", "length", "url", "record_id", "digest", *(["html"] if html else [])]
    schema = ", ".join(f"{n} {'long' if n in ('record_no', 'offset', 'length') else 'string'}" for n in names)
    small_batches(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(run, schema)


def _chunks(rows: Iterator, size: int) -> Iterator[list]:
    """Numbered rows in lists of at most ``size``."""
    numbered = enumerate(rows)
    while part := list(islice(numbered, size)):
        yield part

"""Shard placement by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size; the shards take turns, each
claiming the first slot of its order that is still free, until all slots are taken. Shards so differ by at most
one slot, and a changed shard list moves few slots. A document's slot is a hash of its key modulo the
table size: placement is one look-up in a broadcast table of ``size`` rows, and no row is shuffled.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZE = 65537


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: list[str], size: int = SIZE) -> np.ndarray:
    """The shard number of every slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be named and different")
    if not _is_prime(size) or size < len(shards):
        raise ValueError("the table size must be a prime not below the number of shards")
    words = [hashlib.sha256(name.encode()).digest() for name in shards]
    offset = np.array([int.from_bytes(w[:8], "little") % size for w in words])
    skip = np.array([int.from_bytes(w[8:16], "little") % max(size - 1, 1) + 1 for w in words])
    turn = [0] * len(shards)
    table = np.full(size, -1, dtype=np.int32)
    filled = 0
    while True:
        for shard in range(len(shards)):
            slot = (offset[shard] + turn[shard] * skip[shard]) % size
            while table[slot] >= 0:
                turn[shard] += 1
                slot = (offset[shard] + turn[shard] * skip[shard]) % size
            table[slot] = shard
            turn[shard] += 1
            filled += 1
            if filled == size:
                return table


def slot_of(key: Column, size: int = SIZE) -> Column:
    """A key's slot; equal keys share it, a null key has the slot of its hash too."""
    return F.pmod(F.xxhash64(key), F.lit(size)).cast("int")


def place(rows: DataFrame, key: str, shards: list[str], size: int = SIZE, slot: str = "slot", shard: str = "shard") -> DataFrame:
    """``rows`` with the columns ``slot`` and ``shard`` (name); other columns of these names are replaced.

    Any number of rows with one key, null included, go to one shard; place by a unique id to spread them.
    """
    spark = rows.sparkSession
    table = lookup_table(shards, size)
    slots = spark.createDataFrame(
        [(i, shards[s]) for i, s in enumerate(table.tolist())], "__slot int, __shard string"
    )
    slotted = rows.drop(shard).withColumn(slot, slot_of(F.col(key), size))
    joined = slotted.join(F.broadcast(slots), F.col(slot) == F.col("__slot"))
    return joined.drop("__slot").withColumnRenamed("__shard", shard)


def write_shards(rows: DataFrame, key: str, shards: list[str], path: str, size: int = SIZE) -> None:
    """Parquet folders ``shard=<name>`` under ``path``; each task writes to the shards it has rows of."""
    place(rows, key, shards, size).drop("slot").write.partitionBy("shard").parquet(path)

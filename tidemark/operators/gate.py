"""The drift gate over stored alarms, by pointer doubling.

An accepted alarm is followed by the first alarm at least ``cooldown`` later. That successor is the same whether or not the
alarm itself is accepted, so every alarm gets its link in one bucket join, and the accepted alarms are those that
links reach from the first one. Doubling the links finds them in as many rounds as the logarithm of their
number; no task holds a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.adwin import COOLDOWN, MIN_ROWS
from tidemark.plans.blocked import Scan, prefix_scan
from tidemark.session import materialize


def successors(nodes: DataFrame, keys: Sequence[str], cooldown: int) -> DataFrame:
    """(keys, at, next): for each alarm ``at`` the first alarm of its key at ``at + cooldown`` or later.

    That point lies in the next bucket of ``cooldown`` ids. Inside it a window over at most twice as many rows looks
    for the alarm; without one it is the first alarm of the next filled bucket, which a blocked scan carries.
    """
    keys = list(keys)
    placed = nodes.select(*keys, "at", F.expr(f"at div {cooldown}").alias("bucket"))
    firsts = placed.groupBy(*keys, "bucket").agg(F.min("at").alias("first")).withColumn("__back", -F.col("bucket"))
    filled = prefix_scan(firsts, keys, "__back", {"later": Scan("min", F.col("first"), exclusive=True)})
    filled = materialize(filled.select(*keys, "bucket", "later"), "buckets")
    points = placed.select(*keys, "bucket", F.col("at").alias("__point"), F.lit(None).cast("long").alias("__from"))
    asked = placed.select(*keys, F.col("bucket") + 1, F.col("at") + cooldown, "at")
    onwards = Window.partitionBy(*keys, "bucket").orderBy("__point").rangeBetween(Window.currentRow, Window.unboundedFollowing)
    found = points.union(asked).withColumn("__in", F.min(F.when(F.col("__from").isNull(), F.col("__point"))).over(onwards))
    found = found.filter("__from is not null").join(filled, [*keys, "bucket"], "left").withColumnRenamed("later", "__beyond")
    own = filled.select(*keys, (F.col("bucket") + 1).alias("bucket"), "later")
    # an empty next bucket: the first alarm after the own bucket lies beyond it
    exists = filled.select(*keys, "bucket", F.lit(True).alias("__filled"))
    found = found.join(own, [*keys, "bucket"], "left").join(exists, [*keys, "bucket"], "left")
    after = F.when(F.col("__filled"), F.col("__beyond")).otherwise(F.col("later"))
    return found.select(*keys, F.col("__from").alias("at"), F.coalesce("__in", after).alias("next"))


def gate_alarms(
    alarms: DataFrame,
    keys: Sequence[str],
    order: str = "instance_id",
    cooldown: int = COOLDOWN,
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """(keys, order, accepted): which of the raw ``alarms`` the gate would accept.

    An alarm is accepted after ``min_rows`` rows, at ``cooldown`` or later (the count starts at 0), and at least ``cooldown``
    after the last accepted one. Keys and order values must not be null; an alarm of a key appears once.
    """
    keys = list(keys)
    points = alarms.select(*keys, F.col(order).cast("long").alias("at"))
    nodes = materialize(points.filter(F.col("at") >= max(min_rows + 1, cooldown)), "alarms")
    jump = materialize(successors(nodes, keys, cooldown).filter("next is not null"), "links")
    found = nodes.groupBy(*keys).agg(F.min("at").alias("at"))
    while not jump.isEmpty():
        found = materialize(found.union(found.join(jump, [*keys, "at"]).select(*keys, "next")), "accepted")
        ahead = jump.select(*keys, F.col("at").alias("next"), F.col("next").alias("__next"))
        jump = materialize(jump.join(ahead, [*keys, "next"]).select(*keys, "at", F.col("__next").alias("next")), "links")
    marked = points.join(found.withColumn("accepted", F.lit(True)), [*keys, "at"], "left")
    return marked.select(*keys, F.col("at").cast(alarms.schema[order].dataType).alias(order), F.coalesce("accepted", F.lit(False)).alias("accepted"))

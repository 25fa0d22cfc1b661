"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``replicas`` arcs of a ring of 2**16 places; a row belongs to the arc its key's
hash falls on. A shard takes no more than its capacity: rows beyond it walk clockwise, arc by
arc, to the next shard with room. Own rows come before those that walk, and of an arc the rows
that come first on the ring stay.

Without ``slack`` the capacities add up to the number of rows, so counts differ by one at most.
With it (say 0.1) a shard holds up to 1.1 times the mean and fewer rows move when shards change.

Which rows walk follows from the number of rows per arc alone: those counts, as many as the ring
has arcs, are all that reaches the driver, and they come back as a short list of rank intervals.

Defined results: a null key is hashed like any other value; a null text has size 1 and the
checksum 0; rows that repeat a key are told apart by their checksum and then by their place in
the table, and may end in different shards if they lie where an arc overflows. An empty table
gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.durable import written
from tabloom.ranking import numbered

PLACE_BITS = 16


def _place(*of: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*of), 64 - PLACE_BITS).cast("int")


def ring(spark: SparkSession, shards: int, replicas: int) -> list[tuple[int, int]]:
    """(place, shard) of each virtual node, clockwise. Adding a shard adds nodes and moves none."""
    shard = F.floor(F.col("id") / replicas).alias("shard")
    nodes = spark.range(shards * replicas).select(shard, (F.col("id") % replicas).alias("replica"))
    return sorted(tuple(r) for r in nodes.select(_place(F.lit("node"), "shard", "replica"), "shard").collect())


def fill(counts: list[int], owners: list[int], capacity: list[int]) -> list[list[tuple[int, int]]]:
    """For each arc the (shard, rows) its rows go to, in the order of its rows."""
    free, left = list(capacity), list(counts)
    taken: list[list[tuple[int, int]]] = [[] for _ in counts]
    open_arcs = [a for a, n in enumerate(left) if n]
    step = 0
    while open_arcs:
        for arc in open_arcs:
            shard = owners[(arc + step) % len(owners)]
            if moved := min(left[arc], free[shard]):
                taken[arc].append((shard, moved))
                left[arc] -= moved
                free[shard] -= moved
        open_arcs = [a for a in open_arcs if left[a]]
        step += 1
    return taken


def assign_shards(
    documents: DataFrame,
    shards: int = 16,
    replicas: int = 64,
    slack: float = 0.0,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``key``, size, text_crc32, shard and slot (from 0 without gaps in each shard) of every row."""
    spark = documents.sparkSession
    nodes = ring(spark, shards, replicas)
    places = [p for p, _ in nodes]
    arc_of = ",".join(str(bisect_left(places, p) % len(nodes)) for p in range(1 << PLACE_BITS))
    content = F.coalesce(F.col(text), F.lit(""))
    rows = written(
        documents.select(
            F.col(key).alias("id"),
            F.octet_length(content).cast("bigint").alias("bytes"),
            F.crc32(F.encode(content, "utf-8")).alias("crc"),
            F.element_at(F.split(F.lit(arc_of), ",").cast("array<int>"), _place(F.col(key)) + 1).alias("arc"),
            F.xxhash64(key).alias("hash"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "ring-rows",
    )
    counts = [0] * len(nodes)
    for arc, n in rows.groupBy("arc").count().collect():
        counts[arc] = n
    total = sum(counts)
    if slack:
        capacity = [int(-(-total * (1 + slack) // shards))] * shards
    else:
        capacity = [total // shards + (s < total % shards) for s in range(shards)]

    intervals, first, used = [], 0, [0] * shards
    for arc, parts in enumerate(fill(counts, [s for _, s in nodes], capacity)):
        for shard, n in parts:
            intervals.append((arc, first, first + n, shard, used[shard] - first))
            first += n
            used[shard] += n
    ranges = spark.createDataFrame(intervals, "arc int, lo bigint, hi bigint, shard int, shift bigint")
    ranked = numbered(rows, ["arc", "hash", "id", "crc", "row"], "rank")
    # at most arcs + shards x steps intervals, whatever the table
    return ranked.join(F.broadcast(ranges), "arc").where("rank >= lo and rank < hi").select(
        F.col("id").alias(key),
        (F.col("bytes") + 1).alias("size"),
        F.col("crc").alias("text_crc32"),
        "shard",
        (F.col("rank") + F.col("shift")).alias("slot"),
    )

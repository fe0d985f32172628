"""Sharding by fixed virtual slots.

A record is hashed into one of some thousands of slots, for good. Which shard a
slot lies in is a small versioned table, the slot map; rebalancing edits that
map, so only the records of moved slots travel.

* ``slot_of``: the record's slot, from its identifier (a null one is replaced by its text).
* ``slot_sizes``: records and bytes per slot, one aggregated row each.
* ``first_map`` / ``rebalanced`` / ``grown`` / ``write_map`` / ``read_map``: the versions of the map.
* ``shard_documents``: every record with its shard and a gapless place in that shard.

Defined cases: a null text counts 0 bytes, every record has 8 more; repeated
rows each get a place; records with one identifier share a slot; an empty table
gives an empty result and a map of empty slots. All slots together are
``slots`` rows, a parameter, whatever the size of the table: only they reach
the driver.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from usageloom.llm.common import utf8_bytes, written

SLOTS = 16384
SHARDS = 24
OVERHEAD = 8
#: a map is balanced when the fullest shard is above the mean by at most this part
TOLERANCE = 0.002

MAP_SCHEMA = "version int, slot int, shard int, rows long, bytes long"


def slot_of(identifier: Column, text: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.when(identifier.isNotNull(), F.xxhash64(identifier)).otherwise(F.xxhash64(text)),
                  F.lit(slots)).cast("int")


def records_of(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Identifier, bytes, checksum and slot of each document: all that sharding needs of a text."""
    return docs.select(
        F.col("doc_id"),
        (F.coalesce(utf8_bytes(F.col("text")), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        slot_of(F.col("doc_id"), F.col("text"), slots).alias("virtual_slot"),
    )


def slot_sizes(records: DataFrame) -> DataFrame:
    return records.groupBy("virtual_slot").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"))


def first_map(sizes: dict[int, tuple[int, int]], slots: int = SLOTS, shards: int = SHARDS) -> list[tuple]:
    """Version 1: slots dealt round robin, known before any data."""
    return [(1, s, s % shards, *sizes.get(s, (0, 0))) for s in range(slots)]


def rebalanced(current: list[tuple], shards: int | None = None, tolerance: float = TOLERANCE) -> list[tuple]:
    """The next version: slots leave the fullest shard for the emptiest until sizes are near equal.

    A move takes the slot that brings the two nearest to each other; it stops
    when no move helps. Slots that stay keep their shard.
    """
    width = shards or max(r[2] for r in current) + 1
    held: list[dict[int, int]] = [{} for _ in range(width)]
    for _, slot, shard, _, size in current:
        held[shard][slot] = size
    totals = [sum(h.values()) for h in held]
    mean = sum(totals) / width
    while mean:
        high = max(range(width), key=lambda i: (totals[i], -i))
        low = min(range(width), key=lambda i: (totals[i], i))
        gap = totals[high] - totals[low]
        if totals[high] <= mean * (1 + tolerance) and totals[low] >= mean * (1 - tolerance):
            break
        movable = [(abs(gap / 2 - size), slot) for slot, size in held[high].items() if 0 < size < gap]
        if not movable:
            break
        slot = min(movable)[1]
        size = held[high].pop(slot)
        held[low][slot] = size
        totals[high] -= size
        totals[low] += size
    where = {slot: shard for shard, h in enumerate(held) for slot in h}
    return [(version + 1, slot, where[slot], rows, size) for version, slot, _, rows, size in current]


def grown(current: list[tuple]) -> list[tuple]:
    """The next version with one more shard, which takes slots from the fullest others and gives none back."""
    width = max(r[2] for r in current) + 1
    target = sum(r[4] for r in current) / (width + 1)
    held: list[list[tuple[int, int]]] = [[] for _ in range(width)]
    for _, slot, shard, _, size in current:
        held[shard].append((size, slot))
    fullest = [(-sum(s for s, _ in h), i) for i, h in enumerate(held)]
    heapq.heapify(fullest)
    moved, taken = set(), 0
    while fullest and taken < target:
        total, i = heapq.heappop(fullest)
        fits = [x for x in held[i] if 0 < x[0] <= target - taken]
        if not fits:
            continue
        size, slot = max(fits)
        held[i].remove((size, slot))
        moved.add(slot)
        taken += size
        heapq.heappush(fullest, (total + size, i))
    return [(v + 1, s, width if s in moved else shard, rows, size) for v, s, shard, rows, size in current]


def write_map(spark: SparkSession, rows: list[tuple], path: str) -> None:
    """Adds one version under ``path``; a version is written once and never changed."""
    frame = spark.createDataFrame(rows, MAP_SCHEMA)
    frame.drop("version").coalesce(1).write.mode("errorifexists").parquet(f"{path}/version={rows[0][0]}")


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{path}/version={version}")


def shard_documents(docs: DataFrame, map_path: str, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Every document with its shard and place there; stores map version 1 and the balanced version 2.

    The texts are read once; what follows moves some 30 bytes a record. A place
    is the slot's start within its shard, a sum over the slot table, plus the
    rank within the slot, so no task ever ranks a shard.
    """
    spark = docs.sparkSession
    records = written(records_of(docs, slots), "shard-records")
    sizes = {r["virtual_slot"]: (r["rows"], r["bytes"]) for r in slot_sizes(records).collect()}  # at most `slots` rows
    one = first_map(sizes, slots, shards)
    two = rebalanced(one, shards)
    write_map(spark, one, map_path)
    write_map(spark, two, map_path)
    in_shard = W.partitionBy("shard").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    starts = read_map(spark, map_path, 2).select(  # `slots` rows, so the broadcast is bounded
        F.col("slot").alias("virtual_slot"), "shard",
        F.coalesce(F.sum("rows").over(in_shard), F.lit(0)).alias("start"))
    rank = F.row_number().over(W.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return (
        records.withColumn("place", rank - 1)
        .join(F.broadcast(starts), "virtual_slot")
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("start") + F.col("place")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "virtual_slot",
        )
    )


def write_shards(docs: DataFrame, map_path: str, version: int, path: str, slots: int = SLOTS) -> None:
    """The documents themselves, one folder per shard, by a stored version of the map.

    Slots are the unit of the shuffle, so a shard is written by several tasks.
    """
    spark = docs.sparkSession
    kept = [F.col(c) for c in docs.columns if c not in ("virtual_slot", "shard")]
    where = read_map(spark, map_path, version).select(F.col("slot").alias("virtual_slot"), "shard")
    (docs.select(*kept, slot_of(F.col("doc_id"), F.col("text"), slots).alias("virtual_slot"))
     .join(F.broadcast(where), "virtual_slot")
     .repartition("virtual_slot").drop("virtual_slot")
     .write.partitionBy("shard").parquet(path))

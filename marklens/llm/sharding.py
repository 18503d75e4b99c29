"""Sharding by fixed virtual slots.

A record's key hashes into one of some thousand slots, for ever. A map gives each
slot's shard; it is the only thing that changes. Rebalancing edits the map by the
bytes per slot and stores it as a new version, so records move only where a slot
was moved.

Edge cases: a null text has 0 bytes; a record without key hashes by its text;
equal keys share a slot, equal texts under different keys need not; an empty table
leaves the map as it is.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLOTS = 8192
OVERHEAD = 16

MAP_SCHEMA = "version int, virtual_slot int, shard int"


def sized(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Key, size in bytes, checksum and virtual slot of every record."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    slot = F.pmod(F.xxhash64(F.coalesce("doc_id", "text_crc32")), F.lit(slots))
    return rows.withColumn("virtual_slot", slot.cast("int"))


def slot_sizes(records: DataFrame) -> DataFrame:
    """Bytes and records per slot; combined before the shuffle."""
    return records.groupBy("virtual_slot").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("records")
    )


def first_map(shards: int, slots: int = SLOTS) -> list[int]:
    """Version 1: slots dealt out in turn."""
    return [slot % shards for slot in range(slots)]


def rebalanced(shard_of: list[int], sizes: dict[int, int], shards: int) -> list[int]:
    """The map edited so that all shards hold near the same bytes.

    Slots of a sixteenth of the mean and more are seated first, large ones first: on
    their own shard if it stays within the mean with them, or if they are larger than
    the mean and it is empty; else on the shard with the least so far. Smaller slots
    then stay as long as they fit under the mean; the others go, large ones first, to
    the shard with the least. Works on slots, whose number is fixed, not on records.
    """
    goal = sum(sizes.values()) / shards
    load = [0] * shards
    edited, loose = list(shard_of), []
    for slot in sorted(range(len(shard_of)), key=lambda s: (-sizes.get(s, 0), s)):
        size, shard = sizes.get(slot, 0), shard_of[slot]
        stays = load[shard] + size <= goal or not load[shard] or not size
        if not stays and size * 16 < goal:
            loose.append(slot)
            continue
        if not stays:
            shard = edited[slot] = load.index(min(load))
        load[shard] += size
    heap = [(filled, shard) for shard, filled in enumerate(load)]
    heapq.heapify(heap)
    for slot in loose:
        filled, shard = heapq.heappop(heap)
        edited[slot] = shard
        heapq.heappush(heap, (filled + sizes[slot], shard))
    return edited


def grown(shard_of: list[int], sizes: dict[int, int], shards: int) -> list[int]:
    """The map for one more shard, which alone takes slots: small ones, always
    from the shard that has most left, until it holds its share."""
    load = [0] * shards
    slots: list[list[int]] = [[] for _ in range(shards)]
    for slot in sorted(range(len(shard_of)), key=lambda s: (-sizes.get(s, 0), s)):
        slots[shard_of[slot]].append(slot)
        load[shard_of[slot]] += sizes.get(slot, 0)
    goal, taken, edited = sum(load) / (shards + 1), 0, list(shard_of)
    heap = [(-filled, shard) for shard, filled in enumerate(load)]
    heapq.heapify(heap)
    while heap and taken < goal:
        filled, shard = heapq.heappop(heap)
        if not slots[shard]:
            continue
        slot = slots[shard].pop()
        size = sizes.get(slot, 0)
        edited[slot] = shards
        taken += size
        heapq.heappush(heap, (filled + size, shard))
    return edited


def store_map(spark: SparkSession, path: str, shard_of: list[int], version: int) -> None:
    """Add a version to the stored map; earlier versions stay."""
    rows = [(version, slot, shard) for slot, shard in enumerate(shard_of)]
    frame = spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1)
    frame.write.mode("append").parquet(path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the stored map, the latest by default."""
    versions = spark.read.schema(MAP_SCHEMA).parquet(path)
    if version is None:
        version = versions.agg(F.max("version")).first()[0]
    return versions.filter(F.col("version") == version)


def placed(records: DataFrame, slot_map: DataFrame, sizes: DataFrame) -> DataFrame:
    """Each record's shard and its place in the shard, without gaps from 0.

    A shard's slots follow each other, so only the records of one slot are
    numbered together. Map and sizes have a row per slot and are broadcast.
    """
    before = W.partitionBy("shard").orderBy("virtual_slot").rowsBetween(
        W.unboundedPreceding, -1
    )
    starts = sizes.join(slot_map, "virtual_slot").select(
        "virtual_slot",
        "version",
        "shard",
        F.coalesce(F.sum("records").over(before), F.lit(0)).alias("start"),
    )
    inside = W.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    numbered = records.withColumn("place", F.row_number().over(inside) - 1)
    found = numbered.join(F.broadcast(starts), "virtual_slot")
    return found.withColumn("slot", F.col("start") + F.col("place")).drop("start", "place")


def latest_map(spark: SparkSession, path: str, slots: int = SLOTS) -> tuple[int, list[int]]:
    """Number and shards of the latest stored version; one row per slot."""
    rows = read_map(spark, path).collect()
    shard_of = {row["virtual_slot"]: row["shard"] for row in rows}
    if len(shard_of) != slots or len(rows) != slots:
        raise ValueError(f"{path} holds {len(rows)} entries for {slots} slots")
    return rows[0]["version"], [shard_of[slot] for slot in range(slots)]


def rebalance_stored(
    spark: SparkSession, path: str, sizes: dict[int, int], shards: int, slots: int = SLOTS
) -> int:
    """Edit the latest stored map by the bytes per slot and store it as the next
    version, whose number is returned. An edit that moves nothing stores nothing."""
    version, shard_of = latest_map(spark, path, slots)
    edited = rebalanced(shard_of, sizes, shards)
    if edited != shard_of:
        version += 1
        store_map(spark, path, edited, version)
    return version


def shard_by_bytes(
    docs: DataFrame, path: str, shards: int = 40, slots: int = SLOTS, stored: bool = False
) -> DataFrame:
    """Put all records into shards of near equal bytes.

    Without a ``stored`` map in ``path`` the first one is stored there as version 1.
    The latest version is then edited. The driver gets one row per slot.
    """
    spark = docs.sparkSession
    records = sized(docs, slots)
    totals = slot_sizes(records).collect()
    sizes = {row["virtual_slot"]: row["bytes"] for row in totals}
    if not stored:
        store_map(spark, path, first_map(shards, slots), 1)
    version = rebalance_stored(spark, path, sizes, shards, slots)
    known = spark.createDataFrame(totals, "virtual_slot int, bytes long, records long")
    return placed(records, read_map(spark, path, version), known)

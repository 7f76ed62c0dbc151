"""Sharding through fixed virtual slots.

Records hash into a fixed number of slots. Bytes and rows are aggregated per slot, and a
versioned slot-to-shard map (at most `SLOTS` rows) says where each slot lives. Rebalancing
edits the map; records never change their slot.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affinity.session import scratch_path

SLOTS = 8192
ROW_BYTES = 16  # fixed value: a record's size is its UTF-8 bytes plus this


@dataclass(frozen=True)
class SlotMap:
    version: int
    shards: int
    shard_of: tuple[int, ...]  # by slot


def first_map(shards: int, slots: int = SLOTS) -> SlotMap:
    return SlotMap(1, shards, tuple(s % shards for s in range(slots)))


def rebalance(old: SlotMap, bytes_of: Mapping[int, int], shards: int | None = None) -> SlotMap:
    """The next version: slots are placed by falling size; a slot stays where it was if its
    shard keeps within the mean, else it goes to the lightest shard. No shard exceeds the
    mean by more than its last placed slot."""
    shards = shards or old.shards
    mean = sum(bytes_of.values()) / shards
    load = [0] * shards
    lightest = [(0, s) for s in range(shards)]
    placed = list(old.shard_of)
    for slot in sorted(range(len(placed)), key=lambda s: (-bytes_of.get(s, 0), s)):
        size, home = bytes_of.get(slot, 0), placed[slot]
        if home >= shards or load[home] + size > mean:
            while lightest[0][0] != load[lightest[0][1]]:  # entries of shards that grew meanwhile
                heapq.heapreplace(lightest, (load[lightest[0][1]], lightest[0][1]))
            home = lightest[0][1]
        placed[slot] = home
        load[home] += size
    return SlotMap(old.version + 1, shards, tuple(placed))


def store_map(spark: SparkSession, m: SlotMap, path: str) -> None:
    rows = [(slot, shard, m.shards) for slot, shard in enumerate(m.shard_of)]
    spark.createDataFrame(rows, "slot int, shard int, shards int").coalesce(1).write.parquet(
        f"{path}/version={m.version}"
    )


def load_map(spark: SparkSession, path: str, version: int) -> SlotMap:
    rows = spark.read.parquet(f"{path}/version={version}").orderBy("slot").collect()
    return SlotMap(version, rows[0]["shards"], tuple(r["shard"] for r in rows))


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and the virtual slot of every row. Null text: no bytes."""
    raw = F.encode(F.coalesce(F.col("text"), F.lit("")), "utf-8")
    return docs.select(
        "doc_id",
        (F.octet_length(raw) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
    ).withColumn("virtual_slot", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots)).cast("int"))


def shard_documents(
    docs: DataFrame, shards: int, slots: int = SLOTS, map_path: str | None = None
) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot, map_version, shard and `slot`, the row's
    place in its shard (gapless from 0).

    Law `bytes`: the shards' sizes are near equal. Both map versions (by slot number, then
    edited for the measured bytes) are stored under `map_path`. Nulls in any column are
    data like any other; repeated rows share a virtual slot and get places of their own; an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    rec = records(docs, slots)
    loads = {
        r["virtual_slot"]: (r["bytes"], r["rows"])  # at most `slots` rows
        for r in rec.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()
    }
    path = map_path or scratch_path(spark, "slot-map")
    first = first_map(shards, slots)
    current = rebalance(first, {s: b for s, (b, _) in loads.items()})
    for m in (first, current):
        store_map(spark, m, path)
    before, filled = [], [0] * shards
    for slot, shard in enumerate(current.shard_of):
        before.append((slot, shard, filled[shard]))
        filled[shard] += loads.get(slot, (0, 0))[1]
    placed = F.broadcast(spark.createDataFrame(before, "virtual_slot int, shard int, first long"))
    in_slot = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (
        rec.withColumn("nth", F.row_number().over(in_slot))
        .join(placed, "virtual_slot")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "shard",
            (F.col("first") + F.col("nth") - 1).alias("slot"),
            "virtual_slot",
            F.lit(current.version).alias("map_version"),
        )
    )

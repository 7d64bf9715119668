"""Fixed virtual slots: records hash into slots, slots map to shards through a stored, versioned table.

A record's slot, a hash of its id and text, never changes. Balancing works on the slots alone: their bytes
are aggregated, the latest stored map from slot to shard is read and edited, and the edited map is stored as
the next version, so a rebalance moves whole slots and writes one small table. A path without a map
first gets version 1, which deals the slots out in turn without looking at any record.

Defined results:

- a null or empty text has 0 bytes; its record still counts `RECORD_BYTES`;
- rows of one id with different texts spread over the slots, and so do rows without an id;
- repeated rows (equal id and text) share a slot and get positions of their own, so a shard is at least as large as all
  repeats of one row;
- of slots of equal size, the one with the smaller number moves first;
- a very long text is one record and can't be split: its slot, and the shard that holds it, is at least that large;
- an empty table gives a full map (every slot has a shard) and no rows;
- columns of the input called as an added column are replaced by it.
"""

from __future__ import annotations

import bisect
import heapq
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from surveylake.sources.tables import partition_values

SLOTS = 8192
RECORD_BYTES = 8
MAP_SCHEMA = "version int, slot int, shard int, bytes long, n_rows long"


def record_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(RECORD_BYTES)


def virtual_slot(key: Column, text: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(key, text), F.lit(slots)).cast("int")


@dataclass(frozen=True)
class Slot:
    slot: int
    bytes: int
    n_rows: int


def slot_sizes(records: DataFrame, slots: int = SLOTS) -> list[Slot]:
    """Bytes and rows of every slot; `records` has `virtual_slot` and `size`. The result has `slots` entries, whatever the input."""
    found = {
        row.virtual_slot: row
        for row in records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n_rows")).collect()
    }
    return [Slot(s, found[s].bytes if s in found else 0, found[s].n_rows if s in found else 0) for s in range(slots)]


def rebalanced_map(sizes: Sequence[Slot], mapped: Sequence[int], shards: int) -> list[int]:
    """Edit a map for new sizes or more shards, moving as few slots as that takes.

    The fullest shard gives the emptiest one the slot nearest to half their difference, so large slots move first and
    no move raises the larger of the two loads. A shard none of whose slots is smaller than that difference is
    settled. In the end no shard exceeds the emptiest by more than its own smallest slot with any bytes.
    """
    if shards <= max(mapped, default=-1):
        raise ValueError("a map can't lose shards that hold slots; move their slots first")
    edited, loads, held = list(mapped), [0] * shards, [[] for _ in range(shards)]
    for slot in sorted(sizes, key=lambda s: (s.bytes, -s.slot)):
        loads[edited[slot.slot]] += slot.bytes
        if slot.bytes:
            held[edited[slot.slot]].append((slot.bytes, -slot.slot))
    full, empty = [(-load, s) for s, load in enumerate(loads)], [(load, s) for s, load in enumerate(loads)]
    heapq.heapify(full)
    heapq.heapify(empty)
    while full:
        load, giver = heapq.heappop(full)
        if -load != loads[giver]:  # an entry from before a move
            continue
        while empty[0][0] != loads[empty[0][1]]:
            heapq.heappop(empty)
        taker = empty[0][1]
        slots, apart = held[giver], loads[giver] - loads[taker]
        end = bisect.bisect_left(slots, (apart, -len(edited)))
        if end == 0:
            continue
        at = bisect.bisect_left(slots, (apart / 2, -len(edited)), 0, end)
        if at == end or (at > 0 and apart / 2 - slots[at - 1][0] <= slots[at][0] - apart / 2):
            at = bisect.bisect_right(slots, (slots[at - 1][0], 1), 0, end) - 1
        else:
            at = bisect.bisect_right(slots, (slots[at][0], 1), 0, end) - 1
        moved = slots.pop(at)
        bisect.insort(held[taker], moved)
        edited[-moved[1]] = taker
        for shard, change in ((giver, -moved[0]), (taker, moved[0])):
            loads[shard] += change
            heapq.heappush(full, (-loads[shard], shard))
            heapq.heappush(empty, (loads[shard], shard))
    return edited


def store_map(spark: SparkSession, path: str, sizes: Sequence[Slot], mapped: Sequence[int], version: int) -> DataFrame:
    """Append one version of the map (one row per slot) and read it back; older versions stay as they are."""
    rows = [(version, s.slot, mapped[s.slot], s.bytes, s.n_rows) for s in sizes]
    target = f"{path.rstrip('/')}/version={version}"
    spark.createDataFrame(rows, MAP_SCHEMA).drop("version").coalesce(1).write.parquet(target)
    return read_map(spark, path, version)


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    stored = spark.read.schema("slot int, shard int, bytes long, n_rows long").parquet(f"{path.rstrip('/')}/version={version}")
    return stored.select(F.lit(version).alias("version"), "*")


def latest_map(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest stored version of the map; None where the path holds none."""
    versions = [int(v) for v in partition_values(spark, path, "version")]
    return read_map(spark, path, max(versions)) if versions else None


def rebalance(spark: SparkSession, path: str, sizes: Sequence[Slot], shards: int) -> DataFrame:
    """Read the latest stored map, edit it for these sizes and shards, store it as the next version and return that.

    The driver holds the map: one row per slot, whatever the table. Of two rebalances at once the
    second fails, since its version is there already.
    """
    current = latest_map(spark, path)
    if current is None:
        current = store_map(spark, path, [Slot(s.slot, 0, 0) for s in sizes], [s.slot % shards for s in sizes], version=1)
    rows = current.orderBy("slot").collect()
    if len(rows) != len(sizes):
        raise ValueError(f"the stored map has {len(rows)} slots, the records {len(sizes)}")
    mapped = [row.shard for row in rows]
    return store_map(spark, path, sizes, rebalanced_map(sizes, mapped, shards), rows[0].version + 1)


def place(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Add `shard` and `map_version` to records with `virtual_slot`; the map has one row per slot, so it is broadcast."""
    small = slot_map.select(
        F.col("slot").alias("virtual_slot"), F.col("shard"), F.col("version").alias("map_version")
    )
    return records.drop("shard", "map_version").join(F.broadcast(small), "virtual_slot")


def position(placed: DataFrame, slot_map: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add `slot`, the row's place in its shard, from 0 without gaps.

    Rows are numbered inside their virtual slot, a thousandth of the table or
    less, and shifted by the rows of the shard's earlier slots.
    """
    before = W.partitionBy("shard").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    shifts = slot_map.select(
        F.col("slot").alias("virtual_slot"), F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("_shift")
    )
    number = F.row_number().over(W.partitionBy("virtual_slot").orderBy(*order))
    return (
        placed.join(F.broadcast(shifts), "virtual_slot")
        .withColumn("slot", (F.col("_shift") + number - 1).cast("long"))
        .drop("_shift")
    )


def shard_documents(docs: DataFrame, path: str, shards: int, slots: int = SLOTS) -> tuple[DataFrame, DataFrame]:
    """Documents with `size`, `virtual_slot`, `shard` and `map_version`, and the map that places them, the newest at `path`."""
    sized = docs.withColumns(
        {"size": record_size(F.col("text")), "virtual_slot": virtual_slot(F.col("doc_id"), F.col("text"), slots)}
    )
    slot_map = rebalance(docs.sparkSession, path, slot_sizes(sized, slots), shards)
    return place(sized, slot_map), slot_map

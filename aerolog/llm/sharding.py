"""Shards through fixed virtual slots.

Every record is hashed into one of a few thousand slots, for good. A map, stored under a version, says
which shard a slot belongs to. Rebalancing edits the map, so only the records of the slots that change
hands move. Bytes are summed by slot; the sums (one row a slot, so at most ``slots``) go to the driver,
which deals the slots out. Records never do.

Null keys are keys like any other and fall into one slot; a null or empty text has 16 bytes; a record
that occurs twice is placed twice, in one slot; an empty table gives an empty result and a map with
empty slots; other columns of the input don't matter.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from aerolog.session import materialized

SLOTS = 4096
OVERHEAD = 16
MAP_SCHEMA = "version int, slot int, shard int, bytes long, records long"


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The virtual slot of a key: its place never changes."""
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def record_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD


def slot_sizes(records: DataFrame) -> DataFrame:
    """Bytes and records of each slot that has any. ``records`` has virtual_slot and size."""
    return records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("records"))


def even_map(shards: int, slots: int = SLOTS) -> list[tuple]:
    """Version 1, from before anything is measured: slots dealt out in turn."""
    return [(1, slot, slot % shards, 0, 0) for slot in range(slots)]


def first_map(sizes: dict[int, tuple[int, int]], shards: int, slots: int = SLOTS) -> list[tuple]:
    """Version 1 for sizes that are known: slots by falling size, each to the shard with the fewest bytes so far."""
    heap = [(0, s) for s in range(shards)]
    rows = []
    for slot in sorted(range(slots), key=lambda s: (-sizes.get(s, (0, 0))[0], s)):
        load, shard = heapq.heappop(heap)
        size, records = sizes.get(slot, (0, 0))
        rows.append((1, slot, shard, size, records))
        heapq.heappush(heap, (load + size, shard))
    return sorted(rows)


def rebalanced(rows: list[tuple], sizes: dict[int, tuple[int, int]], shards: int,
               tolerance: float = 0.01) -> list[tuple]:
    """The next version of a map for new sizes or another number of shards.

    Slots of shards that are gone are dealt to the least loaded. Then the fullest shard hands its
    largest fitting slot to the emptiest, until they are within ``tolerance`` of the mean or no slot
    fits. All other slots stay.
    """
    version = 1 + max((r[0] for r in rows), default=0)
    owner = {slot: shard for _, slot, shard, _, _ in rows}
    size = {slot: sizes.get(slot, (0, 0))[0] for slot in owner}
    load = [0] * shards
    held: list[set[int]] = [set() for _ in range(shards)]
    homeless = []
    for slot, shard in owner.items():
        if shard < shards:
            load[shard] += size[slot]
            held[shard].add(slot)
        else:
            homeless.append(slot)

    def move(slot: int, to: int) -> None:
        owner[slot] = to
        load[to] += size[slot]
        held[to].add(slot)

    for slot in sorted(homeless, key=lambda s: (-size[s], s)):
        move(slot, min(range(shards), key=lambda s: (load[s], s)))
    mean = sum(load) / max(1, shards)
    for _ in range(len(owner)):
        full, low = max(range(shards), key=lambda s: load[s]), min(range(shards), key=lambda s: load[s])
        gap = load[full] - load[low]
        fitting = [s for s in held[full] if 0 < size[s] < gap]
        if gap <= tolerance * mean or not fitting:
            break
        slot = max(fitting, key=lambda s: (-abs(gap - 2 * size[s]), -s))
        held[full].remove(slot)
        load[full] -= size[slot]
        move(slot, low)
    return sorted((version, s, owner[s], *sizes.get(s, (0, 0))) for s in owner)


def write_map(spark: SparkSession, rows: list[tuple], folder: str) -> None:
    """Store a version of the map beside the earlier ones."""
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.parquet(f"{folder}/version={rows[0][0]:06d}")


def read_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.schema(MAP_SCHEMA).parquet(f"{folder}/version={version:06d}")


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """The few numbers of each record that sharding needs, without its text."""
    return docs.select(
        F.col(key), record_bytes(F.col(text)).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        slot_of(F.col(key), slots).alias("virtual_slot"))


def placed(records: DataFrame, slot_map: DataFrame, key: str = "doc_id") -> DataFrame:
    """Records with their shard and their place in it, gapless from 0.

    A slot's places begin where the slots before it in the shard end, so ranking needs only the rows of
    a slot together, never those of a shard. The map has as many rows as there are slots.
    """
    in_shard = Window.partitionBy("shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.select(F.col("slot").alias("virtual_slot"), "shard", "version",
                             F.coalesce(F.sum("records").over(in_shard), F.lit(0)).alias("_start"))
    in_slot = Window.partitionBy("virtual_slot").orderBy(F.col(key).asc_nulls_first(), "text_crc32", "size")
    return (records.withColumn("_rank", F.row_number().over(in_slot) - 1)
            .join(F.broadcast(starts), "virtual_slot")
            .withColumn("slot", (F.col("_start") + F.col("_rank")).cast("long")).drop("_start", "_rank"))


def sharded(docs: DataFrame, shards: int, folder: str, slots: int = SLOTS, tolerance: float = 1e-4) -> DataFrame:
    """All records with size, virtual slot, shard and place, by the last version of the map in ``folder``.

    Version 1 deals the slots out in turn; version 2 edits it for the measured bytes. Shards are as
    equal as slots allow: an id that fills more than a shard by itself (it has one slot) makes that shard larger.
    """
    spark = docs.sparkSession
    records = materialized(digests(docs, slots=slots))
    sizes = {r["virtual_slot"]: (r["bytes"], r["records"]) for r in slot_sizes(records).collect()}
    first = even_map(shards, slots)
    last = rebalanced(first, sizes, shards, tolerance)
    for version in (first, last):
        write_map(spark, version, folder)
    return placed(records, read_map(spark, folder, last[0][0]))

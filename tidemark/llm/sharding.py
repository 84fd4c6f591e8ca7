"""Sharding by fixed virtual slots.

Records are hashed into a fixed number of virtual slots.  The bytes and rows of
each slot are summed in Spark; the slot-to-shard map (one entry per slot, so its
size never depends on the data) is made from those sums, written as a numbered
version, and *edited* when shards are added or loads change: only the slots that
must move are re-assigned, records are never hashed again.

The map that is used is the one that was stored: it is written to the shared folder and
read back.  ``rebalance`` loads the latest version, edits it for the present sizes and
stores the next.

Defined results: a null text has no bytes; rows with a null id or equal ids are hashed
with their text as well, so they spread over the slots.  Rows that repeat id and text
have one hash; a slot that such rows make more than ``FULL`` times as large as the mean
slot is dealt anew, row by row, so that the shards stay near equal.  Each row gets its own
place.  A very long text is one row: a slot cannot be smaller than it.  An empty table
gives an empty result.  Copies of a text need not share a shard.  Other columns of the
input are ignored.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import materialise, scratch_path, text_of

SLOTS = 4096
ROW_OVERHEAD = 8
#: Times the mean bytes of a slot from which its rows are dealt by their row numbers.
FULL = 4


def records(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32 and the virtual slot of every record."""
    text = text_of(text_col)
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        F.pmod(F.xxhash64(F.col(id_col), text), F.lit(slots)).cast("int").alias("virtual_slot"),
        F.monotonically_increasing_id().alias("row"),
    )


def dealt(recs: DataFrame, sizes: list[int], slots: int) -> DataFrame:
    """``recs`` with the rows of overfull slots over all slots, by row number (a column
    of the written records, so it is the same in every pass)."""
    most = FULL * sum(sizes) / slots
    full = [slot for slot, size in enumerate(sizes) if size > most]  # fewer than slots / FULL
    if not full:
        return recs
    anew = F.pmod(F.xxhash64("row"), F.lit(slots)).cast("int")
    return recs.withColumn("virtual_slot", F.when(F.col("virtual_slot").isin(full), anew).otherwise(F.col("virtual_slot")))


@dataclass
class SlotMap:
    """One version of the slot-to-shard map.  ``shard_of[s]`` is the shard of slot s."""

    version: int
    shards: int
    shard_of: list[int]
    moved: list[int] = field(default_factory=list)

    def loads(self, sizes: list[int]) -> list[int]:
        out = [0] * self.shards
        for slot, shard in enumerate(self.shard_of):
            out[shard] += sizes[slot]
        return out


def first_map(sizes: list[int], shards: int) -> SlotMap:
    """Largest slot first, each to the shard with the fewest bytes (ties: the
    lowest shard, the lowest slot)."""
    heap = [(0, shard) for shard in range(shards)]
    shard_of = [0] * len(sizes)
    for slot in sorted(range(len(sizes)), key=lambda s: (-sizes[s], s)):
        load, shard = heapq.heappop(heap)
        shard_of[slot] = shard
        heapq.heappush(heap, (load + sizes[slot], shard))
    return SlotMap(1, shards, shard_of, list(range(len(sizes))))


def edit_map(old: SlotMap, sizes: list[int], shards: int) -> SlotMap:
    """The next version for new sizes and perhaps more shards.  Slots move only
    from shards above the mean to the emptiest shard, the largest that still fits
    first; every other slot keeps its shard."""
    if shards < old.shards:
        raise ValueError("shards are only added; drain a shard by moving its slots first")
    new = SlotMap(old.version + 1, shards, list(old.shard_of))
    loads = new.loads(sizes)
    goal = sum(sizes) / shards
    own: dict[int, list[int]] = {shard: [] for shard in range(shards)}
    for slot in sorted(range(len(sizes)), key=lambda s: (-sizes[s], s)):
        own[new.shard_of[slot]].append(slot)
    heap = [(loads[shard], shard) for shard in range(shards)]
    heapq.heapify(heap)
    for giver in sorted(range(shards), key=lambda s: (-loads[s], s)):
        for slot in own[giver]:
            size = sizes[slot]
            if size == 0 or loads[giver] - size < goal:
                continue
            while heap[0][0] != loads[heap[0][1]]:
                heapq.heappop(heap)  # an entry from before a change
            load, taker = heap[0]
            if taker == giver or load + size > goal + size / 2:
                continue
            heapq.heapreplace(heap, (load + size, taker))
            loads[giver] -= size
            loads[taker] += size
            heapq.heappush(heap, (loads[giver], giver))
            new.shard_of[slot] = taker
            new.moved.append(slot)
    return new


def slot_sums(recs: DataFrame, slots: int) -> tuple[list[int], list[int]]:
    """Bytes and rows per slot: at most ``slots`` rows reach the driver."""
    sizes, counts = [0] * slots, [0] * slots
    sums = recs.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"))
    for row in sums.collect():
        sizes[row["virtual_slot"]], counts[row["virtual_slot"]] = row["b"], row["n"]
    return sizes, counts


def map_table(spark: SparkSession, slot_map: SlotMap, counts: list[int]) -> DataFrame:
    """The map as rows (virtual_slot, shard, first place of the slot in its shard,
    version)."""
    used = [0] * slot_map.shards
    rows = []
    for slot, shard in enumerate(slot_map.shard_of):
        rows.append((slot, shard, used[shard], slot_map.version))
        used[shard] += counts[slot]
    return spark.createDataFrame(rows, "virtual_slot int, shard int, first_place long, version int")


def store_map(spark: SparkSession, slot_map: SlotMap, counts: list[int], folder: str) -> str:
    """Write one version beside the earlier ones: ``folder/version=N``."""
    path = f"{folder.rstrip('/')}/version={slot_map.version}"
    rows = map_table(spark, slot_map, counts).drop("version").withColumn("shards", F.lit(slot_map.shards))
    rows.coalesce(1).write.mode("error").parquet(path)
    return path


def load_map(spark: SparkSession, folder: str, version: int) -> SlotMap:
    rows = spark.read.parquet(f"{folder.rstrip('/')}/version={version}").orderBy("virtual_slot").collect()
    shard_of = [r["shard"] for r in rows]
    return SlotMap(version, rows[0]["shards"], shard_of)


def place(recs: DataFrame, slot_map: SlotMap, counts: list[int]) -> DataFrame:
    """Shard and gapless place within it for every record.  The map has one row
    per slot and is broadcast; a record's place is its rank in its own slot
    (thousands of independent windows) after the rows of the shard's earlier
    slots, so no window spans a shard."""
    in_slot = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    mapped = map_table(recs.sparkSession, slot_map, counts)
    return (
        recs.withColumn("rank", F.row_number().over(in_slot) - 1)
        .join(F.broadcast(mapped), "virtual_slot")
        .withColumn("slot", (F.col("first_place") + F.col("rank")).cast("long"))
        .drop("rank", "first_place", "row")
    )


def latest_version(spark: SparkSession, folder: str) -> int:
    """The highest version stored in ``folder`` (0: none)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return max((int(n.partition("=")[2]) for n in names if n.startswith("version=")), default=0)


def rebalance(spark: SparkSession, folder: str, recs: DataFrame, shards: int, slots: int = SLOTS) -> SlotMap:
    """Edit the latest stored map for the records' present sizes (and perhaps more
    shards) and store it as the next version."""
    sizes, counts = slot_sums(recs, slots)
    new = edit_map(load_map(spark, folder, latest_version(spark, folder)), sizes, shards)
    store_map(spark, new, counts, folder)
    return new


def shard_documents(
    docs: DataFrame, shards: int = 24, slots: int = SLOTS, map_folder: str | None = None
) -> DataFrame:
    """All records with their shard under the ``bytes`` law.  The map is stored as
    version 1 in ``map_folder`` (default: a new folder in the checkpoint folder), and
    the records are placed by what is read back.  One job sums the slots; the narrow
    records are written once, so the texts are read a single time."""
    spark = docs.sparkSession
    map_folder = map_folder or scratch_path(spark, "slot-map")
    recs = materialise(records(docs, slots), "shard-records")
    sizes, counts = slot_sums(recs, slots)
    spread = dealt(recs, sizes, slots)
    if spread is not recs:
        sizes, counts = slot_sums(spread, slots)
    store_map(spark, first_map(sizes, shards), counts, map_folder)
    return place(spread, load_map(spark, map_folder, 1), counts)

"""Sharding by fixed virtual slots.

Every record is hashed into one of a fixed number of slots (thousands, never
changed). Bytes are aggregated per slot, and a versioned slot-to-shard map,
stored as a table, says which shard holds a slot. A new map gives the largest
slots away first, each to the shard with the fewest bytes; rebalancing edits
the map and moves as few slots as it can. ``shard`` with a stored map edits its
newest version for the data and the number of shards of the day, and stores
the result as the next version where anything changed; a version is written
once. Only the map passes through the driver: its size is the number of slots,
whatever the size of the data.

The place of a record in its shard is its rank in its slot plus the number of
records in the shard's earlier slots, so no shard is ever sorted as a whole.

Results in odd cases: null text counts as no bytes (size 1, CRC 0); records
are spread by doc_id and text together, so many records under one (or a null)
doc_id do not meet in one slot; equal records get different places; other
columns are kept apart and never read; an empty table gives an empty table and
a map that deals the empty slots out evenly.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starmart.llm.common import new_work_path, persist

SLOTS = 4096
MAP_DDL = "slot int, shard int, bytes long, records long"


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus one), text_crc32 and virtual slot."""
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    base = docs.select("doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"),
                       F.crc32(raw).alias("text_crc32"))
    return base.withColumn("virtual_slot", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(slots)).cast("int"))


def slot_sizes(recs: DataFrame) -> dict[int, tuple[int, int]]:
    """slot -> (bytes, records); at most as many entries as there are slots."""
    rows = recs.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    return {r.virtual_slot: (r.b, r.n) for r in rows}


def new_map(sizes: dict[int, tuple[int, int]], shards: int, slots: int = SLOTS) -> dict[int, int]:
    """Largest slot first, to the shard with the fewest bytes, then slots."""
    heap = [(0, 0, s) for s in range(shards)]
    out = {}
    for slot in sorted(range(slots), key=lambda k: (-sizes.get(k, (0, 0))[0], k)):
        held, n, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (held + sizes.get(slot, (0, 0))[0], n + 1, shard))
    return out


def rebalance(old: dict[int, int], sizes: dict[int, tuple[int, int]], shards: int, slack: float = 0.01) -> dict[int, int]:
    """Edit a map for new sizes or another number of shards: only slots of
    removed shards, and slots that bring a shard above its share down, move."""
    size = lambda k: sizes.get(k, (0, 0))[0]
    held = dict.fromkeys(range(shards), 0)
    for k, s in old.items():
        if s < shards:
            held[s] += size(k)
    bound = sum(size(k) for k in old) / shards * (1 + slack)
    out = {k: s for k, s in old.items() if s < shards}
    homeless = [k for k, s in old.items() if s >= shards]
    for k in sorted(out, key=lambda k: (-size(k), k)):
        s = out[k]
        if size(k) and held[s] - size(k) >= bound / (1 + slack) * (1 - slack) and held[s] > bound:
            held[s] -= size(k)
            homeless.append(k)
            del out[k]
    for k in sorted(homeless, key=lambda k: (-size(k), k)):
        s = min(held, key=lambda s: (held[s], s))
        out[k] = s
        held[s] += size(k)
    return out


def map_frame(spark: SparkSession, slot_map: dict[int, int], sizes: dict[int, tuple[int, int]]) -> DataFrame:
    rows = [(k, s, *sizes.get(k, (0, 0))) for k, s in sorted(slot_map.items())]
    return spark.createDataFrame(rows, MAP_DDL)


def save_map(frame: DataFrame, path: str, version: int) -> None:
    """Store one version; a version is written once and never changed."""
    frame.coalesce(1).write.parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(MAP_DDL).parquet(f"{path}/version={version}")


def _numbers(spark: SparkSession, path: str) -> dict[int, bool]:
    """Number of every version folder in ``path``, and if it is complete."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(hadoop(path))] if fs.exists(hadoop(path)) else []
    numbers = [n.removeprefix("version=") for n in names if n.startswith("version=")]
    return {int(n): fs.exists(hadoop(f"{path}/version={n}/_SUCCESS")) for n in numbers if n.isdigit()}


def versions(spark: SparkSession, path: str) -> list[int]:
    """The complete versions in order; a folder that a crash left without its
    success marker is none, and its number is not used again."""
    return sorted(n for n, done in _numbers(spark, path).items() if done)


def open_map(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, dict[int, int]] | None:
    """Number and slot -> shard of a version (the newest unless given); None
    if nothing is stored."""
    version = version or max(versions(spark, path), default=0)
    if not version:
        return None
    return version, {r.slot: r.shard for r in load_map(spark, path, version).collect()}


def next_map(spark: SparkSession, path: str, sizes: dict[int, tuple[int, int]], shards: int, slots: int = SLOTS) -> int:
    """Number of a stored version that deals these sizes to so many shards:
    the newest one edited, or the newest itself if no slot has to move."""
    stored = open_map(spark, path)
    free = max(_numbers(spark, path), default=0) + 1
    if stored is None:
        save_map(map_frame(spark, new_map(sizes, shards, slots), sizes), path, free)
        return free
    version, old = stored
    if len(old) != slots:
        raise ValueError(f"the stored map has {len(old)} slots, not {slots}; the number of slots never changes")
    edited = rebalance(old, sizes, shards)
    if edited == old:
        return version
    save_map(map_frame(spark, edited, sizes), path, free)
    return free


def place(recs: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Shard of every record and its place there (gapless from 0); the records
    of a slot are counted here, since a stored map may be older than they are."""
    before = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    held = recs.groupBy("virtual_slot").agg(F.count("*").alias("held"))
    offsets = slot_map.select(F.col("slot").alias("virtual_slot"), "shard").join(held, "virtual_slot", "left")
    offsets = offsets.withColumn("offset", F.coalesce(F.sum("held").over(before), F.lit(0))).drop("held")
    rank = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return (recs.withColumn("rank", rank - 1).join(F.broadcast(offsets), "virtual_slot")
            .withColumn("slot", (F.col("rank") + F.col("offset")).cast("long")).drop("rank", "offset"))


def shard(docs: DataFrame, shards: int, path: str | None = None, slots: int = SLOTS) -> DataFrame:
    """Deal documents to shards of near equal bytes through the map stored in
    ``path``: made where there is none, else its newest version, edited."""
    spark = docs.sparkSession
    recs = persist(records(docs, slots), "slot-records")
    path = path or new_work_path(spark, "slot-map")
    version = next_map(spark, path, slot_sizes(recs), shards, slots)
    return place(recs, load_map(spark, path, version))


def digest(placed: DataFrame) -> DataFrame:
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def op8_virtual_slots(spark, sf_dir: str) -> DataFrame:
    return digest(shard(spark.read.parquet(f"{sf_dir}/documents.parquet"), 16))

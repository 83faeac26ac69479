"""Sharding by fixed virtual slots (native).

Every record hashes into one of ``n_slots`` virtual slots. A bounded table of ``n_slots`` rows (bytes and rows per slot) is
all the planner sees; from it a *versioned* slot-to-shard map is edited, moving as few slots as level the shards' bytes. Rows
never move through a global sort: a row's place in its shard is its slot's offset in the shard (a prefix sum over the map)
plus its rank within the slot.

Defined cases: null text has 8 bytes of size and the CRC of no bytes; null ids hash with their text, so many of them spread
over all slots; fully equal rows share a slot; empty input gives empty output; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import bisect
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import shared

N_SLOTS = 4096
OVERHEAD = 8


@dataclass(frozen=True)
class SlotMap:
    """Version ``version`` of the assignment of every virtual slot to a shard."""

    version: int
    n_shards: int
    shards: tuple[int, ...]

    @classmethod
    def uniform(cls, n_slots: int, n_shards: int) -> SlotMap:
        return cls(1, n_shards, tuple(i % n_shards for i in range(n_slots)))

    def frame(self, spark: SparkSession, **columns: list[int]) -> DataFrame:
        """One row per slot, from literals: no Python data reaches the executors."""
        made = spark.range(len(self.shards), numPartitions=1).withColumnRenamed("id", "vslot")
        for name, values in {"shard": list(self.shards), **columns}.items():
            array = F.from_json(F.lit(json.dumps(values)), "array<bigint>")
            made = made.withColumn(name, F.get(array, F.col("vslot").cast("int")))
        return made.withColumn("shard", F.col("shard").cast("int"))

    def save(self, spark: SparkSession, path: str) -> None:
        """Versions are only added, never rewritten: old readers keep resolving with the version they hold."""
        self.frame(spark).select("vslot", "shard", F.lit(self.n_shards).alias("n_shards")).coalesce(1).write.parquet(f"{path}/version={self.version}")

    @classmethod
    def load(cls, spark: SparkSession, path: str, version: int) -> SlotMap:
        rows = spark.read.parquet(f"{path}/version={version}").orderBy("vslot").collect()  # n_slots rows
        return cls(version, rows[0]["n_shards"], tuple(r["shard"] for r in rows))

    @classmethod
    def newest(cls, spark: SparkSession, path: str) -> SlotMap | None:
        """The last version that was written whole; None without one."""
        root = spark._jvm.org.apache.hadoop.fs.Path(path)
        system = root.getFileSystem(spark._jsc.hadoopConfiguration())
        if not system.exists(root):
            return None
        found = [s.getPath() for s in system.listStatus(root)]
        done = [int(p.getName().split("=")[1]) for p in found if p.getName().startswith("version=") and system.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return cls.load(spark, path, max(done)) if done else None

    def rebalanced(self, weights: list[int], n_shards: int | None = None) -> SlotMap:
        """The next version: slots move from the fullest shard to the emptiest while that levels them, then pairs are swapped."""
        n = n_shards or self.n_shards
        members: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for slot, shard in enumerate(self.shards):
            members[shard % n].append((weights[slot], slot))
        loads = [sum(w for w, _ in m) for m in members]
        for m in members:
            m.sort()
        for _ in range(4 * len(self.shards)):
            high, low = max(range(n), key=loads.__getitem__), min(range(n), key=loads.__getitem__)
            gap = loads[high] - loads[low]
            step = _best_step(members[high], members[low], gap)
            if step is None:
                break
            given, taken = step
            members[high].remove(given)
            bisect.insort(members[low], given)
            if taken is not None:
                members[low].remove(taken)
                bisect.insort(members[high], taken)
            moved = given[0] - (taken[0] if taken else 0)
            loads[high] -= moved
            loads[low] += moved
        shards = [0] * len(self.shards)
        for shard, m in enumerate(members):
            for _, slot in m:
                shards[slot] = shard
        return SlotMap(self.version + 1, n, tuple(shards))


def _best_step(high: list, low: list, gap: int):
    """The move or swap that brings the difference nearest to half the gap; None if nothing narrows it."""
    best, found = gap, None
    if gap <= 1:
        return None

    def near(m: list, weight: int):
        at = bisect.bisect_left(m, (weight, -1))
        return m[max(0, at - 1) : at + 1]

    for given in near(high, gap // 2):
        if 0 < given[0] < gap and abs(gap - 2 * given[0]) < best:
            best, found = abs(gap - 2 * given[0]), (given, None)
    if best > gap // 4:
        for given in high:
            for taken in near(low, given[0] - gap // 2):
                moved = given[0] - taken[0]
                if 0 < moved < gap and abs(gap - 2 * moved) < best:
                    best, found = abs(gap - 2 * moved), (given, taken)
    return found


def slotted(docs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and virtual slot of every row."""
    text = shared.text_or_empty(F.col("text"))
    rows = docs.select("doc_id", (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return rows.withColumn("vslot", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(n_slots)))


def slot_totals(rows: DataFrame, n_slots: int = N_SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows per slot: n_slots numbers each, whatever the corpus holds."""
    sizes, counts = [0] * n_slots, [0] * n_slots
    for r in rows.groupBy("vslot").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect():
        sizes[r["vslot"]], counts[r["vslot"]] = r["size"], r["n"]
    return sizes, counts


def shard_documents(docs: DataFrame, n_shards: int = 24, n_slots: int = N_SLOTS, store: str | None = None) -> DataFrame:
    """Each row's shard under the rebalanced map, and its place in the shard, gapless from 0.

    Maps are stored under `store`. The newest one there is edited for the slots' present bytes and the number of shards, which may have
    changed, and saved as the next version, unless nothing moves; without one the uniform map is saved as version 1 and edited.
    """
    spark = docs.sparkSession
    store = store or shared.new_path(spark, "slot-map")
    rows = slotted(docs, n_slots)
    sizes, counts = slot_totals(rows, n_slots)
    known = SlotMap.newest(spark, store)
    if known is None:
        known = SlotMap.uniform(n_slots, n_shards)
        known.save(spark, store)
    elif len(known.shards) != n_slots:
        raise ValueError(f"the stored map has {len(known.shards)} slots, not {n_slots}")
    current = known.rebalanced(sizes, n_shards)
    if (current.shards, current.n_shards) == (known.shards, known.n_shards):
        current = known
    else:
        current.save(spark, store)
    offsets, filled = [0] * n_slots, [0] * n_shards
    for slot, shard in enumerate(current.shards):
        offsets[slot] = filled[shard]
        filled[shard] += counts[slot]
    placed = rows.join(F.broadcast(current.frame(spark, offset=offsets)), "vslot")  # n_slots rows
    rank = F.row_number().over(Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("offset") + rank - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("vslot").alias("virtual_slot"),
        F.lit(current.version).alias("map_version"),
    )

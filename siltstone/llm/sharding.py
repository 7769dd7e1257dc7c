"""Shards by fixed virtual slots.

A record's slot is a hash of its id, for good. Bytes are summed per slot, and a versioned table says which
shard holds which slot: building it balances bytes, and rebalancing edits few of its rows. The table has as many
rows as there are slots, whatever the data, so it is worked out on the driver.
"""

from __future__ import annotations

import heapq
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.session import materialise

#: Production parameters.
SLOTS, SHARDS = 8192, 24
#: Fixed value of the contract: bytes of a record besides its text.
OVERHEAD = 8


def slot_of(id_column: Column, slots: int = SLOTS) -> Column:
    """Virtual slot of an id; a null id has one too."""
    return F.pmod(F.xxhash64(id_column), F.lit(slots)).cast("int")


def bytes_per_slot(records: DataFrame, slots: int = SLOTS) -> list[int]:
    """Bytes in each slot of a table with columns virtual_slot and size: partial sums, then one row per slot."""
    found = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes")).collect()
    sums = dict.fromkeys(range(slots), 0) | {r["virtual_slot"]: r["bytes"] for r in found}
    return [sums[s] for s in range(slots)]


def build_map(weights: list[int], shards: int) -> list[int]:
    """Shard of each slot: the heaviest slots first, each into the lightest shard so far."""
    loads = [(0, shard) for shard in range(shards)]
    out = [0] * len(weights)
    for slot in sorted(range(len(weights)), key=lambda s: (-weights[s], s)):
        load, shard = heapq.heappop(loads)
        out[slot] = shard
        heapq.heappush(loads, (load + weights[slot], shard))
    return out


def rebalance(assigned: list[int], weights: list[int], shards: int) -> list[int]:
    """The map edited for new weights or more shards: slots leave the heaviest shard for the lightest.

    A slot moves while that narrows the gap between the two; all others stay where they are. Fewer shards
    than before send all slots of the shards that go.
    """
    out, loads, held = list(assigned), [0] * shards, [[] for _ in range(shards)]
    homeless = []
    for slot, shard in enumerate(out):
        if shard < shards:
            loads[shard] += weights[slot]
            heapq.heappush(held[shard], (-weights[slot], slot))
        else:
            homeless.append(slot)
    for slot in sorted(homeless, key=lambda s: (-weights[s], s)):
        shard = min(range(shards), key=lambda s: (loads[s], s))
        out[slot], loads[shard] = shard, loads[shard] + weights[slot]
        heapq.heappush(held[shard], (-weights[slot], slot))
    while True:
        high, low = max(range(shards), key=lambda s: (loads[s], -s)), min(range(shards), key=lambda s: (loads[s], s))
        gap = loads[high] - loads[low]
        moving = [(w, s) for w, s in held[high] if 0 < -w < gap]
        if not moving:
            return out
        weight, slot = min(moving, key=lambda x: (abs(-x[0] - gap / 2), x[1]))
        held[high].remove((weight, slot))
        heapq.heapify(held[high])
        heapq.heappush(held[low], (weight, slot))
        out[slot], loads[high], loads[low] = low, loads[high] + weight, loads[low] - weight


def save_map(spark: SparkSession, path: str, assigned: list[int], version: int) -> None:
    """Add a version of the map (version, virtual_slot, shard) to the table at ``path``."""
    _as_table(spark, assigned).select(F.lit(version).alias("version"), "virtual_slot", "shard").write.mode("append").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> list[int]:
    """The given version of the map, or the latest."""
    table = spark.read.parquet(path)
    version = table.agg(F.max("version")).first()[0] if version is None else version
    rows = table.where(F.col("version") == version).select("virtual_slot", "shard").collect()
    return [shard for _, shard in sorted(map(tuple, rows))]


def _as_table(spark: SparkSession, assigned: list[int]) -> DataFrame:
    return spark.range(1).select(F.posexplode(_literal(assigned)).alias("virtual_slot", "shard"))


def _literal(assigned: list[int]) -> Column:
    return F.from_json(F.lit(json.dumps(assigned)), "array<int>")


def shards(
    docs: DataFrame, count: int = SHARDS, slots: int = SLOTS, id_column: str = "doc_id", text_column: str = "text",
    map_path: str | None = None,
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot of every row.

    ``law`` is ``bytes``: shards hold nearly equal bytes, by slots. ``slot`` numbers the rows of a shard from 0
    without gaps, by virtual slot and id; a row's number comes from counts per virtual slot and its rank within
    the slot. Equal ids share a virtual slot, so rows that repeat one id stay on one shard. A null text has no bytes. With ``map_path``
    the map is added there as the next version, edited from the latest one if there is one.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_column), F.lit(""))
    records = materialise(docs.select(
        F.col(id_column).alias("doc_id"), (F.octet_length(text).cast("bigint") + OVERHEAD).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), slot_of(F.col(id_column), slots).alias("virtual_slot")), "records")
    weights = bytes_per_slot(records, slots)
    assigned = build_map(weights, count)
    if map_path:
        try:
            old, version = load_map(spark, map_path), spark.read.parquet(map_path).agg(F.max("version")).first()[0] + 1
            assigned = rebalance(old, weights, count)
        except Exception as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            version = 1
        save_map(spark, map_path, assigned, version)

    # rows before each virtual slot within its shard: a table of one row per slot
    per_slot = records.groupBy("virtual_slot").agg(F.count("*").alias("rows"))
    per_slot = per_slot.withColumn("shard", F.get(_literal(assigned), F.col("virtual_slot")))
    ahead = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slot.select(
        "virtual_slot", "shard", F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return (
        records.withColumn("rank", rank).join(F.broadcast(offsets), "virtual_slot")
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("before") + F.col("rank") - 1).cast("bigint").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"), "virtual_slot"))

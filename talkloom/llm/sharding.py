"""Shards by fixed virtual slots and a versioned map from slots to shards.

Every record is hashed by its id, size and checksum into one of ``SLOTS`` virtual
slots, and records that are equal in all three by their number too, so an id that very
many rows share is spread over the slots like any others. Bytes are
summed per slot. The map from slots to shards is a small table (a row a slot)
with a version; rebalancing writes a new version in which some slots have another
shard, and records follow their slot. Version 1 deals the slots evenly; version
2 moves as few slots as it can until the shards' bytes are near equal.

The size bound of the map is ``SLOTS`` rows, so it is balanced on the driver and
broadcast. Records only meet in groups of one slot, about 1 / ``SLOTS`` of them.

Null text counts as no bytes. Null ids are one id. Repeated rows are separate records,
counted before they are shuffled. An empty table gives an empty result. Further columns do not
matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: equal records that one row stands for at the most
CHUNK = 100_000
SLOTS = 4096
MAP_SCHEMA = "version int, slot int, shard int"


def slot_of(*keys: str, slots: int = SLOTS):
    return F.pmod(F.xxhash64(*[F.col(key) for key in keys]), F.lit(slots)).cast("int")


def record_size(text: str = "text"):
    """UTF-8 bytes of the text plus one."""
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("bigint") + 1


def first_map(shards: int, slots: int = SLOTS) -> dict[int, int]:
    return {slot: slot % shards for slot in range(slots)}


def rebalanced(old: dict[int, int], load: dict[int, int], shards: int) -> dict[int, int]:
    """Edit a map so that the loads of ``shards`` shards are near equal.

    One slot at a time goes from the fullest shard that can give one to the emptiest,
    as long as that brings the two closer. Slots of dropped shards are dealt first; a
    new shard starts empty and fills this way.
    """
    held: dict[int, list[int]] = {shard: [] for shard in range(shards)}
    total = dict.fromkeys(range(shards), 0)
    for slot in sorted(old):
        shard = old[slot] if old[slot] < shards else min(total, key=lambda s: (total[s], s))
        held[shard].append(slot)
        total[shard] += load.get(slot, 0)
    moved = True
    while moved:
        moved = False
        low = min(total, key=lambda s: (total[s], s))
        for high in sorted(total, key=lambda s: (-total[s], s)):
            gap = total[high] - total[low]
            fits = [s for s in held[high] if 0 < load.get(s, 0) < gap]
            if high == low or not fits:
                continue
            # the slot nearest to half the gap evens the two out best
            best = min(fits, key=lambda s: (abs(2 * load[s] - gap), s))
            held[high].remove(best)
            held[low].append(best)
            total[high] -= load[best]
            total[low] += load[best]
            moved = True
            break
    return {slot: shard for shard, slots in held.items() for slot in slots}


def slot_bytes(records: DataFrame) -> dict[int, int]:
    """Bytes of every slot; at most ``SLOTS`` rows come to the driver."""
    rows = records.groupBy("virtual_slot").agg(F.sum("size").alias("load")).collect()
    return {row["virtual_slot"]: row["load"] for row in rows}


def map_table(spark: SparkSession, versions: dict[int, dict[int, int]]) -> DataFrame:
    rows = [(v, slot, shard) for v, m in versions.items() for slot, shard in sorted(m.items())]
    return spark.createDataFrame(rows, MAP_SCHEMA)


def read_map(table: DataFrame, version: int | None = None) -> DataFrame:
    """The newest version of a stored map, or a given one."""
    if version is None:
        version = table.agg(F.max("version")).first()[0]
    return table.where(F.col("version") == version).select("slot", "shard")


def records_of(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, size, text_crc32 and virtual_slot of every record."""
    record = [key, "size", "text_crc32"]
    rows = docs.select(
        key,
        record_size(text).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    # equal records are only told apart by a number, so a count gives them back
    counted = rows.groupBy(*record).agg(F.count("*").alias("_n"))
    # in two steps with a shuffle between, so that one record with very many copies is spread
    chunks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / CHUNK))
    chunked = counted.select(*record, "_n", F.explode(chunks).alias("_chunk"))
    chunked = chunked.repartition(*record, "_chunk")
    first = F.col("_chunk") * CHUNK + 1
    copies = F.sequence(first, F.least(first + (CHUNK - 1), F.col("_n")))
    numbered = chunked.select(*record, F.explode(copies).alias("_copy"))
    return numbered.select(*record, slot_of(*record, "_copy").alias("virtual_slot"))


def assign(records: DataFrame, slot_map: DataFrame, key: str = "doc_id") -> DataFrame:
    """Each record's shard, and its place in the shard without gaps from 0.

    A shard lists its virtual slots in order, and within a slot by id, size and checksum.
    """
    mapped = slot_map.select(F.col("slot").alias("virtual_slot"), "shard")
    counts = records.groupBy("virtual_slot").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("virtual_slot")
    starts = (
        mapped.join(counts, "virtual_slot", "left")
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .withColumn("start", F.sum("n").over(before) - F.col("n"))
        .select("virtual_slot", "shard", "start")
    )
    within = Window.partitionBy("virtual_slot").orderBy(key, "size", "text_crc32")
    placed = records.withColumn("place", F.row_number().over(within))
    out = placed.join(F.broadcast(starts), "virtual_slot")  # a row for each virtual slot
    return out.withColumn("place", F.col("start") + F.col("place") - 1).drop("start")


def shard(docs: DataFrame, store, shards: int = 8, key: str = "doc_id") -> DataFrame:
    """Shard the records by bytes: ``store`` writes the versioned map and returns it as a table.

    Columns: key, size, text_crc32, virtual_slot, shard, place.
    """
    records = records_of(docs, key)
    old = first_map(shards)
    new = rebalanced(old, slot_bytes(records), shards)
    table = store(map_table(docs.sparkSession, {1: old, 2: new}))
    return assign(records, read_map(table), key)

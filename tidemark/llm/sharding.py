"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Keys lie on a ring of ``SLOTS`` equal slots by a hash of their id; every shard owns ``vnodes`` points on it. In ring
order, each slot's keys go to the first shard clockwise that has room, and what overflows a full shard continues to
the next one. The walk needs only the row count of each slot: 65,536 counts at any size of the input, which the
driver may hold. Rows meet their slot's ranges in one shuffle on the slot; copies of a document spread like any
others, since its id and not its text decides.

Defined results: a null id is a key like any other; repeated rows are keys of their own; an empty table gives no
rows; columns named like a result column are replaced by it.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import hash64, text_of, unwrapped, wrapped

SLOTS = 1 << 16
RANGES = "_slot int, _first long, _last long, _shard int, _base long"


def ring(shards: int, vnodes: int) -> tuple[list[int], list[int]]:
    """Positions (in slots) of all virtual nodes in ring order, and their shards."""
    points = sorted((hash64(f"shard {s} node {v}".encode()) % SLOTS, s) for s in range(shards) for v in range(vnodes))
    return [p for p, _ in points], [s for _, s in points]


def capacities(rows: int, shards: int, load: float) -> list[int]:
    """Rows that each shard may hold: exactly even for a load of 1, else load times the mean, rounded up."""
    if load <= 1:
        return [rows // shards + (s < rows % shards) for s in range(shards)]
    return [int(-(-rows * load // shards))] * shards


def walk(counts: dict[int, int], shards: int, vnodes: int, load: float) -> list[tuple[int, int, int, int, int]]:
    """Ranges (slot, first rank, last rank, shard, rows in the shard before): at most one more than slots and shards."""
    places, owners = ring(shards, vnodes)
    room, filled, out = capacities(sum(counts.values()), shards, load), [0] * shards, []
    for slot in sorted(counts):
        rank, left, at = 1, counts[slot], bisect_left(places, slot)
        while left:
            shard = owners[at % len(owners)]
            take = min(left, room[shard] - filled[shard])
            if take:
                out.append((slot, rank, rank + take - 1, shard, filled[shard]))
                filled[shard] += take
                rank, left = rank + take, left - take
            at += 1
    return out


def shard_rows(docs: DataFrame, shards: int = 8, vnodes: int = 128, load: float = 1.0) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``, the gapless position in the shard. With a ``load`` of 1, the row counts
    of the shards are at most one apart; above it, none exceeds ``load`` times the mean and fewer keys move when a
    shard is added."""
    spark = docs.sparkSession
    # The upper 16 bits of the hash; the rest orders the keys of a slot.
    key = F.xxhash64(F.col("row.doc_id"))
    rows = wrapped(docs).withColumns({"_key": key, "_slot": F.shiftrightunsigned(key, 48).cast("int")})
    counts = {r[0]: r[1] for r in rows.groupBy("_slot").count().collect()}
    ranges = spark.createDataFrame(walk(counts, shards, vnodes, load), RANGES)
    in_slot = W.partitionBy("_slot").orderBy("_key", F.xxhash64("row.text"))
    ranked = rows.withColumn("_rank", F.row_number().over(in_slot))
    placed = ranked.join(ranges, (ranked["_slot"] == ranges["_slot"]) & F.col("_rank").between(F.col("_first"), F.col("_last")))
    slot = (F.col("_base") + F.col("_rank") - F.col("_first")).cast("long")
    return unwrapped(placed, docs.columns, shard="_shard", slot=slot)


def op2_shard(docs: DataFrame) -> DataFrame:
    """The contract's columns: sizes, checksums and places under the law ``rows``."""
    text = text_of()
    size = F.octet_length(text).cast("long") + F.lit(1)
    # Only the narrow columns travel with the row.
    narrow = docs.select("doc_id", size.alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text"))
    return shard_rows(narrow).select(
        "doc_id", "size", F.col("text").alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

"""Operator 9: sharding on a consistent-hash ring with virtual nodes and bounded loads.

The 64-bit ring is cut into 2**14 cells. Every shard owns ``vnodes`` points of the
ring; a key belongs to the shard of the first point at or after its cell. Shards
have room for the average number of rows (the first ``n mod shards`` shards take
one more), so counts are at most one apart. Keys stay at their own shard as long
as it has room, in ring order; the rest of a cell continues clockwise to the next
points whose shard has room. A changed shard count moves the keys of the changed
arcs and those at the edges of full shards, the rest stays.

Work on the cluster: hash, one range sort of slim rows (key, size, checksum) along
the ring, counts per cell. The plan (which ranks of a cell go to which shard) needs
the counts of the cells only, at most 2**14 numbers whatever the table's size; it is
joined back by broadcast (bounded by cells + points). Ranks come from the sorted
partitions' row positions, so a key that holds a third of all rows is spread over as
many tasks as its rows fill: the last sort column makes every row distinct.

Defined results: NULL text has size 8 and checksum 0; NULL and repeated keys sit at
one point of the ring and overflow clockwise like any other; an empty table gives an
empty result; columns beside key and text are ignored.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, small_frame

CELL_BITS = 14
CELLS = 1 << CELL_BITS
SEED = 42


def ring_points(n_shards: int, vnodes: int) -> tuple[list[int], list[int]]:
    """Cells and shards of all virtual nodes in ring order."""
    points = sorted(
        (int.from_bytes(hashlib.sha256(f"{shard}:{v}".encode()).digest()[:8], "big"), shard)
        for shard in range(n_shards) for v in range(vnodes))
    return [p >> (64 - CELL_BITS) for p, _ in points], [s for _, s in points]


def plan_cells(counts: dict[int, int], n_shards: int, vnodes: int) -> list[tuple[int, int, int, int]]:
    """(cell, first rank, end rank, shard) for the keys of every cell, loads at most one apart."""
    at, owner = ring_points(n_shards, vnodes)
    total = sum(counts.values())
    room = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    spans, left = [], []
    for cell in sorted(counts):
        first = bisect.bisect_left(at, cell) % len(at)
        take = min(counts[cell], room[owner[first]])
        if take:
            room[owner[first]] -= take
            spans.append((cell, 0, take, owner[first]))
        if take < counts[cell]:
            left.append((cell, take, first))
    for cell, rank, first in left:
        step = first
        while rank < counts[cell]:
            step = (step + 1) % len(at)
            take = min(counts[cell] - rank, room[owner[step]])
            if take:
                room[owner[step]] -= take
                spans.append((cell, rank, rank + take, owner[step]))
                rank += take
    return spans


def assign_shards(docs: DataFrame, n_shards: int = 24, key: str = "doc_id", text: str = "text",
                  vnodes: int = 64) -> DataFrame:
    """(key, size, text_crc32, shard, slot) per row; ``slot`` counts from 0 without gaps in each shard."""
    spark = docs.sparkSession
    position = F.xxhash64(F.lit(SEED), F.col(key))
    raw = F.col(text).cast("binary")
    slim = saved(docs.select(
        F.col(key).alias("key"),
        (F.coalesce(F.octet_length(raw), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(raw), F.lit(0)).cast("long").alias("crc"),
        position.alias("h"),
        F.shiftrightunsigned(position, 64 - CELL_BITS).cast("int").alias("cell"),
        F.monotonically_increasing_id().alias("nth"),
    ))
    # along the ring; a row's place is its partition and position there
    placed = saved(slim.orderBy("cell", "h", "key", "size", "crc", "nth").drop("h", "nth")
                   .withColumn("place", F.monotonically_increasing_id()))
    counts = dict(placed.groupBy("cell").count().collect())
    parts = sorted(placed.groupBy(F.shiftright("place", 33).cast("int").alias("part")).count().collect())

    offsets, before = [], 0
    for part, n in parts:
        offsets.append((part, before))
        before += n
    starts, before = {}, 0
    for cell in sorted(counts):
        starts[cell] = before
        before += counts[cell]
    used, spans = [0] * n_shards, []
    for cell, lo, hi, shard in plan_cells(counts, n_shards, vnodes):
        spans.append((cell, starts[cell] + lo, starts[cell] + hi, shard, used[shard]))
        used[shard] += hi - lo
    offset_rows = small_frame(spark, offsets, ["part", "offset"], "part int, offset long")
    span_rows = small_frame(spark, spans, ["cell", "lo", "hi", "shard", "base"],
                            "cell int, lo long, hi long, shard int, base long")
    ranked = (placed.withColumn("part", F.shiftright("place", 33).cast("int"))
              .join(F.broadcast(offset_rows), "part")
              .withColumn("rank", F.col("offset") + F.col("place").bitwiseAND((1 << 33) - 1)))
    return (ranked.join(F.broadcast(span_rows), "cell")
            .filter("rank >= lo AND rank < hi")
            .select(F.col("key").alias(key), "size", F.col("crc").alias("text_crc32"), "shard",
                    (F.col("base") + F.col("rank") - F.col("lo")).alias("slot")))


def shard_digest(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    """The contract's columns: the law held is ``rows``."""
    return assign_shards(docs, n_shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, n_shards: int = 24, key: str = "doc_id",
                 text: str = "text") -> None:
    """Write the documents as one folder per shard; rows of a repeated key share its first shard."""
    where = assign_shards(docs, n_shards, key, text).groupBy(F.col(key).alias("_key")).agg(
        F.min("shard").alias("shard"))
    out = docs.drop("shard") if "shard" in docs.columns else docs
    (out.join(where, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")
     .write.mode("overwrite").partitionBy("shard").parquet(path))

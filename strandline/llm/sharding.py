"""Sharding by a consistent-hash ring with virtual nodes and bounded loads (DataFrame functions only).

A key hashes to one of ``ring`` positions; the first virtual node clockwise names its shard.  Loads are
bounded: keys that meet a full shard continue clockwise to the next virtual node whose shard has room.
The keys of one position are interchangeable for this, so the walk needs only their number per position
(at most ``ring`` integers, whatever the size of the input).  It yields pieces
``(position, from_rank, to_rank) -> shard``, and every row finds its piece by its rank in its position.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RING = 1 << 16
VNODES = 512


def ring_nodes(n_shards: int, vnodes: int = VNODES, ring: int = RING) -> list[tuple[int, int]]:
    """(position, shard) of every virtual node, clockwise; those of a shard don't depend on the other shards."""
    nodes = []
    for shard in range(n_shards):
        for v in range(vnodes):
            h = int.from_bytes(hashlib.blake2b(f"shard {shard} node {v}".encode(), digest_size=8).digest(), "big")
            nodes.append((h % ring, h, shard))
    return [(p, s) for p, _, s in sorted(nodes)]


def capacities(n_rows: int, n_shards: int, slack: float) -> list[int]:
    """Most rows for each shard: (1 + slack) times the mean; without slack, counts at most one apart."""
    if slack <= 0:
        return [n_rows // n_shards + (s < n_rows % n_shards) for s in range(n_shards)]
    return [-(-int(n_rows * (1 + slack)) // n_shards)] * n_shards


def ring_pieces(counts: dict[int, int], n_shards: int, slack: float = 0.0, vnodes: int = VNODES, ring: int = RING) -> list[tuple[int, int, int, int, int]]:
    """(position, from_rank, to_rank, shard, first_slot): positions clockwise, overflow to the next node with room."""
    nodes, room, used, out = ring_nodes(n_shards, vnodes, ring), capacities(sum(counts.values()), n_shards, slack), [0] * n_shards, []
    at = 0
    for position in range(ring):
        while at < len(nodes) and nodes[at][0] < position:
            at += 1
        left, rank, node = counts.get(position, 0), 0, at
        while left:
            shard = nodes[node % len(nodes)][1]
            take = min(left, room[shard] - used[shard])
            if take > 0:
                out.append((position, rank, rank + take, shard, used[shard]))
                used[shard], rank, left = used[shard] + take, rank + take, left - take
            node += 1
    return out


def ring_position(ring: int = RING) -> Column:
    return F.pmod(F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id")), F.lit(ring)).cast("int")


def shard_documents(docs: DataFrame, n_shards: int = 8, slack: float = 0.0, vnodes: int = VNODES, ring: int = RING) -> DataFrame:
    """Every row of docs (doc_id, text) with its shard: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The key is doc_id (of a row without one, its text).  size: UTF-8 bytes of the text plus 1 (null text: none, so 1, and the checksum of no bytes).
    With slack 0 the law ``rows`` holds: shard counts differ by one at most.  slot counts from 0 in each shard without gaps.
    Repeated rows each take a slot; rows that share a doc_id share a position of the ring and are ranked together; an empty table gives no rows; other columns are ignored; of a text, however long, only its size and checksum
    are carried.  Two passes: one reads doc_id alone and counts per position, one ranks the rows of each position (one shuffle
    of ids, sizes and checksums, no texts).
    """
    position = ring_position(ring)
    counts = {r["position"]: r["n"] for r in docs.select(position.alias("position")).groupBy("position").agg(F.count("*").alias("n")).collect()}
    pieces = docs.sparkSession.createDataFrame(
        ring_pieces(counts, n_shards, slack, vnodes, ring), "position int, from_rank long, to_rank long, shard int, first_slot long"
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), position.alias("position"), F.xxhash64(F.col("doc_id"), F.lit(1)).alias("h")
    )
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("position").orderBy("h", "doc_id", "text_crc32", "size")) - 1)
    # pieces: at most ring + shards * vnodes rows, a bound fixed by the parameters
    return (
        ranked.join(F.broadcast(pieces), "position")
        .where((F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank")))
        .select(
            "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
            (F.col("first_slot") + F.col("rank") - F.col("from_rank")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )

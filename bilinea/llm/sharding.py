"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has 2 ** 60 points. Each shard owns the arcs that end at its virtual nodes. A document hashes to a point; it
belongs to the shard of that arc, or, where that shard is full, to the next one clockwise that has room. All documents
of an arc see the shards in the same order, so the overflow is planned over the counts per arc, a table of as many
rows as there are virtual nodes; documents then take the planned places by their rank within the arc.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bilinea.llm.common import order_hash, ranked, store

#: Bits of a point on the ring, and of the cell by which points look up their arc: each cell meets few arcs.
POINT, CELL = 60, 16
PLAN = "arc int, rank_from long, rank_to long, shard int, slot_from long"


def ring(n_shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(last point, shard) of each arc, clockwise. Two virtual nodes fall on one point, which is left to the smaller shard
    then, about once in a million rings of a thousand shards; a shard has its other nodes all the same."""
    at: dict[int, int] = {}
    for shard in range(n_shards):
        for v in range(vnodes):
            point = int.from_bytes(hashlib.md5(f"shard {shard} node {v}".encode()).digest()[:8], "big") >> (64 - POINT)
            at.setdefault(point, shard)
    return sorted(at.items())


def capacities(total: int, n_shards: int, slack: float) -> list[int]:
    """How many documents each shard takes at most. Without slack the capacities add up to the total and differ by one."""
    if slack <= 0:
        return [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    return [int(-(-total * (1 + slack) // n_shards))] * n_shards


def plan(counts: dict[int, int], owners: list[int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Intervals (arc, rank from, rank to, shard, slot from): round by round, what an arc still holds moves one arc
    clockwise and enters that arc's shard as far as there is room."""
    n, room, slot = len(owners), list(room), [0] * len(room)
    out, waiting = [], {arc: (0, c) for arc, c in sorted(counts.items()) if c}
    for step in range(n):
        for arc, (start, left) in list(waiting.items()):
            shard = owners[(arc + step) % n]
            take = min(left, room[shard])
            if take:
                out.append((arc, start, start + take, shard, slot[shard]))
                room[shard] -= take
                slot[shard] += take
                waiting[arc] = (start + take, left - take)
                if take == left:
                    del waiting[arc]
        if not waiting:
            return out
    raise ValueError("the shards have no room for all documents")


def shard(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", vnodes: int = 64, slack: float = 0.0) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot (0, 1, ... in each shard), arc.

    slack 0 makes the shards' document counts differ by one at most; a slack of 0.25 lets a shard hold a quarter more
    than the mean, and fewer documents move when a shard is added. size is the text's UTF-8 bytes plus 8; a null text
    has none and the checksum of the empty text. Null ids hash as empty, repeated rows take neighbouring slots. The
    largest driver-side and broadcast tables have n_shards * vnodes rows, a row more for each of 65,536 cells, and a row
    per arc and shard between them.
    """
    spark = docs.sparkSession
    nodes = ring(n_shards, vnodes)
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    keyed = keyed.withColumn("hashed", order_hash(F.col("doc_id"), F.when(F.col("doc_id").isNull(), F.concat_ws(":", "size", "text_crc32"))))
    point = F.conv(F.substring("hashed", 1, POINT // 4), 16, 10).cast("long")
    keyed = keyed.withColumn("point", point).withColumn("cell", F.shiftright("point", POINT - CELL).cast("int"))
    arcs = [(a, (nodes[a - 1][0] if a else -1) + 1, last) for a, (last, _) in enumerate(nodes)]
    arcs += [(0, nodes[-1][0] + 1, (1 << POINT) - 1)]
    cell = lambda c: F.shiftright(c, POINT - CELL).cast("int")
    cells = spark.createDataFrame(arcs, "arc int, lo long, hi long").where("lo <= hi").select("*", F.explode(F.sequence(cell("lo"), cell("hi"))).alias("cell"))
    # a row per cell and one per arc, whatever the input
    found = keyed.join(F.broadcast(cells), "cell").where(F.col("point").between(F.col("lo"), F.col("hi")))
    keyed = store(found.withColumn("hashed", F.substring("hashed", 5, 28)).drop("point", "cell", "lo", "hi"), "shard-keys")
    counts = {r["arc"]: r["n"] for r in keyed.groupBy("arc").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = plan(counts, [s for _, s in nodes], capacities(sum(counts.values()), n_shards, slack))
    places = spark.createDataFrame(places, PLAN).withColumnRenamed("arc", "p_arc")
    placed = ranked(keyed, "arc", "hashed", ["doc_id", "size", "text_crc32"], max(counts.values(), default=0))
    here = (F.col("arc") == F.col("p_arc")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to"))
    return placed.join(F.broadcast(places), here).select("doc_id", "size", "text_crc32", "shard", (F.col("slot_from") + F.col("rank") - F.col("rank_from")).alias("slot"), "arc")

"""Links within groups, whatever their size, without writing a group's pairs.

A group is linked so that its members hang together as all of its similar pairs would have them; pairs that are joined
already are not looked at again, and only links that join something are written. Groups of up to a block are one task's
row. Larger ones are cut into blocks by a hash, and linked in two passes:

1. each block by itself and with some pivots of the whole group, which joins nearly all members of a group of copies;
2. members that are not in their group's largest component, against all other members, block by block.

The second pass alone makes the result whole; the first leaves it little to do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bilinea.llm.common import store
from bilinea.llm.simhash import components
from bilinea.llm.trie import Forest

#: Members of a block, their weight, and pivots of a large group, about.
BLOCK, WEIGHT, PIVOTS = 1_024, 1 << 19, 64
#: Pairs that are looked at before those that are joined are set aside.
AT_ONCE = 1 << 16


class Pairs(Protocol):
    """Tells which pairs of places of a batch's members are similar."""

    def similar(self, i: np.ndarray, j: np.ndarray) -> np.ndarray: ...


def partners(first: np.ndarray, last: np.ndarray, at_once: int = AT_ONCE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of each place i with the places first[i] to last[i] - 1, some at a time."""
    many = np.maximum(last - first, 0)
    done, at = np.concatenate([[0], np.cumsum(many)]), 0
    while at < len(many):
        until = max(at + 1, int(np.searchsorted(done, done[at] + at_once, side="right")) - 1)
        i = np.repeat(np.arange(at, until), many[at:until])
        yield i, first[i] + np.arange(len(i)) - (done[i] - done[at])
        at = until


def links_of(work: DataFrame, pairs_of: Callable[[pa.StructArray], Pairs]) -> DataFrame:
    """Links (a, b) within the rows of work: `held`, lists of members (side, node, root, ...). Members of side 0 are
    compared with those after them, and members of side 1 with those of side 2. Members of one root are joined already, and
    a link joins two roots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            held, edges = lists.flatten(), np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths()))]).astype(np.int64)
            side, node, root = (np.asarray(held.field(name)) for name in ("side", "node", "root"))
            row = np.repeat(np.arange(len(lists)), np.diff(edges))
            order = np.lexsort((node, side, row))  # as in any run
            held, side, node, root = held.take(pa.array(order)), side[order], node[order], root[order]
            second = edges[row] + np.bincount(row, side == 1, minlength=len(lists)).astype(np.int64)[row]
            first = np.where(side == 0, np.arange(len(row)) + 1, second)
            last = np.where(side == 2, 0, edges[row + 1])
            _, code = np.unique(root, return_inverse=True)
            forest, pairs = Forest(int(code.max(initial=-1)) + 1), pairs_of(held)
            for i, j in partners(first, last):
                ok = forest.apart(code[i], code[j])
                i, j = i[ok], j[ok]
                ok = pairs.similar(i, j)
                i, j = i[ok], j[ok]
                kept = forest.join(code[i], code[j])
                yield pa.record_batch([pa.array(root[i[kept]]), pa.array(root[j[kept]])], names=["a", "b"])

    return work.mapInArrow(run, "a long, b long").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def link_groups(members: DataFrame, group: str, payload: list[str], pairs_of: Callable[[pa.StructArray], Pairs], weight: str | None = None, block: int = BLOCK, most_weight: int = WEIGHT) -> DataFrame:
    """Links (a, b) that join all similar members of each group. members: group, node (a long), payload; none twice.

    weight: a payload column; the members of a block weigh most_weight at most, about.
    """
    members = members.select(F.col(group).alias("grp"), "node", *payload)  # the group's name may be one of those below
    group = "grp"
    heavy = F.sum(weight) if weight else F.lit(0)
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / block, heavy / most_weight)).cast("int")
    sizes = members.groupBy(group).agg(blocks.alias("blocks"), F.count(F.lit(1)).alias("size")).where("size > 1").drop("size")
    own = F.pmod(F.xxhash64("node", F.lit(11)), F.col("blocks")).cast("int").alias("own")
    placed = store(members.join(sizes, group).select(group, "blocks", own, "node", *payload), "link-members")
    chosen = F.pmod(F.xxhash64("node", F.lit(13)), F.col("blocks") * (block // PIVOTS or 1)) == 0
    others = F.explode(F.array_remove(F.sequence(F.lit(0), F.col("blocks") - 1), F.col("own"))).alias("own")
    pivots = placed.where((F.col("blocks") > 1) & chosen).select(group, "blocks", others, "node", *payload)
    held = lambda *side_root: F.collect_list(F.struct(*side_root, "node", *payload)).alias("held")
    work = placed.unionByName(pivots).groupBy(group, "own").agg(held(F.lit(0).alias("side"), F.col("node").alias("root")))
    links = store(links_of(work.select("held"), pairs_of), "links")
    large = placed.where("blocks > 1")
    if large.isEmpty():
        return links

    roots = components(links)
    rooted = store(large.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "link-rooted")
    sized = rooted.groupBy(group, "root").agg(F.count(F.lit(1)).alias("n"))
    main = sized.groupBy(group).agg(F.max_by("root", F.struct("n", "root")).alias("main"))
    rest = store(rooted.join(main, group).where("root <> main").drop("main"), "link-rest")
    stars = roots.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    if rest.isEmpty():
        return stars
    cells = rest.groupBy(group).agg(blocks.alias("cells"))
    cell = F.pmod(F.xxhash64("node", F.lit(17)), F.col("cells")).cast("int").alias("cell")
    left = rest.join(cells, group).select(group, cell, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("own"), F.lit(1).alias("side"), "root", "node", *payload)
    right = rooted.join(cells, group).select(group, F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"), "own", F.lit(2).alias("side"), "root", "node", *payload)
    work = left.unionByName(right).groupBy(group, "cell", "own").agg(held("side", "root"))
    return stars.unionByName(links_of(work.select("held"), pairs_of))

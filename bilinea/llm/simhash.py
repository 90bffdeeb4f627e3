"""SimHash near-deduplication by a binary-trie self-join.

A fingerprint is a path of 64 bits in a binary trie. The self-join walks pairs of nodes together, from the pair of the
root with itself to the pairs of children, adds up the bits in which the two paths differ, and prunes a pair once more
differ than the error budget allows (bilinea/llm/trie.py). The pairs that are still open form a table: Spark walks them
down level by level until their leaves are few enough for a task, and tasks walk on to where single leaves meet.

A budget of two bits is walked in one trie. A budget wide enough for near copies that share four fifths of their
shingles is walked in three tries, each of which allows a third of it in its first levels. Such a budget also lets
documents through that are less alike. So the links of the walk only tell who may belong together; within such a group
the shingle sets decide, block by block, between all whose fingerprints are within the budget.
"""

from __future__ import annotations

import math
import uuid
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bilinea.llm.common import keep_rows, small_batches, store
from bilinea.llm.trie import BITS, TINY, Budget, Forest, Nodes, Sets, parts, walk

#: Differing bits of linked fingerprints over shingles of three words.
STRICT = Budget(2)
#: Fingerprints over the distinct shingles of near copies differ in up to 14 bits: see the README for the recall.
WIDE = Budget(14, tries=3)
#: Words of a shingle and the similarity of shingle sets from which two documents are near copies.
NEAR_SHINGLE, SIMILAR = 5, 0.8
#: Bits that two fingerprints together may differ in, of 128: sets of a similarity of 0.8 differ in 19.5 of them on
#: average, with a deviation of 4.1, unlike ones in half.
BOTH = 28
#: Levels that Spark walks in one plan, and the leaves of a node pair above which it does.
LEVELS, MOST_IN_TASK = 8, 8_192
#: With a wide budget nearly all pairs of nodes stay open, so a leaf is sent once for each node of its trie: a pair that
#: goes to a task may have so great a share of the leaves, whatever their number, and is walked down to MOST_IN_TASK there.
SHARE = 8
#: Parts of the right nodes that a left one meets, so that a left node's pairs are more than one task's work.
PIECES = 4
#: Documents of a group, about, whose sets are compared with those of as many others at once.
BLOCK = 1_024
#: Node pairs for each task, about, and links that a task looks at before it sets aside those between what is joined.
PAIRS_A_TASK, PIECE = 64, 1 << 15
#: Links of components that a task holds at once, about.
EDGES = 1 << 16


# Fingerprints


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of each of the text's shingles, repeats included; fewer words are one shingle, no words none."""
    found = (text or "").encode().lower().split()  # bytes: only A-Z change, and only ASCII white space parts
    if not found:
        return np.zeros(0, np.uint64)
    line, digest = b" ".join(found), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(found) - shingle + 1)
    out = np.zeros(n, np.uint64)
    for at in range(0, n, 50_000):
        until = min(n, at + 50_000)
        spans = zip(starts[at:until].tolist(), ends[min(shingle, len(found)) - 1 :][at:until].tolist())
        out[at:until] = np.fromiter((digest(line[a:b], 42) for a, b in spans), np.uint64, until - at)
    return out


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is set if it is set in over half of the hashes."""
    set_bits = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 50_000):
        part = hashes[at : at + 50_000].astype(">u8")
        set_bits += np.unpackbits(part.view(np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes)).view(">u8")[0])


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Other hashes of the same shingles."""
    hashes = (hashes ^ (hashes >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    hashes = (hashes ^ (hashes >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return hashes ^ (hashes >> np.uint64(31))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distinct: bool = False, with_set: bool = False, carry: list[Column] = ()) -> DataFrame:
    """doc_id, fingerprint (as a signed long), n (the number of shingles), and what is to be carried.

    distinct: each shingle counts once, and `more` is a second fingerprint by other hashes. with_set: the shingles too.
    Null and empty texts, and those without words, have no shingles and fingerprint zero.
    """
    small_batches(docs.sparkSession)
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *carry)
    hashes = [T.StructField("shingles", T.ArrayType(T.LongType()))] if with_set else []
    more = [T.StructField("more", T.LongType())] if distinct else []
    schema = T.StructType([given.schema["doc_id"], T.StructField("fingerprint", T.LongType()), T.StructField("n", T.LongType()), *more, *hashes, *given.schema.fields[2:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, second, sizes, sets = [], [], [], []
            for text in batch.column(1):
                found = shingle_hashes(text.as_py(), shingle)
                found = np.unique(found) if distinct else found
                prints.append(fingerprint(found))
                second.append(fingerprint(mixed(found)) if distinct else 0)
                sizes.append(len(found))
                sets.append(found.view(np.int64) if with_set else None)
            signed = lambda x: pa.array(np.array(x, dtype=np.uint64).view(np.int64))
            columns = [signed(prints), pa.array(sizes, pa.int64()), *([signed(second)] if distinct else [])]
            if with_set:
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *sets]))))
            yield pa.record_batch([batch.column(0), *columns, *batch.columns[2:]], names=schema.names)

    return given.mapInArrow(run, schema)


# The walk by Spark


def turned(fp, by: int):
    return F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, BITS - by)) if by else fp


def path(level, leaf: str = "leaf") -> Column:
    """The first bits of a leaf, as many as level says; a shift by 64 would be one by none."""
    return F.when(F.expr(level) == 0, F.lit(0).cast("long")).otherwise(F.expr(f"shiftrightunsigned({leaf}, cast({BITS} - {level} as int))"))


def down(pairs: DataFrame, nodes: DataFrame, level: int, budget: Budget, most_in_task: int) -> DataFrame:
    """The pairs of nodes at `level` that have too many leaves for a task give way to the pairs of their children;
    all others stay as they are."""
    step = lambda x, y: F.struct(F.lit(x).cast("long").alias("x"), F.lit(y).cast("long").alias("y"))
    large = (F.col("level") == level) & (F.col("n_a") + F.col("n_b") > most_in_task)
    moves = F.when(large & (F.col("a") == F.col("b")), F.array(step(0, 0), step(1, 1), step(0, 1)))
    moves = moves.when(large, F.array(step(0, 0), step(1, 1), step(0, 1), step(1, 0))).otherwise(F.array(step(None, None)))
    out = pairs.select("trie", "level", "a", "b", "differ", F.explode(moves).alias("to"))
    child = lambda side, bit: F.coalesce(F.shiftleft(side, 1).bitwiseOR(F.col(bit)), F.col(side)).alias(side)
    moved = F.col("to.x").isNotNull().cast("int")
    unlike = F.coalesce((F.col("to.x") != F.col("to.y")).cast("int"), F.lit(0))
    out = out.select("trie", (F.col("level") + moved).alias("level"), child("a", "to.x"), child("b", "to.y"), (F.col("differ") + unlike).alias("differ"), (unlike == 1).alias("unlike"))
    out = out.where(~F.col("unlike") | (F.col("differ") <= budget.at(level + 1)))
    for side in ("a", "b"):
        out = out.join(nodes.select("trie", "level", F.col("path").alias(side), F.col("n").alias(f"n_{side}")), ["trie", "level", side])
    return out.select("trie", "level", "a", "b", "differ", "n_a", "n_b")


def frontier(leaves: DataFrame, budget: Budget, most_in_task: int) -> DataFrame:
    """The pairs of nodes (trie, level, a, b, differ, n_a, n_b; a and b are paths) at which Spark hands over to tasks:
    walked down from the root, none pruned, none with more leaves than a task should hold."""
    roots = leaves.groupBy("trie").agg(F.count(F.lit(1)).alias("n_a"))
    zero = F.lit(0).cast("long")
    pairs = store(roots.select("trie", F.lit(0).alias("level"), zero.alias("a"), zero.alias("b"), F.lit(0).alias("differ"), "n_a", F.col("n_a").alias("n_b")), "trie-root")
    large = F.col("n_a") + F.col("n_b") > most_in_task
    done, pairs = pairs.where(~large), pairs.where(large)
    for level in range(0, BITS, LEVELS):
        if pairs.isEmpty():
            break
        if level:
            ends = pairs.select("trie", F.explode(F.array("a", "b")).alias("top")).distinct()
            leaves_here = leaves.withColumn("top", path(str(level))).join(ends, ["trie", "top"], "left_semi")
        else:
            leaves_here = leaves
        deepest = leaves_here.groupBy("trie", path(str(level + LEVELS)).alias("deep")).agg(F.count(F.lit(1)).alias("n"))
        each = deepest.select("trie", "n", "deep", F.explode(F.sequence(F.lit(level), F.lit(level + LEVELS))).alias("level"))
        nodes = each.groupBy("trie", "level", F.expr(f"shiftrightunsigned(deep, {level + LEVELS} - level)").alias("path")).agg(F.sum("n").alias("n"))
        nodes = store(nodes, "trie-nodes")
        for l in range(level, level + LEVELS):
            pairs = down(pairs, nodes, l, budget, most_in_task)
        pairs = store(pairs, "trie-pairs")
        done = done.unionByName(pairs.where(~large) if level + LEVELS < BITS else pairs)
        pairs = pairs.where(large)
    return done


def self_join(prints: DataFrame, budget: Budget = STRICT, most_in_task: int = MOST_IN_TASK, similar: float | None = None) -> DataFrame:
    """Links (a, b) between the distinct fingerprints (fp) that join all whose bits differ within the budget: of the links
    of a node pair, only those that join what earlier ones leave apart.

    With similar, prints also have n and more: linked ones are alike enough to be candidates().
    """
    extra = ["n", "more"] if similar else []
    turns = F.explode(F.array(*[F.struct(F.lit(r).alias("trie"), turned(F.col("fp"), r * budget.turn).alias("leaf")) for r in range(budget.tries)]))
    leaves = store(prints.select(turns.alias("t"), *extra).select("t.trie", "t.leaf", *extra), "trie-leaves")
    sent, pieces = (max(most_in_task, prints.count() // SHARE), PIECES) if similar else (most_in_task, 1)
    pairs = store(frontier(leaves.select("trie", "leaf"), budget, sent), "trie-frontier")
    node = ["trie", "level", "path"]
    ends = pairs.select("trie", "level", F.explode(F.array("a", "b")).alias("path")).distinct()
    levels = [r["level"] for r in ends.select("level").distinct().collect()]  # 65 at most
    if not levels:
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    placed = leaves.withColumn("level", F.explode(F.array(*[F.lit(x) for x in sorted(levels)]))).withColumn("path", path("level"))
    held = F.sort_array(F.collect_list(F.struct("leaf", *extra))).alias("held")
    # a node's leaves are those of one task at most
    blocks = store(placed.join(ends, node, "left_semi").groupBy(*node).agg(held), "trie-blocks")
    n_pairs = pairs.count()
    tasks = min(n_pairs, max(4 * prints.sparkSession.sparkContext.defaultParallelism, n_pairs * sent**2 // most_in_task**2 // PAIRS_A_TASK))
    right = blocks.select("trie", "level", F.col("path").alias("b"), F.col("held").alias("right"))
    left = blocks.select("trie", "level", F.col("path").alias("a"), F.col("held").alias("left"), F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))).alias("piece"))
    piece = F.pmod(F.xxhash64("b", F.lit(5)), F.lit(pieces)).cast("int").alias("piece")
    work = pairs.select("trie", "level", "a", "b", piece, "differ").join(right, ["trie", "level", "b"])
    work = work.repartition(tasks, "trie", "level", "a", "piece").join(left, ["trie", "level", "a", "piece"])
    work = work.select("trie", "level", "a", "differ", "left", F.when(F.col("a") != F.col("b"), F.col("right")).alias("right"))

    def columns(held: pa.Scalar) -> list[np.ndarray]:
        """Leaves in order of their unsigned value, and what stands beside them."""
        found = [np.asarray(held.values.field(k)) for k in range(1 + len(extra))]
        order = np.argsort(found[0].view(np.uint64))
        return [found[0].view(np.uint64)[order], *(c[order] for c in found[1:])]

    def links(left: list[np.ndarray], right: list[np.ndarray] | None, differ: int, nodes: Nodes, other: Nodes | None) -> tuple[np.ndarray, np.ndarray]:
        shift = len(left[0]) if right else 0
        leaf, *beside = [np.concatenate([p, q]) for p, q in zip(left, right)] if right else left
        forest, found = Forest(len(leaf)), [(np.zeros(0, np.int64),) * 2]
        for all_i, all_j, _ in walk(nodes, other, differ, budget):
            for at in range(0, len(all_i), PIECE):
                i, j = all_i[at : at + PIECE], all_j[at : at + PIECE] + shift
                ok = forest.apart(i, j)
                if similar:
                    ok &= candidates(i, j, leaf, *beside, similar, budget)
                i, j = i[ok], j[ok]
                kept = forest.join(i, j)
                found.append((i[kept], j[kept]))
        i, j = (np.concatenate(c) for c in zip(*found))
        return leaf[i], leaf[j]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: OrderedDict[tuple, Nodes] = OrderedDict()  # pairs of one node follow each other, more or less
        held: tuple = (None, None)

        def nodes_of(trie: int, level: int, leaves: np.ndarray) -> Nodes:
            key = (trie, level, int(leaves[0]) >> (BITS - level))
            if key not in cache:
                cache[key] = Nodes(leaves, level)
                if len(cache) > 8:
                    cache.popitem(last=False)
            cache.move_to_end(key)
            return cache[key]

        for batch in batches:
            for trie, level, a, differ, left, right in zip(*batch.columns):
                key = (trie.as_py(), level.as_py(), a.as_py())
                if held[0] != key:
                    held = key, columns(left)
                mine, other, found = held[1], columns(right) if right.is_valid else None, [(np.zeros(0, np.uint64),) * 2]
                for depth, p, q, unlike in parts(mine[0], other[0] if other else None, key[1], differ.as_py(), budget, most_in_task):
                    x, y = [c[p] for c in mine], None if q is None else [c[q] for c in (other or mine)]
                    found.append(links(x, y, unlike, nodes_of(key[0], depth, x[0]), nodes_of(key[0], depth, y[0]) if y else None))
                x, y = (np.concatenate(c) for c in zip(*found))
                yield pa.record_batch([pa.array(np.full(len(x), key[0], np.int32)), pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], names=["trie", "x", "y"])

    back = lambda c: F.coalesce(*[F.when(F.col("trie") == r, turned(F.col(c), (BITS - r * budget.turn) % BITS)) for r in range(budget.tries)])
    met = work.mapInArrow(run, "trie int, x long, y long").select(back("x").alias("x"), back("y").alias("y"))
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


# Components


def stars(edges: DataFrame) -> DataFrame:
    """Links (v, u) that join what each task's rows join, every node hung on the smallest one: no link twice in a task, and
    none along a path. A task holds EDGES rows at once."""

    def hung(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        v, u = (np.concatenate([np.asarray(batch.column(k)) for batch in held]) for k in (0, 1))
        nodes, code = np.unique(np.concatenate([v, u]), return_inverse=True)  # a smaller place is a smaller node
        forest, none = Forest(len(nodes)), np.zeros(0, np.int64)
        forest.join(code[: len(v)], code[len(v) :])
        forest.apart(none, none)  # every place knows its root now
        low = np.flatnonzero(forest.root != np.arange(len(nodes)))
        return pa.record_batch([pa.array(nodes[low]), pa.array(nodes[forest.root[low]])], names=["v", "u"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = [], 0
        for batch in batches:
            held.append(batch)
            many += len(batch)
            if many >= EDGES:
                yield hung(held)
                held, many = [], 0
        if many:
            yield hung(held)

    return edges.select("v", "u").mapInArrow(run, "v long, u long")


def components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node that links (a, b) reach, for every node that has a link.

    Alternates large-star and small-star steps: each node's neighbours are hung on its smallest one, until every
    component is a star, which takes about as many rounds as the logarithm of the longest path. Before a step is written
    to the shared folder each task joins what its own rows join. A round starts with each node's smallest and largest
    neighbour: where a node below another has no second one, all is done, and these are the result. Tasks are as many as
    cores, or more where edges are more than EDGES for each; nothing but a count comes to the driver.
    """
    edges = store(stars(links.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))), "edges")
    while True:
        tasks = max(links.sparkSession.sparkContext.defaultParallelism, math.ceil(edges.count() / EDGES))
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        near = store(both.groupBy("v").agg(F.min("u").alias("m"), F.max("u").alias("most")).coalesce(tasks), "neighbours")
        least = near.select("v", F.least("v", "m").alias("m"))
        if near.where("m < v and m < most").isEmpty():
            return least.select(F.col("v").alias("node"), F.col("m").alias("root"))
        large = both.where("u > v").join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("u <> v")
        edges = store(stars(large.coalesce(tasks)), "edges")
        least = edges.groupBy("v").agg(F.min("u").alias("m"))
        small = edges.join(least, "v").select(F.explode(F.array(F.struct(F.col("u").alias("v"), F.col("m").alias("u")), F.struct("v", F.col("m").alias("u")))).alias("e"))
        edges = store(stars(small.select("e.v", "e.u").where("u <> v").coalesce(tasks)), "edges")


def distinct_prints(prints: DataFrame) -> DataFrame:
    rest = [F.min(F.struct(*[c for c in ("n", "more") if c in prints.columns])).alias("r")]
    return store(prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("first"), *rest).select("fp", "first", "r.*"), "simhash-distinct")


def rooted(distinct: DataFrame, roots: DataFrame) -> DataFrame:
    """fingerprint, root, first of each distinct fingerprint: its component's smallest fingerprint, its smallest id."""
    return store(distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(F.col("fp").alias("fingerprint"), F.coalesce("root", "fp").alias("root"), "first"), "simhash-rooted")


def label(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, budget: Budget = STRICT, most_in_task: int = MOST_IN_TASK) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id.

    component_id is the smallest doc_id that chains of links reach, the document's own included. Null ids are in no
    order: a component of such rows alone has a null component_id. Repeated rows and equal fingerprints are one node of
    the join. Other columns are not read; an empty table gives no rows.
    """
    prints = store(fingerprints(docs, id_col, text_col, shingle), "simhash")
    distinct = distinct_prints(prints)
    nodes = rooted(distinct, components(self_join(distinct.select("fp"), budget, most_in_task)))
    least = store(nodes.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-least")
    named = store(nodes.join(least, "root").select("fingerprint", "component_id"), "simhash-named")
    return prints.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


# Near copies


def candidates(i: np.ndarray, j: np.ndarray, leaf: np.ndarray, n: np.ndarray, more: np.ndarray, similar: float, budget: Budget) -> np.ndarray:
    """Which pairs of places may be near copies: their fingerprints differ within the budget, both fingerprints in BOTH
    bits at most, and their numbers of shingles allow the similarity."""
    bits = np.bitwise_count(leaf.view(np.uint64)[i] ^ leaf.view(np.uint64)[j])
    both = bits + np.bitwise_count(more.view(np.uint64)[i] ^ more.view(np.uint64)[j])
    return (bits <= budget.bits) & (both <= BOTH) & (np.minimum(n[i], n[j]) >= similar * np.maximum(n[i], n[j]) - TINY)


def similar_links(sets: DataFrame, groups: DataFrame, similar: float, budget: Budget, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that join all near copies of each group. sets: fp, n, more, shingles; groups: node, root.

    A group is cut into blocks by a hash, and each pair of its blocks is a task's work. Pairs of documents are looked at
    there and written nowhere; what is joined already is not compared again.
    """
    sizes = groups.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    placed = sets.join(groups.withColumnRenamed("node", "fp"), "fp").join(sizes, "root")
    placed = placed.withColumn("own", F.pmod(F.xxhash64("fp", F.lit(3)), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = placed.select("root", "own", "fp", "n", "more", "shingles", other)
    pair = [F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")]
    held = F.collect_list(F.struct(F.col("own").alias("block"), "fp", "n", "more", "shingles")).alias("held")
    work = dealt.groupBy("root", *pair).agg(held).select("i", "j", "held")

    def links(i: int, j: int, held: pa.StructArray) -> Iterator[pa.RecordBatch]:
        mine, leaf, n, more = (np.asarray(held.field(k)) for k in range(4))
        order = np.argsort(leaf)  # as in any run
        mine, leaf, n, more = mine[order], leaf[order], n[order], more[order]
        sets = Sets([np.asarray(held.field(4)[int(k)].values) for k in order])
        forest, left, right = Forest(len(leaf)), np.flatnonzero(mine == i), np.flatnonzero(mine == j)
        for at in range(0, len(left), 64):
            x, y = (c.ravel() for c in np.meshgrid(left[at : at + 64], right, indexing="ij"))
            ok = (x < y if i == j else x >= 0) & forest.apart(x, y)
            x, y = x[ok], y[ok]
            ok = candidates(x, y, leaf, n, more, similar, budget)
            x, y = x[ok], y[ok]
            ok = sets.similar(x, y, similar)
            x, y = x[ok], y[ok]
            kept = forest.join(x, y)
            yield pa.record_batch([pa.array(leaf[x[kept]]), pa.array(leaf[y[kept]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, held in zip(*batch.columns):
                yield from links(i.as_py(), j.as_py(), held.values)

    return work.mapInArrow(run, "a long, b long").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def similar_roots(docs: DataFrame, distinct: DataFrame, id_col: str, text_col: str, shingle: int, similar: float, budget: Budget, most_in_task: int, block: int) -> DataFrame:
    """node, root of the fingerprints that have near copies: the smallest one that chains of them reach. Only documents
    that the walk finds a candidate for are read again, for their shingles."""
    # links are stored before they are joined: two steps in Python in one stage would be two workers for each task
    walked = store(self_join(distinct.select("fp", "n", "more"), budget, most_in_task, similar), "near-walked")
    groups = store(components(walked), "near-groups")
    mine = f"_id_{uuid.uuid4().hex}"  # a name that no column of docs has
    met = groups.select(F.col("node").alias("fp"))
    ids = store(distinct.join(met, "fp", "left_semi").select(F.col("first").alias(mine)), "near-ids")
    given = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    some = given.join(ids.where(F.col(mine).isNotNull()), F.col("_id") == F.col(mine), "left_semi").unionByName(given.where("_id is null"))
    found = fingerprints(some, "_id", "_text", shingle, distinct=True, with_set=True).withColumnRenamed("fingerprint", "fp")
    sets = found.join(met, "fp", "left_semi").groupBy("fp").agg(F.min(F.struct("n", "more", "shingles")).alias("r")).select("fp", "r.*")
    return components(store(similar_links(store(sets, "near-sets"), groups, similar, budget, block), "near-links"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = NEAR_SHINGLE, similar: float = SIMILAR, budget: Budget = WIDE, most_in_task: int = MOST_IN_TASK, block: int = BLOCK) -> DataFrame:
    """One document of each group that chains of near copies join, with all its columns: that with the smallest id, a
    null one only where there is no other; of rows that repeat the id, one with the smallest fingerprint.

    Near copies: fingerprints over the distinct shingles differ within the budget, both fingerprints in BOTH bits at
    most, and the shingle sets have a Jaccard similarity of `similar` or more. Equal fingerprints are taken as near copies without that: sets of a similarity
    just below 0.8 have equal ones about once in 100,000 pairs. Texts without words are all alike. An empty table gives
    no rows.
    """
    prints = store(fingerprints(docs, id_col, text_col, shingle, distinct=True), "simhash")
    distinct = distinct_prints(prints)
    nodes = rooted(distinct, similar_roots(docs, distinct, id_col, text_col, shingle, similar, budget, most_in_task, block))
    best = F.min(F.struct(F.isnull("doc_id"), "doc_id", "fingerprint")).alias("best")
    wanted = prints.join(nodes, "fingerprint").groupBy("root").agg(best).select("best.doc_id", F.col("best.fingerprint").alias("key"))

    def keyed(some: DataFrame) -> DataFrame:
        text = some.select("_id", F.col(f"row.{text_col}").alias("_text"), "row")
        return fingerprints(text, "_id", "_text", shingle, distinct=True, carry=[F.col("row")]).select(F.col("doc_id").alias("_id"), "row", F.col("fingerprint").alias("_key"))

    return keep_rows(docs, id_col, prints, store(wanted, "simhash-wanted"), keyed)

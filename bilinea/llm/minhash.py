"""Near-duplicates by MinHash signatures and an inverted join of their coordinates.

A text's set holds its distinct shingles of four words. Its signature has 64 coordinates: the least value of 64 hash
functions over the set. Two sets of similarity s share each coordinate with probability s.

Signatures are joined by an inverted index: each is posted under its coordinate-value pairs, and postings of one pair
count as collisions. Only signatures with MATCHES collisions or more are candidates. Two such signatures share one of the
first 64 - MATCHES + 1 pairs of either, in any order of all pairs that is the same for both. The order is that of rising
frequency, so a signature is posted under its rarest pairs alone (its prefix); pairs that only one signature has come
first and need no posting, and a signature with a prefix of such pairs is skipped altogether. Within a posting list,
collisions are counted some coordinates at a time, and pairs that cannot reach the threshold any more are skipped.

Candidates are no result: those that hang together form a group, and within it the full sets of all decide. At a
similarity of 0.8, the least that links, a pair has fewer than MATCHES collisions once in 50 million times.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bilinea.llm.common import keep_rows, small_batches, store
from bilinea.llm.linking import BLOCK, link_groups
from bilinea.llm.simhash import components, shingle_hashes

#: Words of a shingle, and the similarity of linked sets in hundredths.
SHINGLE, SIMILAR = 4, 80
#: Coordinates of a signature, collisions of a candidate, and the pairs that a signature is posted under at most.
COORDINATES, MATCHES = 64, 32
PREFIX = COORDINATES - MATCHES + 1
#: Coordinates that are compared before hopeless pairs are skipped.
STEP = 16
_RANDOM = np.random.default_rng(64)
FACTORS = _RANDOM.integers(0, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
TERMS = _RANDOM.integers(0, 2**63, COORDINATES, dtype=np.uint64)


# Signatures


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set that is not empty."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 4_096):
        values = hashes[None, at : at + 4_096] * FACTORS[:, None]
        values += TERMS[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    return least


def postings(least: np.ndarray) -> np.ndarray:
    """A number for each pair of a coordinate and its value."""
    return (least & ~np.uint64(COORDINATES - 1) | np.arange(COORDINATES, dtype=np.uint64)).view(np.int64)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, with_set: bool = False, carry: list[Column] = ()) -> DataFrame:
    """doc_id, digest (of the set), n (its size), posts, brief (a byte of each coordinate), with_set the set itself
    (shingles) instead of posts, and what is to be carried. Texts without words have an empty set and no posts."""
    small_batches(docs.sparkSession)
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *carry)
    own = given.select("doc_id", *given.columns[2:]).schema
    names = ["doc_id", "digest", "n", "shingles" if with_set else "posts", "brief", *given.columns[2:]]
    types = [own[0].dataType, "binary", "long", "array<long>", "binary", *[f.dataType for f in own.fields[1:]]]
    schema = ", ".join(f"`{n}` {t if isinstance(t, str) else t.simpleString()}" for n, t in zip(names, types))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, sizes, lists, brief = [], [], [], []
            for text in batch.column(1):
                found = np.unique(shingle_hashes(text.as_py(), shingle))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                sizes.append(len(found))
                least = signature(found) if len(found) else np.zeros(0, np.uint64)
                lists.append(found.view(np.int64) if with_set else postings(least) if len(found) else least.view(np.int64))
                brief.append((least >> np.uint64(20)).astype(np.uint8).tobytes())
            ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *lists])))
            yield pa.record_batch([batch.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), listed, pa.array(brief, pa.binary()), *batch.columns[2:]], names=names)

    return given.mapInArrow(run, schema)


# Pairs


class Collisions:
    """Counts the coordinates that two members of a posting list share."""

    def __init__(self, held: pa.StructArray, matches: int = MATCHES, similar: int = SIMILAR) -> None:
        brief = held.field("brief")
        self.n, self.matches, self.least = np.asarray(held.field("n")), matches, similar
        self.brief = np.frombuffer(b"".join(brief.to_pylist()), np.uint8).reshape(-1, COORDINATES)

    def similar(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        x, y = self.n[i], self.n[j]
        left = np.flatnonzero(100 * np.minimum(x, y) >= self.least * np.maximum(x, y))
        count = np.zeros(len(left), dtype=np.int64)
        for at in range(0, COORDINATES, STEP):
            part = slice(at, at + STEP)
            count += (self.brief[i[left], part] == self.brief[j[left], part]).sum(axis=1)
            hope = count + COORDINATES - at - STEP >= self.matches
            left, count = left[hope], count[hope]
        out = np.zeros(len(i), dtype=bool)
        out[left] = True
        return out


class Sets:
    """Compares the full sets of a group's members, after their signatures."""

    def __init__(self, held: pa.StructArray) -> None:
        lists = held.field("shingles")
        self.collisions, self.n = Collisions(held), np.asarray(held.field("n"))
        self.at = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths()))]).astype(np.int64)
        known, self.codes = np.unique(np.asarray(lists.flatten()), return_inverse=True)
        self.marked = np.zeros(len(known), dtype=np.int64)

    def similar(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), dtype=bool)
        hope = np.flatnonzero(self.collisions.similar(i, j))
        for some in np.split(hope, np.flatnonzero(np.diff(i[hope])) + 1):
            if not len(some):
                continue
            own, others = i[some[0]], j[some]
            mine, size = self.codes[self.at[own] : self.at[own + 1]], self.n[others]
            self.marked[mine] = 1
            ends = np.cumsum(size)
            every = np.repeat(self.at[others] - (ends - size), size) + np.arange(ends[-1])
            common = np.add.reduceat(self.marked[self.codes[every]], ends - size)
            self.marked[mine] = 0
            out[some] = 100 * common >= SIMILAR * (self.n[own] + size - common)
        return out


def posted(sets: DataFrame) -> DataFrame:
    """The postings (post, node, n, brief) that candidates meet in: each signature under its prefix. sets: node, n, posts,
    brief, of distinct sets. Pairs are counted as they are aggregated, and nothing but what is shared is moved again."""
    each = sets.select("node", F.explode("posts").alias("post"))
    shared = each.groupBy("post").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    own = each.join(shared, "post").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "post"))).alias("own"))  # COORDINATES at most
    prefix = F.slice("own", F.lit(1), F.greatest(F.lit(0), F.lit(PREFIX - COORDINATES) + F.size("own")))
    kept = own.select("node", prefix.alias("prefix")).where(F.size("prefix") > 0)
    return kept.join(sets.select("node", "n", "brief"), "node").select(F.explode("prefix.post").alias("post"), "node", "n", "brief")


def roots_of(docs: DataFrame, sets: DataFrame, id_col: str, text_col: str, shingle: int, block: int) -> DataFrame:
    """node, root of the sets that have near copies: the smallest node that chains of links reach. Only texts that have a
    candidate are read again, for their sets."""
    groups = store(components(link_groups(posted(sets), "post", ["n", "brief"], Collisions, block=block)), "minhash-groups")
    mine = f"_id_{uuid.uuid4().hex}"  # a name that no column of docs has
    met = sets.join(groups, "node").select("node", "digest", "n", "brief", "root", "first")
    ids = store(met.select(F.col("first").alias(mine)).distinct(), "minhash-ids")
    given = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    some = given.join(ids.where(F.col(mine).isNotNull()), F.col("_id") == F.col(mine), "left_semi").unionByName(given.where("_id is null"))
    found = signatures(some, "_id", "_text", shingle, with_set=True).select("digest", "shingles")
    full = found.join(met.select("digest"), "digest", "left_semi").groupBy("digest").agg(F.first("shingles").alias("shingles"))
    members = store(full.join(met.drop("first"), "digest").select("root", "node", "n", "brief", "shingles"), "minhash-members")
    return components(link_groups(members, "root", ["n", "brief", "shingles"], Sets, weight="n", block=block))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Stored: the signature of each row (doc_id, digest, n, ...), and the class of each set that is not empty (digest,
    root, first: its smallest id)."""
    prints = store(signatures(docs, id_col, text_col, shingle), "minhash")
    one = [F.first(c).alias(c) for c in ("n", "posts", "brief")]
    grouped = prints.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("first"), *one)
    sets = store(grouped.withColumn("node", F.monotonically_increasing_id()), "minhash-sets")
    roots = roots_of(docs, sets, id_col, text_col, shingle, block)
    return prints, store(sets.join(roots, "node", "left").select("digest", F.coalesce("root", "node").alias("root"), "first"), "minhash-classes")


def label(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    component_id is the smallest doc_id that chains of links reach, the document's own included; a document without words
    is linked with nothing. Null ids are in no order: a component of such rows alone has a null component_id, and they
    are kept. Repeated rows and equal sets are one node of the join. Other columns are not read; an empty table gives no
    rows.
    """
    prints, found = classes(docs, id_col, text_col, shingle, block)
    least = store(found.groupBy("root").agg(F.min("first").alias("least")), "minhash-least")
    named = store(found.join(least, "root").select("digest", "least"), "minhash-named")
    component = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id"))
    out = prints.select("doc_id", "digest", "n").join(named, "digest", "left").select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """One document of each class, with all its columns: that with the smallest id, a null one only where there is no
    other; of rows that repeat the id, one with the smallest digest. Texts without words are kept, one of each id."""
    prints, found = classes(docs, id_col, text_col, shingle, block)
    rows = prints.select("doc_id", "digest", "n").join(found.select("digest", "root"), "digest", "left")
    best = F.min(F.struct(F.isnull("doc_id"), "doc_id", "digest")).alias("best")
    alike = rows.where("n > 0").groupBy("root").agg(best).select("best.doc_id", F.col("best.digest").alias("key"))
    empty = rows.where("n = 0").select("doc_id", F.col("digest").alias("key")).distinct()

    def keyed(some: DataFrame) -> DataFrame:
        text = some.select("_id", F.col(f"row.{text_col}").alias("_text"), "row")
        return signatures(text, "_id", "_text", shingle, carry=[F.col("row")]).select(F.col("doc_id").alias("_id"), "row", F.col("digest").alias("_key"))

    return keep_rows(docs, id_col, prints, store(alike.unionByName(empty), "minhash-wanted"), keyed)

import random

import numpy as np
import pyarrow as pa
import pytest
from bilinea.llm import linking, minhash, queries


def slow_set(text):
    words = [w for w in (text or "").translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if w]
    words = ["".join(c.lower() if c.isascii() else c for c in w) for w in words]
    return {tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set()


def slow_labels(rows):
    """(doc_id, n_shingles, component_id, kept) of rows without null ids."""
    sets = {}
    for d, text, *_ in rows:
        sets.setdefault(d, []).append(slow_set(text))
    nodes = [(d, s) for d, each in sets.items() for s in each]
    root = list(range(len(nodes)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(nodes):
        for j, (_, b) in enumerate(nodes[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(nodes):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, len(s), least[find(i)], d == least[find(i)]) for i, (d, s) in enumerate(nodes))


def texts(n, seed, length=(1, 2, 3, 4, 5, 6, 8, 60, 120)):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "Ça", "The", "ÎLE"]
    passage, out = " ".join(r.choice(vocabulary) for _ in range(40)), []
    for _ in range(n):
        if out and r.random() < 0.6:
            base = r.choice(out).split(" ")
            for _ in range(r.choice([0, 1, 1, 2, 3])):
                base[r.randrange(len(base))] = r.choice(vocabulary)
            out.append(" ".join(base))
        else:
            out.append(" ".join([*(r.choice(vocabulary) for _ in range(r.choice(length))), *[passage] * (r.random() < 0.2)]))
    return out


def labels(spark, rows, block=linking.BLOCK):
    docs = spark.createDataFrame([(*row, "clash", 3) for row in rows], "doc_id long, text string, digest string, n long")
    return sorted(map(tuple, minhash.label(docs, block=block).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_labels_match_brute_force(spark, seed):
    rows = [(i * 7 % 501, t) for i, t in enumerate(texts(300, seed))]
    rows += [(600, None), (601, ""), (602, " \n\t"), (603, "one"), (604, "One"), (605, "a b"), (606, "x " * 3000), (3, rows[0][1]), rows[5], rows[5]]
    assert labels(spark, rows) == sorted(slow_labels(rows), key=str)


@pytest.mark.parametrize("block", [3, 8, 40])
def test_groups_of_many_blocks(spark, block):
    """Chains of copies, so that groups hold texts that are alike and no near copies of each other."""
    r = random.Random(block)
    base = [f"w{r.randrange(900)}" for _ in range(100)]
    rows = []
    for i in range(90):
        own = list(base)
        for _ in range(r.choice([0, 1, 2, 4, 8])):
            own[r.randrange(len(own))] = f"new{r.randrange(40)}"
        base = own if r.random() < 0.2 else base
        rows.append((i, " ".join(own)))
    assert labels(spark, rows, block) == sorted(slow_labels(rows), key=str)


def test_recall_of_candidates_at_the_least_similarity():
    """Pairs of a similarity of 0.8 to 0.82: all are candidates; pairs below 0.3 hardly ever are."""
    rng = np.random.default_rng(3)
    for similarity, low, high in ((0.8, 1.0, 1.0), (0.3, 0.0, 0.02)):
        met = 0
        for _ in range(1500):
            n = int(rng.integers(9, 500))
            union = rng.integers(0, 2**63, n, dtype=np.uint64)
            common = int(np.ceil(similarity * n))
            first = rng.random(n - common) < 0.5
            a, b = (np.concatenate([union[:common], union[common:][c]]) for c in (first, ~first))
            met += int((minhash.signature(a) == minhash.signature(b)).sum() >= minhash.MATCHES)
        assert low <= met / 1500 <= high


def test_postings_leave_single_signatures_out(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(50))) for i in range(20)] + [(30, "a b c d e f g h"), (31, "a b c d e f g i")], "doc_id long, text string")
    sets = minhash.signatures(docs).withColumnRenamed("doc_id", "node").cache()
    post = minhash.posted(sets)
    assert {r["node"] for r in post.select("node").collect()} <= {30, 31}
    assert max(r["count"] for r in post.groupBy("node").count().collect()) <= minhash.PREFIX


@pytest.mark.parametrize("first, last", [([1, 3, 3, 9], [3, 3, 6, 2]), ([], [])])
def test_partners(first, last):
    expected = [(i, j) for i, (a, b) in enumerate(zip(first, last)) for j in range(a, b)]
    for at_once in (1, 2, 100):
        got = [p for i, j in linking.partners(np.array(first, int), np.array(last, int), at_once) for p in zip(i.tolist(), j.tolist())]
        assert got == expected


def test_sets_are_compared_whole():
    sets = [[1, 2, 3, 4], [1, 2, 3, 4, 5], [1, 2, 3], [7]]
    brief = bytes(minhash.COORDINATES)
    held = pa.array([{"n": len(s), "brief": brief, "shingles": s} for s in sets])
    assert minhash.Sets(held).similar(np.array([0, 0, 0, 1, 2]), np.array([1, 2, 3, 2, 3])).tolist() == [True, False, False, False, False]


def test_null_ids_and_no_rows(spark):
    rows = [(None, "a b c d e"), (5, "a b c d e"), (5, "a b c d e"), (None, "other text here entirely"), (9, None), (None, "")]
    expected = [(None, 2, 5, False), (5, 2, 5, True), (5, 2, 5, True), (None, 1, None, True), (9, 0, 9, True), (None, 0, None, True)]
    assert labels(spark, rows) == sorted(expected, key=str)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert minhash.label(docs.limit(0)).count() == 0
    kept = sorted(map(tuple, minhash.deduplicate(docs).collect()), key=str)
    assert kept == sorted([(5, "a b c d e"), (None, "other text here entirely"), (9, None), (None, "")], key=str)
    assert minhash.deduplicate(docs.limit(0)).count() == 0


def test_query_names_its_columns(spark):
    got = queries.op11_inverted_minhash(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, got.collect())) == slow_labels([tuple(r) for r in rows])

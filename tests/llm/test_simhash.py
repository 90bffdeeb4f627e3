import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from bilinea.llm import simhash, trie


def slow_fingerprint(text):
    found = [w.lower() if w.isascii() else "".join(c.lower() if c.isascii() else c for c in w) for w in (text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    grams = [" ".join(found[i : i + 3]) for i in range(len(found) - 2)] if len(found) > 3 else [" ".join(found)] * bool(found)
    counts = Counter(b for g in grams for b in range(64) if xxhash.xxh64_intdigest(g, 42) >> b & 1)
    return sum(1 << b for b, n in counts.items() if 2 * n > len(grams))


def slow_components(prints):
    root = {d: d for d in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = list(prints)
    for i, x in enumerate(ids):
        for y in ids[i + 1 :]:
            if (prints[x] ^ prints[y]).bit_count() <= 2:
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    return {d: find(d) for d in prints}


def texts(n=150, seed=3):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["É", "Ça", "The", "ÎLE"]
    out = []
    for i in range(n):
        if out and r.random() < 0.6:
            base = r.choice(out).split(" ")
            for _ in range(r.choice([0, 1, 1, 2])):
                base[r.randrange(len(base))] = r.choice(vocabulary)
            out.append(" ".join(base))
        else:
            out.append(" ".join(r.choice(vocabulary) for _ in range(r.choice([1, 2, 3, 4, 90, 200]))))
    return [*out, None, "", " \n\t", "one", "One", "x " * 5000]


def test_fingerprints_match_the_definition():
    for text in texts():
        assert simhash.fingerprint(simhash.shingle_hashes(text, 3)) == slow_fingerprint(text), text


def flipped(r, x, most):
    for bit in r.sample(range(64), r.randrange(most + 1)):
        x ^= 1 << bit
    return x


@pytest.mark.parametrize("bits, tries", [(2, 1), (5, 1), (7, 3), (14, 3)])
def test_walk_finds_every_pair_within_budget(bits, tries):
    r = random.Random(5)
    leaves = [r.getrandbits(64) for _ in range(200)]
    leaves = sorted({*leaves, *(flipped(r, x, bits + 2) for x in leaves)})
    expected = {(x, y) for i, x in enumerate(leaves) for y in leaves[i + 1 :] if (x ^ y).bit_count() <= bits}
    budget, found = trie.Budget(bits, tries), set()
    for t in range(tries):
        by = t * budget.turn
        back = {(x << by | x >> 64 - by) % 2**64: x for x in leaves}
        turned = np.array(sorted(back), dtype=np.uint64)
        for i, j, _ in trie.walk(trie.Nodes(turned, 0), None, 0, budget):
            found |= {tuple(sorted((back[x], back[y]))) for x, y in zip(turned[i].tolist(), turned[j].tolist())}
        half = int(np.searchsorted(turned, 1 << 63))  # the same pairs from the two children of the root
        low, high = trie.Nodes(turned[:half], 1), trie.Nodes(turned[half:], 1)
        across = {tuple(sorted((back[x], back[y]))) for i, j, _ in trie.walk(low, high, 1, budget) for x, y in zip(low.leaves[i].tolist(), high.leaves[j].tolist())}
        assert across <= expected and (tries > 1 or across == {p for p in expected if (p[0] ^ p[1]) >> 63})
    assert found == expected


def test_walk_descends_and_prunes_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    prints = {r["fingerprint"] for r in simhash.fingerprints(docs).select("fingerprint").distinct().collect()}
    counts = {"descended": 0, "pruned": 0, "met": 0}
    list(trie.walk(trie.Nodes(np.sort(np.array(list(prints), dtype=np.int64).view(np.uint64)), 0), None, 0, simhash.STRICT, counts))
    assert counts["descended"] > 10 * len(prints) and counts["pruned"] > len(prints) and counts["met"] < len(prints) ** 2 / 4


def test_spark_walks_from_the_root(spark):
    rng = np.random.default_rng(1)
    rows = [(0, int(x)) for x in rng.integers(-(2**63), 2**63, 3000)] + [(0, i) for i in range(500)]
    leaves = spark.createDataFrame(rows, "trie int, leaf long").distinct()
    pairs = simhash.frontier(leaves, simhash.STRICT, 60).collect()
    assert all(r["n_a"] + r["n_b"] <= 60 and r["differ"] <= 2 for r in pairs) and max(r["level"] for r in pairs) > 56
    own = sum(r["n_a"] for r in pairs if r["a"] == r["b"])  # the nodes paired with themselves part all leaves
    assert own == leaves.count() and any(r["differ"] == 2 for r in pairs)


def check(spark, rows, most_in_task):
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, n long")
    got = {r["doc_id"]: (r["fingerprint"] % 2**64, r["component_id"]) for r in simhash.label(docs, most_in_task=most_in_task).collect()}
    prints = {d: slow_fingerprint(t) for d, t, *_ in rows}
    expected = slow_components(prints)
    assert got == {d: (prints[d], expected[d]) for d in prints}


def test_components_match_brute_force(spark):
    check(spark, [(i * 7 % 501, t, "clash", 1) for i, t in enumerate(texts())], simhash.MOST_IN_TASK)


def test_large_nodes_are_walked_by_spark(spark):
    r = random.Random(11)
    base = [f"w{r.randrange(900)}" for _ in range(900)]
    rows = []
    for i in range(120):
        own = list(base)
        for _ in range(r.choice([1, 2, 3])):
            own[r.randrange(len(own))] = f"new{i}"
        rows.append((i, " ".join(own), "clash", 1))
    check(spark, rows, 4)


def test_repeated_rows_null_ids_and_no_rows(spark):
    schema = "doc_id long, text string"
    rows = [(None, "a b c d e"), (5, "a b c d e"), (5, "a b c d e"), (None, "other text here entirely"), (9, None), (2, "")]
    got = sorted(((r["doc_id"] or -1, r["component_id"]) for r in simhash.label(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted([(-1, 5), (5, 5), (5, 5), (-1, None), (9, 2), (2, 2)], key=str)
    assert simhash.label(spark.createDataFrame([], schema)).count() == 0


def linked(spark, pairs, parts):
    links = spark.createDataFrame(pairs, "a long, b long").repartition(parts)
    return {r["node"]: r["root"] for r in simhash.components(links).collect()}


@pytest.mark.parametrize("seed", range(3))
def test_components_match_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(simhash, "EDGES", 50)
    r = random.Random(seed)
    names = [r.randrange(-(1 << 62), 1 << 62) for _ in range(600)]
    pairs = [(names[i], names[i + 1]) for i in range(150)] + [(names[200], names[i]) for i in range(201, 300)] + [(r.choice(names[300:]), r.choice(names[300:])) for _ in range(200)]
    r.shuffle(pairs)
    root = {x: x for p in pairs for x in p if p[0] != p[1]}

    def find(x):
        return x if root[x] == x else find(root[x])

    for a, b in pairs:
        if a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    assert linked(spark, pairs, 7) == {x: find(x) for x in root}


def test_components_of_stars_need_no_round(spark, monkeypatch):
    """Each step is a job over all partitions: links that are stars already take none."""
    written, plain = [], simhash.store
    monkeypatch.setattr(simhash, "store", lambda df, label: written.append(label) or plain(df, label))
    pairs = [(i % 5, i) for i in range(5, 500)]
    assert linked(spark, pairs, 6) == {x: x % 5 for x in range(500)}
    assert len(written) <= 2
    assert linked(spark, [(3, 3)], 2) == {}

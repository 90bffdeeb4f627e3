import random

import numpy as np
from bilinea.llm import simhash
from tests.llm.test_simhash import texts

import corpus_pipeline


def grams(text, size=5):
    found = (text or "").replace("\t", " ").replace("\n", " ").lower().split()
    return frozenset(tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))) if found else frozenset()


def slow_print(text):
    found = np.unique(simhash.shingle_hashes(text, 5))
    return simhash.fingerprint(found), simhash.fingerprint(simhash.mixed(found))


def slow_groups(rows, similar=0.8, bits=14, both=28):
    """The smallest ids of the components of the graph of all pairs that are similar and whose fingerprints are close;
    also how many different texts are similar, and how many of them close."""
    sets, prints, root, pairs, met = {d: grams(t) for d, t in rows}, {d: slow_print(t) for d, t in rows}, {d: d for d, _ in rows}, 0, 0

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = list(sets)
    for i, x in enumerate(ids):
        for y in ids[i + 1 :]:
            a, b = sets[x], sets[y]
            if a == b or len(a & b) >= similar * len(a | b) - 1e-9:
                pairs += a != b
                first, second = ((p ^ q).bit_count() for p, q in zip(prints[x], prints[y]))
                if first <= bits and first + second <= both:
                    met += a != b
                    x0, y0 = find(x), find(y)
                    root[max(x0, y0)] = min(x0, y0)
    return {find(d) for d in ids}, pairs, met


def near_copies(seed=4):
    r = random.Random(seed)
    out, common = [], [f"c{i}" for i in range(30)]
    for i in range(60):
        base = [f"v{r.randrange(500)}" for _ in range(r.choice([6, 30, 120, 400]))] + common * (i % 3 == 0)
        out.append(" ".join(base))
        for _ in range(r.choice([0, 1, 5, 9])):
            own = list(base)
            for _ in range(r.randrange(1, 2 + len(own) // 80)):
                own[r.randrange(len(own))] = f"x{r.randrange(10**6)}"
            out.append(" ".join(own))
            base = own if r.random() < 0.5 else base
    return out


def test_near_copies_and_no_others_are_joined(spark):
    rows = [(i * 7 % 1009, t) for i, t in enumerate(near_copies() + texts())]
    kept, pairs, met = slow_groups(rows)
    assert pairs > 100 and met >= 0.95 * pairs
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert len(got) == len(set(got)) and set(got) == kept


def test_a_group_larger_than_a_task(spark):
    """Copies that are near one text, and not all near each other; nodes are walked by Spark."""
    r = random.Random(2)
    base = [f"w{r.randrange(5000)}" for _ in range(300)]
    rows = [(0, " ".join(base))]
    for i in range(1, 150):
        own = list(base)
        for _ in range(r.randrange(1, 12)):
            own[r.randrange(len(own))] = f"n{r.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    kept, _, _ = slow_groups(rows)
    docs = spark.createDataFrame([(d, t, 1, 2, 3) for d, t in rows], "doc_id long, text string, fp long, group long, n long")
    got = simhash.deduplicate(docs, most_in_task=16, block=40)
    assert got.columns == docs.columns and {r["doc_id"] for r in got.collect()} == kept
    empty = spark.createDataFrame([(None, None), (3, ""), (None, " \n")], "doc_id long, text string")
    assert [r["doc_id"] for r in simhash.deduplicate(empty).collect()] == [3]
    assert simhash.deduplicate(empty.limit(0)).count() == 0


def test_recall_of_candidates_by_similarity():
    """1,200 pairs each of sets that share exactly so much: how many the budget and the second fingerprint let through."""
    rng, shares = np.random.default_rng(7), {}
    for similarity in (0.8, 0.85, 0.9):
        met = 0
        for k in range(1200):
            n = int(rng.integers(40, 400))
            union = rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, n, dtype=np.uint64)
            common = int(np.ceil(similarity * n))
            pair = [np.concatenate([union[:common], union[common + side :: 2]]) for side in (0, 1)]
            leaf, more = (np.array([simhash.fingerprint(f(s)) for s in pair], dtype=np.uint64).view(np.int64) for f in (lambda s: s, simhash.mixed))
            sizes = np.array([len(s) for s in pair])
            met += int(simhash.candidates(np.array([0]), np.array([1]), leaf, sizes, more, 0.8, simhash.WIDE)[0])
        shares[similarity] = met / 1200
    print(shares)
    assert shares[0.8] >= 0.9 and shares[0.85] >= 0.96 and shares[0.9] >= 0.99


def test_leaves_sent_to_tasks_grow_no_faster_than_leaves(spark, monkeypatch):
    """What node pairs send to tasks for four times the fingerprints, and that tasks walk such pairs to the same groups."""
    rng, sent, stored = np.random.default_rng(3), [], simhash.store

    def spied(df, label):
        out = stored(df, label)
        if label == "trie-frontier":
            sent.append(out.selectExpr("sum(n_a + n_b)").first()[0])
        return out

    monkeypatch.setattr(simhash, "store", spied)
    for n in (500, 2000):
        base = rng.integers(0, 2**64, n // 2, dtype=np.uint64)
        flips = rng.integers(0, 64, (n // 2, 14)).astype(np.uint64)
        near = base.copy()
        for k in range(14):
            near ^= np.where(rng.random(n // 2) < 0.6, np.uint64(1) << flips[:, k], np.uint64(0))
        fp = np.unique(np.concatenate([base, near]))
        rows = spark.createDataFrame([(int(x), 100, 0) for x in fp.view(np.int64)], "fp long, n long, more long")
        links = simhash.self_join(rows, simhash.WIDE, 16, 0.8).collect()
        forest = simhash.Forest(len(fp))
        i, j = np.triu_indices(len(fp), 1)
        ok = np.bitwise_count(fp[i] ^ fp[j]) <= 14
        forest.join(i[ok], j[ok])
        place = {int(x): k for k, x in enumerate(fp.view(np.int64))}
        a, b = np.array([place[r["a"]] for r in links]), np.array([place[r["b"]] for r in links])
        assert ok.sum() > n // 4 and (np.bitwise_count(fp[a] ^ fp[b]) <= 14).all() and not forest.apart(a, b).any()
        mine = simhash.Forest(len(fp))
        mine.join(a, b)
        assert not mine.apart(i[ok], j[ok]).any()
    assert sent[1] < 6 * sent[0]


def test_a_task_has_one_python_worker_at_a_time(spark, monkeypatch):
    plans, store = [], simhash.store

    def recorded(df, label):
        plans.append(df._jdf.queryExecution().analyzed().toString())
        return store(df, label)

    monkeypatch.setattr(simhash, "store", recorded)
    docs = spark.createDataFrame(list(enumerate(near_copies())), "doc_id long, text string")
    assert simhash.deduplicate(docs).count() < docs.count()
    assert max(p.count("MapInArrow") for p in plans) == 1

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from bilinea.llm import queries, runs


def slow_runs(x):
    found = []
    for q in range(1, len(x) // 4 + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            own = x[i : j + q]
            if j > i and len(own) >= max(6, 4 * q) and not any(own[p:] == own[:-p] for p in range(1, q)):
                found.append((i, len(own), q))
            i = max(j, i + 1)
    return sorted(found)


def slow_row(doc_id, text):
    words = [w for w in (text or "").translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if w]
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = slow_runs(words)
    gone = {i for a, length, q in found for i in range(a + q, a + length)}
    best = min(found, key=lambda f: (-Fraction(f[1], f[2]), f[0], f[2]), default=None)
    about = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(found), *about, digest("".join(f"{a},{b},{c}\n" for a, b, c in found)), digest(" ".join(w for i, w in enumerate(words) if i not in gone)))


def words_with_runs(r):
    n, vocabulary = r.choice([0, 1, 5, 6, 7, 30, 100, 300]), r.choice([1, 2, 3, 50])
    x = [r.randrange(vocabulary) for _ in range(n)]
    if n > 20 and r.random() < 0.7:
        p = r.randrange(1, n // 4)
        a = r.randrange(n - 4 * p + 1)
        for i in range(a + p, min(n, a + r.randrange(4 * p - 1, n - a + 1))):
            x[i] = x[i - p]
    return x


@pytest.mark.parametrize("largest", [runs.LARGEST, 2, 8])
def test_runs_match_brute_force(largest):
    r = random.Random(1)
    for _ in range(60):
        texts = [[b"%d" % c for c in words_with_runs(r)] for _ in range(r.randrange(1, 6))]
        x, edges = runs.numbered(texts)
        assert runs.runs(x, edges, largest) == [slow_runs(x[a:b].tolist()) for a, b in zip(edges[:-1], edges[1:])]


@pytest.mark.parametrize("size", [1, 2, 8, 1024])
def test_transform_is_exact(size):
    rng = np.random.default_rng(size)
    blocks, windows = rng.integers(0, runs.PRIME, (size, 3)), rng.integers(0, runs.PRIME, (2 * size, 3))
    got = runs.correlate(blocks.astype(float), windows.astype(float)) % runs.PRIME
    expected = [[sum(int(x) * int(y) for x, y in zip(blocks[:, k], windows[d : d + size, k])) % runs.PRIME for k in range(3)] for d in range(size)]
    assert got.astype(int).tolist() == expected


def test_long_periods():
    r = random.Random(2)
    period = [b"%d" % r.randrange(10**6) for _ in range(5000)]
    words = [b"x"] * 3 + period * 4 + period[:17] + [b"y"] * 6
    x, edges = runs.numbered([words])
    assert runs.runs(x, edges)[0] == [(3, 20_017, 5000), (20_020, 6, 1)]


def test_query_matches_brute_force(spark, tmp_path):
    r = random.Random(4)
    planted = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 10 == 0][:60]
    texts = [" ".join(f"w{c}" for c in words_with_runs(r)) for _ in range(200)]
    rows = [(i, t) for i, t in zip([*planted, *range(5000, 5140)], texts)]
    rows += [(None, "a a a a a a a"), (None, None), (7, None), (8, ""), (9, " \n\t"), (10, "É é " * 9), (11, "a\x0bb c " * 5), (11, "a\x0bb c " * 5)]
    spark.createDataFrame([(*row, "clash") for row in rows], "doc_id long, text string, digest string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_block_convolution_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted((slow_row(*row) for row in rows), key=str)


def test_collapse_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "so it goes " * 4 + "on", 5), (2, " kept  as it is", 6), (3, None, 7)], "doc_id long, text string, n_runs long")
    assert sorted(map(tuple, runs.collapse(docs).collect())) == [(1, "so it goes on", 5), (2, " kept  as it is", 6), (3, None, 7)]
    assert runs.label(docs.limit(0)).count() == 0 and runs.collapse(docs).columns == docs.columns

import random
import re
from collections import Counter

import numpy as np
import pytest
from bilinea.llm import collocations, queries, quotient


def slow(rows, least=30, top=2000):
    counts, sizes = Counter(), Counter()
    for text, lang, *_ in rows:
        lang, text = lang or "und", "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            ws = [w for w in re.split("[ \t]+", piece) if w]
            sizes[lang] += len(ws)
            counts.update((lang, *ws[i : i + k]) for k in range(1, 5) for i in range(len(ws) - k + 1))
    found = {p: a for p, a in counts.items() if len(p) > 2 and a >= least}
    most = Counter()
    for (lang, *ws), a in found.items():
        for k in range(2, len(ws)):
            for i in range(len(ws) - k + 1):
                most[(lang, *ws[i : i + k])] = max(most[(lang, *ws[i : i + k])], a)
    out = []
    for p, a in found.items():
        if 100 * most[p] >= 80 * a:
            continue
        cuts = [(2_000_000 * a // (counts[p[: k + 1]] + counts[(p[0], *p[k + 1 :])]), k) for k in range(1, len(p) - 1)]
        score, k = min(cuts)
        out.append((p[0], -score, -a, " ".join(p[1:]).encode(), counts[p[: k + 1]], counts[(p[0], *p[k + 1 :])]))
    result = []
    for lang in sizes:
        own = sorted(r for r in out if r[0] == lang)[:top]
        result += [(lang, i + 1, phrase.decode(), -a, left, right, sizes[lang], -score) for i, (_, score, a, phrase, left, right) in enumerate(own)]
    return sorted(result)


def texts(seed, n=200):
    r = random.Random(seed)
    vocabulary = [*(f"w{i}" for i in range(12)), "É", "The", "the", "a\x1fb", " ", "x" * 300]
    fixed = ["w1 w2 w3 w4", "New York city", "of The", "w5 w5 w5 w5 w5", "alone"]
    rows = []
    for _ in range(n):
        words = [r.choice(fixed) if r.random() < 0.3 else r.choice(vocabulary) for _ in range(r.choice([0, 1, 3, 40]))]
        text = "".join(w + r.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\r", " ; "]) for w in words)
        rows.append((text, r.choice(["en", "en", "en", "fr", None, "und"]), "clash", 1))
    return [*rows, (None, "en", "clash", 1), ("", None, "clash", 1), (". ,;", "de", "clash", 1), rows[0], rows[0]]


@pytest.mark.parametrize("seed, least, shard, slices", [(1, 30, 1 << 20, 4), (2, 5, 200, 4), (3, 3, 300, 0), (4, 2, 1, 2)])
def test_phrases_match_brute_force(spark, monkeypatch, seed, least, shard, slices):
    monkeypatch.setattr(collocations, "SHARD", shard)
    monkeypatch.setattr(collocations, "SLICE_BITS", slices)
    rows = texts(seed)
    docs = spark.createDataFrame(rows, "text string, lang string, phrase string, n long").repartition(3)
    got = collocations.collocations(docs, least=least)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == slow(rows, least)
    assert sorted(map(tuple, collocations.collocations(docs, least=least, top=7).collect())) == slow(rows, least, 7)


def test_no_rows(spark):
    docs = spark.createDataFrame(texts(1)[:5], "text string, lang string, phrase string, n long")
    assert collocations.collocations(docs.limit(0)).count() == 0 and collocations.collocations(docs, least=10**6).count() == 0


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text", "lang").collect()]
    assert sorted(map(tuple, queries.op12_quotient_collocations(spark, "/root/testdata/sf0.001").collect())) == slow(rows)


def test_scores_are_exact_beyond_64_bits(spark):
    big = 10**17
    rows = [(1, 0, 0, 0, 3 * big), (2, 0, 0, 0, 2 * big + 1), (1, 2, 0, 0, big - 1)]
    found = spark.createDataFrame(rows, "w1 long, w2 long, w3 long, w4 long, f long")
    (got,) = collocations.scored(found).collect()
    assert got["score"] == 2_000_000 * (big - 1) // (5 * big + 1) and (got["a"], got["l"], got["r"]) == (big - 1, 3 * big, 2 * big + 1)
    kept = collocations.closed(found.where("w2 > 0").withColumnRenamed("f", "a"), found)
    assert kept.count() == 1


@pytest.mark.parametrize("bits", [1, 2, 5, 18, 31, 32, 33, 48, 64])
def test_filters_lose_nothing(bits):
    rng, mask = np.random.default_rng(bits), np.uint64((1 << bits) - 1)
    halves = lambda n: [rng.integers(0, 2**64, n, dtype=np.uint64) & mask & np.uint64(0xFFFF_0000_FFFF_00FF) for _ in range(2)]
    shards, slice_bits, total = [halves(n) for n in (0, 1, 3000, 2000)], min(3, bits), Counter()
    parts = []
    for left, right in shards:
        assert all((a == b).all() for a, b in zip(quotient.restore(*quotient.permute(left, right, bits), bits), (left, right)))
        found, place = quotient.Filter.of(left, right, bits)
        own = Counter(zip(left.tolist(), right.tolist()))
        total += own
        undone = quotient.restore(found.left, found.right, bits)
        assert dict(zip(zip(*(c.tolist() for c in undone)), found.counts.tolist())) == own
        assert (undone[0][place] == left).all() and (undone[1][place] == right).all()
        parts.append(found)
    merged = Counter()
    for s in range(1 << slice_bits):
        cut = [(f, f.slices(slice_bits)) for f in parts]
        again = [quotient.Filter.unpacked(f.packed(slice_bits, int(e[s]), int(e[s + 1])), slice_bits, s) for f, e in cut]
        together, places = quotient.merged(again)
        assert all((together.left[p] == f.left).all() and (together.right[p] == f.right).all() for f, p in zip(again, places))
        merged += Counter(dict(zip(zip(*(c.tolist() for c in quotient.restore(together.left, together.right, bits))), together.counts.tolist())))
    assert merged == total

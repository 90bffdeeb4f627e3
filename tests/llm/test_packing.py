import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from bilinea.llm import common, mixing, packing
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

FILE = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " ", "a.", "a..", "İstanbul İİ. x", "it's don't, x.y", " a b.", "<|endoftext|> a<|endoftext|>b.", "<|ENDOFTEXT|> Ab <|startoftext|>X, Y", "ÉCOLE, É.", "école.", "12,34. ,", "日本語。 x", "ς Σ. ΑΣ", "\ttab\x0bvt\x0c. ", "'s 's. '", "１２ ²³ Ⅷ.", "ﬁ ﬂ, ǅ", "क़. क़क़, x", "word " * 5000, "x" * 30000]


def expected(text, capacity=4096):
    ids = np.array([*Tokenizer.from_file(FILE).encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
    return [(i // capacity, i, min(capacity, len(ids) - i), zlib.crc32(ids[i : i + capacity].tobytes())) for i in range(0, len(ids), capacity)]


def test_pieces_match_the_tokenizer(spark):
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(ODD)], "doc_id long, text string, row_tag string, piece int")
    got = defaultdict(list)
    for r in packing.pieces(docs, FILE).collect():
        got[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    assert {d: sorted(v) for d, v in got.items()} == {i: expected(t) for i, t in enumerate(ODD)}


def places(plan):
    return {(length, rank): (first + (rank - a) // each, offset + (rank - a) % each * length) for length, a, b, first, each, offset in plan for rank in range(a, b)}


def slow_best_fit(counts, capacity):
    free = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fitting = [s for s in free if s >= length]
            if fitting:
                free.remove(min(fitting))
                free.append(min(fitting) - length)
            else:
                free.append(capacity - length)
    return len(free)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), max_size=25))
def test_plan_is_best_fit_decreasing(counts):
    found = places(packing.plan(counts, 60))
    assert Counter(length for length, _ in found) == Counter(counts)
    used = defaultdict(list)
    for (length, _), (sequence, offset) in found.items():
        used[sequence].append((offset, length))
    for taken in used.values():
        at = 0
        for offset, length in sorted(taken):
            assert offset == at
            at += length
        assert at <= 60
    assert len(used) == slow_best_fit(counts, 60)


@pytest.mark.parametrize("capacity", [7, 64])
def test_packed_sequences_are_gapless(spark, capacity):
    rows = [(i % 90, f"{'word ' * (i % 23)}", i) for i in range(400)] + [(None, None, 0)] * 3
    cut = packing.pieces(spark.createDataFrame(rows, "doc_id long, text string, offset int"), FILE, capacity=capacity)
    got = packing.pack(cut, capacity).collect()
    used = defaultdict(list)
    for r in got:
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    for taken in used.values():
        at = 0
        for offset, length in sorted(taken):
            assert offset == at
            at += length
        assert at <= capacity
    assert sum(r["length"] for r in got) == sum((i % 23) + 1 for i in range(400)) + 3


def test_no_documents(spark):
    assert packing.pack(packing.pieces(spark.createDataFrame([], "doc_id long, text string"), FILE)).count() == 0


def test_the_driver_s_tables_need_no_python_on_executors(spark):
    schema = "n int, name string, x double, many array<struct<a: double, b: long>>"
    rows = [(1, None, 0.5, [(1.0, 2), (0.25, None)]), (2, "é", None, []), (3, "", 1.0, None)]
    for some in (rows, []):
        found = common.driver_table(spark, some, schema)
        assert found.schema == spark.createDataFrame(some, schema).schema
        assert [(r["n"], r["name"], r["x"], r["many"] and list(map(tuple, r["many"]))) for r in found.collect()] == some
    docs = spark.createDataFrame([(i, "a b. " * i, f"s{i % 3}") for i in range(30)], "doc_id long, text string, source string")
    for df in (packing.pack(packing.pieces(docs, FILE)), mixing.plan(docs)):
        assert "LogicalRDD" not in df._jdf.queryExecution().analyzed().toString()

"""Sharding, exact dedup, quality rules, mixing and archives against plain Python."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from bilinea.llm import exact_dedup, mixing, quality, sharding, warc
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, source string, _id string, rank int, _at int, row string"
EMPTY = "doc_id long, text string, source string"


def rows():
    texts = ["a b", "a  b", "a\tb", " a b", "", None, "x", "é ü" * 5, "b" * 3000, "a b\n"]
    out = [(i, texts[i * i % 10] if i % 3 else f"text {i} " + "w " * (i % 17), f"s{i % 5}" if i % 7 else None, "clash", 1, 2, "r") for i in range(300)]
    return out + [(None, "x", "s1", "clash", 1, 2, "r")] * 2 + [(7, "again", None, "clash", 1, 2, "r")] * 3


@pytest.mark.parametrize("slack", [0.0, 0.25])
def test_sharding(spark, slack):
    docs = spark.createDataFrame(rows(), SCHEMA)
    got = sharding.shard(docs, 24, slack=slack).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows())
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[s]) for s in range(24)]
    assert max(counts) - min(counts) <= 1 if slack == 0 else max(counts) <= -(-len(got) * 1.25 // 24)
    again = sharding.shard(docs.repartition(7), 24, slack=slack).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    assert sharding.shard(spark.createDataFrame([], EMPTY), 24).count() == 0


def test_plan_is_the_walk_of_single_keys():
    nodes = sharding.ring(5, 4)
    counts, owners = {a: (a * 7) % 11 for a in range(len(nodes))}, [s for _, s in nodes]
    room = sharding.capacities(sum(counts.values()), 5, 0.0)
    places = {(arc, rank): shard for arc, a, b, shard, _ in sharding.plan(counts, owners, room) for rank in range(a, b)}
    assert Counter(places.values()) == Counter({s: n for s, n in enumerate(room)})
    assert set(places) == {(a, r) for a, n in counts.items() for r in range(n)}
    for (arc, _), shard in places.items():
        # every shard that the key passed on its way is full
        way = [owners[(arc + k) % len(owners)] for k in range(len(owners))]
        assert all(list(places.values()).count(s) == room[s] for s in way[: way.index(shard)])


def test_few_keys_move_when_a_shard_is_added(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    one, two = ({r["doc_id"]: r["shard"] for r in sharding.shard(docs, n, slack=0.25).collect()} for n in (24, 25))
    assert sum(one[d] != two[d] for d in one) < 0.15 * len(one)


def norm(text):
    return re.sub(r"[ \t\n\x0b\f\r]+", " ", text or "")


def test_few_keys_move_between_full_shards(spark):
    """The registered law leaves no room at all, and still few documents change their shard."""
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    before, after = ({r["doc_id"]: r["shard"] for r in sharding.shard(docs, n).collect()} for n in (24, 25))
    assert sum(before[d] != after[d] for d in before) < 0.12 * len(before)


def test_every_shard_of_a_large_ring_owns_an_arc():
    nodes = sharding.ring(8000, 64)
    assert len(nodes) == 8000 * 64 and len({shard for _, shard in nodes}) == 8000 and nodes[-1][0] < 1 << sharding.POINT


def test_exact_dedup(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    table = exact_dedup.scratch_index(spark)
    got = exact_dedup.label(docs, table).collect()
    groups = defaultdict(list)
    for i, t, *_ in rows():
        groups[norm(t)].append(i)
    expected = Counter()
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        for i in ids:
            expected[(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest())] += 1
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == expected
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in kept)
    # a later batch finds the copies of this one, and adds only what is new
    later = spark.createDataFrame([(900, "a b", None), (901, "new", None), (902, "new ", None), (903, "new", None)], EMPTY)
    assert {r["doc_id"]: (r["keep_id"], r["kept"]) for r in exact_dedup.label(later, table, name='later').collect()} == {900: (min(groups["a b"]), False), 901: (901, True), 902: (902, True), 903: (901, False)}
    assert spark.table(table).count() == len(groups) + 2
    fresh = exact_dedup.scratch_index(spark)
    stay = exact_dedup.deduplicate(docs, fresh)
    assert stay.columns == docs.columns and stay.count() == len(groups)
    assert {norm(r["text"]) for r in stay.collect()} == set(groups)
    none = spark.createDataFrame([], EMPTY)
    assert exact_dedup.label(none, exact_dedup.scratch_index(spark)).count() == 0
    for name in (table, fresh):
        spark.sql(f"DROP TABLE {name}")


def test_batches_give_what_one_batch_gives(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    key = lambda r: (r["doc_id"] is None, r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"])
    one, three = (exact_dedup.label(docs, exact_dedup.scratch_index(spark), batches=n).collect() for n in (1, 3))
    assert Counter(map(key, one)) == Counter(map(key, three))
    assert sum(r["kept"] for r in one) == sum(r["kept"] for r in three) == len({r["text_sha256"] for r in one})
    none = docs.limit(0)
    assert exact_dedup.label(none, exact_dedup.scratch_index(spark), batches=3).count() == 0


def test_a_batch_that_is_run_again_keeps_the_same(spark):
    table = exact_dedup.scratch_index(spark)
    docs = lambda *pairs: spark.createDataFrame(pairs, "doc_id long, text string")
    first, second = docs((1, "a"), (2, "a"), (3, "b")), docs((4, "a"), (5, "c"), (6, "c"))
    for _ in range(2):
        assert sorted(r["doc_id"] for r in exact_dedup.deduplicate(first, table, "one").collect()) == [1, 3]
        assert spark.table(table).count() == 2
    for _ in range(2):
        assert [r["doc_id"] for r in exact_dedup.deduplicate(second, table, "two").collect()] == [5]
        assert spark.table(table).count() == 3
    assert sorted(r["doc_id"] for r in exact_dedup.deduplicate(first, table, "one").collect()) == [1, 3]
    small = f"{table}_small"
    exact_dedup.compact(spark, table, small)
    assert exact_dedup.deduplicate(second, small, "three").count() == 0
    assert sorted(map(tuple, spark.table(small).collect())) == sorted(map(tuple, spark.table(table).collect()))


def test_the_index_is_neither_shuffled_nor_sorted(spark):
    table = exact_dedup.scratch_index(spark)
    exact_dedup.deduplicate(spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string"), table, "one")
    new = exact_dedup.tagged(spark.createDataFrame([(99, "text 7")], "doc_id long, text string"), "doc_id", "text")
    joined = new.hint("merge").join(exact_dedup.known(spark, table).hint("merge"), "digest", "left_anti")
    plan = joined._jdf.queryExecution().sparkPlan().toString() + joined._jdf.queryExecution().executedPlan().toString()
    under = plan[plan.rindex("SortMergeJoin") :]
    assert under.count("Sort [") == under.count("Exchange hashpartitioning") == 1, under


CLEAN = "This is a plain sentence with quite a few words in it.\nAnd here is one more that ends as it should, with care."


@pytest.mark.parametrize(
    ("text", "kept", "clean"),
    [
        (CLEAN, True, CLEAN),
        (CLEAN + "\nHome | About | Contact | Help\n\nAll rights reserved.", True, CLEAN + "\n"),
        (CLEAN + "\nno end mark here", True, CLEAN),
        (CLEAN + " Two words", True, CLEAN + " Two words"),
        (CLEAN + "\nOne end. and four words more or five", True, CLEAN),
        ("word | " * 40, False, None),
        ("Too short.", False, None),
        (None, False, None),
        ("", False, None),
        (" \n ", False, None),
        (("alpha beta gamma delta epsilon zeta eta theta. " * 5), False, None),
        ("\n".join(["Read more", "Log in:"] + [CLEAN] * 1), True, CLEAN),
    ],
)
def test_quality(spark, text, kept, clean):
    docs = spark.createDataFrame([(1, text, "x", "c", 1)], "doc_id long, text string, quality string, _words string, n_chars int")
    out = quality.filtered(docs)
    got = out.collect()
    assert out.columns == docs.columns and len(got) == kept
    if kept:
        assert got[0]["text"] == clean and got[0]["n_chars"] == len(clean) and got[0]["_words"] == "c"


def slow_repeats(words):
    at = defaultdict(list)
    for i in range(len(words) - 7):
        at[tuple(words[i : i + 8])].append(i)
    return len({i + k for places in at.values() if len(places) > 1 for i in places for k in range(8)})


def test_repeated_words_and_long_texts(spark):
    base = [f"w{i}" for i in range(30)]
    cases = [base, base + base[:8], base + base[:7], base[:9] * 3, ["a"] * 40, ["a"] * 9, ["a"] * 8, base[3:13] + base + base[12:25], [f"v{i}" for i in range(60000)] + base + base]
    docs = spark.createDataFrame([(i, " ".join(c)) for i, c in enumerate(cases)], "doc_id long, text string")
    got = {r["doc_id"]: r["n"] for r in quality.measure(docs).select("doc_id", F.col("quality.n_repeat_words").alias("n")).collect()}
    assert got == {i: slow_repeats(c) for i, c in enumerate(cases)}


def test_targets_share_the_excess():
    recipe = mixing.Recipe()
    assert mixing.targets([], recipe) == []
    got = mixing.targets([100, 100, 100], recipe)
    assert got[0] == 200 and sum(got) == pytest.approx(450) and all(t <= 200 for t in got)
    got = mixing.targets([1000, 10, 10, 0, 500], recipe)
    assert sum(got) == pytest.approx(1.5 * 1520) and all(t <= 2 * s for t, s in zip(got, [1000, 10, 10, 0, 500]))


def test_mixing(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    planned = mixing.plan(docs).collect()
    assert len(planned) == len(rows())
    sizes = Counter()
    for _, t, s, *_ in rows():
        sizes[s] += len((t or "").split())
    taken, largest = Counter(), Counter()
    for r in planned:
        assert r["source_size"] == sizes[r["source"]] and r["taken"] in (0, r["size"], 2 * r["size"]) and len(r["positions"]) * r["size"] == r["taken"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for r in planned:
        assert abs(taken[r["source"]] - r["target"]) <= largest[r["source"]]
    again = mixing.plan(docs.repartition(5)).collect()
    key = lambda r: (r["doc_id"], r["source"], r["size"], r["taken"], tuple(r["positions"]))
    assert Counter(map(key, planned)) == Counter(map(key, again))
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(len(r["positions"]) for r in planned)
    assert mixing.plan(spark.createDataFrame([], EMPTY)).count() == 0 and mixing.mixed(spark.createDataFrame([], EMPTY)).count() == 0


def test_demand_up_to_a_position_is_the_schedules_integral(spark):
    recipe = mixing.Recipe()
    for knots in recipe.schedules:
        schedule = mixing.pieces(knots, 1000.0)
        df = spark.range(1001).select(F.col("id").cast("double").alias("u")).crossJoin(spark.createDataFrame([(schedule,)], "s array<struct<time: double, before: double, rate: double, change: double>>"))
        at = {r["u"]: r["t"] for r in df.select("u", mixing.due(F.col("u"), F.col("s")).alias("t")).collect()}
        area = sum((t1 - t0) * (f0 + f1) / 2 for (t0, f0), (t1, f1) in zip(knots, knots[1:]))
        for u, t in at.items():
            steps = 2000
            height = lambda x: next(f0 + (f1 - f0) * (x - t0) / (t1 - t0) for (t0, f0), (t1, f1) in zip(knots, knots[1:]) if x <= t1)  # noqa: E731, B023
            if u % 100 == 0:
                assert sum(height(t * (k + 0.5) / steps) for k in range(steps)) * t / steps / area * 1000 == pytest.approx(u, abs=0.1)


def test_archives(spark):
    html = ["<p>one</p>", "<p>two\r\n\r\nWARC/1.1</p>", "", None, "é" * 50000, "<p>one</p>"]
    pages = [(i, f"http://x/{i}?a=\n b" if i % 2 else None, html[i % 6], "clash") for i in range(60)] + [(None, "u", "<p>one</p>", "c"), (None, "u", "only", "c"), (59, "v", "<p>one</p>", "c")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, record_type string")
    index = warc.write(df)
    records = warc.resolve(spark.createDataFrame(warc.read(index).collect(), warc.read(index).schema)).collect()
    best = {}
    for i, _, h, _ in pages:
        best[h or ""] = max(best.get(h or "", -1), -1 if i is None else i)
    expected = Counter()
    for i, _, h, _ in pages:
        data, first = (h or "").encode(), best[h or ""]
        revisit = first >= 0 and i != first
        expected[(i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", first if revisit else None)] += 1
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in records) == expected
    assert {r["html"] for r in records if r["record_type"] == "response"} == {h or "" for h in html} | {"only"}
    some = warc.read(index.where("page_id < 5 and record_type = 'response'"))
    assert some.count() == index.where("page_id < 5 and record_type = 'response'").count()
    large = warc.write(df, min_revisit_bytes=5)
    assert large.where("record_type = 'revisit' and payload_digest = '3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ'").count() == 0
    assert warc.read(warc.write(df.limit(0))).count() == 0


def test_archives_are_read_by_many_tasks(spark):
    html = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(300)), lambda k: F.md5(F.concat_ws(":", "page_id", k.cast("string")))), " ")
    df = spark.range(0, 3000, 1, 6).select(F.col("id").alias("page_id"), F.lit("u").alias("url")).select("*", html.alias("html"))
    index = warc.write(df)
    records = warc.read(index, with_text=False)
    assert records.rdd.getNumPartitions() >= 4 and records.count() == 3000


def test_ranges_are_joined():
    assert list(warc.ranges([], [])) == []
    far = warc.GAP + 1
    assert list(warc.ranges([0, 10, 20 + far, 25 + far], [10, 10, 5, 5])) == [(0, 20, [0, 1]), (20 + far, 30 + far, [2, 3])]

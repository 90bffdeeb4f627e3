import random

import pytest
from bilinea.functions import ranks
from pyspark.sql import functions as F


def test_numbers_have_no_gaps(spark):
    rows = spark.range(1000).repartition(7).where("id % 3 = 0")
    got = ranks.numbered(rows, "number").collect()
    assert sorted(r["number"] for r in got) == list(range(334))
    assert ranks.numbered(rows.limit(0), "number").count() == 0


@pytest.mark.parametrize("parts", [1, 5])
def test_places_follow_the_order(spark, parts):
    r = random.Random(parts)
    rows = [(r.choice([None, "a", "b"]), r.randrange(50), i) for i in range(400)]
    df = spark.createDataFrame(rows, "key string, x long, tie long")
    order = lambda t: (t[0] is not None, t[0] or "", t[1], t[2])
    got = {r["tie"]: r["place"] for r in ranks.ranked(df, ["key", "x", "tie"], "place", parts).collect()}
    assert got == {t[2]: i for i, t in enumerate(sorted(rows, key=order))}
    got = {r["tie"]: r["place"] for r in ranks.ranked_within(df, ["key"], ["x", "tie"], "place", parts).collect()}
    assert got == {t[2]: i for k in (None, "a", "b") for i, t in enumerate(sorted((t for t in rows if t[0] == k), key=order))}


def test_a_hot_key_is_spread(spark):
    df = spark.range(4000).select(F.lit("hot").alias("key"), (F.col("id") * 7919 % 4001).alias("x"))
    placed = ranks.ranked(df, ["key", "x"], "place", 8)
    assert placed.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 2000
    assert "Window [row_number" not in placed._jdf.queryExecution().toString()


@pytest.mark.parametrize("parts", [1, 6])
def test_running_sums(spark, parts):
    r = random.Random(parts)
    rows = [(i * 37 % 500, r.choice("abc"), r.randrange(0, 9), 1) for i in range(500)]
    df = spark.createDataFrame(rows, "x long, key string, n long, one long")
    got = {row["x"]: (row["before"], row["place"]) for row in ranks.running(df, ["x"], {"n": "before", "one": "place"}, parts).collect()}
    assert got == {x: (sum(t[2] for t in rows if t[0] < x), x) for x, *_ in rows}
    got = {row["x"]: row["before"] for row in ranks.running_within(df, ["key"], ["x"], {"n": "before"}, parts).collect()}
    assert got == {x: sum(t[2] for t in rows if t[0] < x and t[1] == k) for x, k, _, _ in rows}

import random

import pytest
from bilinea.operators import replies, summary
from bilinea.sources import readers
from pyspark.sql import functions as F

SENTENCE = "id long, book int, paragraph int, word_begin int, word_end int, text string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("width", [1, 4, 7, 256])
def test_sentences_of_overlapping_ranges(spark, width):
    r = random.Random(width)
    rows = [(i, r.choice([1, 2, 3]), r.randrange(-3, 60), r.randrange(9), 0, f"s{i}") for i in range(300)]
    chapters = [(f"c{i}", r.choice([1, 2, 9]), a := r.randrange(-5, 60), a + r.choice([-1, 0, 0, 2, 9, 30])) for i in range(40)]
    expected = []
    for name, book, a, b in chapters:
        own = sorted((p, w, i) for i, k, p, w, _, _ in rows if k == book and a <= p <= b)
        expected += [(name, n + 1, i) for n, (_, _, i) in enumerate(own)]
    found = replies.chapter_sentences(spark.createDataFrame(chapters, "chapter string, book_id int, para_start int, para_end int"), spark.createDataFrame(rows, SENTENCE), ["chapter"], width)
    assert found.columns == ["chapter", "id", "book", "paragraph", "word_begin", "word_end", "text", "seq"]
    assert sorted((x["chapter"], x["seq"], x["id"]) for x in found.collect()) == sorted(expected)


def test_a_chapter_of_ten_million_paragraphs(spark):
    rows = spark.range(0, 10_000_000, 997).selectExpr("id", "1 AS book", "cast(id AS int) AS paragraph", "0 AS word_begin", "1 AS word_end", "'t' AS text")
    chapters = spark.createDataFrame([("all", 1, 0, 10_000_000), ("late", 1, 9_000_000, 9_999_999)], "chapter string, book_id int, para_start int, para_end int")
    found = replies.chapter_sentences(chapters, rows, ["chapter"])
    pieces = sum(b // replies.BIN - a // replies.BIN + 1 for a, b in ((0, 10_000_000), (9_000_000, 9_999_999)))
    assert pieces < 44_000
    ends = {r["chapter"]: (r["n"], r["most"], r["first"]) for r in found.groupBy("chapter").agg(F.count("id").alias("n"), F.max("seq").alias("most"), F.min("paragraph").alias("first")).collect()}
    assert ends == {"all": (10_031, 10_031, 0), "late": (1_003, 1_003, 9_028 * 997)}


def test_no_window_over_a_chapter_or_corpus(spark):
    chapters = spark.createDataFrame([("a", 1, 1, 5)], "chapter string, book_id int, para_start int, para_end int")
    shown = plan(replies.chapter_sentences(chapters, spark.createDataFrame([(1, 1, 2, 0, 1, "t")], SENTENCE), ["chapter"]))
    assert "row_number() windowspecdefinition(book" in shown and "windowspecdefinition(chapter" not in shown
    rows = spark.createDataFrame([("c", "k", 1, 2, 3)], "corpus string, html string, para_start int, para_end int, line_no long")
    assert "windowspecdefinition(corpus" not in plan(readers.last_wins(rows, "html"))
    para_map = spark.createDataFrame([("c", "f", 0)], "corpus string, text string, pos long")
    figures = spark.createDataFrame([("c", "f", 5)], "corpus string, file string, sentences int")
    merged = summary.merge_summary(para_map, figures, figures)
    assert "windowspecdefinition(corpus" not in plan(merged) and [tuple(r) for r in merged.collect()] == [("c", 1, "f", 5)]

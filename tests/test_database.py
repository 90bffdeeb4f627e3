import random
import uuid

import pytest
from bilinea.sources import readers

OPTIONS = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
SENTENCE = "id long, book int, paragraph int, word_begin int, word_end int, text string"


@pytest.fixture
def url():
    return f"jdbc:derby:memory:test_{uuid.uuid4().hex};create=true"


def test_tables_are_read_in_even_parts(spark, url):
    r = random.Random(1)
    rows = [(i, i % 3, r.choice([r.randrange(100), 5_000_000 + r.randrange(3000), -7]), 0, i, f"s{i}") for i in range(3000)]
    rows += [(9000, 1, None, 0, 0, "no number")]
    spark.createDataFrame(rows, SENTENCE).write.jdbc(url, "pali_sentences", properties=OPTIONS)
    spark.createDataFrame([(1, 5, "five")], "book int, paragraph int, text string").write.jdbc(url, "pali_texts", properties=OPTIONS)
    texts, sentences = readers.read_source_tables(spark, url, OPTIONS, parts=6)
    assert sentences.schema.simpleString() == "struct<id:bigint,book:int,paragraph:int,word_begin:int,word_end:int,text:string>"
    assert sorted(map(tuple, sentences.collect())) == sorted(rows) and [tuple(x) for x in texts.collect()] == [(1, 5, "five")]
    sizes = [len(p) for p in sentences.rdd.glom().collect()]
    # -7 alone has a third of all rows, and 0 to 99 another one: neither is cut, the rest is
    assert len(sizes) >= 3 and max(sizes) < 0.45 * len(rows) and sum(sizes) == len(rows)


def test_even_shares_of_a_range_with_gaps(spark, url):
    numbers = [*range(1000), *range(10**6, 10**6 + 1000), *range(2 * 10**9, 2 * 10**9 + 100)]
    spark.createDataFrame([(n, 1) for n in numbers], "paragraph int, book int").write.jdbc(url, "t", properties=OPTIONS)
    ranges = readers.jdbc_ranges(spark, url, "t", OPTIONS, "paragraph", 4)
    counts = [spark.read.jdbc(url, f"(SELECT \"paragraph\" FROM t WHERE {r}) x", properties=OPTIONS).count() for r in ranges]
    assert sum(counts) == len(numbers) and len(ranges) == 4 and max(counts) < 0.3 * len(numbers)


def test_an_empty_table(spark, url):
    spark.createDataFrame([], SENTENCE).write.jdbc(url, "pali_sentences", properties=OPTIONS)
    spark.createDataFrame([], "book int, paragraph int, text string").write.jdbc(url, "pali_texts", properties=OPTIONS)
    texts, sentences = readers.read_source_tables(spark, url, OPTIONS)
    assert texts.count() == 0 and sentences.count() == 0

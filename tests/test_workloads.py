import json

from bilinea.plans import workloads
from pyspark.sql import functions as F

PAGE = '<div id="center">甲乙<a onmouseover="note(this,1)">丙</a>。</div><div id="east"><div>{}</div></div>'


def test_annotate_and_locate(spark):
    rows = [("c", "2.html", PAGE.format("Dutiyaṃ suttaṃ")), ("c", "1.html", PAGE.format("Evaṃ me sutaṃ")), ("c", "3.html", PAGE.format(" ")), ("d", "1.html", PAGE.format("else"))]
    some = spark.createDataFrame(rows, "corpus string, file string, html string")
    texts = workloads.annotate(some, spark.createDataFrame([(1, "dhamma")], "id int, pali_word string"))
    assert {(r["corpus"], r["file"], r["text"]) for r in texts.collect()} == {(c, f.replace("html", "txt"), "甲乙[[dhamma#丙]]。") for c, f, _ in rows}
    meta = spark.createDataFrame([("c", 7), ("d", 8)], "corpus string, book_id int")
    source = spark.createDataFrame([(7, 1, "evaṃ me"), (7, 2, "sutaṃ"), (7, 3, "dutiyaṃ suttaṃ"), (8, 1, "other")], "book int, paragraph int, text string")
    none = spark.createDataFrame([], "corpus string, html string, para_start int, para_end int")
    found = workloads.locate(some, meta, source, none)
    first = {("c", "1.html", 1, 2, "ok"), ("c", "2.html", 3, 3, "ok"), ("d", "1.html", None, None, "head_mismatch")}
    assert {tuple(r) for r in found.collect()} == first
    done = spark.createDataFrame([("c", "1.html", 1, 2)], "corpus string, html string, para_start int, para_end int")
    assert {tuple(r) for r in workloads.locate(some, meta, source, done).collect()} == first - {("c", "1.html", 1, 2, "ok")}


def test_align(spark):
    event = lambda c: "data: " + json.dumps({"choices": [{"delta": {"content": c}}]})
    reply = ['{"seq":1,"chinese":"甲乙。"}\n{"seq":2,', '"chinese":"丙丁"}\n{"seq":3,"chinese":null}']
    stream = [("c", "1.txt", i, event(x)) for i, x in enumerate(reply)] + [("c", "1.txt", 8, 'data: {"usage":{"prompt_tokens":5,"completion_tokens":2,"total_tokens":7}}'), ("c", "1.txt", 9, "data: [DONE]"), ("c", "2.txt", 0, event("x"))]
    chapters = spark.createDataFrame([("c", "1.txt", 0, 1, 2), ("c", "2.txt", 1, 3, 3), ("c", "3.txt", 2, 9, 9), ("c", "4.txt", 3, 1, 1)], "corpus string, chapter string, pos int, para_start int, para_end int")
    chunks = spark.createDataFrame([("c", "1.txt", "甲乙，\n丙丁"), ("c", "2.txt", " "), ("c", "3.txt", "x"), ("c", "4.txt", "x")], "corpus string, chapter string, text string")
    sentences = spark.createDataFrame([(i, 7, p, b, b + 1, f"s{i}") for i, (p, b) in enumerate([(2, 1), (1, 5), (1, 1), (3, 1)])], "id long, book int, paragraph int, word_begin int, word_end int, text string")
    meta = spark.createDataFrame([("c", 7, 0, 0)], "corpus string, book_id int, para_start int, para_end int")
    got = workloads.align(chapters, chunks, sentences, spark.createDataFrame(stream, "corpus string, chapter string, line_no int, line string"), meta, "m", F.lit("now"))
    assert {(r["chapter"], r["status"]) for r in got.status.collect()} == {("1.txt", "ok"), ("2.txt", "blank_text"), ("3.txt", "no_sentences"), ("4.txt", "no_reply")}
    assert [(r["id"], r["content"]) for r in got.records.orderBy("seq").collect()] == [("7-1-1-2", "甲乙，"), ("7-1-5-6", "丙丁"), ("7-2-1-2", None)]
    m = got.metrics.first()
    assert (m["sentences"], m["nulls"], m["chars"], m["prompt_tokens"], m["hunks"], m["hunks_left"]) == (3, 1, 6, 5, 1, 0)
    report = got.reports.collect()
    assert len(report) == 1 and "| Total tokens | 7 |" in report[0]["report"] and "自动修正 1 处差异：\n  record[0] 位置 [2]: `。` → `，`" in report[0]["report"]
    assert tuple(got.meta.first()) == ("c", 7, 1, 2)
    cut = workloads.align(chapters, chunks, sentences, spark.createDataFrame(stream, "corpus string, chapter string, line_no int, line string"), meta, "m", F.lit("now"), most_chars=2)
    assert ("1.txt", "not_compared") in {(r["chapter"], r["status"]) for r in cut.status.collect()}
    assert cut.metrics.first()["hunks_left"] is None and "未比对" in cut.reports.first()["report"]

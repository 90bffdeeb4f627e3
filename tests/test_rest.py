import json
import re

from bilinea.functions.text import ordered_join
from bilinea.functions import text as T
from bilinea.operators import glossary, profile, replies, reports, summary
from bilinea.sources import readers, writers
from bilinea.streaming.profile import trailing_char_counts
from pyspark.sql import functions as F

KEY = ["chapter"]


def test_white_space_and_words(spark):
    every = "".join(map(chr, range(0x3100)))
    assert [c for c in every if re.match(r"\s", c)] == [c for c in every if c in T.SPACE_CHARS]
    row = spark.createDataFrame([(every, f"{T.SPACE_CHARS}a b{T.SPACE_CHARS}", "Ā-b　_1̣É!")], "e string, s string, h string").select(T.without_spaces(F.col("e")), T.strip(F.col("s")), T.rstrip(F.col("s")), T.normalize_head(F.col("h"))).first()
    assert row[0] == re.sub(r"\s+", "", every) and row[1] == "a b" and row[2].endswith("a b") and row[3] == "āb_1é"
    numbers = spark.createDataFrame([("01_2.html",), ("x.html",), (" 7 .html",), ("1__2.html",), ("-3.html",), ("9" * 30 + ".html",), ("5",)], "f string")
    assert [r[0] for r in numbers.select(T.page_number(F.col("f"))).collect()] == [12, -1, 7, -1, -3, -1, 5]
    pads = spark.createDataFrame([(7, 3), (7, 0), (10000, 4), (-7, 4)], "n int, d int")
    assert [r[0] for r in pads.select(T.zero_padded(F.col("n"), F.col("d"))).collect()] == ["007", "7", "10000", "-007"]


def test_profile_with_bad_lines(spark, tmp_path):
    (tmp_path / "c").mkdir()
    lines = [{"content": "a。"}, {"content": None}, {"content": "b！　"}, {"content": "  "}, {"content": "c！"}, {"other": 1}]
    (tmp_path / "c/1.jsonl").write_text("\n".join(json.dumps(x) for x in lines[:3]) + "\n\nnot json\n[1]\n")
    (tmp_path / "c/2.jsonl").write_text("\r\n".join(json.dumps(x, ensure_ascii=False) for x in lines[3:]) + "\r\n")
    good, bad = readers.read_aligned(spark, str(tmp_path))
    got = [(r["ch"], r["n"], r["rank"]) for r in profile.trailing_char_profile(good).orderBy("rank").collect()]
    assert got == [("(空)", 3, 1), ("！", 2, 2), ("。", 1, 3)]
    total = profile.profile_totals(good, bad).first()
    assert (total["files"], total["total"], total["bad"], total["distinct_chars"]) == (2, 6, 2, 3)
    (tmp_path / "c/2.jsonl").write_text(json.dumps({"content": "x y"}, ensure_ascii=False))
    assert readers.read_aligned(spark, str(tmp_path))[1].count() == 2
    assert readers.read_aligned(spark, str(tmp_path), every_line_end=True)[1].count() == 4


def test_streamed_profile(spark, tmp_path):
    spark.createDataFrame([("c", "a。"), ("c", None), ("d", "b。")], "corpus string, content string").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("corpus string, content string").parquet(f"{tmp_path}/in")
    query = trailing_char_counts(stream).writeStream.outputMode("complete").format("memory").queryName("trailing").start()
    query.processAllAvailable()
    query.stop()
    assert {tuple(r) for r in spark.table("trailing").collect()} == {("c", "。", 1), ("c", "(空)", 1), ("d", "。", 1)}


NOTES = """<div id=div1>「識」(viññāṇa, x)，南傳作「<b>識</b>」(Viññāṇa，見)，菩提譯；另譯為「了別」。</div>
<DIV id="div2" >「色」 (Rūpa，另譯為「物質」)</DIV>
<div id='div3'>「受」(vedanā)</div>
<div id=div4>無</div>
<div id=div5>「a」(x)
</div>
<div id=div3>南傳作「 」( ,)</div>"""


def test_glossary(spark, tmp_path):
    page = spark.createDataFrame([("n1.html", NOTES), ("n2.html", None)], "source string, html string")
    found = glossary.extract_glossary(page)
    got = [(r["id"], r["pali_word"], r["meaning"], r["meaning2"]) for r in found.orderBy("pos").collect()]
    assert got == [(1, "viññāṇa", "識", "了別"), (2, "rūpa", "色", "物質"), (3, "vedanā", "受", None), (4, None, None, None), (3, None, None, None)]
    failures = glossary.glossary_failures(found)
    assert [(r["id"], r["missing"]) for r in failures.orderBy("pos").collect()] == [(4, ["pali_word", "meaning"]), (3, ["pali_word", "meaning"])]
    assert {tuple(r) for r in glossary.glossary_totals(found).collect()} == {("n1.html", 5, 2), (None, 5, 2)}
    writers.write_lines(reports.glossary_report(found, failures).repartition(3), f"{tmp_path}/report")
    report = readers.read_joined(spark, f"{tmp_path}/report", "report").first()["report"]
    assert report.startswith("# 注释提取报告\n\n- 总条目数：5\n- 字段缺失条目：2\n\n## 字段缺失详情\n\n| 来源文件") and report.endswith("| n1.html | 3 | `pali_word, meaning` | 南傳作「 」( ,) |\n")
    writers.write_lines(reports.glossary_report(found.limit(0), failures.limit(0)), f"{tmp_path}/report")
    empty = readers.read_joined(spark, f"{tmp_path}/report", "report").first()["report"]
    assert empty == "# 注释提取报告\n\n- 总条目数：0\n- 字段缺失条目：0\n\n✅ 全部条目均成功提取所有字段。\n"
    writers.write_glossary(found, f"{tmp_path}/csv", f"{tmp_path}/json")
    words = {r["id"]: r["pali_word"] for r in readers.read_glossary(spark, f"{tmp_path}/csv").collect()}
    assert words == {1: "viññāṇa", 2: "rūpa", 3: "vedanā"}
    assert spark.read.json(f"{tmp_path}/json").where("meaning2 is null").count() == 3
    (tmp_path / "g.csv").write_text('id,pali_word\nx,a\n1,b\n1," c "\n2,\n 3 ,"d ""q"""\n', encoding="utf-8")
    assert {tuple(r) for r in readers.read_glossary(spark, f"{tmp_path}/g.csv").collect()} == {(1, "c"), (3, 'd "q"')}


def test_replies(spark):
    event = lambda c: "data: " + json.dumps({"choices": [{"delta": {"content": c}}]})
    lines = [": ping", event('```json{"seq": 1, "chi'), 'data: {"choices": []}', "data: {oops", event('nese": "甲"}\nchat\n{"seq":2,"chinese":null}\n'), 'data: {"usage": {"prompt_tokens": 1}}', 'data:{"choices":[{"delta":{}}],"usage":{"prompt_tokens":5,"completion_tokens":6,"total_tokens":11,"cost":0.5}}', event('{"seq":true,"chinese":"no"}\n{"seq":1.0,"chinese":"no"}\n{"seq":3,"chinese":"a"}\n{"seq":3,"chinese":"b"}\n{"seq":9,"chinese":"x"}\n`{"seq":4}'), "data: [DONE]", event('\n{"seq":1,"chinese":"late"}')]
    stream = spark.createDataFrame([(1, i, x) for i, x in enumerate(lines)], "chapter int, line_no int, line string")
    events = replies.stream_events(stream, KEY)
    usage = replies.stream_usage(events, KEY).first()
    assert (usage["prompt_tokens"], usage["completion_tokens"], usage["total_tokens"], usage["extra"]) == (5, 6, 11, {"cost": "0.5"})
    sentences = spark.createDataFrame([(1, n, 7, n, 1, 2, f"s{n}") for n in range(1, 6)], "chapter int, seq int, book int, paragraph int, word_begin int, word_end int, text string")
    slots = replies.fill_slots(sentences, replies.stream_lines(events, KEY), KEY)
    assert [(r["id"], r["content"]) for r in slots.orderBy("seq").collect()] == [("7-1-1-2", "甲"), ("7-2-1-2", None), ("7-3-1-2", "b"), ("7-4-1-2", None), ("7-5-1-2", None)]
    assert replies.aligned_text(slots, KEY).first()["text"] == "甲b"
    chunk = spark.createDataFrame([(1, " 文\n"), (2, "x")], "chapter int, text string")
    assert replies.build_prompts(sentences.where("seq < 3"), chunk, KEY).first()["prompt"] == "【巴利文句子列表】\n1. s1\n2. s2\n\n【汉文译文】\n文"
    chapters = spark.createDataFrame([(1, 7, 2, 3), (2, 7, 3, 3), (3, 7, 5, 4), (4, 8, 1, 9)], "chapter int, book_id int, para_start int, para_end int")
    source = sentences.drop("chapter", "seq").withColumn("id", F.col("paragraph").cast("long"))
    got = {(r["chapter"], r["seq"], r["paragraph"]) for r in replies.chapter_sentences(chapters, source, KEY).collect()}
    assert got == {(1, 1, 2), (1, 2, 3), (2, 1, 3)}
    states = summary.chapter_status(chapters, chunk, sentences, stream, KEY)
    assert {tuple(r) for r in states.collect()} == {(1, "ok"), (2, "no_sentences"), (3, "missing_file"), (4, "missing_file")}


def test_summary(spark, tmp_path):
    para_map = spark.createDataFrame([("c", "b.txt", 0), ("c", "a.txt", 1), ("c", "n.txt", 2)], "corpus string, text string, pos int")
    figures = "corpus string, file string, sentences int, chars int, model string, prompt_tokens int, completion_tokens int, hunks int, hunks_left int, generated_at string"
    new = spark.createDataFrame([("c", "a.txt", 1, 2, "m", 3, 4, 5, 6, "now")], figures)
    old = spark.createDataFrame([("c", "a.txt", 9, 9, "m", 9, 9, 9, 9, "old"), ("c", "b.txt", 7, 7, "m", 7, 7, 7, 7, "old"), ("c", "gone.txt", 7, 7, "m", 7, 7, 7, 7, "old")], figures)
    merged = summary.merge_summary(para_map, new, old)
    assert [(r["no"], r["file"], r["sentences"]) for r in merged.orderBy("no").collect()] == [(1, "b.txt", 7), (2, "a.txt", 1), (3, "n.txt", None)]
    writers.write_summary(merged, f"{tmp_path}/s")
    lines = next((tmp_path / "s/corpus=c").glob("*.csv")).read_text().splitlines()
    assert lines[0] == "序号,文件名,句子总数,中文字符数,模型,Prompt tokens,Completion tokens,原始差异,修正后剩余差异,生成时间" and lines[3] == "3,n.txt,,,,,,,,"
    meta = summary.initial_meta(spark.createDataFrame([("c", "u", 1, 2), ("d", "u", 3, 0)], "corpus string, url_template string, book_id int, n_digits int"), 1, 9)
    records = spark.createDataFrame([("c", 0, 1, "1-30-1-2"), ("c", 0, 2, "1-31-1-2"), ("c", 4, 1, "1-9-1-2"), ("c", 4, 2, "1-8-1-2")], "corpus string, pos int, seq int, id string")
    assert {(r["corpus"], r["para_start"], r["para_end"]) for r in summary.backfill_meta(meta, records).collect()} == {("c", 30, 8), ("d", 0, 0)}
    rows = spark.createDataFrame([("c", "1", 2, "x", "p", None), ("c", "1", 1, "y", "q", "甲")], "corpus string, chapter string, seq int, id string, original string, content string")
    writers.write_aligned(rows, f"{tmp_path}/a")
    writers.write_aligned(rows.withColumn("chapter", F.lit("2")), f"{tmp_path}/a")
    text = next((tmp_path / "a/corpus=c/chapter=1").glob("*.json")).read_text()
    assert text == '{"id":"y","original":"q","content":"甲"}\n{"id":"x","original":"p","content":null}\n'
    assert len(list((tmp_path / "a/corpus=c").iterdir())) == 2
    ordinals = summary.filter_by_ordinal(para_map, 2, None)
    assert {r["text"] for r in ordinals.collect()} == {"a.txt", "n.txt"} and summary.filter_by_ordinal(para_map, 0, 1).count() == 1


def test_source_tables(spark, tmp_path):
    spark.createDataFrame([(1, 2, "x")], "book int, paragraph int, text string").write.parquet(f"{tmp_path}/pali_texts")
    spark.createDataFrame([(5, 1, 2, 3, 4, "x")], "id long, book int, paragraph int, word_begin int, word_end int, text string").write.parquet(f"{tmp_path}/pali_sentences")
    texts, sentences = readers.read_source_tables(spark, str(tmp_path))
    assert texts.first()["text"] == "x" and sentences.first()["word_end"] == 4


def test_texts_are_joined_in_order_without_an_expression_for_each_pair(spark):
    rows = spark.createDataFrame([(2, "b"), (1, "a"), (3, None), (10, "c")], "place int, text string").agg(ordered_join(F.col("place"), F.col("text"), "\n").alias("t"))
    assert rows.first()["t"] == "a\nb\nc"
    assert "lambdafunction" not in rows._jdf.queryExecution().executedPlan().toString()

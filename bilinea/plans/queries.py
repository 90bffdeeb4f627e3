"""The registered queries of the corpus operators. The test tables hold no bilingual pages, so each query derives its
input from them with Spark expressions; oracles.py says the same in SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bilinea.functions.ranks import ranked_within
from bilinea.functions.storage import new_path, store
from bilinea.functions.text import is_blank, normalize_head, ordered_join, page_number, record_id, split_record_id, strip, without_spaces
from bilinea.operators import diff, glossary, pages, paragraphs, profile, replies, reports, split, summary
from bilinea.plans import workloads
from bilinea.sources import compaction, readers, writers
from bilinea.streaming import locate

KEY = ["doc_id"]
CONV = ["conv_id"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with one row for each order and line number: o, n, q, flag, part."""
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("n")).agg(F.min("l_quantity").cast("int").alias("q"), F.min("l_returnflag").alias("flag"), F.min("l_partkey").alias("part"))


def escaped(text: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def cat(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


# Profile and readers


def a1_trailing_char_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("lang").alias("corpus"), F.col("text").alias("content"), F.col("doc_id").alias("line"))
    return profile.trailing_char_profile(docs, order=["line"])


def record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON line for each document; every seventh is cut short, and every eleventh has a null content."""
    docs = table(spark, sf_dir, "documents")
    record = F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("original"), F.when(F.col("doc_id") % 11 != 0, F.col("text")).alias("content")), {"ignoreNullFields": "false"})
    line = F.when(F.col("doc_id") % 7 == 0, F.substring(record, F.lit(1), F.length(record) - 1)).otherwise(record)
    return docs.select(F.col("source").alias("corpus"), cat(F.col("lang"), ".jsonl").alias("file"), F.col("doc_id").alias("line_no"), line.alias("line"))


def s5_read_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = readers.split_records(record_lines(spark, sf_dir))
    return good.select(F.col("corpus").alias("source"), F.col("line").alias("doc_id"), "original", F.md5("content").alias("content_md5"))


def a1_profile_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_totals(*readers.split_records(record_lines(spark, sf_dir)))


def s2_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map line for each order, keyed on the customer: the last order counts and the first gives the place."""
    orders = table(spark, sf_dir, "orders")
    rows = orders.select(F.col("o_orderpriority").alias("corpus"), cat(F.col("o_custkey"), ".html").alias("html"), F.col("o_orderkey").cast("int").alias("para_start"), (F.col("o_orderkey") + 2).cast("int").alias("para_end"), F.col("o_orderkey").alias("line_no"))
    return readers.last_wins(rows, "html")


# Scalar functions


def p1_url_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = table(spark, sf_dir, "customer").select(F.col("c_name").alias("corpus"), F.lit("https://example.org/c/{n}/raw{n_raw}.htm").alias("url_template"), (F.col("c_nationkey") % 5).alias("n_digits"), F.col("c_custkey"))
    return pages.url_manifest(config, F.lit(95), 95 + F.lit(12))


def p2_page_number_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    name = F.when(key % 4 == 0, cat(key, ".html")).when(key % 4 == 1, cat("0", key, "_1.html")).when(key % 4 == 2, cat("p", key, ".html")).otherwise(cat(key, "__2.html"))
    return pages.filter_by_page_number(table(spark, sf_dir, "orders").select("o_orderkey", name.alias("file")), 100, None).withColumn("page_no", page_number(F.col("file")))


def p3_ordinal_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey"), (F.col("p_partkey") % 50).alias("pos"))
    return summary.filter_by_ordinal(rows, 3, 20)


def p7_p8_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", F.length(without_spaces(text)).alias("n_visible"), F.md5(without_spaces(text)).alias("stripped_md5"), F.substring(normalize_head(text), 1, 30).alias("head"), F.md5(normalize_head(text)).alias("head_md5"), F.length(strip(text)).alias("n_strip"))


def p12_retarget(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 3 == 0, cat(F.col("o_orderkey"), ".a.html")).when(F.col("o_orderkey") % 3 == 1, F.col("o_orderkey").cast("string")).otherwise(cat(F.col("o_orderkey"), ".html")).alias("html"), F.col("o_custkey").alias("para_start"), (F.col("o_custkey") + 1).alias("para_end"))
    return pages.retarget_para_map(rows)


def p15_record_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = record_id(F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber"))
    rows = table(spark, sf_dir, "lineitem").select(name.alias("id"))
    return rows.select("id", split_record_id(F.col("id")).alias("s")).select("id", "s.*")


# Glossary


def note_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A note for each part; a fifth of them each with two meanings, one, another name, a bare name, or none."""
    key, name, kind = F.col("p_partkey"), F.col("p_name"), F.col("p_type")
    note = (
        F.when(key % 5 == 0, cat("<b>南傳作「", kind, "」</b> (", name, "，見經)，北傳另譯為「", F.col("p_brand"), "」。"))
        .when(key % 5 == 1, cat(" 南傳作「", kind, "」(", name, ", x)，無別譯 "))
        .when(key % 5 == 2, cat("「", kind, "」 (Ā", name, "，另譯為「", F.col("p_brand"), "」)"))
        .when(key % 5 == 3, cat("某「", kind, "」(", F.upper(name), ")"))
        .otherwise(cat("無詞 ", name, " | ", kind))
    )
    body = F.when(key % 13 == 0, cat("<div id=div", key, ">two\nlines ", note, "</div>")).when(key % 2 == 0, cat("<DIV id='div", key, "'>", note, "</DIV>")).otherwise(cat('<div id="div', key, '" >', note, "</div>"))
    return table(spark, sf_dir, "part").select(F.col("p_brand").alias("source"), cat("\n", body, "\n").alias("html"))


def p9_p10_glossary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return glossary.extract_glossary(note_pages(spark, sf_dir)).drop("pos")


def p11_glossary_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = glossary.glossary_failures(glossary.extract_glossary(note_pages(spark, sf_dir)))
    return found.select("source", "id", F.array_join("missing", ", ").alias("missing"), "note")


def a8_glossary_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return glossary.glossary_totals(glossary.extract_glossary(note_pages(spark, sf_dir)))


def r2_glossary_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    # read by totals, failures and their places: notes are parsed once
    found = store(glossary.extract_glossary(note_pages(spark, sf_dir)).withColumn("pos", F.col("id")), "glossary")
    path = new_path(spark, "report")
    writers.write_lines(reports.glossary_report(found, glossary.glossary_failures(found)), path)
    return readers.read_joined(spark, path, "report")


# Pages


def annotated_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page for each document: its text, a glossary anchor, a local anchor and, on even pages, the local note."""
    key = F.col("doc_id")
    html = cat(
        '<html><body><div id="center"><div class="nikaya">', escaped(F.col("text")), "<a onmouseover=\"note(this,", key % 3000, ")\">term ", key, "</a> and ",
        '<a onMouseover="local(this , 1 )">place</a></div></div><div id="south">', F.when(key % 2 == 0, cat('<span id="note1"> note of ', key, " </span>")).otherwise(F.lit("")), "</div></body></html>",
    )
    return table(spark, sf_dir, "documents").select("doc_id", html.alias("html"))


def p5_j1_j2_a2_annotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    some = annotated_pages(spark, sf_dir)
    words = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("int").alias("id"), F.when(F.col("p_partkey") % 7 == 0, F.lit(" ")).otherwise(F.col("p_name")).alias("pali_word"))
    shown = pages.resolve_glossary(pages.extract_segments(some, "center", keys=KEY), words)
    text = pages.assemble_text(pages.resolve_local_notes(shown, pages.extract_local_notes(some, KEY), KEY), KEY)
    return text.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").alias("n_chars"), "notes", "locals")


def p4_extract_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = cat('<div><p>before</p><div id="east"><div class="pali">', F.replace(escaped(F.col("text")), F.lit("\n"), F.lit("<br>")), "</div></div><p>after</p></div>")
    section = pages.extract_section(table(spark, sf_dir, "documents").select("doc_id", html.alias("html")), "east", keys=KEY)
    return section.select("doc_id", F.md5("text").alias("text_md5"))


def p6_local_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("doc_id")
    html = cat('<SPAN id="note', key % 50, '">', escaped(F.col("text")), '\n</span><span id="note7">old</span><span class="x" id="note8">no</span><span\nid="note7"> new', key, " </span>")
    notes = pages.extract_local_notes(table(spark, sf_dir, "documents").select("doc_id", html.alias("html")), KEY)
    return notes.select("doc_id", "note_id", F.md5("text").alias("text_md5"))


def j5_pending_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = lambda c: cat(F.col(c), ".html")
    some = table(spark, sf_dir, "orders").select(F.lit("orders").alias("corpus"), name("o_orderkey").alias("file"))
    done = lines(spark, sf_dir).where("n = 3").select(F.lit("orders").alias("corpus"), name("o").alias("html"))
    return pages.pending_pages(some, done)


def j6_missing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("corpus"), F.col("c_custkey").alias("file"))
    there = table(spark, sf_dir, "orders").where("o_custkey % 4 <> 1").select(F.col("o_custkey").alias("file"))
    return pages.missing_sources(wanted, there, ["file"])


# Paragraphs


def located(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as books: lines are the paragraphs, and pages hold two line numbers each with up to 40 odd characters."""
    rows = lines(spark, sf_dir).select(F.col("o").cast("int").alias("book"), F.col("n").alias("paragraph"), cat("P-", F.col("o"), " ", F.repeat(F.lit("ab "), F.col("q")), F.col("flag")).alias("text"))
    rows = store(rows, "paragraphs")
    page = rows.groupBy("book", F.floor((F.col("paragraph") - 1) / 2).alias("page_pos")).agg(ordered_join(F.col("paragraph"), F.col("text"), "\n").alias("text"))
    odd = F.repeat(F.lit("x"), (F.col("book") * 7 + F.col("page_pos") * 13) % 41)
    page = page.select("book", "page_pos", F.lit("orders").alias("corpus"), cat(F.col("page_pos"), ".html").alias("html"), F.concat("text", odd.cast("string")).alias("text"))
    return page, rows


def f1_match_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    page, rows = located(spark, sf_dir)
    none = spark.createDataFrame([], "book int, para_end int")
    return paragraphs.match_pages_to_paragraphs(page, rows, paragraphs.cursor_start(none, rows)).drop("corpus")


def source_books(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Sources as books: documents in order of their ids are the paragraphs, and a page holds three of them and up to 40
    odd characters. A source of a third of all documents is a book of a third of all paragraphs."""
    docs = table(spark, sf_dir, "documents").select(F.coalesce(F.substring("source", 4, 9).try_cast("int"), F.lit(-1)).alias("book"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # ids alone are put in order; texts are joined to them
    places = ranked_within(docs.select("book", "doc_id"), ["book"], ["doc_id"], "place")
    rows = store(docs.join(places, ["book", "doc_id"]).select("book", (F.col("place") + 1).cast("int").alias("paragraph"), "text"), "book-paragraphs")
    page = rows.groupBy("book", F.floor((F.col("paragraph") - 1) / 3).alias("page_pos")).agg(ordered_join(F.col("paragraph"), F.col("text"), "\n").alias("text"))
    odd = F.repeat(F.lit("x"), (F.col("book") * 7 + F.col("page_pos") * 13) % 41)
    return page.select("book", "page_pos", F.lit("sources").alias("corpus"), cat(F.col("page_pos"), ".html").alias("html"), F.concat("text", odd.cast("string")).alias("text")), rows


def f1_source_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    page, rows = source_books(spark, sf_dir)
    none = spark.createDataFrame([], "book int, para_end int")
    return paragraphs.match_pages_to_paragraphs(page, rows, paragraphs.cursor_start(none, rows)).drop("corpus")


def j5_a6_f1_resumed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same books, whose pages arrive in four runs: the cursor of each book is kept as a stream's state."""
    page, rows = source_books(spark, sf_dir)
    path = new_path(spark, "page-stream")
    sizes = page.groupBy("book").agg(F.ceil(F.count(F.lit(1)) / 4).alias("n"))
    parts = store(page.join(sizes, "book").withColumn("part", F.floor(F.col("page_pos") / F.col("n"))).drop("n"), "page-parts")
    none = spark.createDataFrame([], "book int, para_end int")
    for k in range(4):  # each run goes on where the last one ended
        parts.where(F.col("part") == k).drop("part").write.mode("append").parquet(f"{path}/pages")
        arriving = spark.readStream.schema(page.schema).parquet(f"{path}/pages")
        located = locate.locate_stream(arriving, rows, paragraphs.cursor_start(none, rows))
        locate.started(spark, located, f"{path}/map", f"{path}/checkpoint").awaitTermination()
    return spark.read.schema(paragraphs.RESULT).parquet(f"{path}/map").drop("corpus")


def a6_cursor_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rows = located(spark, sf_dir)
    done = table(spark, sf_dir, "orders").where("o_orderkey % 3 = 0").select(F.col("o_orderkey").cast("int").alias("book"), (F.col("o_custkey") % 10).cast("int").alias("para_end"))
    return paragraphs.cursor_start(done, rows)


def j7_verify_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    page, rows = located(spark, sf_dir)
    some = paragraphs.measured(page, "text", "book", "page_pos").withColumn("cursor", (F.col("page_pos") + 1).cast("int"))
    return paragraphs.verify_heads(some, paragraphs.measured(rows, "text", "book", "paragraph")).select("book", "page_pos", "head_ok")


# Sentences and replies


def j3_chapter_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order is a chapter of one to three orders' lines."""
    chapters = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("chapter"), F.lit(1).alias("book_id"), F.col("o_orderkey").cast("int").alias("para_start"), (F.col("o_orderkey") + F.col("o_custkey") % 3).cast("int").alias("para_end"))
    sentences = lines(spark, sf_dir).select((F.col("o") * 8 + F.col("n")).alias("id"), F.lit(1).alias("book"), F.col("o").cast("int").alias("paragraph"), F.col("n").alias("word_begin"), (F.col("n") + F.col("q")).alias("word_end"), F.col("flag").alias("text"))
    return replies.chapter_sentences(chapters, sentences, ["chapter"])


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as chapters: each turn is a sentence; a null text is empty."""
    text = F.coalesce("text", F.lit(""))
    return table(spark, sf_dir, "conversations").select("conv_id", (F.col("turn") + 1).cast("int").alias("seq"), F.lit(1).alias("book"), F.col("turn").cast("int").alias("paragraph"), F.lit(0).alias("word_begin"), F.length(text).alias("word_end"), text.alias("text"), F.col("role"))


def reply_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reply line for each turn: every fifth is missing, every fourth comes twice, some in a fence, some with a number
    that is no integer."""
    rows = turns(spark, sf_dir)
    good = F.to_json(F.struct("seq", F.col("text").alias("chinese")))
    line = F.when(F.col("seq") % 7 == 0, F.to_json(F.struct(F.col("seq").cast("string").alias("seq"), F.col("text").alias("chinese")))).when(F.col("seq") % 3 == 0, cat("```json", good, "```")).otherwise(good)
    first = rows.where("seq % 5 <> 3").select("conv_id", (F.col("seq") * 10).alias("line_no"), line.alias("line"))
    second = rows.where("seq % 4 = 0").select("conv_id", (F.col("seq") * 10 + 5).alias("line_no"), F.to_json(F.struct("seq", F.lit("again").alias("chinese"))).alias("line"))
    noise = rows.where("seq = 1").select("conv_id", F.lit(1).alias("line_no"), F.lit("Here is the result: [1, 2]").alias("line"))
    return first.unionByName(second).unionByName(noise)


def p14_j4_fill_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = replies.fill_slots(turns(spark, sf_dir), reply_lines(spark, sf_dir), CONV)
    return slots.select("conv_id", "seq", "id", F.md5("content").alias("content_md5"))


def recorded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn as two stream lines that split its text; usage at the end, before an end mark and a stray line."""
    rows = turns(spark, sf_dir)
    event = lambda c: cat("data: ", F.to_json(F.struct(F.array(F.struct(F.struct(c.alias("content")).alias("delta"))).alias("choices"))))
    half = F.floor(F.length("text") / 2).cast("int")
    first = rows.select("conv_id", (F.col("seq") * 10).alias("line_no"), event(F.substring(F.col("text"), F.lit(1), half)).alias("line"))
    second = rows.select("conv_id", (F.col("seq") * 10 + 1).alias("line_no"), event(F.concat(F.substring(F.col("text"), half + 1, F.length("text")), F.lit("\n"))).alias("line"))
    broken = rows.select("conv_id", (F.col("seq") * 10 + 2).alias("line_no"), F.when(F.col("seq") % 2 == 0, F.lit("data: {broken")).otherwise(F.lit(": keep-alive")).alias("line"))
    usage = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select("conv_id", F.explode(F.array(F.struct(F.lit(9001).alias("line_no"), cat('data: {"choices":[],"usage":{"prompt_tokens":', F.col("n"), ',"completion_tokens":7,"total_tokens":9,"cached":{"a":1}}}').alias("line")), F.struct(F.lit(9002).alias("line_no"), F.lit('data: {"choices":[],"usage":{}}').alias("line")), F.struct(F.lit(9003).alias("line_no"), F.lit("data: [DONE]").alias("line")), F.struct(F.lit(9004).alias("line_no"), F.lit('data: {"choices":[{"delta":{"content":"late"}}]}').alias("line")))).alias("x"))
    return first.unionByName(second).unionByName(broken).unionByName(usage.select("conv_id", "x.*"))


def p13_reply_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = replies.stream_lines(replies.stream_events(recorded(spark, sf_dir), CONV), CONV)
    return found.select("conv_id", "line_no", F.md5("line").alias("line_md5"))


def p13_reply_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = replies.stream_usage(replies.stream_events(recorded(spark, sf_dir), CONV), CONV)
    return found.select("conv_id", "prompt_tokens", "completion_tokens", "total_tokens", F.to_json("extra").alias("extra"))


def chunks(rows: DataFrame) -> DataFrame:
    return rows.groupBy("conv_id").agg(ordered_join(F.col("seq"), F.col("text"), "\n").alias("text"))


def a4_build_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = turns(spark, sf_dir)
    prompts = replies.build_prompts(rows.withColumn("text", F.col("role")), chunks(rows), CONV)
    return prompts.select("conv_id", F.md5("prompt").alias("prompt_md5"))


def a3_aligned_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = turns(spark, sf_dir).withColumn("content", F.when(F.col("seq") % 3 != 0, F.col("text")))
    return replies.aligned_text(rows, CONV).select("conv_id", F.md5("text").alias("text_md5"))


# Differences


def altered(text: Column) -> Column:
    """text with a foreign mark for its middle character."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), half), F.lit("§"), F.substring(text, half + 2, F.length(text)))


def f2_diff_hunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns against copies that lost a character and gained a mark: the originals, rebuilt from copies and hunks, and how
    many characters the hunks hold, which are that character and that mark alone."""
    rows = turns(spark, sf_dir)
    text = without_spaces(F.col("text"))
    third = F.floor(F.length(text) / 3).cast("int")
    copy = F.concat(F.substring(text, F.lit(1), third), F.substring(text, third + 2, F.length(text)), F.when(F.col("seq") % 2 == 0, F.lit("§")).otherwise(F.lit("")))
    found = diff.diff_hunks(rows.select("conv_id", "seq", F.col("text").alias("original"), copy.alias("aligned")))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))
    fold = F.aggregate("hunks", start, lambda a, h: F.struct(h["aligned_end"].alias("at"), F.concat(a["text"], F.substring(F.col("aligned_norm"), a["at"] + 1, h["aligned_start"] - a["at"]), h["orig_chunk"]).alias("text")))
    rebuilt = F.concat(fold["text"], F.substring(F.col("aligned_norm"), fold["at"] + 1, F.length("aligned_norm")))
    total = lambda side: F.aggregate("hunks", F.lit(0), lambda n, h: n + F.length(h[side]))
    return found.select("conv_id", "seq", F.md5(rebuilt).alias("rebuilt_md5"), total("orig_chunk").alias("n_removed"), total("aligned_chunk").alias("n_added"))


def f3_diff_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = turns(spark, sf_dir).where(~is_blank(F.col("text")))
    found = diff.diff_hunks(rows.select("conv_id", "seq", F.col("text").alias("original"), altered(without_spaces(F.col("text"))).alias("aligned")))
    log = diff.diff_log(F.col("hunks"), F.col("orig_norm"), F.col("aligned_norm"))
    return found.select("conv_id", "seq", F.array_join(log, "\n").alias("log"))


def f4_f5_correct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations whose odd turns have a mark for their middle character: the contents put right."""
    rows = turns(spark, sf_dir)
    whole = chunks(rows)
    records = rows.select("conv_id", "seq", F.when((F.col("seq") % 2 == 1) & (F.length(without_spaces(F.col("text"))) > 0), altered(F.regexp_replace("text", r"[ \n\t\r]+", ""))).otherwise(F.col("text")).alias("content"))
    before = store(diff.recheck(records, whole, CONV), "before")
    fixed = diff.auto_correct(records, before, CONV)
    after = diff.recheck(diff.corrected_records(records, fixed, CONV), whole, CONV)
    counts = fixed.chapters.select("conv_id", "n_fixable", "n_applied").join(after.select("conv_id", "hunks_left", "aligned_norm"), CONV)
    return counts.select("conv_id", "n_fixable", "n_applied", "hunks_left", F.md5("aligned_norm").alias("text_md5"))


def f6_proportional_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut for their own lines: each slot's text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    marked = docs.select("doc_id", F.replace(F.replace("text", F.lit(","), F.lit("，")), F.lit("."), F.lit("。")).alias("text"))
    slots = split.proportional_split(marked, docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("seq", "text")), KEY)
    return slots.select("doc_id", "seq", F.length("content").alias("n_chars"), F.md5("content").alias("content_md5"))


# Summary and reports


def a5_chapter_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = ["chapter"]
    rows, orders = lines(spark, sf_dir), table(spark, sf_dir, "orders")
    records = rows.select(F.col("o").alias("chapter"), F.when(F.col("q") % 4 == 1, F.lit("")).when(F.col("q") % 4 > 1, F.col("flag")).alias("content"))
    text = orders.select(F.col("o_orderkey").alias("chapter"), F.col("o_orderpriority").alias("text"))
    usage = orders.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("chapter"), F.col("o_custkey").alias("prompt_tokens"), F.lit(5).alias("completion_tokens"))
    hunks = lambda n: orders.select(F.col("o_orderkey").alias("chapter"), F.array_repeat(F.lit("h"), n.cast("int")).alias("hunks"))
    return summary.chapter_metrics(records, text, usage, hunks(F.col("o_custkey") % 6), hunks(F.col("o_custkey") % 3), key)


def j8_merge_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_brand").alias("corpus"), cat(F.col("p_partkey"), ".txt").alias("file"), F.col("p_partkey").alias("pos"), F.col("p_size").alias("sentences"), F.length("p_name").alias("chars"))
    figures = ["corpus", "file", "sentences", "chars"]
    old = part.where("pos % 2 = 0").withColumn("sentences", F.lit(-1)).select(*figures).unionByName(part.where("pos % 10 = 0").withColumn("file", cat("gone", F.col("pos"))).select(*figures))
    return summary.merge_summary(part.select("corpus", F.col("file").alias("text"), "pos"), part.where("pos % 3 = 0").select(*figures), old)


def a7_backfill_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("corpus"), F.lit(1).alias("book_id"), F.lit(0).alias("para_start"), F.lit(0).alias("para_end"))
    done = lines(spark, sf_dir).join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("o"), F.col("o_custkey").alias("corpus")), "o")
    return summary.backfill_meta(meta, done.select("corpus", F.col("o").alias("pos"), F.col("n").alias("seq"), record_id(F.lit(1), F.col("part"), F.col("n"), F.col("q")).alias("id")))


def chapter_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as chapters: some have no text, some a blank one, some no lines, some no reply."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("chapter"), "o_custkey", "o_orderpriority")
    text = orders.where("o_custkey % 11 <> 0").select("chapter", F.when(F.col("o_custkey") % 7 == 0, F.lit(" \n")).otherwise(F.col("o_orderpriority")).alias("text"))
    return summary.chapter_status(orders, text, lines(spark, sf_dir).select(F.col("o").alias("chapter")), orders.where("o_custkey % 5 <> 0"), ["chapter"])


def r1_alignment_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    log = F.when(key % 2 == 0, F.array(cat("@@ ", key), F.lit("- x"))).otherwise(F.array().cast("array<string>"))
    rows = table(spark, sf_dir, "orders").select(
        key.alias("chapter"), cat(key, ".txt").alias("file"), F.lit("2026-01-01 00:00:00 UTC").alias("generated_at"), F.lit("m").alias("model"), (key % 100).alias("sentences"), (key % 7).alias("nulls"),
        F.col("o_custkey").alias("prompt_tokens"), F.lit(3).alias("completion_tokens"), (F.col("o_custkey") + 3).alias("total_tokens"), F.create_map(F.lit("cached"), F.col("o_orderstatus")).alias("extra"),
        F.slice(log, 1, 1).alias("hunks"), log.alias("log"), F.array(cat("自动修正 ", key % 3, " 处差异：")).alias("fixed_log"),
        F.when(key % 3 == 0, F.array(F.lit("跳过 1 处复杂差异（需人工检查）："), F.lit("  tag"))).otherwise(F.array(F.lit("跳过 0 处复杂差异（需人工检查）："))).alias("skipped_log"), F.when(key % 4 == 0, log).otherwise(F.array().cast("array<string>")).alias("log_left"),
    )
    return reports.alignment_report(rows, ["chapter"]).select("chapter", F.md5("report").alias("report_md5"))


def k3_aligned_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns written as aligned records, a folder for each role, and read back."""
    path = new_path(spark, "aligned")
    content = F.when(F.col("seq") % 4 != 0, F.col("text"))
    name = record_id(F.col("conv_id"), F.col("paragraph"), F.col("word_begin"), F.col("word_end"))
    writers.write_aligned(turns(spark, sf_dir).select(F.lit("turns").alias("corpus"), F.col("role").alias("chapter"), (F.col("conv_id") * 1000 + F.col("seq")).alias("seq"), name.alias("id"), F.col("role").alias("original"), content.alias("content")), path)
    records, _ = readers.read_aligned(spark, f"{path}/corpus=turns", files="*.json")
    return records.select("id", "original", F.md5("content").alias("content_md5"))


def k4_s3_glossary_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The glossary written as CSV and read back as its words."""
    path = new_path(spark, "glossary")
    writers.write_glossary(glossary.extract_glossary(note_pages(spark, sf_dir)), f"{path}/csv", f"{path}/json")
    return readers.read_glossary(spark, f"{path}/csv")


def k2_para_map_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map rows appended in two runs and read back."""
    path = new_path(spark, "map")
    orders = table(spark, sf_dir, "orders")
    rows = orders.select(F.col("o_orderpriority").alias("corpus"), cat(F.col("o_orderkey"), ".html").alias("html"), F.col("o_custkey").cast("int").alias("para_start"), (F.col("o_custkey") + 3).cast("int").alias("para_end"))
    for part in (0, 1):
        writers.write_para_map(rows.where(F.col("para_start") % 2 == part), path)
    return spark.read.schema("html string, para_start int, para_end int, corpus string").json(path)


def k5_summary_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary written under its headings and read back."""
    path = new_path(spark, "summary")
    orders = table(spark, sf_dir, "orders")
    cells = {"no": F.col("o_orderkey"), "file": cat(F.col("o_orderkey"), ".txt"), "sentences": F.when(F.col("o_custkey") % 3 > 0, F.col("o_custkey")), "chars": F.col("o_custkey") + 1, "model": F.col("o_orderstatus"), "generated_at": F.lit("now, then")}
    rest = {c: F.lit(None).cast("int") for c in writers.SUMMARY_HEADINGS if c not in cells}
    writers.write_summary(orders.select(F.col("o_orderpriority").alias("corpus"), *[c.alias(n) for n, c in (cells | rest).items()]), path)
    found = spark.read.csv(path, header=True, quote='"', escape='"', schema=", ".join(f"`{h}` string" for h in writers.SUMMARY_HEADINGS.values()))
    back = {h: n for n, h in writers.SUMMARY_HEADINGS.items()}
    return found.select(*[F.col(f"`{h}`").alias(n) for h, n in back.items()])


def s1_read_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as files, a folder for each corpus, and read back."""
    path, key = new_path(spark, "pages"), F.col("page_id")
    writers.export_chunks(table(spark, sf_dir, "pages").select(cat("c ", key % 3).alias("corpus"), cat(F.when(key % 4 == 0, "x").otherwise(""), key, ".html").alias("file"), F.coalesce("html", F.lit("")).alias("html")), path, "html")
    return readers.read_pages(spark, path).select("corpus", "file", "page_no", F.md5("html").alias("html_md5"))


def s1_compacted_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as files and compacted; then every fifth is written anew and some more are added, and the second run
    reads these alone."""
    path, key = new_path(spark, "pages"), F.col("page_id")
    some = table(spark, sf_dir, "pages").select("page_id", cat("c ", key % 3).alias("corpus"), cat(key, ".html").alias("file"), F.coalesce("html", F.lit("")).alias("html"))
    writers.export_chunks(some.where(key % 4 > 0), f"{path}/files", "html")
    first = compaction.compact_pages(spark, f"{path}/files", f"{path}/table")
    writers.export_chunks(some.where((key % 4 == 0) | (key % 5 == 0)).withColumn("html", cat("new ", F.col("html"))), f"{path}/files", "html", keep=True)
    second = compaction.compact_pages(spark, f"{path}/files", f"{path}/table")
    third = compaction.compact_pages(spark, f"{path}/files", f"{path}/table")
    found = compaction.read_compacted(spark, f"{path}/table")
    return found.select("corpus", "file", "page_no", F.md5("html").alias("html_md5"), F.lit(first).alias("first_run"), F.lit(second).alias("second_run"), F.lit(third).alias("third_run"))


def s6_read_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts exported as files and read back with their status; every ninth is blank."""
    path, key = new_path(spark, "texts"), F.col("page_id")
    text = F.when(key % 9 == 0, " \t").otherwise(F.coalesce("url", F.lit("")))
    writers.export_chunks(table(spark, sf_dir, "pages").select(cat("c", key % 5).alias("corpus"), cat(key, ".txt").alias("file"), text.alias("text")), path)
    return readers.read_chunks(spark, path)


def k1_write_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts written by corpus; a second run replaces two of the corpora."""
    path = new_path(spark, "chunks")
    docs = table(spark, sf_dir, "documents").select(F.col("lang").alias("corpus"), cat(F.col("doc_id"), ".txt").alias("file"), "text")
    writers.write_chunks(docs, path)
    writers.write_chunks(docs.where("corpus in ('de', 'fr') and text is not null").select("corpus", "file", cat("new ", F.col("text")).alias("text")), path)
    return spark.read.schema("file string, text string, corpus string").parquet(path).select("corpus", "file", F.md5("text").alias("text_md5"))


def k2_s2_para_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map rows appended in two runs and read back: the second run's rows count, and stand where the first one's stood."""
    path = new_path(spark, "map")
    orders = table(spark, sf_dir, "orders")
    rows = orders.select(F.col("o_orderpriority").alias("corpus"), cat(F.col("o_orderkey"), ".html").alias("html"), F.col("o_orderkey").alias("pos"), F.col("o_custkey").cast("int").alias("para_start"), (F.col("o_custkey") + 3).cast("int").alias("para_end"))
    writers.write_para_map(rows, path)
    writers.write_para_map(rows.where("pos % 3 = 0").withColumn("para_end", F.lit(-1)), path)
    return readers.read_para_map(spark, path, files="*.json")


def k2_committed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map rows of two runs. The second one fails once, half written, and comes again, and both are asked for once more:
    only what was committed counts, and once."""
    path = new_path(spark, "map")
    orders = table(spark, sf_dir, "orders")
    rows = orders.select(F.col("o_orderpriority").alias("corpus"), cat(F.col("o_orderkey"), ".html").alias("html"), F.col("o_orderkey").alias("pos"), F.col("o_custkey").cast("int").alias("para_start"), (F.col("o_custkey") + 3).cast("int").alias("para_end"))
    second = rows.where("pos % 3 = 0").withColumn("para_end", F.lit(-1))
    writers.write_run(rows, path, "first")
    writers.write_para_map_rows(second.where("pos % 2 = 0").withColumn("para_end", F.lit(-9)), f"{path}/run=second", "html", "overwrite")  # no commit
    for name, own in (("second", second), ("first", rows), ("second", second)):
        writers.write_run(own, path, name)
    return readers.read_runs(spark, path)


def s4_read_source_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both source tables written as Parquet, with a column more, and read back: sentences with their paragraph's text."""
    path, rows = new_path(spark, "source"), store(lines(spark, sf_dir), "lines")
    book = F.col("o").cast("int").alias("book")
    rows.groupBy(book, F.lit(1).alias("paragraph")).agg(F.max("flag").alias("text"), F.count(F.lit(1)).alias("more")).write.parquet(f"{path}/pali_texts")
    rows.select((F.col("o") * 8 + F.col("n")).alias("id"), book, F.lit(1).alias("paragraph"), F.col("n").alias("word_begin"), F.col("q").alias("word_end"), F.col("flag").alias("text")).write.parquet(f"{path}/pali_sentences")
    texts, sentences = readers.read_source_tables(spark, path)
    return sentences.join(texts.withColumnRenamed("text", "whole"), ["book", "paragraph"])


def s4_jdbc_source_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both source tables written to a database and read back in parts: sentences with their paragraph's text. Orders are
    paragraphs of one book, with a large gap, so that equal ranges of numbers would not be equal shares."""
    url, options = f"jdbc:derby:memory:bilinea_{uuid.uuid4().hex};create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    key = F.when(F.col("o") % 10 == 0, F.col("o") + 10_000_000).otherwise(F.col("o")).cast("int")
    rows = store(lines(spark, sf_dir).select(F.lit(1).alias("book"), key.alias("paragraph"), "o", "n", "q", "flag"), "lines")
    rows.groupBy("book", "paragraph").agg(F.max("flag").alias("text")).write.jdbc(url, "pali_texts", properties=options)
    rows.select((F.col("o") * 8 + F.col("n")).alias("id"), "book", "paragraph", F.col("n").alias("word_begin"), F.col("q").alias("word_end"), F.col("flag").alias("text")).write.jdbc(url, "pali_sentences", properties=options)
    texts, sentences = readers.read_source_tables(spark, url, options)
    return sentences.join(texts.withColumnRenamed("text", "whole"), ["book", "paragraph"])


def s7_k5_corpus_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A meta object for two corpora of three, written and read back; the third is known from the configuration alone."""
    path, key = new_path(spark, "meta"), F.col("n_nationkey")
    config = table(spark, sf_dir, "nation").select(F.col("n_name").alias("corpus"), F.lit("u").alias("url_template"), (key + 100).alias("book_id"), (key % 4).alias("n_digits"))
    writers.write_meta(summary.initial_meta(config.where("book_id % 3 <> 0"), 1, 99), path)
    return readers.read_corpus_meta(spark, path, config=config, files="*.json")


# Workloads


def bilingual_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as corpora: each line is a source paragraph, and a page holds two of them and a translation with an anchor."""
    page, rows = located(spark, sf_dir)
    name = cat(F.lpad(F.col("page_pos").cast("string"), 4, "0"), ".html")
    html = cat('<div id="center">T', F.col("book"), '.<a onmouseover="note(this,', F.col("page_pos"), ')">w</a> end</div><div id="east">', F.col("text"), "</div>")
    return page.select(cat("c", F.col("book")).alias("corpus"), name.alias("file"), html.alias("html"), "book"), rows


def w_annotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    some, _ = bilingual_pages(spark, sf_dir)
    some = store(some.select("corpus", "file", "html"), "bilingual-pages")  # read for segments and for notes
    words = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("pali_word")).where("id < 2")
    return workloads.annotate(some, words)


def w_locate(spark: SparkSession, sf_dir: str) -> DataFrame:
    some, rows = bilingual_pages(spark, sf_dir)
    meta = some.select("corpus", F.col("book").alias("book_id")).distinct()
    none = spark.createDataFrame([], "corpus string, html string, para_start int, para_end int")
    return workloads.locate(some, meta, rows, none).withColumn("corpus", F.substring("corpus", F.lit(2), F.lit(20)).cast("int"))


def w_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as chapters. A third has no reply; in another third the reply has a mark for the middle character of
    the first turn, which is put right."""
    rows = store(turns(spark, sf_dir).withColumn("text", F.concat(F.lit("t "), "text")), "turns")
    corpus, chapter = F.lit("c").alias("corpus"), F.col("conv_id").cast("string").alias("chapter")
    chapters = rows.select(corpus, chapter, F.col("conv_id").alias("pos"), F.col("conv_id").cast("int").alias("para_start"), F.col("conv_id").cast("int").alias("para_end")).distinct()
    sentences = rows.select(F.col("conv_id").alias("id"), F.lit(1).alias("book"), F.col("conv_id").cast("int").alias("paragraph"), F.col("seq").alias("word_begin"), F.col("seq").alias("word_end"), F.col("role").alias("text"))
    said = F.when((F.col("conv_id") % 3 == 1) & (F.col("seq") == 1), altered(without_spaces(F.col("text")))).otherwise(F.col("text"))
    reply = cat(F.to_json(F.struct("seq", said.alias("chinese"))), "\n")
    event = cat("data: ", F.to_json(F.struct(F.array(F.struct(F.struct(reply.alias("content")).alias("delta"))).alias("choices"))))
    stream = rows.where("conv_id % 3 <> 0").select(corpus, chapter, F.col("seq").alias("line_no"), event.alias("line"))
    meta = spark.createDataFrame([("c", 1, 0, 0)], "corpus string, book_id int, para_start int, para_end int")
    text = chunks(rows).select(corpus, chapter, "text")
    done = workloads.align(chapters, text, sentences, stream, meta, "m", F.lit("now"))
    figures = done.metrics.select("chapter", "sentences", "nulls", "chars", "hunks", "hunks_left")
    return done.status.select("chapter", "status").join(figures, "chapter", "left")


QUERIES: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    a1_trailing_char_profile, a1_profile_totals, a3_aligned_text, a4_build_prompts, a5_chapter_metrics, a6_cursor_start, a7_backfill_meta, a8_glossary_totals,
    chapter_states, f1_match_pages, f1_source_books, f2_diff_hunks, f3_diff_log, f4_f5_correct, f6_proportional_split, j3_chapter_sentences, j5_a6_f1_resumed_stream, j5_pending_pages, j6_missing_sources, j7_verify_heads, j8_merge_summary,
    k1_write_chunks, k2_committed_runs, k2_para_map_round_trip, k2_s2_para_map, k3_aligned_round_trip, k4_s3_glossary_round_trip, k5_summary_round_trip, p1_url_manifest, p2_page_number_filter, p3_ordinal_filter, p4_extract_section, p5_j1_j2_a2_annotate, p6_local_notes, p7_p8_normalize, p9_p10_glossary, p11_glossary_failures,
    p12_retarget, p13_reply_stream, p13_reply_usage, p14_j4_fill_slots, p15_record_ids, r1_alignment_report, r2_glossary_report, s1_compacted_pages, s1_read_pages, s2_last_wins, s4_jdbc_source_tables, s4_read_source_tables, s5_read_aligned, s6_read_chunks, s7_k5_corpus_meta, w_align, w_annotate, w_locate,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}

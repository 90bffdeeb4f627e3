"""Recorded model replies: prompts that they answer, the stream's content, its lines, and the slots that these fill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bilinea.functions.ranks import running
from bilinea.functions.storage import store
from bilinea.functions.text import is_blank, ordered_join, record_id, strip

#: The headings of the two parts of a prompt.
SOURCE_HEADING, TEXT_HEADING = "【巴利文句子列表】", "【汉文译文】"
#: A stream line's prefix, and what ends the stream.
PREFIX, DONE = "data:", "[DONE]"

#: Paragraphs of a bin in which ranges and sentences meet.
BIN = 256

EVENT = "struct<usage: map<string, string>, choices: array<struct<delta: struct<content: string>>>>"


def chapter_sentences(chapters: DataFrame, sentences: DataFrame, keys: list[str] = ("corpus", "chapter"), width: int = BIN) -> DataFrame:
    """keys, seq and the sentence's columns: the sentences of each chapter's closed range of paragraphs, numbered from 1
    by paragraph and first word. chapters: keys, none twice, book_id, para_start, para_end; ranges may overlap.

    A range join by bins of paragraphs: a range is cut at the borders of bins, so it is a row for each bin and not for
    each paragraph, and pieces meet sentences by book and bin. Sentences are moved once, by book and bin: a sentence's
    place in its book is its place in its bin and the sentences of all bins before; a chapter's first place is found from
    counts by paragraph and by bin. No task holds a chapter or a book.
    """
    keys = list(keys)
    bin_of = lambda c: F.floor(F.col(c) / width).alias("bin")
    counts = sentences.groupBy("book", "paragraph").agg(F.count(F.lit(1)).alias("n")).select("book", bin_of("paragraph"), "paragraph", "n")
    bins = store(running(counts.groupBy("book", "bin").agg(F.sum("n").alias("n")), ["book", "bin"], {"n": "before"}), "sentence-bins").select("book", "bin", "before")
    earlier = Window.partitionBy("book", "bin").orderBy("paragraph").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(bins, ["book", "bin"]).select("book", "bin", "paragraph", (F.col("first") + F.col("before")).alias("first"))

    span = F.sequence(F.floor(F.col("para_start") / width), F.floor(F.col("para_end") / width))
    pieces = chapters.where(F.col("para_start") <= F.col("para_end")).select(*keys, F.col("book_id").alias("book"), "para_start", "para_end", F.explode(span).alias("bin"))
    whole = (F.col("bin") * width >= F.col("para_start")) & ((F.col("bin") + 1) * width - 1 <= F.col("para_end"))
    inside = F.col("paragraph").between(F.col("para_start"), F.col("para_end"))
    firsts = pieces.where(~whole).join(starts, ["book", "bin"]).where(inside).select(*keys, "first")
    firsts = firsts.unionByName(pieces.where(whole).join(bins, ["book", "bin"]).select(*keys, F.col("before").alias("first")))
    firsts = store(firsts.groupBy(*keys).agg(F.min("first").alias("_first")), "chapter-firsts")

    place = F.row_number().over(Window.partitionBy("book", "bin").orderBy("paragraph", "word_begin", "id"))
    placed = sentences.withColumn("bin", bin_of("paragraph")).withColumn("_place", place).join(bins, ["book", "bin"])
    out = pieces.join(firsts, keys).join(placed, ["book", "bin"]).where(inside)
    seq = (F.col("before") + F.col("_place") - F.col("_first")).cast("int").alias("seq")
    return out.select(*keys, *sentences.columns, seq)


def build_prompts(sentences: DataFrame, chunks: DataFrame, keys: list[str] = ("corpus", "chapter")) -> DataFrame:
    """keys, prompt: the numbered source lines of each chapter and its stripped text. Chapters without either are left out."""
    lines = sentences.groupBy(*keys).agg(ordered_join(F.col("seq"), F.concat(F.col("seq").cast("string"), F.lit(". "), F.coalesce("text", F.lit(""))), "\n").alias("lines"))
    prompt = F.concat(F.lit(SOURCE_HEADING + "\n"), "lines", F.lit("\n\n" + TEXT_HEADING + "\n"), strip(F.col("text")))
    return lines.join(chunks.where(~is_blank(F.col("text"))).select(*keys, "text"), list(keys)).select(*keys, prompt.alias("prompt"))


def stream_events(stream: DataFrame, keys: list[str] = ("corpus", "chapter")) -> DataFrame:
    """keys, line_no, event: the events of each recorded stream (keys, line_no, line) before its end mark. Lines without
    the prefix and bodies that are no JSON objects are passed over."""
    body = F.when(F.col("line").startswith(PREFIX), strip(F.substring(F.col("line"), F.lit(len(PREFIX) + 1), F.length("line"))))
    rows = stream.select(*keys, "line_no", body.alias("body"))
    end = F.min(F.when(F.col("body") == DONE, F.col("line_no"))).over(Window.partitionBy(*keys))
    rows = rows.withColumn("_end", end).where(F.col("body").isNotNull() & (F.col("_end").isNull() | (F.col("line_no") < F.col("_end"))))
    rows = rows.where(F.try_parse_json("body").isNotNull() & F.col("body").startswith("{"))
    return rows.select(*keys, "line_no", F.from_json("body", EVENT).alias("event"))


def stream_lines(events: DataFrame, keys: list[str] = ("corpus", "chapter")) -> DataFrame:
    """keys, line_no, line: the content of the events in order, cut into lines; blank ones are left out."""
    content = F.get("event.choices", F.lit(0))["delta"]["content"]
    text = events.groupBy(*keys).agg(ordered_join(F.col("line_no"), content).alias("text"))
    lines = text.select(*keys, F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.select(*keys, "line_no", strip(F.col("line")).alias("line")).where(F.col("line") != "")


def stream_usage(events: DataFrame, keys: list[str] = ("corpus", "chapter")) -> DataFrame:
    """keys, prompt_tokens, completion_tokens, total_tokens, extra: of the last event with a usage that is not empty."""
    known = ("prompt_tokens", "completion_tokens", "total_tokens")
    last = events.where(F.size("event.usage") > 0).groupBy(*keys).agg(F.max_by("event.usage", "line_no").alias("u"))
    counts = [F.coalesce(F.try_element_at("u", F.lit(k)).try_cast("int"), F.lit(0)).alias(k) for k in known]
    return last.select(*keys, *counts, F.map_filter("u", lambda k, v: ~k.isin(*known)).alias("extra"))


def parse_reply_line(line: Column) -> Column:
    """A struct of seq (null unless a JSON integer) and chinese, null where the line is no JSON object with a seq. A code
    fence at the start and back-ticks at both ends are taken off."""
    bare = strip(F.btrim(F.regexp_replace(line, "^```[a-z]*", ""), F.lit("`")))
    parsed = F.when(bare.startswith("{"), F.try_parse_json(bare))
    kind = F.schema_of_variant(F.try_variant_get(parsed, "$.seq", "variant"))
    whole = F.try_variant_get(parsed, "$.seq", "string").rlike("^-?[0-9]+$") & (kind == "BIGINT")
    seq = F.when(whole, F.try_variant_get(parsed, "$.seq", "long"))
    return F.when(kind.isNotNull(), F.struct(seq.alias("seq"), F.try_variant_get(parsed, "$.chinese", "string").alias("chinese")))


def fill_slots(sentences: DataFrame, lines: DataFrame, keys: list[str] = ("corpus", "chapter")) -> DataFrame:
    """keys, seq, id, original, content: each sentence with the text of the last reply line of its number, null if there
    is none. Lines of other numbers are dropped."""
    reply = lines.select(*keys, "line_no", parse_reply_line(F.col("line")).alias("r")).where("r.seq is not null")
    last = reply.groupBy(*keys, F.col("r.seq").alias("seq")).agg(F.max_by(F.struct("r.chinese"), "line_no").alias("last"))
    name = record_id(F.col("book"), F.col("paragraph"), F.col("word_begin"), F.col("word_end"))
    return sentences.join(last, [*keys, "seq"], "left").select(*keys, "seq", name.alias("id"), F.col("text").alias("original"), F.col("last.chinese").alias("content"))


def aligned_text(records: DataFrame, keys: list[str] = ("corpus", "chapter")) -> DataFrame:
    """keys, text: each chapter's contents joined in order, the null and empty ones left out."""
    return records.groupBy(*keys).agg(ordered_join(F.col("seq"), F.col("content")).alias("text"))

"""The three workloads end to end: annotate pages, locate them in the source text, align chapters with its sentences."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bilinea.functions.storage import store
from bilinea.operators import diff, pages, paragraphs, replies, reports, summary

KEYS = ["corpus", "chapter"]
#: The ids of a page's two sections.
TRANSLATION, SOURCE = "center", "east"


def annotate(some: DataFrame, glossary: DataFrame, strict: bool = False) -> DataFrame:
    """corpus, file (of the text), text, notes, locals: the translation of each page with its markers. some: pages;
    glossary: id, pali_word. Pages without a translation are left out."""
    shown = pages.resolve_glossary(pages.extract_segments(some, TRANSLATION, strict), glossary)
    texts = pages.assemble_text(pages.resolve_local_notes(shown, pages.extract_local_notes(some)))
    return texts.withColumn("file", F.regexp_replace("file", r"(?s)(?<=.)\.[^.]*$", "")).withColumn("file", F.concat("file", F.lit(".txt")))


def locate(some: DataFrame, meta: DataFrame, source: DataFrame, para_map: DataFrame, strict: bool = False) -> DataFrame:
    """corpus, html, para_start, para_end, status: map rows for the pages that para_map does not have yet, by name. Rows
    with another status than ok tell where a corpus stopped. some: pages; meta: corpus, book_id; source: book, paragraph,
    text; para_map: corpus, html, para_start, para_end."""
    books = meta.select("corpus", F.col("book_id").alias("book"))
    cursors = paragraphs.cursor_start(para_map.join(books, "corpus").select("book", "para_end"), source)
    texts = pages.extract_section(pages.pending_pages(some, para_map), SOURCE, strict).join(books, "corpus")
    # places are all the same: pages of a book go by their names
    told = texts.select("corpus", "book", F.col("file").alias("html"), F.lit(0).cast("long").alias("page_pos"), "text")
    found = paragraphs.match_pages_to_paragraphs(told, source, cursors)
    return found.select("corpus", "html", "para_start", "para_end", "status")


@dataclass
class Alignment:
    """status: why a chapter could not be aligned, not_compared, or ok; records: with corrected contents; metrics; reports; meta."""

    status: DataFrame
    records: DataFrame
    metrics: DataFrame
    reports: DataFrame
    meta: DataFrame


def align(chapters: DataFrame, chunks: DataFrame, sentences: DataFrame, stream: DataFrame, meta: DataFrame, model: str, now: Column, most_chars: int | None = None) -> Alignment:
    """chapters: corpus, chapter, pos, para_start, para_end; chunks: corpus, chapter, text; sentences: the source table;
    stream: corpus, chapter, line_no, line of the recorded replies; meta: of the corpora; now: a text for all reports.

    Every chapter goes its own way: one that fails has a status and no records. With most_chars, chapters of longer texts
    have records and the status not_compared. What several results need, the slots,
    both comparisons and the corrections, is stored in the shared folder, so that no text is compared twice.
    """
    books = meta.select("corpus", "book_id")
    own = replies.chapter_sentences(chapters.join(books, "corpus"), sentences)
    status = summary.chapter_status(chapters, chunks, own, stream)
    sound = status.where("status = 'ok'").select(*KEYS)
    events = replies.stream_events(stream)
    slots = store(replies.fill_slots(own.join(sound, KEYS, "left_semi"), replies.stream_lines(events)), "slots")
    before = store(diff.recheck(slots, chunks, most_chars=most_chars), "before")
    fixed = diff.auto_correct(slots, before)
    records = diff.corrected_records(slots, fixed)
    after = store(diff.recheck(records, chunks, most_chars=most_chars), "after")
    status = status.join(after.where("diff_status = 'too_long'").select(*KEYS, F.lit("not_compared").alias("_open")), KEYS, "left")
    status = status.select(*KEYS, F.coalesce("_open", "status").alias("status"))
    usage = replies.stream_usage(events)
    metrics = summary.chapter_metrics(records, chunks, usage, before, after)
    log = lambda df, name: df.select(*KEYS, "hunks", diff.diff_log(F.col("hunks"), F.col("orig_norm"), F.col("aligned_norm")).alias(name))
    told = metrics.drop("hunks", "hunks_left").join(log(before, "log"), KEYS).join(log(after, "log_left").drop("hunks"), KEYS).join(fixed.chapters.select(*KEYS, "fixed_log", "skipped_log"), KEYS)
    told = told.join(usage.select(*KEYS, "total_tokens", "extra"), KEYS, "left").na.fill(0, ["total_tokens"])
    told = told.withColumns({"file": F.col("chapter"), "generated_at": now, "model": F.lit(model)})
    done = records.join(chapters.select(*KEYS, "pos"), KEYS).select("corpus", "pos", "seq", "id")
    return Alignment(status, records, metrics, reports.alignment_report(told), summary.backfill_meta(meta, done))

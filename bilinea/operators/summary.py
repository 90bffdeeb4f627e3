"""Chapter and corpus figures, and the summary that grows run by run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bilinea.functions.ranks import ranked_within
from bilinea.functions.text import is_blank, split_record_id
from bilinea.operators.diff import n_hunks


def filter_by_ordinal(para_map: DataFrame, start: int | None = None, end: int | None = None, pos: str = "pos") -> DataFrame:
    """Map rows by their place in the map, from 1, not by page number; None and 0 leave a bound open. pos counts from 0."""
    out = para_map.where(F.col(pos) + 1 >= (start or 1))
    return out.where(F.col(pos) + 1 <= end) if end else out


def chapter_metrics(records: DataFrame, chunks: DataFrame, usage: DataFrame, before: DataFrame, after: DataFrame, keys: list[str] = ("corpus", "chapter")) -> DataFrame:
    """keys, sentences, nulls, chars, prompt_tokens, completion_tokens, hunks, hunks_left.

    nulls counts null contents only, chars the characters of the chunk as it is. before and after: keys, hunks. Chapters
    without a usage have 0 tokens. hunks and hunks_left are null where the texts were not compared, and 0 where before or
    after has no row.
    """
    slots = records.groupBy(*keys).agg(F.count(F.lit(1)).cast("int").alias("sentences"), F.count_if(F.col("content").isNull()).cast("int").alias("nulls"))
    count = lambda df, name: df.select(*keys, F.coalesce(n_hunks(F.col("hunks")), F.lit(-1)).alias(name))
    out = slots.join(chunks.select(*keys, F.length("text").alias("chars")), list(keys))
    out = out.join(usage.select(*keys, "prompt_tokens", "completion_tokens"), list(keys), "left")
    out = out.join(count(before, "hunks"), list(keys), "left").join(count(after, "hunks_left"), list(keys), "left")
    out = out.na.fill(0, ["prompt_tokens", "completion_tokens", "hunks", "hunks_left"])
    return out.withColumns({c: F.nullif(F.col(c), F.lit(-1)) for c in ("hunks", "hunks_left")})


def merge_summary(para_map: DataFrame, new: DataFrame, old: DataFrame, corpus: str = "corpus", name: str = "file") -> DataFrame:
    """The summary in the map's order, numbered from 1 in `no`: new figures, else old ones, else blanks. Old rows that
    the map does not have vanish. para_map: corpus, text, pos; new and old: corpus, file and the figures."""
    figures = [c for c in new.columns if c not in (corpus, name, "no")]
    rest = old.join(new.select(corpus, name), [corpus, name], "left_anti").select(corpus, name, *figures)
    known = new.select(corpus, name, *figures).unionByName(rest)
    rows = ranked_within(para_map.select(corpus, F.col("text").alias(name), "pos"), [corpus], ["pos", name], "no").withColumn("no", F.col("no") + 1)
    return rows.join(known, [corpus, name], "left").select(corpus, "no", name, *figures)


def initial_meta(config: DataFrame, start: int, end: int) -> DataFrame:
    """A corpus's meta row before anything is aligned: paragraphs 0 to 0."""
    return config.select("corpus", "book_id", F.lit(start).alias("chapter_start"), F.lit(end).alias("chapter_end"), "n_digits", F.lit(0).alias("para_start"), F.lit(0).alias("para_end"))


def backfill_meta(meta: DataFrame, records: DataFrame, corpus: str = "corpus") -> DataFrame:
    """meta with para_start of the first record of the first chapter done and para_end of the last record of the last
    one: by order, not by size. records: corpus, pos (the chapter's), seq, id. Corpora without records stay as they are."""
    done = records.select(corpus, F.struct("pos", "seq").alias("at"), split_record_id(F.col("id"))["paragraph"].alias("paragraph"))
    ends = done.groupBy(corpus).agg(F.min_by("paragraph", "at").alias("_first"), F.max_by("paragraph", "at").alias("_last"))
    out = meta.join(ends, corpus, "left").withColumns({"para_start": F.coalesce("_first", "para_start"), "para_end": F.coalesce("_last", "para_end")})
    return out.select(*meta.columns)


def chapter_status(chapters: DataFrame, chunks: DataFrame, sentences: DataFrame, lines: DataFrame, keys: list[str] = ("corpus", "chapter")) -> DataFrame:
    """keys, status: why a chapter cannot be aligned, or ok. A chapter that fails holds up no other."""
    has = lambda df, name: df.select(*keys).distinct().withColumn(name, F.lit(True))
    out = chapters.select(*keys).join(chunks.select(*keys, is_blank(F.col("text")).alias("_blank")), list(keys), "left")
    out = out.join(has(sentences, "_sentences"), list(keys), "left").join(has(lines, "_lines"), list(keys), "left")
    status = F.when(F.col("_blank").isNull(), "missing_file").when(F.col("_blank"), "blank_text").when(F.col("_sentences").isNull(), "no_sentences").when(F.col("_lines").isNull(), "no_reply").otherwise("ok")
    return out.select(*keys, status.alias("status"))

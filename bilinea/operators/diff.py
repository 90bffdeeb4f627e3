"""Where the aligned text departs from the original, what that looks like, and which small departures are put right."""

from __future__ import annotations

import difflib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bilinea.functions.ranks import running_within
from bilinea.functions.schemas import HUNK
from bilinea.functions.storage import store
from bilinea.functions.text import SPACE_CHARS, without_spaces
from bilinea.operators.replies import aligned_text

HUNKS = f"array<struct<{', '.join(f'{n}: {t}' for n, t in (x.split() for x in HUNK.split(', ')))}>>"
#: Characters of context on either side of a hunk, and the length from which a replacement is left to people; fixed values.
CONTEXT, COMPLEX = 20, 4
#: Characters of a bin in which records and hunks meet.
WIDTH = 4_096
#: Pairs of characters up to which the standard library looks for the longest common stretch.
SMALL = 2_048
#: An odd factor of the hash of a stretch, and its inverse modulo 2^64.
FACTOR = 0x9E3779B97F4A7C15
INVERSE = pow(FACTOR, -1, 1 << 64)


class Windows:
    """Hashes of all stretches of a text by their length: equal stretches have equal hashes."""

    def __init__(self, text: str) -> None:
        self.codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        powers = lambda factor: np.cumprod(np.array([1] + [factor] * len(text), np.uint64))
        self.back = powers(INVERSE)
        terms = (self.codes.astype(np.uint64) + np.uint64(1)) * np.uint64(FACTOR) * powers(FACTOR)[: len(text)]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])

    def of(self, low: int, high: int, size: int) -> np.ndarray:
        """The hash of each stretch of that size between low and high, by its start."""
        return (self.sums[low + size : high + 1] - self.sums[low : high + 1 - size]) * self.back[low : high + 1 - size]


class Collision(Exception):
    """Two stretches differ under one hash."""


def longest_match(a: str, b: str, x: Windows, y: Windows, alo: int, ahi: int, blo: int, bhi: int) -> tuple[int, int, int]:
    """(i, j, size) of the longest stretch that a[alo:ahi] and b[blo:bhi] share; of several the first one in a, and of its
    places in b the first: what the standard library's matcher finds without junk, in time of about a text's length."""
    most = min(ahi - alo, bhi - blo)

    def first(size: int) -> tuple[int, int, int] | None:
        mine, other = x.of(alo, ahi, size), y.of(blo, bhi, size)
        shared = np.flatnonzero(np.isin(mine, other))
        if not len(shared):
            return None
        i, j = alo + int(shared[0]), blo + int(np.argmax(other == mine[shared[0]]))
        if a[i : i + size] != b[j : j + size]:
            raise Collision
        return i, j, size

    # mostly the longest one is what both begin or end with, and nothing is longer
    ahead = x.codes[alo : alo + most] != y.codes[blo : blo + most]
    ends = x.codes[ahi - most : ahi][::-1] != y.codes[bhi - most : bhi][::-1]
    low = max(int(np.argmax(d)) if d.any() else most for d in (ahead, ends))
    best, high, step = None, most, 1
    while low < high:  # low is there, nothing above high is: steps that double, then halves
        size = min(low + step, high)
        found = first(size)
        if found is None:
            high = size - 1
            break
        best, low, step = found, size, step * 2
    while low < high:
        size = (low + high + 1) // 2
        found = first(size)
        best, low, high = (found, size, high) if found else (best, low, size - 1)
    return (best if best and best[2] == low else first(low)) if low else (alo, blo, 0)


def matching_blocks(a: str, b: str) -> list[tuple[int, int, int]]:
    """(i, j, size) of the equal stretches in order: the longest one, and so on before and behind it."""
    x, y = Windows(a), Windows(b)
    found, open_ = [], [(0, len(a), 0, len(b))]
    while open_:
        alo, ahi, blo, bhi = open_.pop()
        if (ahi - alo) * (bhi - blo) <= SMALL:
            i, j, size = difflib.SequenceMatcher(None, a[alo:ahi], b[blo:bhi], autojunk=False).find_longest_match()
            i, j = i + alo, j + blo
        else:
            i, j, size = longest_match(a, b, x, y, alo, ahi, blo, bhi)
        if size:
            found.append((i, j, size))
            open_ += [part for part in ((alo, i, blo, j), (i + size, ahi, j + size, bhi)) if part[0] < part[1] and part[2] < part[3]]
    return sorted(found)


def hunks_of(original: str, aligned: str) -> list[dict]:
    """The unequal stretches of a longest-matching-block comparison in which no character counts as junk."""
    try:
        blocks = matching_blocks(original, aligned)
    except Collision:
        blocks = difflib.SequenceMatcher(None, original, aligned, autojunk=False).get_matching_blocks()
    hunks, a, c = [], 0, 0
    for b, d, size in [*blocks, (len(original), len(aligned), 0)]:
        if a < b or c < d:
            tag = "replace" if a < b and c < d else "delete" if a < b else "insert"
            hunks.append({"tag": tag, "orig_start": a, "orig_end": b, "aligned_start": c, "aligned_end": d, "orig_chunk": original[a:b], "aligned_chunk": aligned[c:d]})
        a, c = b + size, d + size
    return hunks


def compared(original: pd.Series, aligned: pd.Series) -> pd.Series:
    return pd.Series([None if a is None else hunks_of(a, b) for a, b in zip(original, aligned)])


def diff_hunks(texts: DataFrame, original: str = "original", aligned: str = "aligned", most_chars: int | None = None) -> DataFrame:
    """texts with orig_norm and aligned_norm (without white space; a null text is empty), hunks in their offsets, and
    diff_status: equal (hunks empty), differs, or too_long (hunks null).

    Only texts that differ go to the helper. All texts are compared, however long, unless most_chars is given: the time
    grows with a text's length and its number of hunks, and one pair is one task's work. Longer pairs then are too_long:
    nothing is known of them, and figures and reports made from them say so.
    """
    norm = lambda c: without_spaces(F.coalesce(F.col(c), F.lit("")))
    out = texts.withColumns({"orig_norm": norm(original), "aligned_norm": norm(aligned)})
    long = F.lit(False) if most_chars is None else F.greatest(F.length("orig_norm"), F.length("aligned_norm")) > most_chars
    status = F.when(F.col("orig_norm") == F.col("aligned_norm"), "equal").when(long, "too_long").otherwise("differs")
    # small tables can still be much work: no fewer tasks than shuffle partitions
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = out.withColumn("diff_status", status).repartition(tasks, F.xxhash64("orig_norm", "aligned_norm"))
    needed = lambda c: F.when(F.col("diff_status") == "differs", F.col(c))
    found = F.pandas_udf(compared, HUNKS)(needed("orig_norm"), needed("aligned_norm"))
    return out.withColumn("hunks", F.coalesce(found, F.when(F.col("diff_status") == "equal", F.array().cast(HUNKS))))


def n_hunks(hunks: Column) -> Column:
    """How many there are; null where the texts were not compared."""
    return F.when(hunks.isNotNull(), F.size(hunks))


def shown_char(ch: Column) -> Column:
    """A character in quotes as Python's repr shows it; ch must not be white space."""
    code = F.ascii(ch)
    escaped = F.when(code < 256, F.format_string("'\\x%02x'", code)).when(code < 65536, F.format_string("'\\u%04x'", code)).otherwise(F.format_string("'\\U%08x'", code))
    return F.when(ch == "'", "\"'\"").when(ch == "\\", "'\\\\'").when(ch.rlike(r"^[\p{C}\p{Z}]$"), escaped).otherwise(F.concat(F.lit("'"), ch, F.lit("'")))


def diff_log(hunks: Column, orig_norm: Column, aligned_norm: Column) -> Column:
    """The report's lines on all hunks: a header, what was removed and added, both contexts, the first character that
    differs. The wording is fixed by the report format. Null where the texts were not compared."""

    def context(text: Column, start: Column, end: Column, chunk: Column, name: str) -> Column:
        low = F.greatest(F.lit(0), start - CONTEXT)
        before = F.substring(text, low + 1, start - low)
        return F.concat(F.lit(f"  {name}上下文: ..."), before, F.lit("["), chunk, F.lit("]"), F.substring(text, end + 1, F.lit(CONTEXT)), F.lit("..."))

    def first_difference(h: Column) -> Column:
        a, b = h["orig_chunk"], h["aligned_chunk"]
        n = F.least(F.length(a), F.length(b))
        at = F.get(F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.substring(a, i + 1, F.lit(1)) != F.substring(b, i + 1, F.lit(1))), F.lit(0))
        x, y = (F.substring(c, at + 1, F.lit(1)) for c in (a, b))
        side = lambda c: F.concat(F.format_string("U+%04X", F.ascii(c)), F.lit("("), shown_char(c), F.lit(")"))
        return F.when(n > 0, F.concat(F.lit("  ℹ️ 首个不同字符位置 "), at.cast("string"), F.lit(": 原文 "), side(x), F.lit(" vs 对齐 "), side(y)))

    def lines(h: Column) -> Column:
        ticked = lambda head, c: F.concat(F.lit(head), F.lit("`"), c, F.lit("`"))
        header = F.format_string("@@ 原文[%d:%d] 对齐[%d:%d] tag=%s", h["orig_start"], h["orig_end"], h["aligned_start"], h["aligned_end"], h["tag"])
        removed = F.when(h["tag"] == "replace", ticked("- 原文: ", h["orig_chunk"])).when(h["tag"] == "delete", ticked("- 原文多出: ", h["orig_chunk"]))
        added = F.when(h["tag"] == "replace", ticked("+ 对齐: ", h["aligned_chunk"])).when(h["tag"] == "insert", ticked("+ 对齐多出: ", h["aligned_chunk"]))
        around = [context(orig_norm, h["orig_start"], h["orig_end"], h["orig_chunk"], "原文"), context(aligned_norm, h["aligned_start"], h["aligned_end"], h["aligned_chunk"], "对齐")]
        return F.array_compact(F.array(header, removed, added, *around, first_difference(h)))

    return F.flatten(F.transform(hunks, lines))


def is_fixable(h: Column) -> Column:
    return (h["tag"] == "replace") & (F.length(h["orig_chunk"]) < COMPLEX) & (F.length(h["aligned_chunk"]) < COMPLEX)


def patched(index: int, content: str, start: int, hunks: list[dict]) -> tuple[str, list[str], int]:
    """A record's content with each hunk's original characters in place of the aligned ones, a log line for each, and how
    many were applied.

    index: the record's place in its chapter; start: the chapter's white-space-free characters before it; hunks: those that
    start within it, in order. A hunk's characters are looked up in the record as it is by then: after a correction that
    changed the length, later ones can miss; they are skipped if a character is not what it should be.
    """
    log, applied = [], 0
    for h in hunks:
        wrong, right = h["aligned_chunk"], h["orig_chunk"]
        visible = [k for k, ch in enumerate(content) if ch not in SPACE_CHARS]
        offset = h["aligned_start"] - start
        places = visible[offset : offset + len(wrong)]
        if len(places) < len(wrong):
            log.append(f"  record[{index}]: 归一化偏移越界，跳过")
            continue
        missed = next(((k, ch) for k, ch in zip(places, wrong) if content[k] != ch), None)
        if missed:
            log.append(f"  record[{index}]: 位置 {missed[0]} 预期 `{missed[1]}` 实际 `{content[missed[0]]}`，整处跳过")
            continue
        gone = set(places)
        content = content[: places[0]] + right + "".join(ch for k, ch in enumerate(content[places[0] :], places[0]) if k not in gone)
        log.append(f"  record[{index}] 位置 {places}: `{wrong}` → `{right}`")
        applied += 1
    return content, log, applied


def owned_hunks(records: DataFrame, hunks: DataFrame, keys: list[str], width: int = WIDTH) -> DataFrame:
    """keys, seq, index, start, hunk: the record in whose range of white-space-free characters each hunk starts. records:
    keys, seq, content; hunks: keys, hunk.

    Where records start is a running sum over their lengths, counted by ranges of records. Records and hunks meet by
    chapter and bin of characters, so neither is gathered by chapter.
    """
    size = F.length(without_spaces(F.coalesce("content", F.lit("")))).cast("long")
    sized = records.select(*keys, "seq", size.alias("size"), F.lit(1).cast("long").alias("one"))
    placed = running_within(sized, list(keys), ["seq"], {"size": "start", "one": "index"}).where("size > 0")
    span = F.sequence(F.floor(F.col("start") / width), F.floor((F.col("start") + F.col("size") - 1) / width))
    pieces = placed.select(*keys, "seq", "index", "start", "size", F.explode(span).alias("bin"))
    at = F.col("hunk.aligned_start")
    met = hunks.withColumn("bin", F.floor(at / width)).join(pieces, [*keys, "bin"])
    return met.where((at >= F.col("start")) & (at < F.col("start") + F.col("size"))).select(*keys, "seq", "index", "start", "hunk")


@dataclass
class Corrections:
    """chapters: keys, fixed_log, skipped_log, n_fixable, n_applied; records: keys, seq, content of those changed or tried."""

    chapters: DataFrame
    records: DataFrame


def auto_correct(records: DataFrame, diffs: DataFrame, keys: list[str] = ("corpus", "chapter"), width: int = WIDTH) -> Corrections:
    """Small replacements put right.

    records: keys, seq, content. diffs: keys, hunks. fixed_log opens with the number of hunks that are fixable, which is not
    the number applied, and has a line for each that belongs to a record; skipped_log lists the others. A chapter whose
    texts were not compared is left as it is. Only records that a fixable hunk starts in go to the helper, each by itself;
    what is gathered by chapter are the lines of its log.
    """
    keys = list(keys)
    known = diffs.select(*keys, F.coalesce("hunks", F.array().cast(HUNKS)).alias("hunks"))
    fixable = known.select(*keys, F.explode(F.filter("hunks", is_fixable)).alias("hunk"))
    owned = owned_hunks(records, fixable, keys, width).groupBy(*keys, "seq", "index", "start").agg(F.array_sort(F.collect_list(F.struct(F.col("hunk.aligned_start").alias("at"), "hunk"))).alias("own"))
    given = owned.join(records.select(*keys, "seq", "content"), [*keys, "seq"]).select(*keys, "seq", "index", "content", "start", F.transform("own", lambda x: x["hunk"]).alias("hunks"))
    fields = ", ".join(f"`{k}` {given.schema[k].dataType.simpleString()}" for k in [*keys, "seq"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [patched(i, c, s, list(h)) for i, c, s, h in zip(batch["index"], batch["content"], batch["start"], batch["hunks"])]
            at = [[h["aligned_start"] for h in own] for own in batch["hunks"]]
            yield batch[[*keys, "seq"]].assign(content=[d[0] for d in done], at=at, log=[d[1] for d in done], applied=[d[2] for d in done])

    changed = store(given.mapInPandas(run, f"{fields}, content string, at array<int>, log array<string>, applied int"), "corrected")
    lines = F.array_sort(F.flatten(F.collect_list(F.arrays_zip("at", "log")))).alias("lines")
    told = changed.groupBy(*keys).agg(lines, F.sum("applied").cast("int").alias("n_applied"))
    skipped = F.filter("hunks", lambda h: ~is_fixable(h))
    shown = F.transform(skipped, lambda h: F.format_string("  tag=%s 对齐[%d:%d] 原文片段=`%s` 对齐片段=`%s`", h["tag"], h["aligned_start"], h["aligned_end"], h["orig_chunk"], h["aligned_chunk"]))
    chapters = records.select(*keys).distinct().join(known, keys, "left").withColumn("hunks", F.coalesce("hunks", F.array().cast(HUNKS)))
    n = F.size(F.filter("hunks", is_fixable))
    chapters = chapters.select(*keys, n.alias("n_fixable"), F.concat(F.array(F.format_string("跳过 %d 处复杂差异（需人工检查）：", F.size(skipped))), shown).alias("skipped_log")).join(told, keys, "left")
    log = F.concat(F.array(F.format_string("自动修正 %d 处差异：", F.col("n_fixable"))), F.coalesce(F.transform("lines", lambda x: x["log"]), F.array().cast("array<string>")))
    chapters = chapters.select(*keys, log.alias("fixed_log"), "skipped_log", "n_fixable", F.coalesce("n_applied", F.lit(0)).alias("n_applied"))
    return Corrections(chapters, changed.select(*keys, "seq", "content"))


def corrected_records(records: DataFrame, corrections: Corrections, keys: list[str] = ("corpus", "chapter")) -> DataFrame:
    """records with the corrected contents; those that no hunk starts in stay as they are, null ones too."""
    new = corrections.records.select(*keys, "seq", F.struct(F.col("content").alias("text")).alias("_new"))
    content = F.when(F.col("_new").isNotNull(), F.col("_new.text")).otherwise(F.col("content")).alias("content")
    return records.join(new, [*keys, "seq"], "left").select(*[content if c == "content" else F.col(c) for c in records.columns])


def recheck(records: DataFrame, chunks: DataFrame, keys: list[str] = ("corpus", "chapter"), most_chars: int | None = None) -> DataFrame:
    """keys, hunks_left (null where the texts were not compared) and what diff_hunks adds, for the records as they are
    now."""
    texts = chunks.select(*keys, F.col("text").alias("original")).join(aligned_text(records, keys).withColumnRenamed("text", "aligned"), list(keys))
    return diff_hunks(texts, most_chars=most_chars).withColumn("hunks_left", n_hunks(F.col("hunks")))

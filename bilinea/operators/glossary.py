"""The glossary: entries out of note pages, their fields, what is missing in them, and totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bilinea.functions.text import SPACE_CLASS, strip

#: How a note names its word and meanings, tried in this order. (?d) keeps \n the only line end that a dot
#: does not match.
GAP, SOME = f"[{SPACE_CLASS}]*", f"[{SPACE_CLASS}]+"
LETTER = "[a-zA-ZāīūṃṅñṭḍḷṇśṣḥĀĪŪṂṄÑṬḌḶṆŚṢḤ]"
SOUTHERN = "(?d)南傳作「([^」]+)」" + GAP + "\\(([^，,）)]+)[，,](?:.*?另譯為「([^」]+)」)?"
ALSO = "(?d)「([^」]+)」" + GAP + "\\((" + LETTER + "[^，,)]*)[，,]" + GAP + "另譯為「([^」]+)」\\)"
PLAIN = "(?d)「([^」]+)」" + GAP + "\\((" + LETTER + "[^\\)]*)\\)"
#: A note's element, on one line.
NOTE = "(?id)<div" + SOME + "id=[\"']?div([0-9]+)[\"']?" + GAP + ">(.*?)</div>"
#: Characters of a note that a failure shows.
SHOWN = 120


def parse_note_divs(pages: DataFrame, source: str = "source") -> DataFrame:
    """id, note, source, pos: the text of each note element without tags, stripped."""
    found = F.arrays_zip(F.regexp_extract_all("html", F.lit(NOTE), F.lit(1)).alias("n"), F.regexp_extract_all("html", F.lit(NOTE), F.lit(2)).alias("t"))
    rows = pages.select(F.col(source).alias("source"), F.posexplode(found).alias("pos", "d"))
    return rows.select(F.col("d.n").cast("int").alias("id"), strip(F.regexp_replace(strip(F.col("d.t")), "<[^>]+>", "")).alias("note"), "source", "pos")


def glossary_fields(note: Column) -> Column:
    """A struct of pali_word (in lower case), meaning and meaning2 by the first pattern that the note has; all null if it
    has none, and null for what is blank."""
    group = lambda pattern, i: F.nullif(strip(F.regexp_extract(note, pattern, i)), F.lit(""))
    fields = lambda p, second: F.struct(F.lower(group(p, 2)).alias("pali_word"), group(p, 1).alias("meaning"), (group(p, 3) if second else F.lit(None).cast("string")).alias("meaning2"))
    nothing = F.struct(*[F.lit(None).cast("string").alias(c) for c in ("pali_word", "meaning", "meaning2")])
    return F.when(note.rlike(SOUTHERN), fields(SOUTHERN, True)).when(note.rlike(ALSO), fields(ALSO, True)).when(note.rlike(PLAIN), fields(PLAIN, False)).otherwise(nothing)


def extract_glossary(pages: DataFrame, source: str = "source") -> DataFrame:
    """id, pali_word, meaning, meaning2, note, source, pos of every note in the pages."""
    notes = parse_note_divs(pages, source).withColumn("_f", glossary_fields(F.col("note")))
    return notes.select("id", "_f.pali_word", "_f.meaning", "_f.meaning2", "note", "source", "pos")


def glossary_failures(glossary: DataFrame) -> DataFrame:
    """source, id, missing, note, pos: entries without a word or a meaning, and the start of their note."""
    lack = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in ("pali_word", "meaning")]))
    return glossary.select("source", "id", lack.alias("missing"), F.substring("note", 1, SHOWN).alias("note"), "pos").where(F.size("missing") > 0)


def glossary_totals(glossary: DataFrame) -> DataFrame:
    """source, entries, failures for each note page, and for all of them under a null source."""
    failed = F.count_if(F.col("pali_word").isNull() | F.col("meaning").isNull())
    each = glossary.groupBy("source").agg(F.count(F.lit(1)).alias("entries"), failed.alias("failures"))
    return each.unionByName(each.agg(F.coalesce(F.sum("entries"), F.lit(0)).alias("entries"), F.coalesce(F.sum("failures"), F.lit(0)).alias("failures")).select(F.lit(None).cast("string").alias("source"), "entries", "failures"))


def in_order(glossary: DataFrame) -> DataFrame:
    """Entries by id, those of equal id as they stand in the pages."""
    return glossary.orderBy("id", "source", "pos")

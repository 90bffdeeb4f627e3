"""What the aligned records' texts end in."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bilinea.functions.text import rstrip

#: Stands for a text without a visible character; a fixed value of the reports.
EMPTY = "(空)"


def trailing_char_profile(aligned: DataFrame, group: str = "corpus", content: str = "content", order: list[str] = ("file", "line")) -> DataFrame:
    """group, ch, n, pct, total, rank: how often the right-stripped content ends in each character.

    Null and blank contents count under EMPTY. pct is the share of all rows of the group, in percent; rank goes by n,
    larger first, and ties by which character the order columns show first. Rows are summed before they are shuffled, so
    a character that ends most texts is no burden.
    """
    last = F.right(rstrip(F.col(content)), F.lit(1))
    ch = F.when(F.coalesce(last, F.lit("")) == "", EMPTY).otherwise(last)
    seen = aligned.select(group, ch.alias("ch"), F.struct(*order).alias("place"))
    counts = seen.groupBy(group, "ch").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    whole = Window.partitionBy(group)
    by_count = whole.orderBy(F.desc("n"), "first")
    total = F.sum("n").over(whole)
    return counts.select(group, "ch", "n", (F.col("n") * 100.0 / total).alias("pct"), total.alias("total"), F.row_number().over(by_count).alias("rank"))


def profile_totals(aligned: DataFrame, bad_lines: DataFrame, group: str = "corpus", content: str = "content") -> DataFrame:
    """group, files, total, bad, distinct_chars: the profile's summary line; groups with bad lines only are listed too."""
    last = F.right(rstrip(F.col(content)), F.lit(1))
    ch = F.when(F.coalesce(last, F.lit("")) == "", EMPTY).otherwise(last)
    both = aligned.select(group, "file", ch.alias("ch"), F.lit(0).alias("bad")).unionByName(bad_lines.select(group, "file", F.lit(None).cast("string").alias("ch"), F.lit(1).alias("bad")))
    return both.groupBy(group).agg(F.countDistinct("file").alias("files"), F.count("ch").alias("total"), F.sum("bad").alias("bad"), F.countDistinct("ch").alias("distinct_chars"))

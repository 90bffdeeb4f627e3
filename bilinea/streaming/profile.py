"""The profile of trailing characters over a stream of aligned records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bilinea.functions.text import rstrip
from bilinea.operators.profile import EMPTY


def trailing_char_counts(records: DataFrame, group: str = "corpus", content: str = "content") -> DataFrame:
    """group, ch, n for a streaming DataFrame, to be written in complete or update mode. The state has a row for each
    group and character, so it needs no watermark; ranks and shares are taken from it by a batch query."""
    last = F.right(rstrip(F.col(content)), F.lit(1))
    ch = F.when(F.coalesce(last, F.lit("")) == "", EMPTY).otherwise(last)
    return records.select(group, ch.alias("ch")).groupBy(group, "ch").agg(F.count(F.lit(1)).alias("n"))

"""Places in an order, and numbers without gaps, counted part by part, so that no task sees more than its part."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bilinea.functions.storage import store

#: Bits of monotonically_increasing_id below a partition's number.
ROW_BITS = 33


def numbered(df: DataFrame, name: str) -> DataFrame:
    """df, stored, with a column of numbers from 0 without gaps, in the order of its partitions and of their rows.

    Partitions number their rows themselves. They are counted, and each is shifted by the rows before it; what meets in
    one task is a row for each partition.
    """
    part = F.shiftright("_at", ROW_BITS).alias("_part")
    placed = store(df.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    shifts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return placed.withColumn("_part", part).join(F.broadcast(shifts), "_part").withColumn(name, F.col("_before") + within).drop("_at", "_part", "_before")


def ranked(df: DataFrame, order: list[str], name: str, parts: int | None = None) -> DataFrame:
    """df, stored, with the 0-based place of each row in the given order. Rows are dealt by ranges of the order, so a
    value that many rows share is spread as far as the columns after it differ."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return numbered(df.repartitionByRange(parts, *order).sortWithinPartitions(*order), name)


def ranked_within(df: DataFrame, keys: list[str], order: list[str], name: str, parts: int | None = None) -> DataFrame:
    """df with the 0-based place of each row among those of its keys, in the given order. A key may hold any number of
    rows: places are counted over all rows, and a key's first is taken off."""
    all_ = ranked(df, [*keys, *order], "_place", parts)
    first = all_.groupBy(*keys).agg(F.min("_place").alias("_first"))
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    condition = same[0] if len(same) == 1 else same[0] & same[1]
    for more in same[2:]:
        condition &= more
    joined = all_.alias("l").join(first.alias("r"), condition)
    return joined.select(*[F.col(f"l.{c}") for c in df.columns], (F.col("_place") - F.col("_first")).alias(name))


def running(df: DataFrame, order: list[str], sums: dict[str, str], parts: int | None = None) -> DataFrame:
    """df, stored, with sums over all rows before each, in the given order: sums has the new column's name for each column
    that is summed. Ranges of the order are summed up by themselves, and each is shifted by the sums of those before."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = store(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "running")
    placed = placed.withColumn("_part", F.shiftright("_at", ROW_BITS))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_part").agg(*[F.sum(c).alias(f"_sum_{c}") for c in sums])
    shifts = totals.select("_part", *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_before_{c}") for c in sums])
    within = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    own = placed.withColumns({name: F.coalesce(F.sum(c).over(within), F.lit(0)) for c, name in sums.items()})
    out = own.join(F.broadcast(shifts), "_part").withColumns({name: F.col(name) + F.col(f"_before_{c}") for c, name in sums.items()})
    return out.select(*df.columns, *sums.values())


def running_within(df: DataFrame, keys: list[str], order: list[str], sums: dict[str, str], parts: int | None = None) -> DataFrame:
    """df with sums over the rows of the same keys before each. A key may hold any number of rows: sums run over all rows,
    and what stands before a key's first row is taken off. Values must not be negative, nor keys null."""
    all_ = running(df, [*keys, *order], sums, parts)
    firsts = all_.groupBy(*keys).agg(*[F.min(name).alias(f"_first_{name}") for name in sums.values()])
    out = all_.join(firsts, keys).withColumns({name: F.col(name) - F.col(f"_first_{name}") for name in sums.values()})
    return out.select(*df.columns, *sums.values())

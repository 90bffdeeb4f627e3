"""Mixing sources to target weights by a time-varying curriculum.

Each source gets a token target. Its schedule, a piecewise-linear weight over training time 0 to 1, says when those
tokens are due: the integral of the schedule up to t, scaled to the target, is the source's cumulative demand at t. A
document that starts u tokens into its source's stream trains at the time where that demand reaches u, which inverts a
quadratic in closed form. Sorting all documents by that time gives the training order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bilinea.llm.common import NOT_SPACE, driver_table, order_hash, ranked, store

#: More sources than this are refused: one row for each is sent to the driver and broadcast.
MAX_SOURCES = 100_000


@dataclass(frozen=True)
class Recipe:
    """weights: given to the sources in code-point order, null last, over and over. budget: tokens to take, as a share
    of all. most: how often a source, and so each of its documents, is taken at most. schedules: for each weight its
    knots (time, factor), straight between them, first at 0 and last at 1; factors are positive. Only the schedule's
    shape counts, the target fixes its integral.
    """

    weights: tuple[float, ...] = (5, 2, 1)
    budget: float = 1.5
    most: int = 2
    schedules: tuple[tuple[tuple[float, float], ...], ...] = (((0, 1.5), (1, 0.5)), ((0, 1), (1, 1)), ((0, 0.5), (0.5, 1), (1, 1.5)))


def targets(sizes: list[int], recipe: Recipe) -> list[float]:
    """Tokens to take of each source: the budget by weight, none above most times its size, the excess shared anew."""
    weights = [recipe.weights[i % len(recipe.weights)] for i in range(len(sizes))]
    caps = [float(recipe.most * s) for s in sizes]
    full: set[int] = set()
    while True:
        left = recipe.budget * sum(sizes) - sum(caps[i] for i in full)
        open_weight = sum(w for i, w in enumerate(weights) if i not in full)
        over = {i for i, w in enumerate(weights) if i not in full and left * w / open_weight > caps[i]}
        if not over:
            return [caps[i] if i in full else left * w / open_weight for i, w in enumerate(weights)]
        full |= over


def pieces(knots: tuple[tuple[float, float], ...], target: float) -> list[tuple[float, float, float, float]]:
    """(time, demand before, rate, change of rate) of each straight piece, for demands that add up to the target."""
    area = sum((t1 - t0) * (f0 + f1) / 2 for (t0, f0), (t1, f1) in zip(knots, knots[1:]))
    out, before = [], 0.0
    for (t0, f0), (t1, f1) in zip(knots, knots[1:]):
        out.append((float(t0), before, target * f0 / area, target * (f1 - f0) / (t1 - t0) / area))
        before += target * (t1 - t0) * (f0 + f1) / 2 / area
    return out


def due(tokens: Column, schedule: Column) -> Column:
    """The time at which the cumulative demand reaches tokens: in the last piece that starts at or below it, the root of
    rate * x + change * x * x / 2 = rest, in the form that does not cancel."""
    piece = F.element_at(F.filter(schedule, lambda p: p["before"] <= tokens), -1)
    rest = tokens - piece["before"]
    root = F.sqrt(F.greatest(F.lit(0.0), piece["rate"] * piece["rate"] + 2 * piece["change"] * rest))
    return F.least(F.lit(1.0), piece["time"] + F.when(rest > 0, 2 * rest / (piece["rate"] + root)).otherwise(0.0))


def plan(docs: DataFrame, recipe: Recipe = Recipe(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: list[Column] = ()) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, positions (a time for each copy), hashed,
    and what is asked to carry.

    size counts the words of the whole text, none for a null one. Documents of a source follow each other in the order
    of a hash of their id, the same in every run, and again from the start for each repeat; copy k is taken if its
    middle lies within the target, so a source misses its target by half a document at most. Null sources form one
    source. Nothing is taken of documents without words. Repeated rows are separate documents. An empty table gives no
    rows. Sizes are counted first, without what is carried; that moves only once.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = F.regexp_count(text, F.lit(NOT_SPACE + "+")).cast("long")
    slim = [F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"), F.crc32(text).alias("check")]
    # documents without an id are told apart by their text, or they would all be in one bucket of ranked
    slim.append(order_hash(F.coalesce(F.col(id_col).cast("string"), F.concat_ws(":", F.lit(""), size, F.crc32(text)))).alias("hashed"))
    rows = store(docs.select(*slim), "mix-rows")
    found = rows.groupBy("source").agg(F.sum("size").alias("total"), F.count(F.lit(1)).alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: group them before mixing")
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    kinds = recipe.schedules
    wanted = targets([r["total"] for r in found], recipe)
    table = [(i, r["source"], r["total"], t, pieces(kinds[i % len(kinds)], t)) for i, (r, t) in enumerate(zip(found, wanted))]
    sources = driver_table(spark, table, "number int, name string, source_size long, target double, schedule array<struct<time: double, before: double, rate: double, change: double>>")
    numbered = lambda df: df.join(F.broadcast(sources.select("number", "name")), F.col("source").eqNullSafe(F.col("name"))).drop("name")  # noqa: E731  at most MAX_SOURCES rows
    full = numbered(docs.select(*slim, *carry) if carry else rows)
    placed = ranked(full, "number", "hashed", ["doc_id", "size", "check"], max((r["n"] for r in found), default=0), "size", numbered(rows))
    placed = placed.join(F.broadcast(sources.drop("name")), "number")
    start = lambda k: F.col("before") + k * F.col("source_size")
    taken = F.filter(F.sequence(F.lit(0), F.lit(recipe.most - 1)), lambda k: (F.col("size") > 0) & (start(k) + F.col("size") / 2 <= F.col("target")))
    positions = F.transform(taken, lambda k: due(start(k).cast("double"), F.col("schedule")))
    names = [c for c in full.columns if c not in ("doc_id", "source", "size", "check", "hashed", "number")]
    return placed.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.size(taken)).alias("taken"), positions.alias("positions"), "hashed", *names)


def by_position(planned: DataFrame) -> DataFrame:
    """planned range-sorted by first position; documents that are not taken follow, spread by their hash. Store planned
    first: the ranges are found by reading it."""
    spread = F.conv(F.substring("hashed", 1, 8), 16, 10).cast("double") / 2**32
    key = F.coalesce(F.get("positions", F.lit(0)), 1.0 + spread)
    return planned.withColumn("_at", key).repartitionByRange("_at").sortWithinPartitions("_at").drop("_at")


def mixed(docs: DataFrame, recipe: Recipe = Recipe(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The documents of the mix with all their columns, a row for each copy, range-sorted by training position."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    copies = plan(docs, recipe, id_col, text_col, source_col, [row]).select(F.explode("positions").alias("_at"), "row")
    return copies.repartitionByRange("_at").sortWithinPartitions("_at").select("row.*")

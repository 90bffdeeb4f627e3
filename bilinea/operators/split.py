"""Alignment without a model: text is cut in proportion to the lengths of the source sentences."""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bilinea.functions.ranks import numbered, running_within
from bilinea.functions.storage import store
from bilinea.functions.text import ordered_join

#: The marks after which a text may be cut.
CUT_AFTER = "。！？；，、"
PIECE = re.compile(f"[^{CUT_AFTER}]*[{CUT_AFTER}]|[^{CUT_AFTER}]+")
#: Pieces in a batch.
PIECES = 10_000


class Fold:
    """A chapter's pieces dealt to its sentences, both given bit by bit, each in its order.

    Each group takes a piece, and the next one while that brings it at least as near to its sentence's target; then the
    next sentence begins, and pieces after the last sentence make groups of their own, with a target of none. What is held
    are pieces whose target is not known yet and targets that are not reached yet.
    """

    def __init__(self) -> None:
        self.group, self.size = -1, 0
        self.target: float | None = None
        self.pieces: deque[tuple[int, int]] = deque()
        self.targets: deque[float] = deque()

    def add(self, pieces: Iterable[tuple[int, int]], targets: Iterable[float]) -> None:
        """More pieces (number, length) and targets."""
        self.pieces.extend(pieces)
        self.targets.extend(targets)

    def open(self) -> None:
        self.group, self.size = self.group + 1, 0
        self.target = self.targets.popleft() if self.targets else None

    def steps(self, last: bool) -> Iterator[tuple[int, int]]:
        """(piece, group) of the pieces that can be dealt. last: nothing else will come."""
        while self.pieces:
            if self.group >= 0 and self.target is None and self.targets:
                self.target = self.targets.popleft()
            if self.group >= 0 and self.target is None and not last:
                return
            piece, length = self.pieces.popleft()
            target = self.target or 0.0
            if self.group < 0 or abs(self.size + length - target) > abs(self.size - target):
                self.open()
            self.size += length
            yield piece, self.group


def pieces_of(chunks: DataFrame) -> DataFrame:
    """chapter, number, before (characters ahead of it), piece. chunks: chapter (a number), text. A text's pieces leave it in
    batches."""
    schema = pa.schema([("chapter", pa.int64()), ("number", pa.int64()), ("before", pa.int64()), ("piece", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chapter, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows: list[tuple[int, int, int, str]] = []
                for k, m in enumerate(PIECE.finditer(text.as_py() or "")):
                    rows.append((chapter, k, m.start(), m[0]))
                    if len(rows) == PIECES:
                        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows = []
                if rows:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return chunks.select("chapter", "text").mapInArrow(run, "chapter long, number long, before long, piece string")


def dealt(pieces: DataFrame, targets: DataFrame) -> DataFrame:
    """chapter, number, slot of each piece. pieces: chapter, number, before, size; targets: chapter, index, before, target.

    Pieces and targets of a chapter run through a task as one stream, in order of the characters before them, so that a
    piece comes near the sentence it goes to and neither a text nor a chapter is ever held.
    """
    none = F.lit(None)
    rows = pieces.select("chapter", F.col("before").cast("double").alias("before"), "number", F.col("size").cast("long").alias("size"), none.cast("double").alias("target"), none.cast("long").alias("index"))
    rows = rows.unionByName(targets.select("chapter", F.col("before").cast("double").alias("before"), none.cast("long").alias("number"), none.cast("long").alias("size"), "target", F.col("index").cast("long").alias("index")))
    stream = rows.repartition("chapter").sortWithinPartitions("chapter", "before", F.isnotnull("number"), "number", "index").select("chapter", "number", "size", "target")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, chapter = Fold(), None
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            of = np.asarray(batch.column(0))
            cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                if of[a] != chapter:
                    out += [(chapter, *step) for step in fold.steps(True)]
                    fold, chapter = Fold(), int(of[a])
                part = batch.slice(a, b - a)
                known = part.column(1).is_valid()
                piece = zip(part.column(1).filter(known).to_pylist(), part.column(2).filter(known).to_pylist())
                fold.add(piece, part.column(3).filter(part.column(3).is_valid()).to_pylist())
                out += [(chapter, *step) for step in fold.steps(False)]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in (zip(*out) if out else ([], [], []))], names=["chapter", "number", "slot"])
        out = [(chapter, *step) for step in fold.steps(True)]
        if out:
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)], names=["chapter", "number", "slot"])

    return stream.mapInArrow(run, "chapter long, number long, slot long")


def proportional_split(chunks: DataFrame, sentences: DataFrame, keys: list[str] = ("corpus", "chapter")) -> DataFrame:
    """keys, seq, content: a slot for each sentence of a chapter. chunks: keys, text; sentences: keys, seq, text, a null
    text without characters. Chapters without sentences have no slots.

    Pieces end after a mark; a sentence's target is its share of all source characters, in characters of the text. If
    there are not as many groups of pieces as sentences, the first slot gets the whole text and the others null.
    """
    keys = list(keys)
    names = [F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]  # a key may be named like a column below
    own, back = [f"_key{i}" for i in range(len(keys))], [F.col(f"_key{i}").alias(k) for i, k in enumerate(keys)]
    chapters = numbered(chunks.select(*names, F.coalesce("text", F.lit("")).alias("text")), "chapter")  # stored, but for the number
    sized = sentences.select(*names, "seq", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n"), F.lit(1).cast("long").alias("one"))
    placed = running_within(sized, own, ["seq"], {"n": "before", "one": "index"}).join(chapters.select(*own, "chapter", F.length("text").alias("chars")), own)
    placed = store(placed, "split-slots")
    totals = placed.groupBy("chapter").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("slots"))
    share = lambda c: F.when(F.col("total") > 0, (F.col("chars") * F.col(c)).cast("double") / F.col("total")).otherwise(F.lit(0.0))
    targets = placed.join(totals, "chapter").select("chapter", "index", share("before").alias("before"), share("n").alias("target"))
    pieces = store(pieces_of(chapters), "split-pieces")
    slots = store(dealt(pieces.select("chapter", "number", "before", F.length("piece").alias("size")), targets), "split-dealt")

    found = slots.groupBy("chapter").agg((F.max("slot") + 1).alias("found"))
    fits = totals.join(found, "chapter", "left").select("chapter", (F.coalesce("found", F.lit(0)) == F.col("slots")).alias("fits"))
    # all pieces of a text that does not fit go to its first slot; only a text without characters has none
    given = slots.join(fits, "chapter").select("chapter", "number", F.when(F.col("fits"), F.col("slot")).otherwise(F.lit(0)).alias("index"))
    texts = pieces.select("chapter", "number", "piece").join(given, ["chapter", "number"]).groupBy("chapter", "index").agg(ordered_join(F.col("number"), F.col("piece")).alias("own"))
    rows = placed.join(fits, "chapter").join(texts, ["chapter", "index"], "left")
    content = F.coalesce("own", F.when(~F.col("fits") & (F.col("index") == 0), F.lit("")))
    return rows.select(*back, "seq", content.alias("content"))

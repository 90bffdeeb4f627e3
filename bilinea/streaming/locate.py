"""The paragraphs of pages that arrive bit by bit: a book's cursor and what is left of it are keyed state.

The batch form (operators/paragraphs.py) resumes from a stored map; here the stream itself remembers. The state of a book is
its cursor, whether a page has stopped it, and its paragraphs from the cursor on, as lengths and heads in chunks. A
micro-batch reads the chunks that its pages cover and drops those that are used up, so its work does not depend on the
size of the book. The source text is the initial state, read once with the stream's first micro-batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from bilinea.functions.text import is_blank
from bilinea.operators.paragraphs import RESULT, Walk, measured

#: Paragraphs of a chunk of state.
CHUNK = 256
COLUMNS = ["book", "page_pos", "corpus", "html", "para_start", "para_end", "status"]
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def initial_chunks(paragraphs: DataFrame, cursors: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """book, cursor, chunk, numbers, lengths, heads: a book's paragraphs from its cursor on, a row for each chunk."""
    source = measured(paragraphs, "text", "book", "paragraph").groupBy("book", "paragraph").agg(F.min(F.struct("length", "head")).alias("s"))
    left = source.join(cursors, "book").where(F.col("paragraph") >= F.col("cursor"))
    row = F.struct("paragraph", F.coalesce("s.length", F.lit(0)).alias("length"), F.coalesce("s.head", F.lit("")).alias("head"))
    grouped = left.groupBy("book", "cursor", F.floor(F.col("paragraph") / chunk).alias("chunk")).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    return grouped.select("book", "cursor", "chunk", F.col("rows.paragraph").alias("numbers"), F.col("rows.length").alias("lengths"), F.col("rows.head").alias("heads"))


class Locator(StatefulProcessor):
    """State of a book: chunks, the cursor with the last chunk's number, and whether the book has stopped."""

    def __init__(self, chunk: int = CHUNK) -> None:
        self.chunk = chunk

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.chunks = handle.getMapState("chunks", "chunk long", "numbers array<int>, lengths array<long>, heads array<string>")
        self.place = handle.getValueState("place", "cursor int, last long, stopped boolean")

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues: object) -> None:
        rows = [initialState] if isinstance(initialState, pd.DataFrame) else initialState
        cursor, last = None, -1
        if self.place.exists():
            cursor, last, _ = self.place.get()
        for part in rows:
            for r in part.itertuples(index=False):
                self.chunks.updateValue((int(r.chunk),), ([int(x) for x in r.numbers], [int(x) for x in r.lengths], [str(x) for x in r.heads]))
                cursor, last = int(r.cursor), max(last, int(r.chunk))
        if cursor is not None:
            self.place.update((cursor, last, False))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        pages = [r for part in rows for r in part.itertuples(index=False)]
        cursor, last, stopped = self.place.get() if self.place.exists() else (None, -1, False)
        if stopped:
            return
        pages.sort(key=lambda r: (r.page_pos, r.html or "", r.corpus or "", r.length, r.head))
        walk = Walk(cursor)
        walk.add([(k, int(r.length), r.head) for k, r in enumerate(pages)], [], [], [])
        first = at = cursor // self.chunk if cursor is not None else 0
        out = []
        while True:
            more = at <= last
            for k, start, end, status in walk.steps(not more):
                out.append((key[0], pages[k].page_pos, pages[k].corpus, pages[k].html, start, end, status))
            if not walk.pages or not more:
                break
            if self.chunks.containsKey((at,)):
                numbers, lengths, heads = self.chunks.getValue((at,))
                kept = [i for i, n in enumerate(numbers) if n >= walk.cursor]
                walk.add([], [numbers[i] for i in kept], [lengths[i] for i in kept], [heads[i] for i in kept])
            at += 1
        for used in range(first, walk.cursor // self.chunk if walk.cursor is not None else 0):
            if self.chunks.containsKey((used,)):
                self.chunks.removeKey((used,))
        self.place.update((walk.cursor, last, walk.stopped))
        found = pd.DataFrame(out, columns=COLUMNS)
        yield found.astype({"para_start": "Int32", "para_end": "Int32"})

    def close(self) -> None:
        pass


def locate_stream(pages: DataFrame, paragraphs: DataFrame, cursors: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The map rows of a stream of pages (corpus, book, html, page_pos, text), as match_pages_to_paragraphs has them.

    Pages of a book are taken in order within a micro-batch and go on where earlier ones ended; those after a page that
    stopped its book give no row. paragraphs and cursors are tables: of the source text, and of cursor_start. Blank texts
    are passed over. Needs the state store that keeps its state on disk: see started().
    """
    told = measured(pages.where(~is_blank(F.col("text"))), "text", "book", "page_pos", "corpus", "html")
    initial = initial_chunks(paragraphs, cursors, chunk).groupBy("book")
    return told.groupBy("book").transformWithStateInPandas(Locator(chunk), RESULT, "Append", "None", initial)


def started(spark: SparkSession, located: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes what is there of the stream to a folder of Parquet, then ends. Started again with the same checkpoint it goes
    on after the last finished micro-batch, and a micro-batch that is repeated counts once."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return located.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)

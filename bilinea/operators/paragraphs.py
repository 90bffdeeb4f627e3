"""Which paragraphs of the numbered source text a page covers."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bilinea.functions.text import is_blank, normalized_start, without_spaces

#: Characters of a page's and a paragraph's beginning that must agree; a fixed value.
HEAD = 30

RESULT = "book int, page_pos long, corpus string, html string, para_start int, para_end int, status string"


def cursor_start(para_map: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """book, cursor: the paragraph after the last one mapped, or the book's first one if none is. para_map has book and
    para_end; books without paragraphs start nowhere."""
    first = paragraphs.groupBy("book").agg(F.min("paragraph").alias("first"))
    last = para_map.groupBy("book").agg(F.max("para_end").alias("last"))
    return first.join(last, "book", "full").select("book", F.coalesce(F.col("last") + 1, F.col("first")).cast("int").alias("cursor"))


def measured(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """keep, length (without white space), head: all that the walk needs of a text."""
    return df.select(*[F.col(c).alias(c) for c in keep], F.length(without_spaces(F.col(text))).cast("long").alias("length"), normalized_start(F.col(text), HEAD).alias("head"))


def verify_heads(pages: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """pages (book, cursor, head, ...) with `head_ok`: whether page and paragraph at the cursor begin alike, as far as the
    shorter of both heads goes; null where there is no such paragraph."""
    first = paragraphs.select("book", F.col("paragraph").alias("cursor"), F.col("head").alias("_head"))
    n = F.least(F.length("head"), F.length("_head"))
    return pages.join(first, ["book", "cursor"], "left").withColumn("head_ok", F.substring(F.col("head"), F.lit(1), n) == F.substring(F.col("_head"), F.lit(1), n)).drop("_head")


class Walk:
    """A book's walk over pages and paragraphs that come bit by bit, each in its order.

    A page takes consecutive paragraphs up to the first one with which their summed length reaches its own. That one is
    given back if the sum without it is as near, unless no paragraph follows. Statuses: ok; exhausted, where the cursor's
    paragraph is not there; head_mismatch; no_paragraph, where the first one was given back. Any but ok stops the book.

    What is held are the pages that are not decided yet and the paragraphs from the cursor on: none that a page has taken.
    """

    def __init__(self, cursor: int | None) -> None:
        self.cursor, self.stopped = cursor, False
        self.pages: deque[tuple[int, int, str]] = deque()
        self.numbers, self.lengths, self.heads = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, object)

    def add(self, pages: Iterable[tuple[int, int, str]], numbers: Iterable[int], lengths: Iterable[int], heads: Iterable[str]) -> None:
        """More pages (place, length, head) and paragraphs, all after those before."""
        if self.stopped:
            return
        self.pages.extend(pages)
        self.numbers = np.concatenate([self.numbers, np.array(numbers, dtype=np.int64)])
        self.lengths = np.concatenate([self.lengths, np.array(lengths, dtype=np.int64)])
        self.heads = np.concatenate([self.heads, np.array(heads, dtype=object)])

    def steps(self, last: bool) -> Iterator[tuple[int, int | None, int | None, str]]:
        """(place, para_start, para_end, status) of the pages that can be decided. last: nothing else will come."""
        total = np.concatenate([[0], np.cumsum(self.lengths)])
        breaks = np.flatnonzero(np.diff(self.numbers) != 1) + 1
        known, i = len(self.numbers), 0
        while self.pages and not self.stopped:
            place, length, head = self.pages[0]
            i = int(np.searchsorted(self.numbers, self.cursor)) if self.cursor is not None else known
            if i == known and not last and self.cursor is not None:
                break
            start, end, status = self.cursor, None, "ok"
            if i == known or self.numbers[i] != self.cursor:
                status = "exhausted"
            elif not alike(head, self.heads[i]):
                status = "head_mismatch"
            else:
                later = breaks[np.searchsorted(breaks, i, side="right") :]
                stop = int(later[0]) if len(later) else known
                j = max(int(np.searchsorted(total, total[i] + length, side="left")), i + 1)  # total[j]: with paragraphs i .. j - 1
                if j >= stop and stop == known and not last:
                    break  # what follows decides
                if j > stop:
                    j = stop
                elif j < stop and abs(total[j - 1] - total[i] - length) <= abs(total[j] - total[i] - length):
                    j -= 1
                if j == i:
                    status = "no_paragraph"
                else:
                    end, i = int(self.numbers[j - 1]), j
            self.pages.popleft()
            self.stopped = status != "ok"
            yield (place, start, end, status) if status == "ok" else (place, None, None, status)
            self.cursor = end + 1 if end is not None else self.cursor
        if self.stopped:
            self.pages.clear()
            i = known
        self.numbers, self.lengths, self.heads = self.numbers[i:], self.lengths[i:], self.heads[i:]


def alike(a: str, b: str) -> bool:
    """Whether both begin alike, as far as the shorter one goes."""
    n = min(len(a), len(b))
    return a[:n] == b[:n]


def merge_stream(pages: DataFrame, paragraphs: DataFrame, cursors: DataFrame) -> DataFrame:
    """Pages and paragraphs of all books as sorted streams, a book in a partition: book, cursor, place (null for a
    paragraph), number, length, head, corpus, html.

    Both are put in order of the text before them in their book, so that a page stands near the paragraphs it will take,
    and a walk has to hold no more than what pages and paragraphs have drifted apart.

    Pages and paragraphs are dealt together, once, by the book and a hash of it. By the book alone Spark would take the
    union as dealt already if both sides are, and then read either side in partitions of its own.
    """
    told = measured(pages.where(~is_blank(F.col("text"))), "text", "book", "page_pos", "corpus", "html").join(cursors, "book", "left")
    told = told.select("book", "cursor", F.col("page_pos").alias("place"), F.lit(None).cast("int").alias("number"), "length", "head", "corpus", "html")
    source = measured(paragraphs, "text", "book", "paragraph").groupBy("book", "paragraph").agg(F.min(F.struct("length", "head")).alias("s"))
    open_ = source.join(cursors, "book").where(F.col("paragraph") >= F.col("cursor")).select("book", "cursor", F.col("paragraph").alias("number"), F.coalesce("s.length", F.lit(0)).alias("length"), F.coalesce("s.head", F.lit("")).alias("head"))
    # a book without pages has nothing to tell
    open_ = open_.join(told.select("book").distinct(), "book", "left_semi")
    none = F.lit(None).cast("string")
    rows = told.unionByName(open_.select("book", "cursor", F.lit(None).cast("long").alias("place"), "number", "length", "head", none.alias("corpus"), none.alias("html")))
    dealt = rows.withColumn("deal", F.xxhash64("book")).repartition("book", "deal")
    ahead = Window.partitionBy("book", "deal", F.isnotnull("number")).orderBy("place", "html", "corpus", "number", "length", "head").rowsBetween(Window.unboundedPreceding, -1)
    dealt = dealt.withColumn("before", F.coalesce(F.sum("length").over(ahead), F.lit(0)))
    return dealt.sortWithinPartitions("book", "before", F.isnotnull("number"), "place", "html", "corpus", "number").drop("before", "deal")


def match_pages_to_paragraphs(pages: DataFrame, paragraphs: DataFrame, cursors: DataFrame) -> DataFrame:
    """book, page_pos, corpus, html, para_start, para_end, status: the paragraphs of each page, up to the page that stops
    its book.

    pages: corpus, book, html, page_pos (their order in the book), text; blank texts are passed over. paragraphs: book,
    paragraph, text. cursors: of cursor_start. Books are walked side by side; pages of one book one after the other, as
    each starts where the last one ended. Only lengths and heads are shuffled, never texts. A book runs through its task
    as a sorted stream: the task holds a batch of it and the stretch around the cursor, however long the book is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, book = None, None
        names: dict[int, tuple[int, str | None, str | None]] = {}  # of the pages that the walk holds
        seen = 0

        def told(steps: Iterator[tuple]) -> list[tuple]:
            out = []
            for number, start, end, status in steps:
                out.append((book, *names.pop(number), start, end, status))
            if walk.stopped:
                names.clear()
            return out

        for batch in batches:
            out: list[tuple] = []
            books, page, lengths = np.asarray(batch.column(0)), np.asarray(batch.column(2).is_valid()), np.asarray(batch.column(4))
            numbers = np.asarray(batch.column(3).fill_null(0))
            places, heads, corpora, html = (batch.column(i).to_pylist() for i in (2, 5, 6, 7))
            for at, until in zip(*stretches(books)):
                if walk is None or books[at] != book:
                    out += told(walk.steps(True)) if walk else []
                    book, walk = int(books[at]), Walk(batch.column(1)[at].as_py())
                if not walk.stopped:
                    here = page[at:until]
                    own, rest = (np.flatnonzero(here) + at).tolist(), np.flatnonzero(~here) + at
                    names.update((seen + k, (places[i], corpora[i], html[i])) for k, i in enumerate(own))
                    walk.add([(seen + k, int(lengths[i]), heads[i]) for k, i in enumerate(own)], numbers[rest], lengths[rest], [heads[i] for i in rest.tolist()])
                    seen += len(own)
                    out += told(walk.steps(False))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(target)], schema=target)
        if walk:
            out = told(walk.steps(True))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(target)], schema=target)

    target = pa.schema([("book", pa.int32()), ("page_pos", pa.int64()), ("corpus", pa.string()), ("html", pa.string()), ("para_start", pa.int32()), ("para_end", pa.int32()), ("status", pa.string())])
    rows = merge_stream(pages, paragraphs, cursors).select(F.col("book").cast("int"), F.col("cursor").cast("int"), F.col("place").cast("long"), F.col("number").cast("int"), F.col("length").cast("long"), "head", "corpus", "html")
    return rows.mapInArrow(run, RESULT)


def stretches(values: np.ndarray) -> tuple[list[int], list[int]]:
    """Where stretches of equal values start, and where they end."""
    cuts = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
    return (cuts[:-1], cuts[1:]) if len(values) else ([], [])

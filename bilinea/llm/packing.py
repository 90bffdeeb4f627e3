"""Best-fit packing of token sequences, planned over a histogram of lengths.

Documents become pieces of at most `capacity` tokens. Only the number of pieces of each length, a table of as many rows
as there are lengths, goes to the driver; best-fit decreasing runs over those counts. The plan says which ranks of a
length go to which sequences; each piece takes its place by its rank within its length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bilinea.llm.common import driver_table, order_hash, ranked, slices, small_batches, store

PLAN = "length int, rank_from long, rank_to long, sequence_from long, per_sequence int, offset_from int"
PIECES = "row_tag long, doc_id {id_type}, piece int, start long, length long, ids_crc32 long"


#: ASCII punctuation and symbols, which the tokenizer parts from letters before them.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


#: Latin (without U+0130, which lower-casing parts), Greek, Cyrillic, kana, Han and Hangul blocks, whose letters stay
#: letters when they are composed and lower-cased.
STEADY = r"^[A-Za-z\x{c0}-\x{12f}\x{131}-\x{24f}\x{370}-\x{482}\x{48a}-\x{52f}\x{3041}-\x{3096}\x{30a1}-\x{30fa}\x{4e00}-\x{9fff}\x{ac00}-\x{d7a3}]+$"


def plain(units: pa.Array) -> pa.Array:
    """Which units are letters and stay so when the tokenizer composes and lower-cases them; others are encoded alone."""
    return pc.and_(pc.utf8_is_alpha(units), pc.match_substring_regex(units, STEADY))


class WordIds:
    """Token ids of whole texts by way of their distinct words.

    The tokenizer drops white space and never joins across it, nor across the border of a run of letters, so a text's
    ids are those of its words in order, and a word of letters with punctuation after it is two such units.
    Each distinct unit of a slice is encoded once; texts are put together from the units' ids by array operations.
    """

    #: Units remembered from slice to slice; beyond that the memory starts anew.
    MOST_KNOWN = 300_000

    def __init__(self, tokenizer_file: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.sizes = np.zeros(0, dtype="<u4"), np.zeros(0, dtype=np.int64)

    def encode(self, units: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]

    def encode_letters(self, units: list[str], at_once: int = 1000) -> tuple[np.ndarray, np.ndarray]:
        """ids and the number of ids of each unit. Units of letters are encoded as one text: each ends at a token that
        closes a word. Should the count of those differ, the chunk is encoded unit by unit."""
        ids, sizes = [], []
        for chunk in (units[i : i + at_once] for i in range(0, len(units), at_once)):
            found = np.array(self.encode([" ".join(chunk)])[0], dtype="<u4")
            ends = np.flatnonzero(self.closes[found]) + 1
            if len(ends) != len(chunk):
                each = self.encode(chunk)
                found, ends = np.array([i for e in each for i in e], dtype="<u4"), np.cumsum([len(e) for e in each])
            ids.append(found)
            sizes.append(np.diff(ends, prepend=0))
        return np.concatenate([np.zeros(0, dtype="<u4"), *ids]), np.concatenate([np.zeros(0, dtype=np.int64), *sizes])

    def learn(self, units: pa.Array) -> np.ndarray:
        """Each unit's place among the known ones, after the new ones are encoded. Units must differ."""
        if len(self.known) > self.MOST_KNOWN:
            self.forget()
        place = np.fromiter(map(self.known.get, units.to_pylist(), repeat(-1)), dtype=np.int64, count=len(units))
        fresh = np.flatnonzero(place < 0)
        new = units.take(pa.array(fresh))
        letters = np.asarray(plain(new))
        words, others = new.filter(pa.array(letters)).to_pylist(), new.filter(pa.array(~letters)).to_pylist()
        ids, sizes = self.encode_letters(words)
        each = self.encode(others) if others else []
        at = len(self.sizes)
        place[fresh[letters]] = np.arange(at, at + len(words))
        place[fresh[~letters]] = np.arange(at + len(words), at + len(fresh))
        self.flat = np.concatenate([self.flat, ids, np.array([i for e in each for i in e], dtype="<u4")])
        self.sizes = np.concatenate([self.sizes, sizes, np.array([len(e) for e in each], dtype=np.int64)])
        self.known.update(zip(words + others, range(at, len(self.sizes))))
        return place

    def batch(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts, each text closed by end_id, and where each text's ids end."""
        texts = pc.fill_null(texts, "")
        # special tokens are told by their case, so texts that may have some stay as they are
        parts = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts)))
        words = parts.flatten()
        cores = pc.ascii_rtrim(words, characters=MARKS)
        coded = cores.dictionary_encode()
        letters = plain(coded.dictionary)
        code, whole = np.array(coded.indices), ~np.asarray(letters)[np.asarray(coded.indices)]
        rest = words.filter(pa.array(whole)).dictionary_encode()
        code[whole] = len(coded.dictionary) + np.asarray(rest.indices)
        tails = suffixes(words, cores, whole).dictionary_encode()
        units = pa.concat_arrays([pc.if_else(letters, coded.dictionary, ""), rest.dictionary, tails.dictionary])
        differ = units.dictionary_encode()
        place = self.learn(differ.dictionary)[np.asarray(differ.indices)]
        # core and tail of each word in turn
        pieces = np.empty(2 * len(words), dtype=np.int64)
        pieces[::2], pieces[1::2] = place[code], place[len(coded.dictionary) + len(rest.dictionary) + np.asarray(tails.indices)]
        size, first = self.sizes[pieces], (np.cumsum(self.sizes) - self.sizes)[pieces]
        until = np.concatenate([[0], np.cumsum(size)])
        flat = self.flat[np.repeat(first - until[:-1], size) + np.arange(until[-1])]
        ends = until[2 * (np.asarray(parts.offsets)[1:].astype(np.int64) - np.asarray(parts.offsets)[0])]
        return np.insert(flat, ends, end_id), ends + np.arange(1, len(ends) + 1)


def suffixes(words: pa.Array, cores: pa.Array, without: np.ndarray) -> pa.Array:
    """What each word has after its core; nothing where it is to go without."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    size = np.where(without, 0, np.diff(offsets) - np.asarray(pc.binary_length(cores)))
    until = np.concatenate([[0], np.cumsum(size)])
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[np.repeat(offsets[1:] - size - until[:-1], size) + np.arange(until[-1])]
    return pa.StringArray.from_buffers(len(words), pa.py_buffer(until.astype(np.int32)), pa.py_buffer(data))


def cut(batches: Iterator[pa.RecordBatch], tokenizer_file: str, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    encoder = WordIds(tokenizer_file)
    for whole in batches:
        for at, n in slices(whole.column(2)):
            batch = whole.slice(at, n)
            ids, ends = encoder.batch(batch.column(2).cast(pa.string()), end_id)
            raw = memoryview(ids).cast("B")
            out: list[tuple[int, int, int, int, int]] = []
            begin = 0
            for row, end in enumerate(ends.tolist()):
                for piece, start in enumerate(range(begin, end, capacity)):
                    stop = min(start + capacity, end)
                    out.append((row, piece, start - begin, stop - start, zlib.crc32(raw[4 * start : 4 * stop])))
                begin = end
            rows, piece, start, length, crc = (np.array(x) for x in zip(*out))
            yield pa.record_batch(
                [batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["row_tag", "doc_id", "piece", "start", "length", "ids_crc32"],
            )


def pieces(docs: DataFrame, tokenizer_file: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of all documents: row_tag, doc_id, piece, start, length, ids_crc32.

    A document is its text's ids and then end_id; a null or empty text is end_id alone. Only what is longer than
    capacity is cut, into full pieces and a last one. Repeated rows are separate documents, told apart by row_tag.
    """
    small_batches(docs.sparkSession)
    given = docs.select(F.monotonically_increasing_id().alias("row_tag"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = PIECES.format(id_type=given.schema["doc_id"].dataType.simpleString())
    return given.mapInArrow(lambda batches: cut(batches, tokenizer_file, capacity, end_id), schema)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows (length, rank from, rank to, first sequence, pieces in each, offset).

    Sequences of equal free space are kept as runs. A length enters the run with the least space that suffices; there
    it fills each sequence as often as it fits, since the one just used stays the tightest. Each length adds two runs
    at most beyond those it uses up, so the plan has a few rows per length, however many documents there are.
    """
    runs: dict[int, list[tuple[int, int]]] = {}
    spaces: list[int] = []

    def put(space: int, first: int, n: int) -> None:
        if space and n:
            if space not in runs:
                runs[space] = []
                insort(spaces, space)
            runs[space].append((first, n))

    out, opened = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                first, n = runs[space].pop()
                if not runs[space]:
                    del runs[space], spaces[at]
            else:
                space, first = capacity, opened
                n = -(-left // (capacity // length))
                opened += n
            each = space // length
            used = min(n, -(-left // each))
            here = min(left, used * each)
            out.append((length, rank, rank + here, first, each, capacity - space))
            full = here // each
            put(space - each * length, first, full)
            if used > full:
                put(space - (here - full * each) * length, first + full, 1)
            put(space, first + used, n - used)
            rank += here
            left -= here
    return out


def pack(cut_pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """Adds sequence_id and offset to pieces. An empty table gives no rows. The tables that the driver and each executor
    hold have a few rows per length, capacity lengths at most."""
    spark = cut_pieces.sparkSession
    keyed = store(cut_pieces.withColumn("hashed", order_hash(F.col("row_tag"), F.col("piece"))), "pack-pieces")
    counts = {r["length"]: r["n"] for r in keyed.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = driver_table(spark, plan(counts, capacity), PLAN).withColumnRenamed("length", "p_length")
    placed = ranked(keyed, "length", "hashed", ["row_tag", "piece"], max(counts.values(), default=0))
    here = (F.col("length") == F.col("p_length")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to"))
    within = F.col("rank") - F.col("rank_from")
    return placed.join(F.broadcast(places), here).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("sequence_from") + F.floor(within / F.col("per_sequence"))).cast("long").alias("sequence_id"),
        (F.col("offset_from") + within % F.col("per_sequence") * F.col("length")).cast("long").alias("offset"),
    )

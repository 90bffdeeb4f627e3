"""Mining of phrase collocations with counting quotient filters.

Texts are cut into shards of about a million words, whose words are numbered within the shard. Phrases are counted level by level, two words, three, four: each
shard packs the numbers of a phrase's words into a key and counts its keys in a filter (bilinea/llm/quotient.py); the slices
of all shards' filters are merged, sorted list by sorted list. A phrase can be frequent only if its first and its last
words are, all but one of them. So each shard is told which of its own phrases are frequent in the corpus, by a bit for
each, and counts longer phrases only where both parts are; nothing that could reach the threshold is left out.

Words are numbered for each language anew, so a phrase's numbers tell its language.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bilinea.functions.ranks import numbered
from bilinea.llm.common import slices, small_batches, store
from bilinea.llm.quotient import Filter, merged, planes, restore, squeeze, unplanes, unsqueeze

#: Occurrences of a candidate at least, its longest, and the share of them, in hundredths, at which a longer candidate
#: makes it superfluous.
LEAST, LONGEST, WITHIN = 30, 4, 80
#: Candidates of a language in the result, and what stands for a null language.
TOP, UNKNOWN = 2_000, "und"
#: Words of a shard, and phrases of a slice, about; slices are two to this power at least.
SHARD, SLICE, SLICE_BITS = 1 << 20, 1 << 20, 4
#: Parts of a language that are ranked by themselves first.
SALTS = 64
#: Parts pieces; none of them is ever within a word.
BREAK = b"."
_TABLE = bytes(ord(BREAK) if chr(c) in ".,;:!?\n\x0b\x0c\r" else c for c in range(256))
WORDS = [f"w{i}" for i in range(1, LONGEST + 1)]
PLACE_BITS = 32


class Shard:
    """Texts as numbers of words, 0 between pieces; a word has a number for each language it occurs in."""

    def __init__(self) -> None:
        self.codes: dict[tuple[str, bytes], int] = {}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, langs: list[str], texts: list[str | None]) -> None:
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(langs, texts):
            by_lang.setdefault(lang, []).append((text or "").encode())
        for lang in sorted(by_lang):
            found = BREAK.join(by_lang[lang]).lower().translate(_TABLE).replace(BREAK, b" " + BREAK + b" ").split()
            coded = pa.array(found, pa.binary()).dictionary_encode()
            known = coded.dictionary.to_pylist()
            codes = np.array([0 if w == BREAK else self.codes.setdefault((lang, w), len(self.codes) + 1) for w in known], dtype=np.int64)
            self.parts += [codes[np.asarray(coded.indices)] if known else codes, np.zeros(1, np.int64)]
            self.size += len(found)

    def row(self, number: int) -> pa.RecordBatch:
        """Words are numbered anew, from 1, the frequent ones first."""
        tokens, n = np.concatenate(self.parts), len(self.codes)
        counts = np.bincount(tokens, minlength=n + 1)[1:]
        order = np.argsort(-counts, kind="stable")
        again = np.zeros(n + 1, dtype=np.int64)
        again[order + 1] = np.arange(1, n + 1)
        pairs = list(self.codes)
        langs, words = pa.array([lang for lang, _ in pairs], pa.string()), pa.array([w for _, w in pairs], pa.binary()).cast(pa.string())
        listed = pa.StructArray.from_arrays([langs.take(pa.array(order)), words.take(pa.array(order)), pa.array(counts[order])], ["lang", "word", "n"])
        one_row = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), listed)
        return pa.record_batch([pa.array([number]), pa.array([packed(again[tokens])], pa.binary()), one_row], names=["shard", "tokens", "words"])


def packed(tokens: np.ndarray) -> bytes:
    return squeeze(planes(tokens))


def unpacked(data: bytes) -> np.ndarray:
    return unplanes(unsqueeze(data))[0].astype(np.int64)


def shards(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """shard, tokens, words (its words in order of their numbers: lang, word, n)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = Shard(), TaskContext.get().partitionId() << PLACE_BITS
        for whole in batches:
            for at, n in slices(whole.column(1)):
                part = whole.slice(at, n)
                shard.add(part.column(0).to_pylist(), part.column(1).to_pylist())
                if shard.size >= SHARD:
                    yield shard.row(number)
                    shard, number = Shard(), number + 1
        if shard.size:
            yield shard.row(number)

    given = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(run, "shard long, tokens binary, words array<struct<lang: string, word: string, n: long>>")


def each_row(work: Callable[..., Iterator[tuple]], schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function on batches out of one on rows that gives rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(c.to_pylist() if pa.types.is_binary(c.type) or pa.types.is_integer(c.type) else c for c in batch.columns)):
                found = list(zip(*work(*row)))
                if found:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(found, schema)], schema=schema)

    return run


def of_frequent_words(parts: DataFrame, known: DataFrame) -> DataFrame:
    """shard, tokens (frequent words alone, numbered anew), ids (the corpus' number of each). known: shard, code, id."""
    schema = pa.schema([("shard", pa.int64()), ("tokens", pa.binary()), ("ids", pa.binary())])

    def work(shard: int, data: bytes, pairs: pa.ListScalar) -> Iterator[tuple]:
        tokens, code, ids = unpacked(data), np.asarray(pairs.values.field(0)), np.asarray(pairs.values.field(1))
        order = np.argsort(code)
        again = np.zeros(int(tokens.max(initial=0)) + 1, dtype=np.int64)
        again[code[order]] = np.arange(1, len(code) + 1)
        yield shard, packed(single_breaks(again[tokens])), squeeze(planes(ids[order]))

    told = known.groupBy("shard").agg(F.collect_list(F.struct("code", "id")).alias("pairs"))  # a shard's words
    return parts.select("shard", "tokens").join(told, "shard").mapInArrow(each_row(work, schema), "shard long, tokens binary, ids binary")


def single_breaks(tokens: np.ndarray) -> np.ndarray:
    return tokens[np.concatenate([[True], (tokens[1:] != 0) | (tokens[:-1] != 0)])] if len(tokens) else tokens


def phrases(tokens: np.ndarray, n: int) -> np.ndarray:
    """Where n words stand next to each other."""
    if len(tokens) < n:
        return np.zeros(0, np.int64)
    word, size = tokens != 0, len(tokens) - n + 1
    return np.flatnonzero(np.logical_and.reduce([word[i : i + size] for i in range(n)]))


def filter_of(tokens: np.ndarray, ids: np.ndarray, n: int, bits: int) -> tuple[Filter, np.ndarray, np.ndarray]:
    """The filter of a shard's phrases of n words; where they start, and their places in the filter."""
    at = phrases(tokens, n)
    own = np.concatenate([[0], ids]).astype(np.uint64)[tokens]
    part = lambda i: own[at + i] if i < n else np.zeros(len(at), np.uint64)
    wide, left, right = 1 if n == 2 else 2, part(0), part(1)
    if wide == 2:
        left, right = left << np.uint64(bits) | right, part(2) << np.uint64(bits) | part(3)
    found, place = Filter.of(left, right, wide * bits)
    return found, at, place


def shortened(tokens: np.ndarray, start: np.ndarray, frequent: np.ndarray, n: int) -> np.ndarray:
    """The tokens of all stretches in which two or more frequent phrases of n words follow each other word by word."""
    start = start[frequent]
    if not len(start):
        return np.zeros(0, np.int64)
    first = np.flatnonzero(np.diff(start, prepend=start[0] - 2) != 1)
    length = np.diff(np.append(first, len(start)))
    first, length = start[first[length > 1]], length[length > 1] + n  # words, and a break
    ends = np.cumsum(length)
    out = tokens[np.minimum(np.repeat(first - (ends - length), length) + np.arange(int(length.sum())), len(tokens) - 1)]
    out[ends - 1] = 0
    return out


def told_frequent(found: Filter, place: np.ndarray, told: pa.ListScalar, slice_bits: int) -> np.ndarray:
    """Which phrases are frequent, by the bits that came back for each slice of the shard's filter."""
    flags, edges = np.zeros(len(found.left), dtype=bool), found.slices(slice_bits)
    for s, bits in zip(told.values.field(0).to_pylist(), told.values.field(1).to_pylist()):
        n = int(edges[s + 1] - edges[s])
        flags[edges[s] : edges[s + 1]] = np.unpackbits(np.frombuffer(unsqueeze(bits), np.uint8))[:n]
    return flags[place]


def longer(parts: DataFrame, merged_: DataFrame, n: int, bits: int, slice_bits: int) -> DataFrame:
    """shard, tokens, ids of what is left of the shards for phrases of more than n words."""
    schema = pa.schema([("shard", pa.int64()), ("tokens", pa.binary()), ("ids", pa.binary())])

    def work(shard: int, data: bytes, ids: bytes, told: pa.ListScalar) -> Iterator[tuple]:
        tokens = unpacked(data)
        found, start, place = filter_of(tokens, unplanes(unsqueeze(ids))[0], n, bits)
        rest = shortened(tokens, start, told_frequent(found, place, told, slice_bits), n)
        if len(rest):
            yield shard, packed(rest), ids

    told = merged_.where("shard is not null").groupBy("shard").agg(F.collect_list(F.struct("slice", "bits")).alias("told"))  # a shard's slices
    return parts.join(told, "shard").mapInArrow(each_row(work, schema), "shard long, tokens binary, ids binary")


def merge_filters(parts: DataFrame, n: int, bits: int, slice_bits: int, least: int) -> DataFrame:
    """The shards' filters of phrases of n words, merged. A row for each shard and slice: shard, slice, bits (whether each
    phrase is frequent); and for each slice, with null there: phrases, the frequent ones (numbers of words, f)."""
    schema = pa.schema([("shard", pa.int64()), ("slice", pa.int32()), ("filter", pa.binary())])

    def cut(shard: int, data: bytes, ids: bytes) -> Iterator[tuple]:
        found, _, _ = filter_of(unpacked(data), unplanes(unsqueeze(ids))[0], n, bits)
        edges = found.slices(slice_bits)
        for s in np.flatnonzero(np.diff(edges)).tolist():
            yield shard, s, found.packed(slice_bits, int(edges[s]), int(edges[s + 1]))

    def words_of(found: Filter) -> list[np.ndarray]:
        left, right = restore(found.left, found.right, found.bits)
        if n > 2:
            mask, by = np.uint64((1 << bits) - 1), np.uint64(bits)
            return [left >> by, left & mask, right >> by, right & mask]
        return [left, right, np.zeros_like(left), np.zeros_like(left)]

    out = pa.schema([("shard", pa.int64()), ("slice", pa.int32()), ("bits", pa.binary()), ("phrases", pa.list_(pa.struct([*((w, pa.int64()) for w in WORDS), ("f", pa.int64())])))])

    def together(slice_: int, rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
        total, places = merged([Filter.unpacked(data, slice_bits, slice_) for _, data in rows])
        often = total.counts >= least
        bits_ = [squeeze(np.packbits(often[p]).tobytes()) for p in places]
        kept = Filter(total.left[often], total.right[often], total.counts[often], total.bits)
        fields = [pa.array(c.astype(np.int64)) for c in (*words_of(kept), kept.counts)]
        listed = pa.ListArray.from_arrays(pa.array([0] * (len(rows) + 1) + [len(kept.left)], pa.int32()), pa.StructArray.from_arrays(fields, [*WORDS, "f"]))
        return pa.record_batch([pa.array([s for s, _ in rows] + [None], pa.int64()), pa.array([slice_] * len(rows) + [None], pa.int32()), pa.array([*bits_, None], pa.binary()), listed], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            for shard, slice_, data in zip(*(c.to_pylist() for c in batch.columns)):
                if slice_ != now and rows:
                    yield together(now, rows)
                    rows = []
                now = slice_
                rows.append((shard, data))
        if rows:
            yield together(now, rows)

    phrase = ", ".join(f"{w}: long" for w in [*WORDS, "f"])
    filters = parts.mapInArrow(each_row(cut, schema), "shard long, slice int, filter binary")
    sliced = filters.repartition(1 << slice_bits, "slice").sortWithinPartitions("slice", "shard")
    return store(sliced.mapInArrow(run, f"shard long, slice int, bits binary, phrases array<struct<{phrase}>>"), "phrase-filters")


def counted(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored: all frequent phrases of one word and more (w1 to w4, numbers of words, 0 where there is none; f), what the
    numbers stand for (id, lang, word), and the words of each language (lang, n)."""
    parts = store(shards(docs, text_col, lang_col), "phrase-shards")
    each = parts.select("shard", F.posexplode("words").alias("code", "w")).select("shard", (F.col("code") + 1).alias("code"), "w.*")
    sizes = parts.select(F.explode("words").alias("w")).groupBy("w.lang").agg(F.sum("w.n").alias("n"))
    # a shard has a word once, so a window over a word has as many rows as there are shards
    often = F.sum("n").over(Window.partitionBy("lang", "word"))
    own = store(each.withColumn("f", often).where(F.col("f") >= least).select("shard", "code", "lang", "word", "f"), "phrase-words")
    words = store(numbered(own.groupBy("lang", "word").agg(F.first("f").alias("f")), "id").withColumn("id", F.col("id") + 1), "phrase-vocabulary")
    about = words.agg(F.count(F.lit(1)), F.sum("f")).first()
    bits = max(2, int(about[0]).bit_length())
    known = own.join(words.select("lang", "word", "id"), ["lang", "word"]).select("shard", "code", "id")
    parts = store(of_frequent_words(parts, known), "phrase-frequent")
    slice_bits = max(SLICE_BITS, (int(about[1] or 0) // SLICE).bit_length())

    none = F.lit(0).cast("long")
    tables = [words.select(F.col("id").alias("w1"), *[none.alias(w) for w in WORDS[1:]], "f")]
    for n in range(2, LONGEST + 1):
        by = min(slice_bits, bits)
        found = merge_filters(parts, n, bits, by, least)
        tables.append(found.where("shard is null").select(F.explode("phrases").alias("p")).select("p.*"))
        if n < LONGEST:
            parts = store(longer(parts, found, n, bits, by), "phrase-longer")
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return store(out, "phrases"), words.select("id", "lang", "word"), store(sizes, "phrase-sizes")


# Scores


def size_of_phrase() -> Column:
    return sum((F.col(w) > 0).cast("int") for w in WORDS)


def part(start: int, size: int) -> Column:
    """A phrase's words from start on, as many as size says, as a struct like a whole phrase."""
    return F.struct(*[(F.col(WORDS[start + i]) if i < size else F.lit(0).cast("long")).alias(w) for i, w in enumerate(WORDS)])


def parts_of(lengths: range, cut: Callable[[int], list[Column]]) -> Column:
    """An array that depends on the number of a phrase's words."""
    out = F.when(F.lit(False), F.array(*cut(lengths[0])))
    for n in lengths:
        out = out.when(F.col("n") == n, F.array(*cut(n)))
    return F.explode(out)


def scored(found: DataFrame) -> DataFrame:
    """Of each candidate: its words, a, l, r, score of the cut that scores lowest, the first of such."""
    longer_than_one = found.withColumn("n", size_of_phrase()).where("n > 1")
    cuts = parts_of(range(2, LONGEST + 1), lambda n: [F.struct(F.lit(k).alias("k"), part(0, k).alias("first"), part(k, n - k).alias("rest")) for k in range(1, n)])
    cut = longer_than_one.select(*WORDS, F.col("f").alias("a"), cuts.alias("c")).select(*WORDS, "a", "c.*")
    for side, name in (("first", "l"), ("rest", "r")):
        other = found.select(*[F.col(w).alias(f"_{w}") for w in WORDS], F.col("f").alias(name))
        on = [F.col(f"{side}.{w}") == F.col(f"_{w}") for w in WORDS]
        cut = cut.join(other, on).drop(*[f"_{w}" for w in WORDS])
    # exact: 2,000,000 * a may pass 64 bits, the quotient is a million at most
    score = F.expr("(cast(2000000 as decimal(20, 0)) * cast(a as decimal(18, 0))) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    return cut.groupBy(*WORDS, "a").agg(best).select(*WORDS, "a", "best.l", "best.r", "best.score")


def closed(candidates: DataFrame, found: DataFrame, within: int = WITHIN) -> DataFrame:
    """The candidates that no longer one holds in so many hundredths of their occurrences or more."""
    whole = found.withColumn("n", size_of_phrase()).where("n > 2")
    inner = parts_of(range(3, LONGEST + 1), lambda n: [part(at, k) for k in range(2, n) for at in range(n - k + 1)])
    most = whole.select("f", inner.alias("p")).groupBy("p").agg(F.max("f").alias("most")).select("p.*", "most")
    share = F.col("most").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * within
    return candidates.join(most, WORDS, "left").where(~F.coalesce(share, F.lit(False))).drop("most")


def leading(rows: DataFrame, order: list[Column], top: int) -> DataFrame:
    """The first rows of each language, with their rank. A language's rows are ranked in parts, then the firsts of all."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*WORDS), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("rank") <= top)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top).drop("_salt")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """Each language's leading phrases: lang, rank, phrase, a, l, r, n, score.

    Null and empty texts have no words; a null language is named `und`. Repeated rows count again; other columns are not
    read. A language without candidates, and an empty table, give no rows. Counts and scores are exact.
    """
    found, words, sizes = counted(docs, text_col, lang_col, least)
    rows = closed(scored(found), found).join(words.select(F.col("id").alias("w1"), "lang", F.col("word").alias("t1")), "w1")
    rows = store(rows, "phrase-candidates")
    by_number = [F.desc("score"), F.desc("a")]
    # texts are joined only to candidates that can be among the first; equal ones at the edge all can
    edge = leading(rows, by_number, top).groupBy("lang").agg(F.min(F.struct("score", "a")).alias("edge"))
    rows = rows.join(edge, "lang").where(F.struct("score", "a") >= F.col("edge")).drop("edge")
    for w in WORDS[1:]:
        rows = rows.join(words.select(F.col("id").alias(w), F.col("word").alias(f"t{w[1:]}")), w, "left")
    phrase = F.concat_ws(" ", *[f"t{w[1:]}" for w in WORDS])
    ranked = leading(store(rows.withColumn("phrase", phrase), "phrase-leading"), [*by_number, F.col("phrase")], top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

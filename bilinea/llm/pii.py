"""Personal data: patterns find protected entities, and corpus co-occurrence finds the terms that give them away.

A term discloses an entity as far as knowing the term tells which entity is meant. With e the documents that hold the
entity, t those that hold the term, et those that hold both and n all documents, the chance of the entity given the term
is estimated as (et + e / n) / (t + 1): as if one more document had the term, and the entity in it at random. The
information that is still missing to know the entity is minus its binary logarithm. A term that leaves a bit or less is
generalised, one that leaves 0.415 bits or less (a chance of three in four) is removed: a number becomes the range of its
leading digit, a word the class that its letters show. The estimate counts evidence, not corpus size: a term that one
document has, beside an entity, is generalised; one that three documents have, each with the entity, is removed; a term
that most of the time stands elsewhere is left alone, however large the corpus and however rare the entity. A term must
also stand in a tenth of the entity's documents, or it tells of a document more than of the entity. Statistics know
terms by 64-bit hashes; two of them are mistaken for one about once in a corpus of four billion terms.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bilinea.llm.common import slices, small_batches, store

KINDS = ("email", "ip", "card", "phone")
#: Characters of an address before its @.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Stripped from both ends of a word before it is a term.
EDGES = ".,;:!?\"'()[]{}<>|*#$%&…«»„“”‘’"

#: Chance of the entity given the term from which a term is removed, and from which it is generalised.
REMOVE, GENERALISE = 0.75, 0.5
#: Part of the entity's documents that hold a disclosing term, at least.
COVER = 0.1
#: Bits for each term in the map by which texts without an entity are searched for disclosing terms; its least and its
#: largest size (256 MB). Beyond, more words are joined with the terms, and the result is the same.
BITS_A_TERM, LEAST_BITS, MOST_BITS = 16, 1 << 20, 1 << 31

SPAN = "array<struct<kind: string, start: long, end: long>>"
NEAR = "array<struct<term: long, start: long, end: long>>"


# Patterns. They are written so that each character is looked at a bounded number of times, however long a run is.


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The local part is the whole run of its characters before the @, as far as the last address leaves it."""
    last = 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            last = m.end()
            yield start, last


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in IP.finditer(text):
        if all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m[0].split("."))):
            yield m.span()


def luhn(digits: str) -> bool:
    doubled = (2 * int(d) if i % 2 else int(d) for i, d in enumerate(reversed(digits)))
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 9 <= len(DIGIT.findall(m[0])) <= 15:
            yield m.span()


def entities(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind and place, in code points."""
    found = []
    if "@" in text:
        found += [("email", *s) for s in emails(text)]
    if DIGIT.search(text):
        found += [("ip", *s) for s in ips(text)]
        found += [("card", *s) for s in cards(text)]
        if "+" in text:
            found += [("phone", *s) for s in phones(text)]
    return found


def terms_of(words: pa.Array) -> pa.Array:
    return pc.utf8_lower(words)


def is_term(core: str) -> bool:
    """Words with a letter or a digit."""
    return any(c.isalnum() for c in core)


def words_of(text: str, base: list[tuple[str, int, int]]) -> tuple[list[str], list[tuple[int, int]]]:
    """The terms of the whole text outside of its entities, and their places."""
    cores, spans, k = [], [], 0
    inside = sorted((a, b) for _, a, b in base)
    for m in WORD.finditer(text):
        core = m[0].strip(EDGES)
        if is_term(core):
            x = text.index(core, m.start())
            y = x + len(core)
            while k < len(inside) and inside[k][1] <= x:
                k += 1
            if not any(p < y and x < q for p, q in inside[k : k + len(KINDS) + 1]):
                cores.append(core)
                spans.append((x, y))
    return terms_of(pa.array(cores, pa.string())).to_pylist(), spans


def term_hash(term: str) -> int:
    """Signed, as Spark holds it."""
    return xxhash.xxh64_intdigest(term) - (1 << 63)


def holders(docs: DataFrame, text_col: str) -> DataFrame:
    """row_tag, entities, terms (hashes): the distinct ones of each document that holds an entity."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            found = []
            for tag, text in zip(whole.column(0).to_pylist(), (t.as_py() or "" for t in whole.column(1))):
                if base := entities(text):
                    own = {term_hash(f"{k}:{text[a:b].lower()}") for k, a, b in base}
                    found.append((tag, sorted(own), sorted(map(term_hash, set(words_of(text, base)[0])))))
            lists = [pa.array([x[i] for x in found], pa.list_(pa.int64())) for i in (1, 2)]
            yield pa.record_batch([pa.array([x[0] for x in found], pa.int64()), *lists], names=["row_tag", "entities", "terms"])

    given = docs.select(F.monotonically_increasing_id().alias("row_tag"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(run, "row_tag long, entities array<long>, terms array<long>")


def sketch(terms: DataFrame) -> np.ndarray:
    """A bitmap in which the place of each term is set; other terms can share it. Its size follows the number of terms, up
    to MOST_BITS; it comes to the driver in pieces of 65,536 bits."""
    size = LEAST_BITS
    while size < min(MOST_BITS, BITS_A_TERM * terms.count()):
        size *= 2
    bits = np.zeros(size, dtype=bool)
    place = F.pmod("term", F.lit(size))
    pieces = terms.groupBy(F.shiftright(place, 16).alias("piece")).agg(F.collect_set(place.bitwiseAND(F.lit(0xFFFF)).cast("int")).alias("places"))
    for r in pieces.toLocalIterator():
        bits[(r["piece"] << 16) + np.array(r["places"])] = True
    return np.packbits(bits)


@dataclass
class Words:
    """The words of some texts: the row of each, its term's hash (words that can be no term have one as well), and where
    it starts in its text, in code points."""

    words: pa.Array
    row: np.ndarray
    hashes: np.ndarray
    start: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array, places: bool = True) -> Words:
        texts = pc.fill_null(texts, "")
        parts = pc.ascii_split_whitespace(texts)
        words, row = parts.flatten(), np.repeat(np.arange(len(texts)), np.diff(np.asarray(parts.offsets)))
        real = pc.not_equal(words, "")
        words, row = words.filter(real), row[np.asarray(real)]
        coded = terms_of(pc.utf8_trim(words, characters=EDGES)).dictionary_encode()
        hashes = np.array([term_hash(t) for t in coded.dictionary.to_pylist()], dtype=np.int64)
        hashes = hashes[np.asarray(coded.indices)] if len(words) else hashes
        return cls(words, row, hashes, starts_of(texts, row) if places else row)

    def spans(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of some words' terms: the words without the marks at their edges."""
        words = self.words.take(pa.array(some))
        left = np.asarray(pc.subtract(pc.utf8_length(words), pc.utf8_length(pc.utf8_ltrim(words, characters=EDGES))), dtype=np.int64)
        start = self.start[some] + left
        return start, start + np.asarray(pc.utf8_length(pc.utf8_trim(words, characters=EDGES)), dtype=np.int64)


def starts_of(texts: pa.Array, row: np.ndarray) -> np.ndarray:
    """Where each word starts in its text, in code points; row: the text of each word."""
    if not len(row):
        return np.zeros(0, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets -= offsets[0]
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    first = ~space
    first[1:] &= space[:-1] | edge[1:-1]
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return points[np.flatnonzero(first)] - points[offsets[row]]


def detect(docs: DataFrame, id_col: str, text_col: str, bitmap: np.ndarray, carry: list[Column] = ()) -> DataFrame:
    """row_tag, doc_id, base (the entities' spans), near (words that may be disclosing terms, outside of the entities: all
    of a text with an entity, and those of other texts that the bitmap may hold), and what is carried."""
    small_batches(docs.sparkSession)
    given = docs.select(F.monotonically_increasing_id().alias("row_tag"), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *carry)
    extra = given.schema.fields[3:]
    types = given.limit(0).select(F.lit(None).cast(SPAN).alias("base"), F.lit(None).cast(NEAR).alias("near")).schema
    schema = T.StructType([*given.schema.fields[:2], *types.fields, *extra])
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, bits = 8 * len(shared.value), shared.value  # packed as it is: a task holds no more
        for whole in batches:
            for at, n in slices(whole.column(2)):
                batch = whole.slice(at, n)
                bases = [entities(t.as_py() or "") for t in batch.column(2)]
                words = Words.of(batch.column(2))
                place = words.hashes % size
                inside = np.array([bool(found) for found in bases], dtype=bool)[words.row]
                some = np.flatnonzero(inside | (bits[place >> 3] >> (7 - (place & 7)) & 1).astype(bool))
                start, end = words.spans(some)
                free = outside(words.row[some], start, end, bases)
                row, fields = words.row[some][free], [words.hashes[some], start, end]
                ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]).astype(np.int32))
                near = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([pa.array(f[free]) for f in fields], ["term", "start", "end"]))
                base = pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in found] for found in bases], span)
                yield pa.record_batch([batch.column(0), batch.column(1), base, near, *batch.columns[3:]], names=schema.names)

    return given.mapInArrow(run, schema)


def outside(row: np.ndarray, start: np.ndarray, end: np.ndarray, bases: list[list[tuple[str, int, int]]]) -> np.ndarray:
    """Which spans, in order of row, overlap no entity of their row."""
    free = np.ones(len(row), dtype=bool)
    for i in (i for i, base in enumerate(bases) if base):
        a, b = np.searchsorted(row, [i, i + 1])
        for _, x, y in bases[i]:
            free[a:b] &= (end[a:b] <= x) | (start[a:b] >= y)
    return free


def document_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """term (hashed), t: the documents of the whole corpus that hold the term anywhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            texts = whole.column(0)
            for at, n in slices(texts):
                words = Words.of(texts.slice(at, n), places=False)
                terms, number = np.unique(words.hashes, return_inverse=True)
                once = np.unique(words.row * max(1, len(terms)) + number) % max(1, len(terms))
                yield pa.record_batch([pa.array(terms), pa.array(np.bincount(once, minlength=len(terms)))], names=["term", "t"])

    return docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "term long, t long").groupBy("term").agg(F.sum("t").alias("t"))


def disclosing(held: DataFrame, counts: DataFrame, n_docs: int) -> DataFrame:
    """term, chance (the largest, of an entity given the term), elsewhere (whether a document without any entity has the
    term): the terms at or above the lower threshold. held: the stored result of holders; counts: of document_counts.

    No pair is left out that can reach the threshold. It takes t + 1 <= 2 * (et + 1), and et is e at most, so of each
    document only the terms that are rare enough for its entities are paired with them. Entities that no other document
    has are alike, with one and the same e and et, and are one entity here. What is left is joined by document.
    """
    own = held.select("row_tag", F.explode("entities").alias("entity"))
    having = own.groupBy("entity").agg(F.count(F.lit(1)).alias("e")).where(F.col("e") < n_docs)
    own = own.join(having, "entity")
    single = F.when(F.col("e") > 1, F.col("entity"))  # null for those of one document
    own = store(own.groupBy("row_tag", single.alias("entity")).agg(F.first("e").alias("e")), "pii-entities")
    most = own.groupBy("row_tag").agg(F.max("e").alias("most"))
    terms = held.select("row_tag", F.explode("terms").alias("term")).join(counts, "term")
    rare = store(terms.join(most, "row_tag").where(F.col("t") <= 2 * F.col("most") + 1).select("row_tag", "term", "t"), "pii-rare")
    holding = rare.groupBy("term").agg(F.count(F.lit(1)).alias("h"), F.first("t").alias("t"))
    # of entities with one document each, a term's pairs are alike, and et is 1 in all of them
    joint = rare.join(own, "row_tag").groupBy("entity", "term").agg(F.first("e").alias("e"), F.first("t").alias("t"), F.count(F.lit(1)).alias("_n"))
    joint = joint.withColumn("et", F.when(F.col("entity").isNull(), F.lit(1)).otherwise(F.col("_n")))
    chance = (F.col("et") + F.col("e") / F.lit(float(n_docs))) / (F.col("t") + 1)
    told = joint.where(F.col("et") >= COVER * F.col("e")).select("term", chance.alias("chance")).where(F.col("chance") >= GENERALISE)
    return told.groupBy("term").agg(F.max("chance").alias("chance")).join(holding, "term").select("term", "chance", (F.col("t") > F.col("h")).alias("elsewhere"))


def label(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[Column] = ()) -> DataFrame:
    """One row per document: doc_id, base (entities), terms (start, end, removed: if not, generalised), and what is asked
    to carry.

    A disclosing term is marked wherever it stands, in any document. Null and empty texts have no spans. Repeated rows
    count as documents of their own. Statistics are those of the whole table; in an empty one there are none, and no
    rows.
    """
    held = store(holders(docs, text_col), "pii-holders")
    shares = store(disclosing(held, document_counts(docs, text_col), docs.count()), "pii-disclosing")
    found = store(detect(docs, id_col, text_col, sketch(shares.where("elsewhere")), carry), "pii-found")
    at = found.select("row_tag", F.explode("near").alias("near")).select("row_tag", "near.*").join(shares, "term")
    spans = at.groupBy("row_tag").agg(F.sort_array(F.collect_list(F.struct("start", "end", (F.col("chance") >= REMOVE).alias("removed")))).alias("terms"))
    return found.drop("near").join(spans, "row_tag", "left").withColumn("terms", F.coalesce("terms", F.array().cast("array<struct<start: long, end: long, removed: boolean>>"))).drop("row_tag")


def general(term: str) -> str:
    """What stands for a generalised term: for a number the range of its leading digit, else what its letters show."""
    if term.isdecimal():
        low = int(term[0]) * 10 ** (len(term) - 1)
        return f"[{low}-{low + 10 ** (len(term) - 1) - 1}]"
    if any(c.isdigit() for c in term):
        return "[CODE]"
    if len(term) > 1 and term.isupper():
        return "[ACRONYM]"
    return "[NAME]" if term[:1].isupper() else "[WORD]"


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with column clean_text: entities replaced by their kind in brackets, generalised terms by what general() makes
    of them, removed terms gone; null stays null."""
    marked = label(docs, id_col, text_col, [F.col(text_col).alias("_text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")])

    def clean(text: str | None, base, terms) -> str | None:
        if text is None:
            return None
        last = len(text)
        cuts = [(s["start"], s["end"], f"[{s['kind'].upper()}]") for s in base] + [(s["start"], s["end"], "" if s["removed"] else general(text[s["start"] : s["end"]])) for s in terms]
        out = []
        for start, end, new in sorted(cuts, reverse=True):
            if end <= last:  # of overlapping spans the later one stands, and the earlier is cut up to it
                out += [text[end:last], new]
            else:
                out += [new] if start < last else []
            last = min(last, start)
        return text[:last] + "".join(reversed(out))

    @F.pandas_udf("string")
    def cleaned(text, base, terms):
        return text.combine(base, lambda t, b: (t, b)).combine(terms, lambda tb, s: clean(tb[0], tb[1], s))

    return marked.select("_row.*", cleaned("_text", "base", "terms").alias("clean_text"))

"""Language-model scores by masked pseudo-likelihood.

A window network, trained in numpy, predicts every token from the two tokens before and the two after it. A document's
score is the sum of the log-probabilities of all its words, each given its neighbours on both sides.

What is gathered from the corpus grows with it: Spark counts all words, and windows, a word between its two neighbours.
The most frequent words are the network's tokens; other words share a token with those of their shape, and pay for their
spelling besides, so no word is free. The network's probability is the prior of a window's own counts: a word that stands
elsewhere between the same neighbours is likely there, as the occurrence that is scored is left out. Windows of every
pair of neighbours are counted, in all documents; where the counts know nothing the network decides alone. They are
counted in sorted, compact filters (bilinea/llm/quotient.py): documents are cut into shards of about a million words, each
counts its own windows, filters are merged slice by slice, and what comes back to a shard is two small numbers for each
of its windows, in their order.

The network is learned from all texts. Documents are dealt to replicas by a hash, not by how the input happens to be
cut; each replica trains on all its words from the same start, and Spark averages the replicas by the words they saw.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bilinea.functions.storage import new_path
from bilinea.llm.common import slices, small_batches, store
from bilinea.llm.quotient import Filter, firsts, merged, planes, squeeze, unplanes, unsqueeze

#: The network's tokens: CLASSES classes of as many. The most frequent words have a token each; all other words share
#: those of the last class by their shape.
CLASSES = 32
SIZE = CLASSES * CLASSES
FREQUENT = SIZE - CLASSES
#: Stands beyond a text's ends.
PAD = SIZE
#: Where the context tokens stand, and the hidden units.
CONTEXT, HIDDEN = (-2, -1, 1, 2), 16
#: Tokens in a step of training, the step length, and the words of a replica, about.
BATCH, RATE, REPLICA = 8192, 0.15, 1_000_000
#: What the network's probability counts for beside a window's counts.
PRIOR = 2.0
#: Bits by which windows know their pair of neighbours; 32 more tell the word between them. Two of the 10^13 pairs of 100 TB
#: are mistaken for one about once in 450.
CONTEXT_BITS = 52
#: Words of a shard, and windows of a slice, about; slices are two to this power at least.
SHARD, SLICE, SLICE_BITS = 1 << 20, 1 << 20, 4
#: The sign before a word's first byte and after its last, among the bytes.
EDGE = 256
SIGNS = EDGE + 1
SHAPES = {"table": (len(CONTEXT), SIZE + 1, HIDDEN), "hidden_bias": (HIDDEN,), "class_w": (HIDDEN, CLASSES), "class_b": (CLASSES,), "token_w": (CLASSES, HIDDEN, CLASSES), "token_b": (CLASSES, CLASSES)}


class Network:
    """p(token | context) = p(class | context) * p(token | class, context), each a softmax over tanh units."""

    def __init__(self, flat: np.ndarray | None = None, seed: int = 5) -> None:
        total = sum(int(np.prod(s)) for s in SHAPES.values())
        if flat is None:
            flat = np.random.default_rng(seed).standard_normal(total) * 0.1
        self.flat = flat.astype(np.float32)
        self.p = self.parts(self.flat)

    @staticmethod
    def parts(flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in SHAPES.items():
            n = int(np.prod(shape))
            out[name] = flat[at : at + n].reshape(shape)
            at += n
        return out

    def hidden(self, context: np.ndarray) -> np.ndarray:
        h = self.p["table"][0].take(context[0], axis=0)
        for table, ids in zip(self.p["table"][1:], context[1:]):
            h += table.take(ids, axis=0)
        h += self.p["hidden_bias"]
        return np.tanh(h, out=h)

    def log_prob(self, context: np.ndarray, target: np.ndarray, grads: dict[str, np.ndarray] | None = None) -> np.ndarray:
        """The log-probability of each target; with grads, the sum over all of them is differentiated into it.

        context: (4, n), target: (n). Targets are taken by class, so that each class is one matrix product.
        """
        p, n = self.p, len(target)
        order = np.argsort(target, kind="stable")
        inside = target[order] % CLASSES
        edges = np.searchsorted(target[order], np.arange(CLASSES + 1) * CLASSES)
        h = self.hidden(context[:, order])
        rows = np.arange(n)
        scores = p["class_w"].T @ h.T
        scores += p["class_b"][:, None]
        logp, share = pick(scores, np.repeat(np.arange(CLASSES), np.diff(edges)), rows, grads is not None)
        d_h = None
        if grads is not None:
            grads["class_w"] += h.T @ share.T
            grads["class_b"] += share.sum(axis=1)
            d_h = share.T @ p["class_w"].T
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            if a == b:
                continue
            scores = p["token_w"][k].T @ h[a:b].T
            scores += p["token_b"][k][:, None]
            own, share = pick(scores, inside[a:b], rows[: b - a], grads is not None)
            logp[a:b] += own
            if grads is not None:
                grads["token_w"][k] += h[a:b].T @ share.T
                grads["token_b"][k] += share.sum(axis=1)
                d_h[a:b] += share.T @ p["token_w"][k].T
        if grads is not None:
            d_h *= 1 - h * h
            grads["hidden_bias"] += d_h.sum(axis=0)
            columns = np.ascontiguousarray(d_h.T)
            for i in range(len(CONTEXT)):
                ids = context[i][order]
                for unit in range(HIDDEN):
                    grads["table"][i, :, unit] += np.bincount(ids, columns[unit], minlength=SIZE + 1)
        out = np.empty(n, dtype=np.float32)
        out[order] = logp
        return out

    def train(self, context: np.ndarray, target: np.ndarray, squares: np.ndarray) -> None:
        """One step of Adagrad towards more likely targets; squares: the sums of squared gradients so far."""
        flat = np.zeros_like(self.flat)
        self.log_prob(context, target, self.parts(flat))
        flat /= len(target)
        squares += flat * flat
        flat /= np.sqrt(squares) + 1e-6
        flat *= RATE
        self.flat += flat


def pick(scores: np.ndarray, chosen: np.ndarray, rows: np.ndarray, want: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Log-softmax along axis 0 at the chosen places, and its gradient by the scores if wanted."""
    scores -= scores.max(axis=0)
    at = scores[chosen, rows]
    np.exp(scores, out=scores)
    total = scores.sum(axis=0)
    logp = at - np.log(total)
    if not want:
        return logp, None
    scores /= -total
    scores[chosen, rows] += 1
    return logp, scores


# Words


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, as they are written, and the row of each."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    found = parts.flatten()
    row = np.repeat(np.arange(len(texts)), np.diff(np.asarray(parts.offsets)))
    real = pc.not_equal(found, "")
    return found.filter(real), row[np.asarray(real)]


def raw(found: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all words, and where each word starts and the last one ends."""
    if not len(found):
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    offsets = np.frombuffer(found.buffers()[1], np.int32)[found.offset : found.offset + len(found) + 1].astype(np.int64)
    return np.frombuffer(found.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].astype(np.int64), offsets - offsets[0]


def shapes(found: pa.Array) -> np.ndarray:
    """0 to 31 for each word: whether it starts with a capital, how it ends (letter or digit, comma, full stop, other
    mark), and how long it is."""
    data, at = raw(found)
    if not len(found):
        return np.zeros(0, np.int64)
    first, last, second = data[at[:-1]], data[at[1:] - 1], data[np.minimum(at[:-1] + 1, at[1:] - 1)]
    capital = ((first >= 65) & (first <= 90)) | ((first == 0xC3) & (second >= 0x80) & (second <= 0x9E))
    letter = (last >= 128) | ((last >= 48) & (last <= 57)) | ((last | 32) >= 97) & ((last | 32) <= 122)
    end = np.select([letter, last == ord(","), last == ord(".")], [0, 1, 2], 3)
    return 16 * capital + 4 * end + np.searchsorted([3, 6, 9], np.diff(at))


def spelled(found: pa.Array) -> np.ndarray:
    """For each word's bytes and its end, in order: the place of (byte before, byte) in a table of pairs."""
    data, at = raw(found)
    n = len(found)
    signs = np.insert(data, at[1:], EDGE)  # each word followed by an edge
    before = np.concatenate([[EDGE], signs[:-1]]) if n else signs
    return before * SIGNS + signs


@dataclass
class Model:
    """frequent: words with a token of their own. weights: the network's. pairs: log-probability of each pair of bytes,
    given the first, in the other words. shares: log of the part that each shape has of their occurrences. parts: the
    corpus in shards, whose windows are counted when documents are scored, in slices of so many bits."""

    frequent: list[str]
    weights: np.ndarray
    pairs: np.ndarray
    shares: np.ndarray
    parts: DataFrame | None = None
    slice_bits: int = SLICE_BITS


def tokens(texts: pa.Array, frequent: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray, np.ndarray]:
    """The words, coded; the token of each, its context (4, n), and its row."""
    found, row = split(texts)
    coded = found.dictionary_encode()
    token = token_of(coded, frequent)
    return coded, token, contexts(token, row), row


def token_of(coded: pa.DictionaryArray, frequent: pa.Array) -> np.ndarray:
    ids = np.asarray(pc.fill_null(pc.index_in(coded.dictionary, value_set=frequent), -1))
    ids = np.where(ids < 0, FREQUENT + shapes(coded.dictionary), ids)
    return ids[np.asarray(coded.indices)].astype(np.intp) if len(coded) else np.zeros(0, np.intp)


def contexts(token: np.ndarray, row: np.ndarray) -> np.ndarray:
    return np.stack([beside(token, row, d, PAD) for d in CONTEXT])


def beside(values: np.ndarray, row: np.ndarray, d: int, beyond) -> np.ndarray:
    """What stands d places further in the same row."""
    out = np.full_like(values, beyond)
    here, there = (slice(-d, None), slice(None, d)) if d < 0 else (slice(None, -d), slice(d, None))
    out[here] = np.where(row[here] == row[there], values[there], beyond)
    return out


def window_filter(own: np.ndarray, row: np.ndarray) -> tuple[Filter, np.ndarray]:
    """The filter of all windows of some texts and the place of each word's window in it. own: a hash of each word; row: the
    text of each."""
    mix = lambda x, y: (x * np.uint64(0x9E3779B97F4A7C15) ^ (x >> np.uint64(29))) + y * np.uint64(0xC2B2AE3D27D4EB4F)
    context = mix(beside(own, row, -1, 0), beside(own, row, 1, 0))
    context = (context ^ (context >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)  # its leading bits part the slices
    return Filter.of(context >> np.uint64(64 - CONTEXT_BITS), mix(context, own) >> np.uint64(32), CONTEXT_BITS, even=True)


def unknown(coded: pa.DictionaryArray, token: np.ndarray, model: Model) -> np.ndarray:
    """The log-probability of each word given its token: none for frequent words, for others that of the spelling among
    those of the shape."""
    if not len(token):
        return np.zeros(0)
    _, at = raw(coded.dictionary)
    starts = at[:-1] + np.arange(len(coded.dictionary))
    spelling = np.add.reduceat(model.pairs[spelled(coded.dictionary)], starts)
    spelling = spelling - model.shares[shapes(coded.dictionary)]
    return np.where(token >= FREQUENT, np.minimum(0, spelling)[np.asarray(coded.indices)], 0.0)


def each_slice(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at, n in slices(whole.column(column)):
            yield whole.slice(at, n)


# Spark


class Shard:
    """Documents as numbers of their words."""

    def __init__(self) -> None:
        self.codes: dict[str, int] = {}
        self.ids: list[pa.Array] = []
        self.places: list[pa.Array] = []
        self.sizes: list[np.ndarray] = []
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, ids: pa.Array, texts: pa.Array, places: pa.Array) -> None:
        found, row = split(texts)
        coded = found.dictionary_encode()
        numbers = np.array([self.codes.setdefault(w, len(self.codes)) for w in coded.dictionary.to_pylist()], dtype=np.int64)
        self.parts.append(numbers[np.asarray(coded.indices)] if len(found) else numbers)
        self.sizes.append(np.bincount(row, minlength=len(texts)))
        self.ids.append(ids)
        self.places.append(places)
        self.size += len(found)

    def row(self, number: int) -> pa.RecordBatch:
        """Words are numbered anew, the frequent ones first."""
        codes, words = np.concatenate(self.parts), list(self.codes)
        order = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
        again = np.empty(len(words), dtype=np.int64)
        again[order] = np.arange(len(words))
        text = b"\n".join(words[i].encode() for i in order.tolist())  # no word has a line end
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        sizes, whole = pa.array(np.concatenate(self.sizes).astype(np.int32)), [squeeze(planes(again[codes])), squeeze(text)]
        return pa.record_batch([pa.array([number]), one(pa.concat_arrays(self.ids)), one(pa.concat_arrays(self.places)), one(sizes), *(pa.array([w], pa.binary()) for w in whole)], names=["shard", "ids", "places", "sizes", "codes", "words"])


def shards(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """shard, ids, places (a hash) and sizes (in words) of its documents, codes (of all their words, one after the other),
    words."""
    small_batches(docs.sparkSession)
    text = F.col(text_col).cast("string")
    given = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(F.col(id_col).cast("string"), text).alias("place"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = Shard(), TaskContext.get().partitionId() << 32
        for part in each_slice(batches, 1):
            shard.add(*part.columns)
            if shard.size >= SHARD:
                yield shard.row(number)
                shard, number = Shard(), number + 1
        if shard.ids:
            yield shard.row(number)

    return given.mapInArrow(run, f"shard long, ids array<{given.schema['doc_id'].dataType.simpleString()}>, places array<long>, sizes array<int>, codes binary, words binary")


def store_by_shard(parts: DataFrame) -> DataFrame:
    """The shards, stored in buckets, so that what comes back to a shard is joined to it and the shard itself stays."""
    spark = parts.sparkSession
    n, path = int(spark.conf.get("spark.sql.shuffle.partitions")), new_path(spark, "lm-shards")
    name = f"lm_shards_{uuid.uuid4().hex}"
    parts.write.bucketBy(n, "shard").option("path", path).saveAsTable(name)
    return spark.table(name)


def opened(sizes: pa.ListScalar, codes: bytes, words: bytes) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of a shard, coded, and the row of each."""
    numbers, text = unplanes(unsqueeze(codes))[0].astype(np.int32), unsqueeze(words)
    known = pa.array(text.split(b"\n") if text else [], pa.binary()).cast(pa.string())
    n = np.asarray(sizes.values)
    return pa.DictionaryArray.from_arrays(pa.array(numbers), known), np.repeat(np.arange(len(n)), n)


def hashed(coded: pa.DictionaryArray) -> np.ndarray:
    own = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], dtype=np.uint64)
    return own[np.asarray(coded.indices)] if len(own) else own


def word_counts(parts: DataFrame) -> DataFrame:
    """word, n: how often each word occurs in the whole corpus. Shards are counted in Python, the rest by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sizes, codes, words in zip(*batch.columns):
                coded, _ = opened(sizes, codes.as_py(), words.as_py())
                n = np.bincount(np.asarray(coded.indices), minlength=len(coded.dictionary))
                yield pa.record_batch([coded.dictionary, pa.array(n)], names=["word", "n"])

    return parts.select("sizes", "codes", "words").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def filters(parts: DataFrame, slice_bits: int, counts: bool) -> DataFrame:
    """shard, slice, counts, filter: the windows of each shard, slice by slice."""
    schema = pa.schema([("shard", pa.int64()), ("slice", pa.int32()), ("counts", pa.bool_()), ("filter", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, sizes, codes, words in zip(*batch.columns):
                coded, row = opened(sizes, codes.as_py(), words.as_py())
                found, _ = window_filter(hashed(coded), row)
                edges = found.slices(slice_bits)
                there = np.flatnonzero(np.diff(edges)).tolist()
                cut = [found.packed(slice_bits, int(edges[s]), int(edges[s + 1])) for s in there]
                yield pa.record_batch([pa.array([shard.as_py()] * len(there), pa.int64()), pa.array(there, pa.int32()), pa.array([counts] * len(there), pa.bool_()), pa.array(cut, pa.binary())], schema=schema)

    return parts.select("shard", "sizes", "codes", "words").mapInArrow(run, "shard long, slice int, counts boolean, filter binary")


def counted(cut: DataFrame, slice_bits: int, own: bool) -> DataFrame:
    """shard, slice, counts: for each window of a shard's slice, in order, how often it is counted and how often its context.
    own: the shards' windows are those that are counted; otherwise those of the rows that say so, which get no answer."""
    out = pa.schema([("shard", pa.int64()), ("slice", pa.int32()), ("counts", pa.binary())])

    def together(slice_: int, rows: list[tuple[int, bool, bytes]]) -> pa.RecordBatch:
        each = [Filter.unpacked(data, slice_bits, slice_) for _, _, data in rows]
        for (_, counts, _), f in zip(rows, each):
            f.counts = f.counts if counts else np.zeros_like(f.counts)
        total, places = merged(each)
        first = firsts(total.left, np.zeros_like(total.left))
        sums = np.repeat(np.add.reduceat(total.counts, first), np.diff(np.append(first, len(total.left)))) if len(first) else total.counts
        asked = [k for k, (_, counts, _) in enumerate(rows) if own or not counts]
        answers = [squeeze(planes(total.counts[places[k]]) + planes(sums[places[k]])) for k in asked]
        return pa.record_batch([pa.array([rows[k][0] for k in asked], pa.int64()), pa.array([slice_] * len(asked), pa.int32()), pa.array(answers, pa.binary())], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            for shard, slice_, counts, data in zip(*(c.to_pylist() for c in batch.columns)):
                if slice_ != now and rows:
                    yield together(now, rows)
                    rows = []
                now = slice_
                rows.append((shard, counts, data))
        if rows:
            yield together(now, rows)

    sliced = cut.repartition(1 << slice_bits, "slice").sortWithinPartitions("slice", "counts", "shard")
    return sliced.mapInArrow(run, "shard long, slice int, counts binary")


def spelling(words: DataFrame, frequent: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs and shares of a model, from all words but the frequent ones; words: word, n. What reaches the driver is
    a number for each pair of bytes and each shape."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = pa.array(frequent, pa.string()), np.zeros(SIGNS * SIGNS + CLASSES)
        for batch in batches:
            rare = pc.invert(pc.is_in(batch.column(0), value_set=known))
            found, n = batch.column(0).filter(rare), np.asarray(batch.column(1).filter(rare), dtype=float)
            counts[: SIGNS * SIGNS] += np.bincount(spelled(found), minlength=SIGNS * SIGNS)
            counts[SIGNS * SIGNS :] += np.bincount(shapes(found), n, minlength=CLASSES)
        there = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(there), pa.array(counts[there])], names=["place", "n"])

    counts = np.zeros(SIGNS * SIGNS + CLASSES)
    for r in words.select("word", "n").mapInArrow(run, "place long, n double").groupBy("place").agg(F.sum("n").alias("n")).collect():
        counts[r["place"]] = r["n"]
    pairs = counts[: SIGNS * SIGNS].reshape(SIGNS, SIGNS) + 0.1
    shares = counts[SIGNS * SIGNS :] + 0.1
    return np.log(pairs / pairs.sum(axis=1, keepdims=True)).ravel(), np.log(shares / shares.sum())


def learn(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> Model:
    """A model of all texts. What reaches the driver is FREQUENT words and a number for each weight, pair of bytes and
    shape, whatever the corpus; all other counts stay tables. An empty corpus gives the network as it starts."""
    parts = store_by_shard(shards(docs, id_col, text_col))
    words = store(word_counts(parts), "lm-words")
    # stored first: the words of all partitions meet in a task then, not in the driver
    top = store(words.orderBy(F.desc("n"), "word").limit(FREQUENT), "lm-frequent")
    frequent = [r["word"] for r in top.orderBy(F.desc("n"), "word").collect()]
    pairs, shares = spelling(words, frequent)
    total = words.agg(F.sum("n")).first()[0] or 0

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(frequent, pa.string())
        for batch in batches:
            for places, sizes, codes, text in zip(*batch.columns):
                found, _ = opened(sizes, codes.as_py(), text.as_py())
                at, small = np.concatenate([[0], np.cumsum(np.asarray(sizes.values))]), token_of(found, known).astype(np.uint16)
                yield pa.record_batch([places.values, pa.array([squeeze(small[x:y].tobytes()) for x, y in zip(at[:-1], at[1:])], pa.binary())], names=["place", "tokens"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, seen = Network(), 0
        squares = np.full_like(network.flat, 1e-4)
        for batch in batches:
            texts = [np.frombuffer(unsqueeze(t.as_py()), np.uint16) for t in batch.column(0)]
            token = np.concatenate([np.zeros(0, np.intp), *texts])
            context = contexts(token, np.repeat(np.arange(len(texts)), [len(t) for t in texts]))
            for at in range(0, len(token), BATCH):
                network.train(context[:, at : at + BATCH], token[at : at + BATCH], squares)
            seen += len(token)
        if seen:
            weight = pa.array(np.full(len(network.flat), float(seen)))
            yield pa.record_batch([pa.array(np.arange(len(network.flat), dtype=np.int32)), pa.array(network.flat.astype(np.float64) * seen), weight], names=["place", "value", "weight"])

    dealt = parts.select("places", "sizes", "codes", "words").mapInArrow(coded, "place long, tokens binary").repartition(max(1, -(-total // REPLICA)), "place").sortWithinPartitions("place").select("tokens")
    replicas = dealt.mapInArrow(run, "place int, value double, weight double")
    mean = replicas.groupBy("place").agg((F.sum("value") / F.sum("weight")).alias("value"))
    flat = Network().flat.astype(np.float64)
    for r in mean.collect():
        flat[r["place"]] = r["value"]
    slice_bits = max(SLICE_BITS, (int(total) // SLICE).bit_length())
    return Model(frequent, flat, pairs, shares, parts, slice_bits)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", seen: bool = True) -> DataFrame:
    """One row per document: doc_id, n_tokens, log_prob (the sum over all words), mean_log_prob.

    seen: the model was learned from these documents, which are not read again then, and each occurrence of a window is
    judged by the others. Otherwise all documents of the model count.
    Texts that are null or have no word have no tokens and null scores. Repeated rows are scored each; other columns are
    not read; an empty table gives no rows.
    """
    parts, bits = model.parts if seen else store_by_shard(shards(docs, id_col, text_col)), model.slice_bits
    cut = filters(parts, bits, seen)
    told = store(counted(cut if seen else cut.unionByName(filters(model.parts, bits, True)), bits, seen), "lm-counts")
    answers = told.groupBy("shard").agg(F.collect_list(F.struct("slice", "counts")).alias("answers"))  # a shard's slices
    known, less = Model(model.frequent, model.weights, model.pairs, model.shares), 1 if seen else 0
    id_type = parts.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, network = pa.array(known.frequent, pa.string()), Network(known.weights)
        for batch in batches:
            for ids, sizes, codes, words, own in zip(*batch.columns):
                coded, row = opened(sizes, codes.as_py(), words.as_py())
                found, place = window_filter(hashed(coded), row)
                edges, n, total = found.slices(bits), np.zeros(len(found.left)), np.zeros(len(found.left))
                for s, data in zip(own.values.field(0).to_pylist(), own.values.field(1).to_pylist()) if own.is_valid else ():
                    data = unsqueeze(data)
                    n[edges[s] : edges[s + 1]], after = unplanes(data)
                    total[edges[s] : edges[s + 1]] = unplanes(data, after)[0]
                token = token_of(coded, frequent)
                context = contexts(token, row)
                logp = [network.log_prob(context[:, a : a + 4 * BATCH], token[a : a + 4 * BATCH]) for a in range(0, len(token), 4 * BATCH)]
                logp = np.concatenate([np.zeros(0), *logp]) + unknown(coded, token, known)
                logp = np.log((np.maximum(n[place] - less, 0) + PRIOR * np.exp(logp)) / (np.maximum(total[place] - less, 0) + PRIOR))
                sums = np.bincount(row, logp, minlength=len(ids.values)).astype(float)
                yield pa.record_batch([ids.values, pa.array(np.asarray(sizes.values).astype(np.int64)), pa.array(sums)], names=["doc_id", "n_tokens", "log_prob"])

    found = parts.join(answers, "shard", "left").select("ids", "sizes", "codes", "words", "answers").mapInArrow(run, f"doc_id {id_type}, n_tokens long, log_prob double")
    some = F.when(F.col("n_tokens") > 0, F.col("log_prob")).alias("log_prob")
    return found.select("doc_id", "n_tokens", some).withColumn("mean_log_prob", F.col("log_prob") / F.col("n_tokens"))

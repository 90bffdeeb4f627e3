"""Language identification: a bidirectional gated recurrent network over bytes.

One recurrent layer reads a window of bytes forwards, one backwards; at every byte the two states give a distribution
over the languages, and a document's label pools those of all its bytes. The network is trained in numpy by
backpropagation through time on windows of a bounded, documented sample of labelled documents. Prediction reads every
byte of every text: texts are cut into windows of fixed length that start from a zero state, so a task's memory does
not depend on a text's length, and many windows are stepped through together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bilinea.llm.common import slices, small_batches

#: Bytes in a window, and windows stepped through together.
LENGTH, TOGETHER = 64, 2048
#: Units in each direction.
UNITS = 8
#: The bounded sample that is learned from: so many documents of each language, and so many windows of LENGTH bytes of each.
DOCS_PER_LANGUAGE, WINDOWS_PER_DOC = 400, 4
SPARE = 4
#: More languages than this are refused: the sample, the network's last layer and its output grow with them.
MOST_LANGUAGES = 1000
EPOCHS, BATCH, RATE = 6, 64, 0.02
#: The label of texts without a letter.
NONE = "und"


@dataclass
class Model:
    """languages, and for each direction: table (byte -> gate inputs), u (state -> gates); w, b: states -> languages.

    Gate inputs are ordered reset, update, candidate. Reset and update tables and weights hold half the usual values:
    sigmoid(x) = (1 + tanh(x / 2)) / 2, so one tanh does for both.
    """

    languages: list[str]
    table: list[np.ndarray]
    u: list[np.ndarray]
    w: np.ndarray
    b: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [*self.table, *self.u, self.w, self.b]


def new_model(languages: list[str], units: int = UNITS, seed: int = 7) -> Model:
    r = np.random.default_rng(seed)
    make = lambda *shape: (r.standard_normal(shape) * 0.3).astype(np.float32)
    return Model(languages, [make(257, 3 * units) for _ in range(2)], [make(units, 3 * units) for _ in range(2)], make(2 * units, len(languages)), np.zeros(len(languages), np.float32))


def states(model: Model, windows: np.ndarray, direction: int, keep: list | None = None) -> np.ndarray:
    """States after each byte, (length, windows, units); windows: (length, windows), 256 where there is no byte.

    keep collects what the way back needs. Each gate has arrays of its own, so that all of them are contiguous. Where there
    is no byte the state stays zero, so what a window is stepped through with does not matter.
    """
    length, n = windows.shape
    units = model.u[0].shape[0]
    gates = [slice(k * units, (k + 1) * units) for k in range(3)]
    tables = [np.ascontiguousarray(model.table[direction][:, k]) for k in gates]
    ur, uz, uc = (np.ascontiguousarray(model.u[direction][:, k]) for k in gates)
    out = np.empty((length, n, units), model.w.dtype)
    h = np.zeros((n, units), model.w.dtype)
    real = windows < 256
    real = None if real.all() else real[:, :, None]
    for t in range(length) if direction == 0 else range(length - 1, -1, -1):
        r, z, c = (x.take(windows[t], axis=0) for x in tables)
        for gate, u in ((r, ur), (z, uz)):
            gate += h @ u
            np.tanh(gate, out=gate)
            gate += 1
            gate *= 0.5
        rh = r * h
        c += rh @ uc
        np.tanh(c, out=c)
        if keep is not None:
            keep.append((t, h, r, z, c, rh))
        new = np.subtract(h, c, out=out[t])
        new *= z
        new += c
        if real is not None:
            new *= real[t]
        h = new
    return out


def log_softmax(logits: np.ndarray, axis: int) -> np.ndarray:
    logits -= logits.max(axis=axis, keepdims=True)
    logits -= np.log(np.exp(logits).sum(axis=axis, keepdims=True))
    return logits


def backward(model: Model, windows: np.ndarray, direction: int, keep: list, d_states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Backpropagation through time: gradients of the direction's table and u."""
    units = model.u[0].shape[0]
    u, d_table, d_u = model.u[direction], np.zeros_like(model.table[direction]), np.zeros_like(model.u[direction])
    d_h = np.zeros_like(keep[0][1])
    for t, h, r, z, c, rh in reversed(keep):
        d_h = (d_h + d_states[t]) * (windows[t] < 256)[:, None]
        d_z = d_h * (h - c)
        d_c = d_h * (1 - z) * (1 - c * c)
        d_rh = d_c @ u[:, 2 * units :].T
        d_r = d_rh * h
        # the derivative of (1 + tanh(a)) / 2
        d_x = np.concatenate([d_r * 2 * r * (1 - r), d_z * 2 * z * (1 - z), d_c], axis=1)
        np.add.at(d_table, windows[t], d_x)
        d_u[:, : 2 * units] += h.T @ d_x[:, : 2 * units]
        d_u[:, 2 * units :] += rh.T @ d_c
        d_h = d_h * z + d_rh * r + d_x[:, : 2 * units] @ u[:, : 2 * units].T
    return d_table, d_u


def gradients(model: Model, windows: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss over the labelled positions and the gradients of all parameters; windows (length, n), labels (n)."""
    units = model.u[0].shape[0]
    kept: list[list] = [[], []]
    both = np.concatenate([states(model, windows, d, kept[d]) for d in (0, 1)], axis=2)
    logp = log_softmax(both @ model.w + model.b, -1)
    real = windows < 256
    n = max(1, int(real.sum()))
    loss = -float((np.take_along_axis(logp, np.broadcast_to(labels[None, :, None], (*windows.shape, 1)), 2)[..., 0] * real).sum()) / n
    d = np.exp(logp)
    np.subtract.at(d, (slice(None), np.arange(len(labels)), labels), 1)
    d *= real[..., None] / n
    d = d.astype(model.w.dtype)
    d_w = both.reshape(-1, 2 * units).T @ d.reshape(-1, d.shape[2])
    d_both = d @ model.w.T
    sides = [backward(model, windows, i, kept[i], d_both[:, :, i * units : (i + 1) * units]) for i in (0, 1)]
    return loss, [sides[0][0], sides[1][0], sides[0][1], sides[1][1], d_w, d.sum(axis=(0, 1))]


def fit(examples: list[tuple[bytes, str]], units: int = UNITS, epochs: int = EPOCHS, seed: int = 7) -> Model:
    """examples: windows of bytes and their languages. Adam, with the rate falling to a tenth."""
    languages = sorted({lang for _, lang in examples})
    model = new_model(languages, units, seed)
    if len(languages) < 2:
        return model
    windows = np.full((len(examples), LENGTH), 256, np.int64)
    for i, (data, _) in enumerate(examples):
        windows[i, : len(data)] = np.frombuffer(data, np.uint8)
    labels = np.array([languages.index(lang) for _, lang in examples])
    r = np.random.default_rng(seed)
    first = [np.zeros_like(p) for p in model.parameters()]
    second = [np.zeros_like(p) for p in model.parameters()]
    total, done = epochs * -(-len(examples) // BATCH), 0
    for _ in range(epochs):
        order = r.permutation(len(examples))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            _, grads = gradients(model, windows[some].T, labels[some])
            done += 1
            rate = RATE * (1 - 0.9 * done / total)
            for p, g, m, v in zip(model.parameters(), grads, first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9**done)) / (np.sqrt(v / (1 - 0.99**done)) + 1e-8)
    return model


def predict(model: Model, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mean log-probability of each language over the bytes of each text; data: all bytes, starts and ends: the texts'."""
    size = ends - starts
    count = -(-size // LENGTH)
    of_text = np.repeat(np.arange(len(starts)), count)
    begin = starts[of_text] + (np.arange(len(of_text)) - np.repeat(np.cumsum(count) - count, count)) * LENGTH
    until = np.minimum(begin + LENGTH, ends[of_text])
    sums = np.zeros((len(starts), len(model.languages)))
    units = model.u[0].shape[0]
    # full windows first, so that only the last lots have gaps
    order = np.argsort(begin - until, kind="stable")
    together = max(1, min(TOGETHER, (8 << 20) // (LENGTH * len(model.languages))))
    for at in range(0, len(order), together):
        lot = order[at : at + together]
        longest = int((until[lot] - begin[lot]).max())
        place = begin[lot] + np.arange(longest)[:, None]
        real = place < until[lot]
        windows = np.where(real, data[np.minimum(place, len(data) - 1)].astype(np.intp), 256)
        logits = model.w[:units].T @ states(model, windows, 0).reshape(-1, units).T
        logits += model.w[units:].T @ states(model, windows, 1).reshape(-1, units).T
        logits += model.b[:, None]
        logp = log_softmax(logits, 0).reshape(-1, longest, len(lot))
        if not real.all():
            logp *= real
        for k, pooled in enumerate(logp.sum(axis=1)):
            sums[:, k] += np.bincount(of_text[lot], pooled, minlength=len(starts))
    return sums / np.maximum(size, 1)[:, None]


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_language: int, per_doc: int, most_languages: int) -> list[tuple[bytes, str]]:
    """Training windows: of each language per_language documents by hash, of each per_doc windows spread over its bytes.
    Only these windows come to the driver. Every language is learned; more than most_languages are an error."""
    lang, text = F.col(lang_col), F.col(text_col)
    spark = docs.sparkSession
    labelled = docs.where(lang.isNotNull() & text.isNotNull()).select(lang.alias("lang"), text.cast("binary").alias("data"), F.xxhash64(F.col(id_col), F.lit(11)).alias("h"))
    few = labelled.groupBy("lang").count().limit(most_languages + 1).collect()
    if len(few) > most_languages:
        raise ValueError(f"more than {most_languages} languages: allow more, or group them before training")
    # a language's smallest hashes lie below a bound that leaves several times as many documents as are wanted
    bounds = [(r["lang"], min(1.0, SPARE * per_language / r["count"])) for r in few]
    bound = spark.createDataFrame(bounds, "of string, bound double")
    size = F.octet_length("data")
    spots = F.transform(F.sequence(F.lit(0), F.lit(per_doc - 1)), lambda k: (F.greatest(F.lit(0), size - LENGTH) * k / F.lit(max(1, per_doc - 1))).cast("int"))
    windows = F.array_distinct(F.transform(spots, lambda s: F.substring("data", s + 1, F.lit(LENGTH))))
    near = labelled.join(F.broadcast(bound), F.col("lang") == F.col("of")).where(F.col("h") / 2.0**64 + 0.5 <= F.col("bound"))
    slim = near.select("lang", "h", windows.alias("windows"))
    ranks = Window.partitionBy("lang").orderBy("h", "windows")
    chosen = slim.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= per_language).select("lang", "windows").collect()
    return [(bytes(w), r["lang"]) for r in sorted(chosen, key=lambda r: (r["lang"], r["windows"])) for w in r["windows"] if w]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = DOCS_PER_LANGUAGE, per_doc: int = WINDOWS_PER_DOC, most_languages: int = MOST_LANGUAGES) -> Model:
    """A network for every label that is not null, learned from a bounded sample: at most per_language documents of each
    label, chosen by a hash of their id, and of each at most per_doc windows of LENGTH bytes."""
    return fit(sample(docs, id_col, text_col, lang_col, per_language, per_doc, most_languages))


def label(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: list = ()) -> DataFrame:
    """One row per document: doc_id, lang_pred, score, and what is asked to carry.

    The prediction has the text alone for input. The document's distribution is the softmax of its mean log-probabilities;
    score is the share of the chosen language, and languages that tie are taken in code-point order. A text that is null
    or has no letter is `und` with score 0; so is every text if no language was learned.
    """
    small_batches(docs.sparkSession)
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("letters"), *carry)
    names = ["doc_id", "lang_pred", "score", *[f.name for f in given.schema.fields[3:]]]
    id_type = given.schema["doc_id"].dataType.simpleString()
    schema = ", ".join([f"doc_id {id_type}", "lang_pred string", "score double", *[f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[3:]]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at, n in slices(whole.column(1)):
                batch = whole.slice(at, n)
                texts = pc.fill_null(batch.column(1).cast(pa.string()), "")
                offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
                data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
                letters = np.asarray(batch.column(2)) & bool(model.languages)
                mean = predict(model, data, offsets[:-1], np.where(letters, offsets[1:], offsets[:-1])) if model.languages else np.zeros((n, 1))
                share = np.exp(log_softmax(mean, 1))
                best = share.argmax(axis=1)
                names_of = np.array([*model.languages, NONE], dtype=object)[np.where(letters, best, len(model.languages))]
                score = np.where(letters, share[np.arange(n), best], 0.0)
                yield pa.record_batch([batch.column(0), pa.array(names_of, pa.string()), pa.array(score), *batch.columns[3:]], names=names)

    return given.mapInArrow(run, schema)

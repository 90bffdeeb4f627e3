import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from bilinea.llm import langid, lm
from pyspark.sql import functions as F

DOCS = "/root/testdata/sf0.01/documents.parquet"


def numeric(f, array, place, step=1e-4):
    was = array[place]
    array[place] = was + step
    up = f()
    array[place] = was - step
    down = f()
    array[place] = was
    return (up - down) / (2 * step)


def test_gru_gradients():
    r = np.random.default_rng(1)
    model = langid.new_model(list("abcd"), 5)
    model.table, model.u = [x.astype(float) for x in model.table], [x.astype(float) for x in model.u]
    model.w, model.b = model.w.astype(float), model.b.astype(float)
    windows, labels = r.integers(0, 257, (7, 5)), np.array([0, 1, 2, 3, 0])
    _, grads = langid.gradients(model, windows, labels)
    for parameter, grad in zip(model.parameters(), grads):
        for place in [tuple(x) for x in np.argwhere(np.abs(grad) >= np.sort(np.abs(grad).ravel())[-3])]:
            assert np.isclose(grad[place], numeric(lambda: langid.gradients(model, windows, labels)[0], parameter, place), rtol=1e-3)


def test_window_network_gradients_and_normalisation():
    r = np.random.default_rng(0)
    net = lm.Network()
    net.flat = net.flat.astype(float)
    net.p = net.parts(net.flat)
    context, target = r.integers(0, lm.SIZE + 1, (4, 40)), r.integers(0, lm.SIZE, 40)
    grad = np.zeros_like(net.flat)
    net.log_prob(context, target, net.parts(grad))
    for places in net.parts(np.arange(len(grad)).astype(float)).values():
        at = places.ravel().astype(int)
        at = at[np.abs(grad[at]).argmax()]
        assert np.isclose(grad[at], numeric(lambda: net.log_prob(context, target).astype(float).sum(), net.flat, at, 1e-3), rtol=0.05)
    everything = lm.Network().log_prob(np.repeat(context[:, :1], lm.SIZE, axis=1), np.arange(lm.SIZE))
    assert np.isclose(np.exp(everything).sum(), 1, atol=1e-4)


def test_contexts_end_at_the_text():
    _, token, context, row = lm.tokens(pa.array(["a b c", None, "", " a\tb "]), pa.array(["a", "b", "c"]))
    assert token.tolist() == [0, 1, 2, 0, 1] and row.tolist() == [0, 0, 0, 3, 3]
    p = lm.PAD
    assert context.T.tolist() == [[p, p, 1, 2], [p, 0, 2, p], [0, 1, p, p], [p, p, 1, p], [p, 0, p, p]]


def slow_shape(word):
    first, last, size = word[0], word[-1], len(word.encode())
    end = 0 if last.isalnum() or ord(last) > 127 else 1 if last == "," else 2 if last == "." else 3
    return 16 * first.isupper() + 4 * end + (size > 3) + (size > 6) + (size > 9)


def slow_network(weights, context, target):
    """The log-probability of one token, unit by unit."""
    w = lm.Network.parts(np.asarray(weights, dtype=float))
    hidden = [math.tanh(w["hidden_bias"][u] + sum(w["table"][i][c][u] for i, c in enumerate(context))) for u in range(lm.HIDDEN)]
    kind, inside = divmod(target, lm.CLASSES)

    def log_softmax(matrix, bias, chosen):
        scores = [bias[k] + sum(hidden[u] * matrix[u][k] for u in range(lm.HIDDEN)) for k in range(lm.CLASSES)]
        return scores[chosen] - math.log(sum(math.exp(x) for x in scores))

    return log_softmax(w["class_w"], w["class_b"], kind) + log_softmax(w["token_w"][kind], w["token_b"][kind], inside)


def slow_scores(texts, model):
    """Each text's score, word by word, with all counts taken anew."""
    words = [(t or "").split() for t in texts]
    at = lambda ws, i: ws[i] if 0 <= i < len(ws) else None
    contexts = Counter((at(ws, i - 1), at(ws, i + 1)) for ws in words for i in range(len(ws)))
    windows = Counter((at(ws, i - 1), at(ws, i + 1), w) for ws in words for i, w in enumerate(ws))
    number = {w: i for i, w in enumerate(model.frequent)}
    rare = Counter(w for ws in words for w in ws if w not in number)
    pairs, firsts, shapes = Counter(), Counter(), Counter()
    signs = lambda w: [256, *w.encode(), 256]
    for w, n in rare.items():
        shapes[slow_shape(w)] += n
        for x, y in zip(signs(w), signs(w)[1:]):
            pairs[x, y] += 1
            firsts[x] += 1
    token = lambda w: lm.PAD if w is None else number.get(w, lm.FREQUENT + slow_shape(w))
    out = []
    for ws in words:
        total = 0.0
        for i, w in enumerate(ws):
            logp = slow_network(model.weights, [token(at(ws, i + d)) for d in lm.CONTEXT], token(w))
            if w not in number:
                spelled = sum(math.log((pairs[x, y] + 0.1) / (firsts[x] + 0.1 * 257)) for x, y in zip(signs(w), signs(w)[1:]))
                logp += min(0, spelled - math.log((shapes[slow_shape(w)] + 0.1) / (rare.total() + 0.1 * 32)))
            context = at(ws, i - 1), at(ws, i + 1)
            n, others = windows[*context, w] - 1, contexts[context] - 1
            total += math.log((n + 2 * math.exp(logp)) / (others + 2)) if others else logp
        out.append(total if ws else None)
    return out


def test_scores_match_a_slow_scorer(spark):
    r = random.Random(4)
    rare = ["Wörter,", "Zebra", "x9", "naïve.", "(odd)", "abcdefghijklm", "one-off!"]
    usual = [f"w{i}" for i in range(1000)]
    texts = [" ".join(r.choice(rare) if r.random() < 0.2 else usual[int(1000 * r.random() ** 3)] for _ in range(r.randrange(1, 40))) for _ in range(150)]
    texts += [" ".join(usual), texts[3], texts[3], None, "", " \n"]
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)], "doc_id long, text string, window string, n long")
    model = lm.learn(docs)
    got = {r["doc_id"]: (r["n_tokens"], r["log_prob"]) for r in lm.score(docs, model).collect()}
    for i, (text, expected) in enumerate(zip(texts, slow_scores(texts, model))):
        n, score = got[i]
        assert n == len((text or "").split()) and (score is None) == (expected is None)
        assert expected is None or math.isclose(score, expected, rel_tol=1e-3, abs_tol=1e-2), (text, score, expected)


@pytest.mark.parametrize("shard, slices", [(200, 2), (1, 0)])
def test_shards_and_slices_of_any_size_give_the_same_scores(spark, monkeypatch, shard, slices):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").where("doc_id < 60")
    one = {r["doc_id"]: r["log_prob"] for r in lm.score(docs, lm.learn(docs)).collect()}
    monkeypatch.setattr(lm, "SHARD", shard)
    monkeypatch.setattr(lm, "SLICE_BITS", slices)
    other = {r["doc_id"]: r["log_prob"] for r in lm.score(docs, lm.learn(docs)).collect()}
    assert one.keys() == other.keys() and all(math.isclose(one[d], other[d], rel_tol=1e-4) for d in one if one[d] is not None)


def test_text_beats_its_shuffle_and_random_letters(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang")
    model = lm.learn(docs.where("doc_id % 5 <> 0"))
    r, rows = random.Random(1), []
    for d, text in docs.where("doc_id % 5 = 0 and lang = 'en'").select("doc_id", "text").collect():
        words = (text or "").split()
        if len(words) >= 10:
            gibberish = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in w) for w in words]
            rows += [(3 * d, text), (3 * d + 1, " ".join(r.sample(words, len(words)))), (3 * d + 2, " ".join(gibberish))]
    got = {r["doc_id"]: r["mean_log_prob"] for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string"), model, seen=False).collect()}
    held_out = [d for d in got if d % 3 == 0]
    assert len(held_out) > 500
    assert sum(got[d] > got[d + 1] for d in held_out) >= 0.95 * len(held_out)
    assert sum(got[d] > got[d + 2] for d in held_out) >= 0.99 * len(held_out)


def test_scores_do_not_depend_on_how_the_input_is_cut(spark):
    docs = spark.read.parquet(DOCS).select("doc_id", "text")
    whole, cut = docs.coalesce(1), docs.repartition(7, F.col("doc_id") % 7)
    one, other = ({r["doc_id"]: r["log_prob"] for r in lm.score(d, lm.learn(d)).collect()} for d in (whole, cut))
    assert one.keys() == other.keys() and all(math.isclose(one[d], other[d], rel_tol=1e-4) for d in one if one[d] is not None)


def test_scores_of_empty_texts_and_tables(spark):
    docs = spark.createDataFrame([(1, None, 0), (1, "", 0), (None, "a b a", 0)], "doc_id long, text string, n_tokens int")
    got = sorted((r["n_tokens"], r["log_prob"] is None, r["mean_log_prob"] is None) for r in lm.score(docs, lm.learn(docs)).collect())
    assert got == [(0, True, True), (0, True, True), (3, False, False)]
    none = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score(none, lm.learn(none)).count() == 0


def test_held_out_languages(spark):
    docs = spark.read.parquet(DOCS)
    from bilinea.llm.queries import op8_byte_gru_langid

    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = op8_byte_gru_langid(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    held_out = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held_out) >= 0.95 * len(held_out)


def slow_states(model, data, direction):
    """The state after each byte, unit by unit; reset and update weights hold half the usual values."""
    table, u = model.table[direction].astype(float), model.u[direction].astype(float)
    units = len(u)
    h, out = [0.0] * units, {}
    gate = lambda x, k, j: x[k * units + j] + sum(h[i] * u[i][k * units + j] for i in range(units))
    for t in range(len(data)) if direction == 0 else range(len(data) - 1, -1, -1):
        x = table[data[t]]
        reset = [1 / (1 + math.exp(-2 * gate(x, 0, j))) for j in range(units)]
        update = [1 / (1 + math.exp(-2 * gate(x, 1, j))) for j in range(units)]
        fresh = [math.tanh(x[2 * units + j] + sum(reset[i] * h[i] * u[i][2 * units + j] for i in range(units))) for j in range(units)]
        h = [update[j] * h[j] + (1 - update[j]) * fresh[j] for j in range(units)]
        out[t] = h
    return [out[t] for t in range(len(data))]


def slow_language(model, text):
    """The language and its share, byte by byte."""
    data, sums = text.encode(), [0.0] * len(model.languages)
    for at in range(0, len(data), langid.LENGTH):
        window = data[at : at + langid.LENGTH]
        for forth, back in zip(slow_states(model, window, 0), slow_states(model, window, 1)):
            scores = [float(model.b[k]) + sum(x * float(model.w[i][k]) for i, x in enumerate([*forth, *back])) for k in range(len(sums))]
            total = math.log(sum(math.exp(x) for x in scores))
            sums = [a + x - total for a, x in zip(sums, scores)]
    shares = [math.exp(x / len(data)) for x in sums]
    best = max(range(len(shares)), key=shares.__getitem__)
    return model.languages[best], shares[best] / sum(shares)


def test_predictions_match_a_slow_forward_pass(spark):
    docs = spark.read.parquet(DOCS)
    model = langid.train(docs.select("doc_id", "text", "lang"), per_language=40)
    some = docs.where("doc_id < 12").select("doc_id", F.substring("text", 1, 300).alias("text"))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.label(some, model).collect()}
    for r in some.collect():
        lang, share = slow_language(model, r["text"])
        assert got[r["doc_id"]][0] == lang and math.isclose(got[r["doc_id"]][1], share, rel_tol=1e-3)
    try:
        langid.train(docs.select("doc_id", "text", F.col("doc_id").cast("string").alias("lang")), most_languages=50)
    except ValueError:
        return
    raise AssertionError("too many languages were learned")


def test_languages_of_odd_texts(spark):
    docs = spark.createDataFrame([(1, "abc def", "x"), (2, "αβγ δε", "y"), (3, None, "x"), (4, "12 34", None), (5, "", "y"), (5, "", "y"), (None, "abc " * 40000, "x")], "doc_id long, text string, lang string")
    model = langid.train(docs)
    got = [(r["doc_id"], r["lang_pred"], r["score"] > 0) for r in langid.label(docs, model).collect()]
    assert sorted(got, key=str) == sorted([(1, "x", True), (2, "y", True), (3, "und", False), (4, "und", False), (5, "und", False), (5, "und", False), (None, "x", True)], key=str)
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.train(none).languages == [] and langid.label(none, langid.train(none)).count() == 0
    assert langid.label(docs, langid.train(none)).where("lang_pred <> 'und'").count() == 0

"""Each stage's result against plain Python over what it was given."""

import random
from collections import Counter, defaultdict

import corpus_pipeline
from bilinea.llm import mixing

from tests.llm.test_packing import expected, slow_best_fit
from tests.llm.test_rows import norm, slow_repeats
from tests.llm.test_near import slow_groups


def documents(n=220, seed=8):
    r = random.Random(seed)
    sentence = lambda: " ".join(f"w{r.randrange(300)}" for _ in range(r.randrange(4, 12))) + "."
    out = []
    for i in range(n):
        kind = r.random()
        if out and kind < 0.15:
            text = r.choice(out)[1]
        elif out and kind < 0.35:
            words = (r.choice(out)[1] or "w").split(" ")
            words[r.randrange(len(words))] = "changed."
            text = " ".join(words)
        elif kind < 0.4:
            text = r.choice([None, "", "too short.", "menu | of | many | words", "again and again it is said. " * 12])
        else:
            text = "\n".join(sentence() for _ in range(r.choice([3, 8, 60, 400]))) + r.choice(["", "\nAll rights reserved.", "\nno end mark"])
        out.append((i * 3 % 661, text, "en", r.choice(["s1", "s2", "s2", None]), None if text is None else len(text)))
    return out


def test_stages(spark, tmp_path):
    docs = spark.createDataFrame(documents(), "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    before, results = docs, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, str(tmp_path)).write.parquet(f"{tmp_path}/{i}")
        after = spark.read.parquet(f"{tmp_path}/{i}")
        if i < 4:
            assert set(after.columns) == set(docs.columns)
        results.append([r.asDict() for r in after.collect()])
        before = after
    clean, exact, near, mixed, packed = results

    kept = {}
    for d, text, *_ in documents():
        words = (text or "").split()
        lines = (text or "").split("\n")
        bad = [x for x in lines if x.strip() and (x.rstrip()[-1] not in ".!?" or "rights reserved" in x or x.count("|") >= 3)]
        if len(words) >= 20 and 100 * slow_repeats(words) <= 30 * len(words) and 2 * sum(len(x.split()) for x in bad) <= len(words):
            kept[d] = "\n".join(x for x in lines if x not in bad)
    assert {r["doc_id"]: r["text"] for r in clean} == kept and all(r["n_chars"] == len(r["text"]) for r in clean)

    first = {}
    for d, text in sorted(kept.items()):
        first.setdefault(norm(text), d)
    assert {r["doc_id"] for r in exact} == set(first.values()) and len(exact) == len(first)

    roots, _, _ = slow_groups([(r["doc_id"], r["text"]) for r in exact])
    assert Counter(r["doc_id"] for r in near) == Counter(roots)

    times, sizes, taken, most = Counter(r["doc_id"] for r in mixed), Counter(), Counter(), Counter()
    for r in near:
        n = len(r["text"].split())
        sizes[r["source"]] += n
        taken[r["source"]] += n * times[r["doc_id"]]
        most[r["source"]] = max(most[r["source"]], n)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    wanted = dict(zip(order, mixing.targets([sizes[s] for s in order], mixing.Recipe())))
    assert max(times.values()) <= 2 and all(abs(taken[s] - wanted[s]) <= most[s] for s in order)

    text = {r["doc_id"]: r["text"] for r in near}
    pieces = Counter((d, *p) for d, n in times.items() for p in expected(text[d]) * n)
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == pieces
    used = defaultdict(list)
    for r in packed:
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(used) == slow_best_fit(Counter(r["length"] for r in packed), 4096)


def test_run_and_empty_documents(spark, tmp_path):
    docs = spark.createDataFrame(documents(40), "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/some/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/some").count() > 0
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0

"""Every operator over null ids, null columns, repeated rows, empty tables and columns that clash with its own."""

import public_tokenizers
import pytest
from bilinea.llm import collocations, exact_dedup, langid, lm, minhash, mixing, packing, pii, quality, runs, sharding, simhash, warc
from pyspark.sql import functions as F

FILE = public_tokenizers.path("word_bpe_49k.json")
TEXT = " ".join(f"word{i}" for i in range(30)) + "."
DOCS = [(1, TEXT, "en", "s", 9), (1, TEXT, "en", "s", 9), (None, TEXT, None, None, None), (None, None, None, None, None), (2, "", "fr", "s", 0), (3, "x" * 200_000, "fr", None, 9)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ("digest", "row_tag", "keep_id", "row", "size", "shard", "rank", "before", "hashed", "positions", "fingerprint", "piece", "length", "base", "near", "token", "url", "html", "quality", "lang_pred", "key", "best", "_id", "_key", "_text", "_bucket", "more", "n", "shingles", "fp", "context", "window", "point", "cell", "batch", "held", "block", "post", "brief", "root", "digest_2", "w1", "f", "slice", "start", "period", "collapsed", "n_runs", "kept", "component_id", "n_shingles", "own", "side")


def deduplicated(docs):
    return exact_dedup.deduplicate(docs, exact_dedup.scratch_index(docs.sparkSession))


CASES = {
    "sharding": (lambda d: sharding.shard(d, 24), 6),
    "packing": (lambda d: packing.pack(packing.pieces(d, FILE)), None),
    "quality": (quality.filtered, 3),
    "exact": (deduplicated, 3),
    "exact labels": (lambda d: exact_dedup.label(d, exact_dedup.scratch_index(d.sparkSession)), 6),
    "simhash": (simhash.deduplicate, 3),
    "simhash labels": (simhash.label, 6),
    "mixing": (mixing.mixed, None),
    "mixing plan": (mixing.plan, 6),
    "language": (lambda d: langid.label(d, langid.train(d)), 6),
    "scores": (lambda d: lm.score(d, lm.learn(d)), 6),
    "minhash": (minhash.deduplicate, 4),
    "minhash labels": (minhash.label, 6),
    "collocations": (lambda d: collocations.collocations(d, least=2), None),
    "runs": (runs.label, 6),
    "collapsed": (runs.collapse, 6),
    "personal data": (pii.label, 6),
    "sanitised": (pii.sanitised, 6),
    "archives": (lambda d: warc.read(warc.write(d.select(F.col("doc_id").alias("page_id"), F.col("source").alias("url"), F.col("text").alias("html")))), 6),
}


@pytest.mark.parametrize("name", CASES)
def test_odd_rows(spark, name):
    run, n = CASES[name]
    docs = spark.createDataFrame(DOCS, SCHEMA).select("*", *[F.lit("clash").alias(c) for c in CLASH])
    got = run(docs)
    rows = got.collect()
    assert n is None or len(rows) == n
    if name in ("quality", "exact", "simhash", "mixing", "minhash", "collapsed"):
        assert got.columns == docs.columns and all(r[c] == "clash" for r in rows for c in CLASH)
    assert run(docs.limit(0)).count() == 0


@pytest.mark.parametrize("name", CASES)
def test_a_text_of_two_megabytes(spark, name):
    run, _ = CASES[name]
    text = ". ".join(f"Word{i % 90_000} and {i}" for i in range(110_000)) + "."
    assert len(text) > 2_000_000
    docs = spark.createDataFrame([(1, text, "en", "s", len(text)), (2, TEXT, "en", "s", 9)], SCHEMA)
    rows = run(docs).collect()
    assert name in ("packing", "mixing", "collocations") or len(rows) == 2

"""The registered queries of the subpackage: each applies its operator to a whole table and names the columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bilinea.llm.common import store
from bilinea.llm import collocations, exact_dedup, langid, lm, minhash, mixing, packing, pii, quality, runs, sharding, simhash, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bounded_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_histogram_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), capacity=4096, end_id=1)
    return packing.pack(cut, capacity=4096)


def op3_line_first_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = quality.measure(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "lost_words", "kept")
    return measured.select("doc_id", *[f"quality.{c}" for c in names])


def op4_indexed_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write(table(spark, sf_dir, "pages"))
    records = store(warc.read(index, with_text=False), "warc-read")
    return warc.resolve(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_window_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm.score(docs, lm.learn(docs))


def op6_disclosure_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = pii.label(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    written = F.transform("base", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    terms = F.transform("terms", lambda s: F.concat_ws(":", F.lit("term"), s["start"].cast("string"), s["end"].cast("string")))
    return marked.select("doc_id", *counts, F.sha2(F.array_join(written, ","), 256).alias("base_sha256"), F.array_join(F.concat(written, terms), ",").alias("spans"))


def op7_trie_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = simhash.label(table(spark, sf_dir, "documents"))
    return labels.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op8_byte_gru_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True)).alias("held_out")
    model = langid.train(docs.select("doc_id", "text", "lang", held_out).where("not held_out"))
    return langid.label(docs, model, carry=[held_out]).select("doc_id", "held_out", "lang_pred", "score")


def op9_curriculum_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan(table(spark, sf_dir, "documents"))
    in_order = mixing.by_position(store(planned, "mix-plan"))
    at = lambda k: F.round(F.get("positions", F.lit(k)), 9)
    return in_order.select("doc_id", "size", "source_size", "target", "taken", at(0).alias("position"), at(1).alias("position_2"))


def op10_digest_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = exact_dedup.scratch_index(spark)
    labels = exact_dedup.label(table(spark, sf_dir, "documents"), index, batches=2)
    spark.sql(f"DROP TABLE {index}")  # the labels are read from stored decisions
    return labels


def op11_inverted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.label(table(spark, sf_dir, "documents"))


def op12_quotient_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_block_convolution_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.label(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_bounded_ring_sharding, op2_histogram_packing, op3_line_first_quality, op4_indexed_warc, op5_window_pseudo_likelihood, op6_disclosure_pii, op7_trie_simhash, op8_byte_gru_langid, op9_curriculum_mixing, op10_digest_index_dedup, op11_inverted_minhash, op12_quotient_collocations, op13_block_convolution_runs)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_line_first_quality": OP3_SQL,
        "op4_indexed_warc": OP4_SQL,
        "op9_curriculum_mixing": OP9_SQL,
        "op10_digest_index_dedup": OP10_SQL,
        "op11_inverted_minhash": OP11_SQL,
        "op12_quotient_collocations": OP12_SQL,
    }


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""

OP3_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
),
f AS (
  SELECT doc_id, text, ws, ls,
    list_filter(ls, lambda x: (NOT contains('.!?:;,…。！？；：”’»"'')]', right(rtrim(x, e' \t\n\x0b\f\r'), 1)) AND NOT regexp_matches(x, '[.!?…。！？]["'')\]]*\s+\S+(?:\s+\S+)?\s*$'))
      OR regexp_matches(x, '(?:[|»›•·>][^|»›•·>]*){3}')
      OR (lower(trim(x, e' \t\n\x0b\f\r.!:»>')) IN ('home', 'menu', 'login', 'log in', 'sign in', 'sign up', 'next', 'previous', 'back to top', 'skip to content', 'read more', 'share', 'share this', 'search', 'sitemap', 'site map'))
      OR (length(x) <= 250 AND regexp_matches(lower(x), 'all rights reserved|licensed under|released under the|terms of use|terms of service|privacy policy|cookie policy|use cookies|uses cookies|enable javascript|lorem ipsum|click here|subscribe to our'))) AS bad
  FROM w
),
g AS (
  SELECT doc_id, i, array_to_string(ws[i:i+7], ' ') AS gram FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)
),
r AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1
),
c AS (
  SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM r) GROUP BY doc_id
),
m AS (
  SELECT f.doc_id, len(ws) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(list_sum(list_transform(bad, lambda x: len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')))), 0) AS BIGINT) AS lost_words
  FROM f LEFT JOIN c USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, lost_words,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND lost_words <= 0.5 * n_words AS kept
FROM m
"""

# Base32 by hand: character i stands for bits 5i to 5i + 4, which lie in two neighbouring hex digits.
OP4_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS x FROM pages),
d AS (SELECT *, list_transform(range(40), lambda i: instr('0123456789abcdef', substr(x, i + 1, 1)) - 1) AS digits, max(page_id) OVER (PARTITION BY html) AS best FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((digits[5 * i // 4 + 1] * 16 + digits[5 * i // 4 + 2]) // (1 << (3 - 5 * i % 4)) % 32 + 1 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id < best THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id < best THEN best END AS refers_to
FROM d
"""

OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
),
t AS (SELECT source, sum(size) AS total FROM d GROUP BY source),
n AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS kind FROM t),
w AS (SELECT *, [5, 2, 1][kind + 1] AS weight, CAST(2 * total AS DOUBLE) AS cap, sum(total) OVER () * 1.5::DOUBLE AS budget FROM n),
r AS (
  SELECT *, coalesce(sum(cap) OVER f, 0) AS caps, sum(weight) OVER () - coalesce(sum(weight) OVER f, 0) AS open_weight
  FROM w WINDOW f AS (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
o AS (SELECT *, min(CASE WHEN (budget - caps) * weight / open_weight > cap THEN 1 ELSE 0 END) OVER (ORDER BY cap / weight, source) AS full_up FROM r),
p AS (
  SELECT source, kind, CAST(total AS BIGINT) AS source_size, CASE WHEN full_up = 1 THEN cap ELSE
    (budget - coalesce(sum(CASE WHEN full_up = 1 THEN cap END) OVER (), 0)) * weight / sum(CASE WHEN full_up = 0 THEN weight END) OVER () END AS target
  FROM o
),
b AS (
  SELECT d.doc_id, size, source_size, target, kind,
    CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, d.doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
),
c AS (SELECT *, unnest([0, 1]) AS copy FROM b),
k AS (SELECT doc_id, size, source_size, target, kind, before + copy * source_size AS start FROM c),
e AS (
  SELECT *, size > 0 AND start + size / 2 <= target AS takes,
    CASE WHEN kind = 2 AND start >= 0.375 * target THEN 0.5 ELSE 0 END AS since,
    start - CASE WHEN kind = 2 AND start >= 0.375 * target THEN 0.375 * target ELSE 0 END AS rest,
    target * CASE WHEN kind = 0 THEN 1.5 WHEN kind = 2 AND start < 0.375 * target THEN 0.5 ELSE 1 END AS rate,
    target * CASE kind WHEN 0 THEN -1 WHEN 1 THEN 0 ELSE 1 END AS change
  FROM k
),
u AS (SELECT *, CASE WHEN takes THEN round(since + CASE WHEN rest > 0 THEN 2 * rest / (rate + sqrt(greatest(0, rate * rate + 2 * change * rest))) ELSE 0 END, 9) END AS due FROM e)
SELECT doc_id, any_value(size) AS size, any_value(source_size) AS source_size, any_value(target) AS target, any_value(size) * count(*) FILTER (takes) AS taken, min(due) AS position,
  CASE WHEN count(*) FILTER (takes) = 2 THEN max(due) END AS position_2
FROM u GROUP BY doc_id
"""

OP11_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
),
g AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i+3], ' ') AS gram FROM (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws) - 2))) AS i FROM w WHERE len(ws) > 0)),
s AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_ FROM g x JOIN g y ON x.gram = y.gram AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN s p ON p.doc_id = a JOIN s q ON q.doc_id = b WHERE 100 * both_ >= 80 * (p.n + q.n - both_)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS least_ FROM documents UNION SELECT e.b, r.least_ FROM r JOIN e ON r.doc_id = e.a WHERE r.least_ < e.b)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(least_) AS component_id, d.doc_id = min(least_) AS kept
FROM documents d JOIN r USING (doc_id) LEFT JOIN s USING (doc_id) GROUP BY d.doc_id
"""

OP12_SQL = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS ws FROM t),
g AS (
  SELECT lang, k, array_to_string(ws[i:i+k-1], ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM p, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k)
),
f AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, count(*) AS a FROM g GROUP BY lang, k, phrase HAVING count(*) >= 30),
n AS (SELECT lang, count(*) AS n FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT *, array_to_string(ws[1:c], ' ') AS first_, array_to_string(ws[c+1:], ' ') AS rest FROM (SELECT *, unnest(range(1, k)) AS c FROM f WHERE k > 1)),
s AS (
  SELECT c.lang, c.k, c.phrase, c.a, c.c, x.a AS l, y.a AS r, CAST(2000000::HUGEINT * c.a // (x.a::HUGEINT + y.a) AS BIGINT) AS score
  FROM c JOIN f x ON x.lang = c.lang AND x.phrase = first_ JOIN f y ON y.lang = c.lang AND y.phrase = rest
),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
i AS (
  SELECT lang, a, array_to_string(ws[j:j+m-1], ' ') AS phrase
  FROM (SELECT lang, a, ws, m, unnest(range(1, k - m + 2)) AS j FROM (SELECT *, unnest(range(2, k)) AS m FROM f WHERE k > 2))
),
m AS (SELECT lang, phrase, max(a) AS most FROM i GROUP BY lang, phrase),
o AS (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.phrase) AS rank, b.phrase, b.a, l, r, score
  FROM b LEFT JOIN m ON m.lang = b.lang AND m.phrase = b.phrase WHERE coalesce(100 * most < 80 * b.a, true)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM o JOIN n USING (lang) WHERE rank <= 2000
"""

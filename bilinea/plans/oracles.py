"""The SQL of the registered queries, for DuckDB over the same tables.

White space is spelled out: DuckDB's own class has the ASCII characters alone.
"""

from __future__ import annotations

from bilinea.functions.text import SPACE_CHARS, SPACE_CLASS

BARE = f"regexp_replace(%s, '[{SPACE_CLASS}]+', '', 'g')"
STRIP = f"trim(%s, '{SPACE_CHARS}')"

LINES = "l AS (SELECT l_orderkey AS o, l_linenumber AS n, CAST(min(l_quantity) AS INT) AS q, min(l_returnflag) AS flag, min(l_partkey) AS part FROM lineitem GROUP BY 1, 2)"
TURNS = "t AS (SELECT conv_id, CAST(turn + 1 AS INT) AS seq, turn, coalesce(text, '') AS text, role FROM conversations)"
# The three note patterns of operators/glossary.py, with white space spelled as DuckDB needs it.
GAP, LETTER = f"[{SPACE_CLASS}]*", "[a-zA-ZāīūṃṅñṭḍḷṇśṣḥĀĪŪṂṄÑṬḌḶṆŚṢḤ]"
SOUTHERN = "南傳作「([^」]+)」" + GAP + r"\(([^，,）)]+)[，,](?:.*?另譯為「([^」]+)」)?"
ALSO = "「([^」]+)」" + GAP + r"\((" + LETTER + "[^，,)]*)[，,]" + GAP + r"另譯為「([^」]+)」\)"
PLAIN = "「([^」]+)」" + GAP + r"\((" + LETTER + r"[^\)]*)\)"

NOTES = rf"""
h AS (
  SELECT p_brand AS source, p_partkey AS k, CASE p_partkey % 5
    WHEN 0 THEN '<b>南傳作「' || p_type || '」</b> (' || p_name || '，見經)，北傳另譯為「' || p_brand || '」。'
    WHEN 1 THEN ' 南傳作「' || p_type || '」(' || p_name || ', x)，無別譯 '
    WHEN 2 THEN '「' || p_type || '」 (Ā' || p_name || '，另譯為「' || p_brand || '」)'
    WHEN 3 THEN '某「' || p_type || '」(' || upper(p_name) || ')'
    ELSE '無詞 ' || p_name || ' | ' || p_type END AS body
  FROM part WHERE p_partkey % 13 <> 0
),
x AS (SELECT source, k AS id, {STRIP % "regexp_replace(body, '<[^>]+>', '', 'g')"} AS note FROM h),
m AS (SELECT *, CASE WHEN regexp_matches(note, '{SOUTHERN}') THEN '{SOUTHERN}' WHEN regexp_matches(note, '{ALSO}') THEN '{ALSO}' WHEN regexp_matches(note, '{PLAIN}') THEN '{PLAIN}' END AS p FROM x),
f AS (
  SELECT id, note, source,
    CASE p WHEN '{SOUTHERN}' THEN regexp_extract(note, '{SOUTHERN}', 2) WHEN '{ALSO}' THEN regexp_extract(note, '{ALSO}', 2) WHEN '{PLAIN}' THEN regexp_extract(note, '{PLAIN}', 2) END AS w,
    CASE p WHEN '{SOUTHERN}' THEN regexp_extract(note, '{SOUTHERN}', 1) WHEN '{ALSO}' THEN regexp_extract(note, '{ALSO}', 1) WHEN '{PLAIN}' THEN regexp_extract(note, '{PLAIN}', 1) END AS a,
    CASE p WHEN '{SOUTHERN}' THEN regexp_extract(note, '{SOUTHERN}', 3) WHEN '{ALSO}' THEN regexp_extract(note, '{ALSO}', 3) END AS b
  FROM m
),
g AS (SELECT CAST(id AS INT) AS id, lower(nullif({STRIP % "w"}, '')) AS pali_word, nullif({STRIP % "a"}, '') AS meaning, nullif({STRIP % "b"}, '') AS meaning2, note, source FROM f)
"""

#: Books: paragraphs p and pages g out of paragraphs p0 and pages g0.
BOOKS = rf""",
p1 AS (SELECT book, paragraph, {BARE % "text"} AS bare, text FROM p0),
p AS (
  SELECT book, paragraph, length(bare) AS len, substr(lower(regexp_replace(bare, '[^\p{{L}}\p{{N}}_]', '', 'g')), 1, 30) AS head,
    sum(length(bare)) OVER w AS cum, paragraph - row_number() OVER w AS run
  FROM p1 WINDOW w AS (PARTITION BY book ORDER BY paragraph)
),
g1 AS (SELECT book, page_pos, {BARE % "text || repeat('x', (book * 7 + page_pos * 13) % 41)"} AS bare FROM g0),
g AS (SELECT book, page_pos, row_number() OVER (PARTITION BY book ORDER BY page_pos) AS rn, length(bare) AS len, substr(lower(regexp_replace(bare, '[^\p{{L}}\p{{N}}_]', '', 'g')), 1, 30) AS head FROM g1 WHERE bare <> '')
"""
PAGES = "g0 AS (SELECT book, CAST(floor((paragraph - 1) / %d.0) AS BIGINT) AS page_pos, string_agg(text, chr(10) ORDER BY paragraph) AS text FROM p0 GROUP BY 1, 2)"
LOCATED = "WITH RECURSIVE " + LINES + ", p0 AS (SELECT o AS book, n AS paragraph, 'P-' || o || ' ' || repeat('ab ', q) || flag AS text FROM l), " + PAGES % 2 + BOOKS
SOURCES = (
    "WITH RECURSIVE p0 AS (SELECT book, row_number() OVER (PARTITION BY book ORDER BY doc_id) AS paragraph, text"
    " FROM (SELECT coalesce(TRY_CAST(substr(source, 4, 9) AS INT), -1) AS book, doc_id, coalesce(text, '') AS text FROM documents)), " + PAGES % 3 + BOOKS
)

STEPS = r""",
u AS (
  SELECT g.book, g.page_pos, g.rn, c.paragraph AS cursor, g.len AS len, c.cum - c.len AS base,
    substr(g.head, 1, least(length(g.head), length(c.head))) = substr(c.head, 1, least(length(g.head), length(c.head))) AS ok,
    min(q.paragraph) FILTER (q.cum - (c.cum - c.len) >= g.len) AS j, max(q.paragraph) AS last
  FROM g JOIN p c ON c.book = g.book JOIN p q ON q.book = c.book AND q.run = c.run AND q.paragraph >= c.paragraph
  GROUP BY g.book, g.page_pos, g.rn, c.paragraph, g.len, c.cum, c.len, g.head, c.head
),
v AS (
  SELECT u.book, u.page_pos, u.rn, u.cursor, u.ok, CASE WHEN j IS NULL THEN last WHEN j = last THEN j
    WHEN abs(e.cum - e.len - base - u.len) <= abs(e.cum - base - u.len) THEN j - 1 ELSE j END AS para_end
  FROM u LEFT JOIN p e ON e.book = u.book AND e.paragraph = u.j
),
s AS (SELECT *, CASE WHEN NOT ok THEN 'head_mismatch' WHEN para_end < cursor THEN 'no_paragraph' ELSE 'ok' END AS status FROM v),
walk AS (
  SELECT g.book, g.page_pos, g.rn, c.cursor, s.para_end, coalesce(s.status, 'exhausted') AS status
  FROM g JOIN (SELECT book, min(paragraph) AS cursor FROM p GROUP BY book) c ON c.book = g.book AND g.rn = 1 LEFT JOIN s ON s.book = g.book AND s.rn = 1 AND s.cursor = c.cursor
  UNION ALL
  SELECT g.book, g.page_pos, g.rn, w.para_end + 1, s.para_end, coalesce(s.status, 'exhausted')
  FROM walk w JOIN g ON g.book = w.book AND g.rn = w.rn + 1 LEFT JOIN s ON s.book = g.book AND s.rn = g.rn AND s.cursor = w.para_end + 1
  WHERE w.status = 'ok'
)
"""

RANGES = """
SELECT CAST(book AS INT) AS %s, CASE WHEN status = 'ok' THEN CAST(cursor AS INT) END AS para_start, CASE WHEN status = 'ok' THEN CAST(para_end AS INT) END AS para_end, status, %s AS html FROM walk
"""

REPORT = (
    "WITH k AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS st, o_orderkey % 2 = 0 AS has, '@@ ' || o_orderkey || chr(10) || '- x' AS log FROM orders) "
    "SELECT k AS chapter, md5(array_to_string(['# 对齐报告：' || k || '.txt', '', '## 基本信息', '', '| 项目 | 值 |', '|------|----|', '| 源文件 | `' || k || '.txt` |', '| 生成时间 | 2026-01-01 00:00:00 UTC |', '| 模型 | `m` |', "
    "'| 句子总数 | ' || k % 100 || ' |', '| 未对齐（null）| ' || k % 7 || ' |', '', '## Token 用量', '', '| 类型 | 数量 |', '|------|------|', '| Prompt tokens | ' || c || ' |', '| Completion tokens | 3 |', '| Total tokens | ' || c + 3 || ' |', '| cached | ' || st || ' |', '', '## 原始差异', '', "
    "CASE WHEN has THEN '发现 1 处差异（已忽略空白）：' || chr(10) || chr(10) || '```diff' || chr(10) || log || chr(10) || '```' ELSE '✅ 无差异：对齐后拼接文本与原文完全一致（忽略空白）。' END, '', '## 自动修正', '', '自动修正 ' || k % 3 || ' 处差异：', '', "
    "CASE WHEN k % 3 = 0 THEN '跳过 1 处复杂差异（需人工检查）：' || chr(10) || '  tag' || chr(10) || chr(10) ELSE '' END || '## 修正后剩余差异', '', "
    "CASE WHEN k % 4 = 0 AND has THEN '剩余 1 处差异（需人工检查）：' || chr(10) || chr(10) || '```diff' || chr(10) || log || chr(10) || '```' ELSE '✅ 无剩余差异。' END, ''], chr(10))) AS report_md5 FROM k"
)


def oracle_sql() -> dict[str, str]:
    last = f"right(rtrim(%s, '{SPACE_CHARS}'), 1)"
    return {
        "a1_trailing_char_profile": f"""
WITH c AS (SELECT lang AS corpus, coalesce(nullif({last % "text"}, ''), '(空)') AS ch, doc_id FROM documents),
n AS (SELECT corpus, ch, count(*) AS n, min(doc_id) AS first FROM c GROUP BY 1, 2)
SELECT corpus, ch, n, n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY corpus) AS pct, CAST(sum(n) OVER (PARTITION BY corpus) AS BIGINT) AS total, row_number() OVER (PARTITION BY corpus ORDER BY n DESC, first) AS rank FROM n""",
        "a1_profile_totals": f"""
WITH c AS (SELECT source AS corpus, lang, doc_id % 7 = 0 AS bad, coalesce(nullif({last % "CASE WHEN doc_id % 11 <> 0 THEN text END"}, ''), '(空)') AS ch FROM documents)
SELECT corpus, count(DISTINCT lang) AS files, count(*) FILTER (NOT bad) AS total, count(*) FILTER (bad) AS bad, count(DISTINCT ch) FILTER (NOT bad) AS distinct_chars FROM c GROUP BY corpus""",
        "s5_read_aligned": "SELECT source, doc_id, lang AS original, CASE WHEN doc_id % 11 <> 0 THEN md5(text) END AS content_md5 FROM documents WHERE doc_id % 7 <> 0",
        "s2_last_wins": """
WITH x AS (SELECT o_orderpriority AS corpus, o_custkey || '.html' AS html, max(o_orderkey) AS last, min(o_orderkey) AS first FROM orders GROUP BY 1, 2)
SELECT corpus, html, CAST(last AS INT) AS para_start, CAST(last + 2 AS INT) AS para_end, row_number() OVER (PARTITION BY corpus ORDER BY first) - 1 AS pos FROM x""",
        "p1_url_manifest": """
WITH x AS (SELECT c_name AS corpus, c_nationkey % 5 AS d, unnest(range(95, 108)) AS n FROM customer), s AS (SELECT corpus, n, CASE WHEN length(n::VARCHAR) < d THEN lpad(n::VARCHAR, d, '0') ELSE n::VARCHAR END AS shown FROM x)
SELECT corpus, n, 'https://example.org/c/' || shown || '/raw' || n || '.htm' AS url, shown || '.html' AS file FROM s""",
        "p2_page_number_filter": r"""
WITH x AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_orderkey || '.html' WHEN 1 THEN '0' || o_orderkey || '_1.html' WHEN 2 THEN 'p' || o_orderkey || '.html' ELSE o_orderkey || '__2.html' END AS file FROM orders),
s AS (SELECT *, regexp_replace(file, '\.[^.]*$', '') AS stem FROM x),
p AS (SELECT o_orderkey, file, CASE WHEN regexp_full_match(stem, '[+-]?[0-9]+(_[0-9]+)*') THEN CAST(replace(stem, '_', '') AS BIGINT) ELSE -1 END AS page_no FROM s)
SELECT * FROM p WHERE page_no BETWEEN 100 AND 999999""",
        "p3_ordinal_filter": "SELECT p_partkey, p_partkey % 50 AS pos FROM part WHERE p_partkey % 50 + 1 BETWEEN 3 AND 20",
        "p7_p8_normalize": rf"""
WITH x AS (SELECT doc_id, text, {BARE % "text"} AS bare FROM documents), y AS (SELECT *, lower(regexp_replace(bare, '[^\p{{L}}\p{{N}}_]', '', 'g')) AS h FROM x)
SELECT doc_id, length(bare) AS n_visible, md5(bare) AS stripped_md5, substr(h, 1, 30) AS head, md5(h) AS head_md5, length({STRIP % "text"}) AS n_strip FROM y""",
        "p12_retarget": "SELECT CASE o_orderkey % 3 WHEN 0 THEN o_orderkey || '.a.txt' ELSE o_orderkey || '.txt' END AS text, o_custkey AS para_start, o_custkey + 1 AS para_end FROM orders",
        "p15_record_ids": "SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS id, CAST(l_orderkey AS INT) AS book, CAST(l_partkey AS INT) AS paragraph, CAST(l_suppkey AS INT) AS word_begin, CAST(l_linenumber AS INT) AS word_end FROM lineitem",
        "p9_p10_glossary": f"WITH {NOTES} SELECT * FROM g",
        "p11_glossary_failures": f"WITH {NOTES} SELECT source, id, concat_ws(', ', CASE WHEN pali_word IS NULL THEN 'pali_word' END, CASE WHEN meaning IS NULL THEN 'meaning' END) AS missing, substr(note, 1, 120) AS note FROM g WHERE pali_word IS NULL OR meaning IS NULL",
        "a8_glossary_totals": f"WITH {NOTES} SELECT source, count(*) AS entries, count(*) FILTER (pali_word IS NULL OR meaning IS NULL) AS failures FROM g GROUP BY GROUPING SETS ((source), ())",
        "r2_glossary_report": f"""
WITH {NOTES}, b AS (SELECT * FROM g WHERE pali_word IS NULL OR meaning IS NULL),
s AS (SELECT count(*) AS n, string_agg('| ' || source || ' | ' || id || ' | `' || concat_ws(', ', CASE WHEN pali_word IS NULL THEN 'pali_word' END, CASE WHEN meaning IS NULL THEN 'meaning' END) || '` | ' || replace(substr(note, 1, 120), '|', '｜') || ' |', chr(10) ORDER BY source, id) AS rows FROM b)
SELECT array_to_string(['# 注释提取报告', '', '- 总条目数：' || (SELECT count(*) FROM g), '- 字段缺失条目：' || n, ''] || CASE WHEN n = 0 THEN ['✅ 全部条目均成功提取所有字段。'] ELSE ['## 字段缺失详情', '', '| 来源文件 | id | 缺失字段 | 注释原文（前120字） |', '|----------|----|----------|---------------------|', rows] END || [''], chr(10)) AS report FROM s""",
        "p5_j1_j2_a2_annotate": f"""
WITH x AS (
  SELECT doc_id, text || CASE WHEN p_partkey IS NOT NULL AND p_partkey % 7 <> 0 THEN '[[' || p_name || '#term ' || doc_id || ']]' ELSE 'term ' || doc_id END || ' and '
    || CASE WHEN doc_id % 2 = 0 THEN '{{{{note|trigger=place|text=note of ' || doc_id || '}}}}' ELSE 'place' END AS t,
    CASE WHEN p_partkey IS NOT NULL AND p_partkey % 7 <> 0 THEN 1 ELSE 0 END AS notes, CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 0 END AS locals
  FROM documents LEFT JOIN part ON p_partkey = doc_id % 3000
)
SELECT doc_id, md5(t) AS text_md5, length(t) AS n_chars, notes, locals FROM x""",
        "p4_extract_section": f"SELECT doc_id, md5(text) AS text_md5 FROM documents WHERE {STRIP % 'text'} <> ''",
        "p6_local_notes": f"""
WITH x AS (
  SELECT doc_id, doc_id % 50 AS note_id, {STRIP % "replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"} AS t FROM documents WHERE doc_id % 50 <> 7
  UNION ALL SELECT doc_id, 7, 'new' || doc_id FROM documents
)
SELECT doc_id, note_id, md5(t) AS text_md5 FROM x""",
        "j5_pending_pages": f"WITH {LINES} SELECT 'orders' AS corpus, o_orderkey || '.html' AS file FROM orders WHERE o_orderkey NOT IN (SELECT o FROM l WHERE n = 3)",
        "j6_missing_sources": "SELECT c_nationkey AS corpus, c_custkey AS file FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey % 4 <> 1)",
        "f1_match_pages": LOCATED + STEPS + RANGES % ("book", "page_pos, page_pos || '.html'"),
        "f1_source_books": SOURCES + STEPS + RANGES % ("book", "page_pos, page_pos || '.html'"),
        "j5_a6_f1_resumed_stream": SOURCES + STEPS + RANGES % ("book", "page_pos, page_pos || '.html'"),
        "w_locate": LOCATED + STEPS + RANGES % ("corpus", "lpad(page_pos::VARCHAR, 4, '0') || '.html'"),
        "w_annotate": f"""
WITH {LINES}, g AS (SELECT DISTINCT o, CAST(floor((n - 1) / 2.0) AS BIGINT) AS p FROM l)
SELECT 'c' || o AS corpus, lpad(p::VARCHAR, 4, '0') || '.txt' AS file, 'T' || o || '.' || CASE WHEN p < 2 THEN '[[' || r_name || '#w]]' ELSE 'w' END || ' end' AS text, CASE WHEN p < 2 THEN 1 ELSE 0 END AS notes, 0 AS locals
FROM g LEFT JOIN region ON r_regionkey = p""",
        "w_align": f"""
WITH {TURNS}, x AS (SELECT conv_id, count(*) AS n, sum(length(text) + 2) + count(*) - 1 AS chars, count(*) FILTER (seq = 1) AS firsts FROM t GROUP BY 1)
SELECT conv_id::VARCHAR AS chapter, CASE WHEN conv_id % 3 = 0 THEN 'no_reply' ELSE 'ok' END AS status, CASE WHEN conv_id % 3 > 0 THEN CAST(n AS INT) END AS sentences, CASE WHEN conv_id % 3 > 0 THEN 0 END AS nulls,
  CASE WHEN conv_id % 3 > 0 THEN CAST(chars AS INT) END AS chars, CASE conv_id % 3 WHEN 1 THEN CAST(firsts AS INT) WHEN 2 THEN 0 END AS hunks, CASE WHEN conv_id % 3 > 0 THEN 0 END AS hunks_left FROM x""",
        "a6_cursor_start": f"""
WITH {LINES}, f AS (SELECT o AS book, min(n) AS first FROM l GROUP BY 1), d AS (SELECT o_orderkey AS book, max(o_custkey % 10) AS last FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1)
SELECT CAST(coalesce(f.book, d.book) AS INT) AS book, CAST(coalesce(last + 1, first) AS INT) AS cursor FROM f FULL JOIN d ON f.book = d.book""",
        "j7_verify_heads": LOCATED + "SELECT CAST(g.book AS INT) AS book, page_pos, substr(g.head, 1, least(length(g.head), length(p.head))) = substr(p.head, 1, least(length(g.head), length(p.head))) AS head_ok FROM g LEFT JOIN p ON p.book = g.book AND p.paragraph = page_pos + 1",
        "j3_chapter_sentences": f"""
WITH {LINES}, c AS (SELECT o_orderkey AS chapter, o_orderkey AS a, o_orderkey + o_custkey % 3 AS b FROM orders)
SELECT 1 AS book, CAST(o AS INT) AS paragraph, chapter, o * 8 + n AS id, n AS word_begin, n + q AS word_end, flag AS text, row_number() OVER (PARTITION BY chapter ORDER BY o, n, o * 8 + n) AS seq FROM c JOIN l ON o BETWEEN a AND b""",
        "p14_j4_fill_slots": f"""
WITH {TURNS} SELECT conv_id, seq, '1-' || turn || '-0-' || length(text) AS id, CASE WHEN seq % 4 = 0 THEN md5('again') WHEN seq % 5 = 3 OR seq % 7 = 0 THEN NULL ELSE md5(text) END AS content_md5 FROM t""",
        "p13_reply_stream": f"""
WITH {TURNS}, a AS (SELECT conv_id, string_agg(text || chr(10), '' ORDER BY seq) AS s FROM t GROUP BY 1), x AS (SELECT conv_id, string_split(s, chr(10)) AS ls FROM a),
y AS (SELECT conv_id, unnest(ls) AS line, unnest(range(len(ls))) AS line_no FROM x)
SELECT conv_id, line_no, md5({STRIP % "line"}) AS line_md5 FROM y WHERE {STRIP % "line"} <> ''""",
        "p13_reply_usage": """SELECT conv_id, CAST(count(*) AS INT) AS prompt_tokens, 7 AS completion_tokens, 9 AS total_tokens, '{"cached":"{\\"a\\":1}"}' AS extra FROM conversations GROUP BY 1""",
        "a4_build_prompts": f"""
WITH {TURNS}, a AS (SELECT conv_id, string_agg(seq || '. ' || coalesce(role, ''), chr(10) ORDER BY seq) AS l, string_agg(text, chr(10) ORDER BY seq) AS c FROM t GROUP BY 1)
SELECT conv_id, md5('【巴利文句子列表】' || chr(10) || l || chr(10) || chr(10) || '【汉文译文】' || chr(10) || {STRIP % "c"}) AS prompt_md5 FROM a WHERE {STRIP % "c"} <> ''""",
        "a3_aligned_text": f"WITH {TURNS} SELECT conv_id, md5(coalesce(string_agg(text, '' ORDER BY seq) FILTER (seq % 3 <> 0), '')) AS text_md5 FROM t GROUP BY 1",
        "f2_diff_hunks": f"WITH {TURNS} SELECT conv_id, seq, md5({BARE % 'text'}) AS rebuilt_md5, CASE WHEN length({BARE % 'text'}) > 0 THEN 1 ELSE 0 END AS n_removed, CASE WHEN seq % 2 = 0 THEN 1 ELSE 0 END AS n_added FROM t",
        "f3_diff_log": f"""
WITH {TURNS}, x AS (SELECT conv_id, seq, {BARE % "text"} AS s FROM t), y AS (SELECT *, length(s) // 2 AS k FROM x WHERE s <> ''),
z AS (SELECT *, substr(s, k + 1, 1) AS c, substr(s, greatest(0, k - 20) + 1, k - greatest(0, k - 20)) AS b, substr(s, k + 2, 20) AS e FROM y)
SELECT conv_id, seq, '@@ 原文[' || k || ':' || k + 1 || '] 对齐[' || k || ':' || k + 1 || '] tag=replace' || chr(10) || '- 原文: `' || c || '`' || chr(10) || '+ 对齐: `§`' || chr(10)
  || '  原文上下文: ...' || b || '[' || c || ']' || e || '...' || chr(10) || '  对齐上下文: ...' || b || '[§]' || e || '...' || chr(10)
  || '  ℹ️ 首个不同字符位置 0: 原文 U+' || printf('%04X', ord(c)) || '(''' || c || ''') vs 对齐 U+00A7(''§'')' AS log FROM z""",
        "f4_f5_correct": f"""
WITH {TURNS}, x AS (SELECT conv_id, seq, text, length({BARE % "text"}) > 0 AND seq % 2 = 1 AS changed FROM t)
SELECT conv_id, CAST(count(*) FILTER (changed) AS INT) AS n_fixable, CAST(count(*) FILTER (changed) AS INT) AS n_applied, 0 AS hunks_left, md5({BARE % "string_agg(text, '' ORDER BY seq)"}) AS text_md5 FROM x GROUP BY 1""",
        "f6_proportional_split": """
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS text, replace(replace(coalesce(text, ''), ',', '，'), '.', '。') AS m FROM documents),
s AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS seq FROM d),
n AS (SELECT doc_id, count(*) AS slots, sum(length(line)) AS total FROM s GROUP BY 1),
t AS (SELECT s.doc_id, seq, CASE WHEN total > 0 THEN length(m) * length(line) / total::DOUBLE ELSE 0 END AS target FROM s JOIN n USING (doc_id) JOIN d USING (doc_id)),
q AS (SELECT doc_id, regexp_extract_all(m, '[^。！？；，、]*[。！？；，、]|[^。！？；，、]+') AS ps FROM d),
p AS (SELECT doc_id, unnest(ps) AS piece, unnest(range(len(ps))) AS i FROM q),
g AS (
  SELECT doc_id, i, CAST(0 AS BIGINT) AS seq, length(piece) AS size FROM p WHERE i = 0
  UNION ALL
  SELECT doc_id, i, CASE WHEN near THEN seq ELSE seq + 1 END, CASE WHEN near THEN size + l ELSE l END FROM (
    SELECT g.doc_id, p.i, g.seq, g.size, length(p.piece) AS l, abs(g.size + length(p.piece) - coalesce(t.target, 0)) <= abs(g.size - coalesce(t.target, 0)) AS near
    FROM g JOIN p ON p.doc_id = g.doc_id AND p.i = g.i + 1 LEFT JOIN t ON t.doc_id = g.doc_id AND t.seq = g.seq
  )
),
c AS (SELECT g.doc_id, g.seq, string_agg(piece, '' ORDER BY g.i) AS content FROM g JOIN p ON p.doc_id = g.doc_id AND p.i = g.i GROUP BY 1, 2),
k AS (SELECT doc_id, count(*) AS found FROM c GROUP BY 1),
r AS (
  SELECT s.doc_id, s.seq, CASE WHEN coalesce(found, 0) = slots THEN c.content WHEN s.seq = 0 THEN m END AS content
  FROM s JOIN n ON n.doc_id = s.doc_id JOIN d ON d.doc_id = s.doc_id LEFT JOIN k ON k.doc_id = s.doc_id LEFT JOIN c ON c.doc_id = s.doc_id AND c.seq = s.seq
)
SELECT doc_id, CAST(seq AS INT) AS seq, length(content) AS n_chars, md5(content) AS content_md5 FROM r""",
        "a5_chapter_metrics": f"""
WITH {LINES}
SELECT o AS chapter, CAST(count(*) AS INT) AS sentences, CAST(count(*) FILTER (q % 4 = 0) AS INT) AS nulls, length(o_orderpriority) AS chars, CASE WHEN o % 3 = 0 THEN o_custkey ELSE 0 END AS prompt_tokens, CASE WHEN o % 3 = 0 THEN 5 ELSE 0 END AS completion_tokens,
  o_custkey % 6 AS hunks, o_custkey % 3 AS hunks_left
FROM l JOIN orders ON o = o_orderkey GROUP BY o, o_orderpriority, o_custkey""",
        "j8_merge_summary": """
SELECT p_brand AS corpus, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS no, p_partkey || '.txt' AS file, CASE WHEN p_partkey % 3 = 0 THEN p_size WHEN p_partkey % 2 = 0 THEN -1 END AS sentences, CASE WHEN p_partkey % 3 = 0 OR p_partkey % 2 = 0 THEN length(p_name) END AS chars FROM part""",
        "a7_backfill_meta": f"""
WITH {LINES}, d AS (SELECT o_custkey AS corpus, arg_min(part, o * 100 + n) AS a, arg_max(part, o * 100 + n) AS b FROM l JOIN orders ON o = o_orderkey GROUP BY 1)
SELECT c_custkey AS corpus, 1 AS book_id, CAST(coalesce(a, 0) AS INT) AS para_start, CAST(coalesce(b, 0) AS INT) AS para_end FROM customer LEFT JOIN d ON corpus = c_custkey""",
        "chapter_states": f"""
WITH {LINES}
SELECT o_orderkey AS chapter, CASE WHEN o_custkey % 11 = 0 THEN 'missing_file' WHEN o_custkey % 7 = 0 THEN 'blank_text' WHEN o_orderkey NOT IN (SELECT o FROM l) THEN 'no_sentences' WHEN o_custkey % 5 = 0 THEN 'no_reply' ELSE 'ok' END AS status FROM orders""",
        "r1_alignment_report": REPORT,
        "k2_para_map_round_trip": "SELECT o_orderpriority AS corpus, o_orderkey || '.html' AS html, CAST(o_custkey AS INT) AS para_start, CAST(o_custkey + 3 AS INT) AS para_end FROM orders",
        "k1_write_chunks": "SELECT doc_id || '.txt' AS file, lang AS corpus, md5(CASE WHEN lang IN ('de', 'fr') THEN 'new ' || text ELSE text END) AS text_md5 FROM documents WHERE lang NOT IN ('de', 'fr') OR text IS NOT NULL",
        "k2_s2_para_map": "SELECT o_orderpriority AS corpus, o_orderkey || '.html' AS html, CAST(o_custkey AS INT) AS para_start, CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE CAST(o_custkey + 3 AS INT) END AS para_end, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS pos FROM orders",
        "s1_read_pages": "SELECT 'c ' || page_id % 3 AS corpus, CASE WHEN page_id % 4 = 0 THEN 'x' ELSE '' END || page_id || '.html' AS file, CASE WHEN page_id % 4 = 0 THEN -1 ELSE page_id END AS page_no, md5(coalesce(html, '') || chr(10)) AS html_md5 FROM pages",
        "k2_committed_runs": "SELECT o_orderpriority AS corpus, o_orderkey || '.html' AS html, CAST(o_custkey AS INT) AS para_start, CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE CAST(o_custkey + 3 AS INT) END AS para_end, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS pos FROM orders",
        "s1_compacted_pages": """
WITH x AS (SELECT page_id, page_id % 4 = 0 OR page_id % 5 = 0 AS later, coalesce(html, '') AS html FROM pages)
SELECT 'c ' || page_id % 3 AS corpus, page_id || '.html' AS file, page_id AS page_no, md5(CASE WHEN later THEN 'new ' ELSE '' END || html || chr(10)) AS html_md5,
  (SELECT count(*) FILTER (page_id % 4 > 0) FROM x) AS first_run, (SELECT count(*) FILTER (later) FROM x) AS second_run, 0 AS third_run FROM x""",
        "s6_read_chunks": f"WITH x AS (SELECT 'c' || page_id % 5 AS corpus, page_id || '.txt' AS file, CASE WHEN page_id % 9 = 0 THEN ' ' || chr(9) ELSE coalesce(url, '') END || chr(10) AS text FROM pages) SELECT *, CASE WHEN {STRIP % 'text'} = '' THEN 'blank_text' ELSE 'ok' END AS status FROM x",
        "s4_read_source_tables": f"WITH {LINES} SELECT CAST(o AS INT) AS book, 1 AS paragraph, o * 8 + n AS id, n AS word_begin, q AS word_end, flag AS text, max(flag) OVER (PARTITION BY o) AS whole FROM l",
        "s4_jdbc_source_tables": f"WITH {LINES}, x AS (SELECT *, CAST(CASE WHEN o % 10 = 0 THEN o + 10000000 ELSE o END AS INT) AS paragraph FROM l) SELECT 1 AS book, paragraph, o * 8 + n AS id, n AS word_begin, q AS word_end, flag AS text, max(flag) OVER (PARTITION BY o) AS whole FROM x",
        "s7_k5_corpus_meta": """
WITH x AS (SELECT n_name AS corpus, n_nationkey + 100 AS book_id, n_nationkey % 4 AS n_digits FROM nation)
SELECT corpus, book_id, CASE WHEN book_id % 3 > 0 THEN 1 END AS chapter_start, CASE WHEN book_id % 3 > 0 THEN 99 END AS chapter_end, n_digits, CASE WHEN book_id % 3 > 0 THEN 0 END AS para_start, CASE WHEN book_id % 3 > 0 THEN 0 END AS para_end FROM x""",
        "k4_s3_glossary_round_trip": f"WITH {NOTES} SELECT id, pali_word FROM g WHERE pali_word IS NOT NULL",
        "k5_summary_round_trip": """
SELECT o_orderkey::VARCHAR AS no, o_orderkey || '.txt' AS file, CASE WHEN o_custkey % 3 > 0 THEN o_custkey::VARCHAR END AS sentences, (o_custkey + 1)::VARCHAR AS chars, o_orderstatus AS model, NULL::VARCHAR AS prompt_tokens, NULL::VARCHAR AS completion_tokens, NULL::VARCHAR AS hunks, NULL::VARCHAR AS hunks_left, 'now, then' AS generated_at FROM orders""",
        "k3_aligned_round_trip": "SELECT concat_ws('-', conv_id, turn, 0, length(coalesce(text, ''))) AS id, role AS original, CASE WHEN (turn + 1) % 4 <> 0 THEN md5(coalesce(text, '')) END AS content_md5 FROM conversations",
    }

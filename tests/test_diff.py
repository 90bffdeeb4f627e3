import difflib
import random
import time

import pytest
from bilinea.functions import ranks
from bilinea.operators import diff, reports, split, summary
from pyspark.sql import functions as F

LOG = """@@ 原文[22:23] 对齐[22:23] tag=replace
- 原文: `，`
+ 对齐: `。`
  原文上下文: ...丙丁戊己庚辛壬癸子丑寅卯辰巳午未申酉戌亥[，]東西南北...
  对齐上下文: ...丙丁戊己庚辛壬癸子丑寅卯辰巳午未申酉戌亥[。]東西X南...
  ℹ️ 首个不同字符位置 0: 原文 U+FF0C('，') vs 对齐 U+3002('。')
@@ 原文[25:25] 对齐[25:26] tag=insert
+ 对齐多出: `X`
  原文上下文: ...己庚辛壬癸子丑寅卯辰巳午未申酉戌亥，東西[]南北...
  对齐上下文: ...己庚辛壬癸子丑寅卯辰巳午未申酉戌亥。東西[X]南...
@@ 原文[26:27] 对齐[27:27] tag=delete
- 原文多出: `北`
  原文上下文: ...庚辛壬癸子丑寅卯辰巳午未申酉戌亥，東西南[北]...
  对齐上下文: ...辛壬癸子丑寅卯辰巳午未申酉戌亥。東西X南[]..."""


def test_log_lines(spark):
    rows = [(0, "甲乙丙丁戊己庚辛壬癸\n子丑寅卯辰巳午未申酉戌亥，東西南北", "甲乙丙丁戊己庚辛壬癸子丑寅卯辰巳午未申酉戌亥。東西X南"), (1, "it's", 'it"s'), (2, "a\\b\u200b𝄞", "a'b\u200c𝄢"), (3, "same", "same")]
    found = diff.diff_hunks(spark.createDataFrame(rows, "i int, original string, aligned string"))
    got = {r["i"]: r["log"] for r in found.select("i", diff.diff_log(F.col("hunks"), F.col("orig_norm"), F.col("aligned_norm")).alias("log")).collect()}
    assert "\n".join(got[0]) == LOG and got[3] == []
    shown = [x for i in (1, 2) for x in got[i] if "首个" in x]
    pairs = [("'", '"'), ("\\", "'"), ("\u200b𝄞", "\u200c𝄢")]
    assert shown == [f"  ℹ️ 首个不同字符位置 0: 原文 U+{ord(a[0]):04X}({a[0]!r}) vs 对齐 U+{ord(b[0]):04X}({b[0]!r})" for a, b in pairs]


def rebuilt(aligned, hunks):
    out, at = "", 0
    for h in hunks:
        out += aligned[at : h["aligned_start"]] + h["orig_chunk"]
        at = h["aligned_end"]
    return out + aligned[at:]


def test_hunks(spark):
    r = random.Random(1)
    pairs = [("a b", "a　b"), ("", "x"), ("x", None), (None, None), ("ab" * 300, "ab" * 150 + "c" + "ab" * 150)]
    pairs += [("".join(r.choice("abcde \n") for _ in range(60)), "".join(r.choice("abcde ") for _ in range(60))) for _ in range(30)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, original string, aligned string")
    for row in diff.diff_hunks(df).collect():
        assert rebuilt(row["aligned_norm"], row["hunks"]) == row["orig_norm"]
        assert (row["diff_status"] == "equal") == (row["orig_norm"] == row["aligned_norm"]) == (not row["hunks"])


def test_texts_that_are_not_compared_say_so(spark):
    """Not compared is not the same as no difference: null hunks and counts, a status, and lines of their own."""
    text = "甲" * 30
    records = spark.createDataFrame([("c", "1", 1, text + "乙"), ("c", "2", 1, "same"), ("c", "3", 1, "a")], "corpus string, chapter string, seq int, content string")
    chunks = spark.createDataFrame([("c", "1", text + "丙"), ("c", "2", "same"), ("c", "3", "b")], "corpus string, chapter string, text string")
    some = diff.recheck(records, chunks, most_chars=20)
    got = {r["chapter"]: (r["diff_status"], r["hunks"] is None, r["hunks_left"]) for r in some.collect()}
    assert got == {"1": ("too_long", True, None), "2": ("equal", False, 0), "3": ("differs", False, 1)}
    assert {r["hunks_left"] for r in diff.recheck(records, chunks).collect()} == {0, 1}
    fixed = diff.auto_correct(records, some)
    assert {r["chapter"]: r["content"] for r in diff.corrected_records(records, fixed).collect()} == {"1": text + "乙", "2": "same", "3": "b"}
    usage = spark.createDataFrame([], "corpus string, chapter string, prompt_tokens int, completion_tokens int")
    metrics = summary.chapter_metrics(records, chunks, usage, some, some)
    assert {r["chapter"]: (r["hunks"], r["hunks_left"], r["prompt_tokens"]) for r in metrics.collect()} == {"1": (None, None, 0), "2": (0, 0, 0), "3": (1, 1, 0)}
    log = some.select("corpus", "chapter", "hunks", diff.diff_log(F.col("hunks"), F.col("orig_norm"), F.col("aligned_norm")).alias("log"))
    told = metrics.drop("hunks").join(log, ["corpus", "chapter"]).join(fixed.chapters.select("corpus", "chapter", "fixed_log", "skipped_log"), ["corpus", "chapter"])
    told = told.withColumns({"log_left": F.col("log"), "file": F.col("chapter"), "generated_at": F.lit("now"), "model": F.lit("m"), "total_tokens": F.lit(0), "extra": F.lit(None).cast("map<string,string>")})
    report = {r["chapter"]: r["report"] for r in reports.alignment_report(told).collect()}
    assert report["1"].count("未比对") == 2 and "✅" not in report["1"]
    assert report["2"].count("✅") == 2 and "未比对" not in report["2"] + report["3"]


def test_a_text_of_250000_characters_is_compared(spark):
    text = "".join(map(chr, random.Random(1).choices(range(0x4E00, 0x9000), k=250_000)))
    df = spark.createDataFrame([(text, text[:100_000] + "x" + text[100_001:])], "original string, aligned string")
    hunks = diff.diff_hunks(df).first()["hunks"]
    assert [(h["tag"], h["orig_start"], h["orig_end"]) for h in hunks] == [("replace", 100_000, 100_001)]


def hunk(start, wrong, right, tag="replace"):
    return {"tag": tag, "orig_start": 0, "orig_end": len(right), "aligned_start": start, "aligned_end": start + len(wrong), "orig_chunk": right, "aligned_chunk": wrong}


@pytest.mark.parametrize(
    ("contents", "hunks", "expected", "log"),
    [
        (["a b", "cd"], [hunk(1, "b", "X")], ["a X", "cd"], ["  record[0] 位置 [2]: `b` → `X`"]),
        ([None, "", "a b", "cd"], [hunk(2, "c", "XY")], [None, "", "a b", "XYd"], ["  record[3] 位置 [0]: `c` → `XY`"]),
        (["ab", "cd"], [hunk(1, "bc", "X")], ["ab", "cd"], ["  record[0]: 归一化偏移越界，跳过"]),
        (["abcd"], [hunk(0, "a", "XY"), hunk(2, "c", "Z")], ["XYbcd"], ["  record[0] 位置 [0]: `a` → `XY`", "  record[0]: 位置 2 预期 `c` 实际 `b`，整处跳过"]),
        (["a b c d"], [hunk(1, "bc", "Q")], ["a Q  d"], ["  record[0] 位置 [2, 4]: `bc` → `Q`"]),
        (["ab", " 　", "cd"], [hunk(9, "x", "y")], ["ab", " 　", "cd"], []),
    ],
)
@pytest.mark.parametrize("width", [1, 2, 4096])
def test_corrections(spark, contents, hunks, expected, log, width):
    records = spark.createDataFrame([("c", 1, i * 3, c) for i, c in enumerate(contents)], "corpus string, chapter int, seq int, content string")
    diffs = spark.createDataFrame([("c", 1, hunks)], f"corpus string, chapter int, hunks {diff.HUNKS}")
    fixed = diff.auto_correct(records, diffs, width=width)
    (row,) = fixed.chapters.collect()
    assert row["fixed_log"] == [f"自动修正 {len(hunks)} 处差异：", *log] and row["n_applied"] == sum("→" in x for x in log) and row["n_fixable"] == len(hunks)
    assert [r["content"] for r in diff.corrected_records(records, fixed).orderBy("seq").collect()] == expected


def test_only_touched_records_are_patched(spark):
    """A chapter of 20,000 records with 40 hunks: rows in Python are the records that a hunk starts in."""
    records = spark.range(20_000).selectExpr("'c' AS corpus", "1 AS chapter", "id AS seq", "concat('r ', lpad(id, 6, '0')) AS content")
    hunks = [hunk(7 * i * 500 + 6, str(i * 500 % 10), "X") for i in range(40)]
    diffs = spark.createDataFrame([("c", 1, hunks)], f"corpus string, chapter int, hunks {diff.HUNKS}")
    fixed = diff.auto_correct(records, diffs)
    assert fixed.records.count() == 40 and fixed.chapters.first()["n_applied"] == 40
    after = diff.corrected_records(records, fixed)
    assert after.count() == 20_000 and {r["seq"] for r in after.where("content LIKE '%X'").collect()} == {i * 500 for i in range(40)}


def test_correction_of_chapters(spark):
    records = spark.createDataFrame([("c", 1, 1, "甲乙。"), ("c", 1, 2, None), ("c", 1, 3, "丙丁戊己庚"), ("c", 2, 1, "same")], "corpus string, chapter int, seq int, content string")
    chunks = spark.createDataFrame([("c", 1, "甲乙，\n丙XX庚"), ("c", 2, "same")], "corpus string, chapter int, text string")
    before = diff.recheck(records, chunks)
    fixed = diff.auto_correct(records, before)
    rows = {r["chapter"]: r for r in fixed.chapters.collect()}
    assert rows[1]["fixed_log"][0] == "自动修正 2 处差异：" and rows[1]["n_applied"] == 2 and rows[2]["n_fixable"] == 0
    assert rows[2]["skipped_log"] == ["跳过 0 处复杂差异（需人工检查）："]
    after = diff.corrected_records(records, fixed)
    assert [r["content"] for r in after.orderBy("chapter", "seq").collect()] == ["甲乙，", None, "丙XX庚", "same"]
    assert {r["hunks_left"] for r in diff.recheck(after, chunks).collect()} == {0}


def proportional(text, lengths):
    """One text for each length, with everything at hand."""
    if not lengths:
        return []
    total, groups = sum(lengths), []
    target = lambda k: len(text) * lengths[k] / total if k < len(lengths) and total else 0.0
    for piece in split.PIECE.findall(text):
        size = len(groups[-1]) if groups else 0
        near = abs(size + len(piece) - target(len(groups) - 1)) <= abs(size - target(len(groups) - 1))
        if groups and near:
            groups[-1] += piece
        else:
            groups.append(piece)
    return groups if len(groups) == len(lengths) else [text, *[None] * (len(lengths) - 1)]


def folded(r, text, lengths):
    """The same by the fold, given bit by bit."""
    pieces, total = split.PIECE.findall(text), sum(lengths)
    fold, out, a, b = split.Fold(), {}, 0, 0
    targets = [len(text) * n / total if total else 0.0 for n in lengths]
    while True:
        c, d = min(len(pieces), a + r.randrange(4)), min(len(targets), b + r.randrange(4))
        fold.add([(i, len(pieces[i])) for i in range(a, c)], targets[b:d])
        a, b = c, d
        for piece, group in fold.steps(a == len(pieces) and b == len(targets)):
            out[group] = out.get(group, "") + pieces[piece]
        if a == len(pieces) and b == len(targets):
            break
    return list(out.values()) if len(out) == len(lengths) else [text, *[None] * (len(lengths) - 1)]


def test_the_fold_matches_the_plain_one():
    r = random.Random(3)
    assert proportional("甲乙，丙丁。戊己。", [6, 3]) == ["甲乙，丙丁。", "戊己。"] and proportional("甲乙丙丁。", [1, 1]) == ["甲乙丙丁。", None]
    assert proportional("甲。乙。丙。", [1, 1, 1]) == ["甲。", "乙。", "丙。"] and proportional("", [3]) == [""]
    for _ in range(3000):
        text = "".join(r.choice("甲乙丙丁。，") for _ in range(r.randrange(30)))
        lengths = [r.randrange(6) for _ in range(r.randrange(1, 7))]
        assert folded(r, text, lengths) == proportional(text, lengths), (text, lengths)


def test_chapters_are_split_as_the_plain_fold_does(spark):
    r = random.Random(5)
    texts = ["".join(r.choice("甲乙丙丁戊。，、") for _ in range(r.choice([0, 1, 9, 60, 400]))) for _ in range(60)] + [None]
    slots = [[r.choice([None, "a" * r.randrange(1, 9)]) for _ in range(r.choice([1, 1, 2, 5, 30]))] for _ in texts]
    chunks = spark.createDataFrame([("c", 900 - 7 * i, t) for i, t in enumerate(texts)] + [("d", 0, "no sentence")], "corpus string, chapter int, text string")
    rows = [("c", 900 - 7 * i, 3 * k, s) for i, own in enumerate(slots) for k, s in enumerate(own)] + [("e", 0, 1, "no text")]
    got = split.proportional_split(chunks, spark.createDataFrame(rows, "corpus string, chapter int, seq int, text string"))
    expected = {(900 - 7 * i, 3 * k): c for i, (t, own) in enumerate(zip(texts, slots)) for k, c in enumerate(proportional(t or "", [len(s or "") for s in own]))}
    assert {(x["chapter"], x["seq"]): x["content"] for x in got.collect()} == expected
    assert sum(c is not None for (_, k), c in expected.items() if k) > 9
    assert split.proportional_split(chunks.limit(0), spark.createDataFrame(rows, "corpus string, chapter int, seq int, text string")).count() == 0


def test_a_long_chapter_is_held_in_bits():
    """300,000 pieces for 100,000 sentences in the order of the stream: what the fold holds stays small."""
    r = random.Random(9)
    sizes = [r.randrange(1, 20) for _ in range(300_000)]
    lengths = [r.randrange(1, 50) for _ in range(100_000)]
    total, chars = sum(lengths), sum(sizes)
    rows, at, so_far = [], 0, 0.0
    for n in lengths:
        rows.append((so_far, 0, n * chars / total))
        so_far += n * chars / total
    for k, n in enumerate(sizes):
        rows.append((at, 1, (k, n)))
        at += n
    rows.sort(key=lambda x: x[:2])
    fold, held, seen = split.Fold(), 0, 0
    for a in range(0, len(rows), 1000):
        part = rows[a : a + 1000]
        fold.add([x for _, kind, x in part if kind], [x for _, kind, x in part if not kind])
        seen += sum(1 for _ in fold.steps(False))
        held = max(held, len(fold.pieces) + len(fold.targets))
    seen += sum(1 for _ in fold.steps(True))
    assert seen == len(sizes) and held < 20_000


def test_proportional_split(spark):
    chunks = spark.createDataFrame([("c", 1, "甲。乙。"), ("c", 2, None)], "corpus string, chapter int, text string")
    sentences = spark.createDataFrame([("c", 1, 1, "a"), ("c", 1, 2, "b"), ("c", 2, 1, None), ("c", 2, 2, "x")], "corpus string, chapter int, seq int, text string")
    got = {(r["chapter"], r["seq"]): r["content"] for r in split.proportional_split(chunks, sentences).collect()}
    assert got == {(1, 1): "甲。", (1, 2): "乙。", (2, 1): "", (2, 2): None}


REPORT = """# 对齐报告：5.txt

## 基本信息

| 项目 | 值 |
|------|----|
| 源文件 | `5.txt` |
| 生成时间 | now |
| 模型 | `m` |
| 句子总数 | 9 |
| 未对齐（null）| 1 |

## Token 用量

| 类型 | 数量 |
|------|------|
| Prompt tokens | 3 |
| Completion tokens | 4 |
| Total tokens | 7 |
| cached | 2 |

## 原始差异

发现 2 处差异（已忽略空白）：

```diff
@@ a
+ x
@@ b
```

## 自动修正

自动修正 1 处差异：
  record[0] 位置 [1]: `a` → `b`

跳过 1 处复杂差异（需人工检查）：
  tag=insert

## 修正后剩余差异

剩余 1 处差异（需人工检查）：

```diff
@@ b
```
"""

CLEAN = """

## 原始差异

✅ 无差异：对齐后拼接文本与原文完全一致（忽略空白）。

## 自动修正

自动修正 0 处差异：

## 修正后剩余差异

✅ 无剩余差异。
"""


def test_alignment_report(spark):
    schema = "chapter int, file string, generated_at string, model string, sentences int, nulls int, prompt_tokens int, completion_tokens int, total_tokens int, extra map<string, string>, hunks array<string>, log array<string>, fixed_log array<string>, skipped_log array<string>, log_left array<string>"
    figures = ("5.txt", "now", "m", 9, 1, 3, 4, 7)
    rows = [(1, *figures, {"cached": "2"}, ["a", "b"], ["@@ a", "+ x", "@@ b"], ["自动修正 1 处差异：", "  record[0] 位置 [1]: `a` → `b`"], ["跳过 1 处复杂差异（需人工检查）：", "  tag=insert"], ["@@ b"])]
    rows.append((2, *figures, None, [], [], ["自动修正 0 处差异："], ["跳过 0 处复杂差异（需人工检查）："], []))
    got = {r["chapter"]: r["report"] for r in reports.alignment_report(spark.createDataFrame(rows, schema), ["chapter"]).collect()}
    assert got[1] == REPORT
    assert got[2] == REPORT.split("\n| cached")[0] + CLEAN


def plain_hunks(a, b):
    return [(tag, *places) for tag, *places in difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes() if tag != "equal"]


def told_hunks(a, b):
    return [(h["tag"], h["orig_start"], h["orig_end"], h["aligned_start"], h["aligned_end"]) for h in diff.hunks_of(a, b)]


def test_hunks_are_those_of_the_standard_library():
    r = random.Random(11)
    for _ in range(400):
        letters = r.choice(["ab", "abcdef", "abcdefghijklmnopqrst 甲𝄞"])
        a = "".join(r.choice(letters) for _ in range(r.choice([1, 40, r.randrange(500)])))
        b = list(a)
        for _ in range(r.choice([0, 1, 3, 30])):
            k, size = r.randrange(len(b) + 1), r.choice([0, 1, 15])
            b[k : k + size] = r.choice(["", "§", r.choice(letters), a[: r.randrange(30)]])
        assert told_hunks(a, "".join(b)) == plain_hunks(a, "".join(b))
    # stretches of this sequence and of its opposite have equal hashes
    bits = ["ab"[bin(k).count("1") % 2] for k in range(2048)]
    a, b = "".join(bits), "".join("ab"[x == "a"] for x in bits)
    assert told_hunks(a, b) == plain_hunks(a, b)


def test_the_time_of_a_comparison_does_not_grow_with_the_square():
    r = random.Random(12)
    text = "".join(r.choice("etaoinshrdlucmf") for _ in range(40_000))
    start = time.process_time()
    assert len(diff.hunks_of(text, text[:9_000] + text[9_001:30_000] + "§" + text[30_001:] + "§")) == 3
    assert time.process_time() - start < 10  # the standard library takes several times as long


def test_proportional_split_moves_texts_once(spark, monkeypatch):
    """A chapter's text is stored once, and not joined: one that does not fit is put together from its pieces."""
    stored, plain = [], split.store
    for module in (split, ranks):
        monkeypatch.setattr(module, "store", lambda df, label: stored.append((label, df.columns)) or plain(df, label))
    texts = {1: "甲，乙。丙", 2: "", 3: None, 4: "一。二", 5: "\n 甲，\n\n乙。"}
    chunks = spark.createDataFrame([("c", k, t) for k, t in texts.items()], "corpus string, chapter int, text string")
    slots = {1: ["a", "b", "c"], 2: ["a", "b"], 3: [None], 4: ["a"] * 4, 5: ["a" * 9]}
    rows = spark.createDataFrame([("c", k, i, t) for k, own in slots.items() for i, t in enumerate(own)], "corpus string, chapter int, seq int, text string")
    got = {(r["chapter"], r["seq"]): r["content"] for r in split.proportional_split(chunks, rows).collect()}
    assert [got[1, i] for i in range(3)] == ["甲，", "乙。", "丙"]
    assert (got[2, 0], got[2, 1], got[3, 0]) == ("", None, "")
    assert [got[4, i] for i in range(4)] == ["一。二", None, None, None]
    assert got[5, 0] == "\n 甲，\n\n乙。"
    assert [label for label, columns in stored if "text" in columns] == ["numbered"]

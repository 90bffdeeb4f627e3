"""Markdown reports as columns. Headings and wording are fixed by the report format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bilinea.functions.ranks import ranked


def joined(*parts: Column | str) -> Column:
    """Lines, and arrays of lines, as one text."""
    return F.array_join(F.concat(*[F.array(F.lit(p)) if isinstance(p, str) else p for p in parts]), "\n")


def row(name: str, value: Column) -> Column:
    return F.array(F.concat(F.lit(f"| {name} | "), value, F.lit(" |")))


def alignment_report(chapters: DataFrame, keys: list[str] = ("corpus", "chapter")) -> DataFrame:
    """keys, report. chapters: keys, file, generated_at, model, sentences, nulls, prompt_tokens, completion_tokens,
    total_tokens, extra (a map), hunks, log, fixed_log, skipped_log and log_left (arrays). A null log or log_left says that
    the texts were not compared."""
    shown = lambda c: F.col(c).cast("string")
    ticked = lambda c: F.concat(F.lit("`"), F.col(c), F.lit("`"))
    none = F.array().cast("array<string>")
    fenced = lambda head, log: F.concat(F.array(head, F.lit(""), F.lit("```diff")), log, F.array(F.lit("```")))
    extra = F.transform(F.array_sort(F.map_entries("extra")), lambda e: F.concat(F.lit("| "), e["key"], F.lit(" | "), F.coalesce(e["value"], F.lit("None")), F.lit(" |")))
    left = F.size(F.filter("log_left", lambda x: x.startswith("@@")))
    open_end = F.array(F.lit("⚠️ 未比对：文本超过长度上限，差异未知。"))  # ours: the format has no such case
    report = joined(
        F.array(F.concat(F.lit("# 对齐报告："), "file"), F.lit("")),
        "## 基本信息",
        "",
        "| 项目 | 值 |",
        "|------|----|",
        row("源文件", ticked("file")),
        row("生成时间", F.col("generated_at")),
        row("模型", ticked("model")),
        row("句子总数", shown("sentences")),
        F.array(F.concat(F.lit("| 未对齐（null）| "), shown("nulls"), F.lit(" |"))),
        "",
        "## Token 用量",
        "",
        "| 类型 | 数量 |",
        "|------|------|",
        row("Prompt tokens", shown("prompt_tokens")),
        row("Completion tokens", shown("completion_tokens")),
        row("Total tokens", shown("total_tokens")),
        F.coalesce(extra, none),
        "",
        "## 原始差异",
        "",
        F.when(F.col("log").isNull(), open_end).when(F.size("log") == 0, F.array(F.lit("✅ 无差异：对齐后拼接文本与原文完全一致（忽略空白）。"))).otherwise(fenced(F.format_string("发现 %d 处差异（已忽略空白）：", F.size("hunks")), F.col("log"))),
        "",
        "## 自动修正",
        "",
        F.col("fixed_log"),
        "",
        F.when(F.size("skipped_log") > 1, F.concat(F.col("skipped_log"), F.array(F.lit("")))).otherwise(none),
        "## 修正后剩余差异",
        "",
        F.when(F.col("log_left").isNull(), open_end).when(F.size("log_left") == 0, F.array(F.lit("✅ 无剩余差异。"))).otherwise(fenced(F.format_string("剩余 %d 处差异（需人工检查）：", left), F.col("log_left"))),
        "",
    )
    return chapters.select(*keys, report.alias("report"))


def glossary_report(glossary: DataFrame, failures: DataFrame) -> DataFrame:
    """line_no, line: the report's lines, numbered from 0: how many entries there are, and a table of those that lack a
    field, by source and place. Entries are put in order by ranges, so no task and no row holds the table; write_lines
    writes it in parts."""
    note = F.replace(F.replace("note", F.lit("|"), F.lit("｜")), F.lit("\n"), F.lit(" "))
    line = F.concat(F.lit("| "), "source", F.lit(" | "), F.col("id").cast("string"), F.lit(" | `"), F.array_join("missing", ", "), F.lit("` | "), note, F.lit(" |"))
    totals = glossary.agg(F.count(F.lit(1)).alias("total")).crossJoin(F.broadcast(failures.agg(F.count(F.lit(1)).alias("n"))))  # one row each
    table = [F.lit(x) for x in ("## 字段缺失详情", "", "| 来源文件 | id | 缺失字段 | 注释原文（前120字） |", "|----------|----|----------|---------------------|")]
    opening = [F.lit("# 注释提取报告"), F.lit(""), F.format_string("- 总条目数：%d", "total"), F.format_string("- 字段缺失条目：%d", "n"), F.lit("")]
    body = F.when(F.col("n") == 0, F.array(F.lit("✅ 全部条目均成功提取所有字段。"))).otherwise(F.array(*table))
    head = totals.select(F.posexplode(F.concat(F.array(*opening), body)).alias("line_no", "line"))
    rows = ranked(failures.select("source", "pos", "id", line.alias("line")), ["source", "pos", "id"], "place")
    return head.select(F.col("line_no").cast("long"), "line").unionByName(rows.select((F.col("place") + len(opening) + len(table)).alias("line_no"), "line"))

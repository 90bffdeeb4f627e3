"""Writers: chunks, maps, aligned records, glossary, summaries, meta. JSON keeps null fields."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bilinea.operators.glossary import in_order
from bilinea.sources.readers import COMMITTED, committed_runs

#: The summary's headings, in order, over our column names.
SUMMARY_HEADINGS = {
    "no": "序号",
    "file": "文件名",
    "sentences": "句子总数",
    "chars": "中文字符数",
    "model": "模型",
    "prompt_tokens": "Prompt tokens",
    "completion_tokens": "Completion tokens",
    "hunks": "原始差异",
    "hunks_left": "修正后剩余差异",
    "generated_at": "生成时间",
}


def write_chunks(chunks: DataFrame, path: str) -> None:
    """corpus, file, text as Parquet, a folder for each corpus; only corpora that are written are replaced."""
    chunks.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("corpus").parquet(path)


def file_name(column: str) -> Column:
    """column=value as the name of a file or folder, with odd characters as Spark writes them."""
    odd = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")
    shown = F.coalesce(F.col(column).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    for ch in sorted((c for c in map(chr, range(1, 128)) if odd.match(c)), key=lambda c: c != "%"):
        shown = F.replace(shown, F.lit(ch), F.lit(f"%{ord(ch):02X}"))
    return F.concat(F.lit(f"{column}="), shown)


def export_chunks(chunks: DataFrame, path: str, text: str = "text", keep: bool = False) -> None:
    """The texts as text files, a folder for each corpus and a file for each chapter: for people, and for splitting by hand.
    keep: chapters that are not written stay. Rows of one chapter are lines of its file.

    Tasks write the files themselves, under a hidden name until they are whole. Spark's writer would make a folder for each
    file, and the driver would move or look at every one of them.
    """
    spark = chunks.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not keep:
        system.delete(at, True)
    system.mkdirs(at)
    root = path if "://" in path or path.startswith("file:") else f"file://{system.makeQualified(at).toUri().getPath()}"
    names = chunks.select(file_name("corpus").alias("corpus"), file_name("file").alias("file"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = names.repartition("corpus", "file").sortWithinPartitions("corpus", "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to, base = fs.FileSystem.from_uri(root)
        folders: set[str] = set()
        each = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        n = 0
        for (corpus, file), texts in groupby(each, key=lambda row: row[:2]):
            if corpus not in folders:
                to.create_dir(f"{base}/{corpus}", recursive=True)
                folders.add(corpus)
            hidden = f"{base}/{corpus}/.{uuid.uuid4().hex}"
            with to.open_output_stream(hidden) as out:
                for row in texts:
                    out.write(row[2].encode() + b"\n")
            to.move(hidden, f"{base}/{corpus}/{file}")
            n += 1
        yield pa.record_batch([pa.array([n], pa.int64())], names=["n"])

    rows.mapInArrow(run, "n long").agg(F.sum("n")).collect()


def write_para_map(para_map: DataFrame, path: str, key: str = "html") -> None:
    """Appends map rows as JSON lines, in page order: each file of a run holds a range of it, in the order of their
    names, so no task writes more than its share however long a corpus's map is."""
    write_para_map_rows(para_map, path, key, "append")


def write_para_map_rows(para_map: DataFrame, path: str, key: str, mode: str) -> None:
    order = [c for c in ("page_pos", "pos", key) if c in para_map.columns][:1]
    rows = para_map.repartitionByRange("corpus", *order).sortWithinPartitions("corpus", *order)
    rows.select("corpus", key, "para_start", "para_end").write.mode(mode).option("ignoreNullFields", "false").partitionBy("corpus").json(path)


def write_run(para_map: DataFrame, path: str, run: str, key: str = "html") -> bool:
    """Appends map rows as the run of that name; whether it did. The rows go to a folder of the run, and a line in a folder
    of committed runs makes them count. A run that failed on the way left nothing that counts, and is written over when
    it comes again; one that is committed already changes nothing. Of committed runs a later one follows an earlier one."""
    spark = para_map.sparkSession
    done = committed_runs(spark, path)
    if run in done:
        return False
    write_para_map_rows(para_map, f"{path}/run={run}", key, "overwrite")
    spark.createDataFrame([(run, len(done))], "run string, place long").coalesce(1).write.mode("overwrite").json(f"{path}/{COMMITTED}/{run}")
    return True


def write_aligned(records: DataFrame, path: str) -> None:
    """corpus, chapter, seq and the record's fields as JSON lines in order, a folder for each chapter; chapters that are
    written replace their former selves, others stay. A chapter of many records is several files, in the order of their
    names: tasks hold ranges of records, not whole chapters."""
    rows = records.repartitionByRange("corpus", "chapter", "seq").sortWithinPartitions("corpus", "chapter", "seq")
    out = rows.select("corpus", "chapter", "id", "original", "content").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.option("ignoreNullFields", "false").partitionBy("corpus", "chapter").json(path)


def write_glossary(glossary: DataFrame, csv_path: str, json_path: str) -> None:
    """The six fields by id, as CSV with empty cells for nulls and as JSON lines with nulls."""
    rows = in_order(glossary).select("id", "pali_word", "meaning", "meaning2", "note", "source")
    rows.write.mode("overwrite").csv(csv_path, header=True, quote='"', escape='"', nullValue="", emptyValue="")
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(json_path)


def write_summary(summary: DataFrame, path: str) -> None:
    """The summary as one CSV file for each corpus, under the fixed headings, by number; unknown cells are empty."""
    rows = summary.repartition("corpus").sortWithinPartitions("corpus", "no")
    shown = [F.col(name).alias(heading) for name, heading in SUMMARY_HEADINGS.items()]
    rows.select("corpus", *shown).write.mode("overwrite").partitionBy("corpus").csv(path, header=True, quote='"', escape='"', nullValue="", emptyValue="")


def write_meta(meta: DataFrame, path: str) -> None:
    """A JSON object for each corpus, in a folder of its own."""
    rows = meta.withColumn("_folder", F.col("corpus"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", "false").partitionBy("_folder").json(path)


def write_reports(reports: DataFrame, path: str) -> None:
    """corpus, chapter, report as text files, a folder for each chapter."""
    reports.select("corpus", "chapter", "report").write.mode("overwrite").partitionBy("corpus", "chapter").text(path)


def write_lines(lines: DataFrame, path: str) -> None:
    """line_no, line as text in parts: each file holds a range of the lines, in the order of their names."""
    lines.repartitionByRange("line_no").sortWithinPartitions("line_no").select("line").write.mode("overwrite").text(path)

"""Many small files, listed and read by tasks: the driver holds neither their names nor what Spark keeps of each."""

from __future__ import annotations

import os
import re
import stat
from collections.abc import Iterator
from itertools import batched

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a batch of names, bytes of a batch of contents, about, and files and bytes that a task reads.
NAMES, BATCH_BYTES = 10_000, 4 << 20
FILES_PER_TASK, BYTES_PER_TASK = 4_000, 32 << 20

#: What a folder has: name, whether it is a folder, bytes, and when it was last written, in milliseconds.
Entry = tuple[str, bool, int, int]


class Store:
    """A folder as Spark spells it, and as tasks open it: local ones directly, others through pyarrow."""

    def __init__(self, shown: str, local: str | None) -> None:
        self.shown, self.local = shown, local

    def entries(self, folder: str, wanted: re.Pattern[str]) -> Iterator[Entry]:
        """What is in shown/folder by names of that form; nothing if it is gone. A local folder is read bit by bit, one in
        another store is one answer of that store."""
        if self.local is None:
            to, base = fs.FileSystem.from_uri(self.shown)
            for i in to.get_file_info(fs.FileSelector(f"{base}/{folder}", allow_not_found=True)):
                if wanted.search(i.base_name):
                    yield i.base_name, i.type == fs.FileType.Directory, i.size or 0, (i.mtime_ns or 0) // 1_000_000
            return
        try:
            found = os.scandir(f"{self.local}/{folder}")
        except FileNotFoundError:
            return
        with found:
            for entry in found:
                if wanted.search(entry.name):
                    try:
                        now = entry.stat()
                    except FileNotFoundError:  # gone meanwhile
                        continue
                    yield entry.name, stat.S_ISDIR(now.st_mode), now.st_size, now.st_mtime_ns // 1_000_000

    def read(self, path: str) -> bytes:
        """What is in the file of that path, which begins as shown does."""
        rest = path[len(self.shown) :]
        if self.local is not None:
            with open(self.local + rest, "rb") as file:
                return file.read()
        to, base = fs.FileSystem.from_uri(self.shown)
        with to.open_input_stream(base + rest) as file:
            return file.read()


def store_of(spark: SparkSession, root: str) -> Store | None:
    """None for stores that pyarrow does not reach from here."""
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    at = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at)
    if at.toUri().getScheme() == "file":
        return Store(at.toString(), at.toUri().getPath())
    try:
        fs.FileSystem.from_uri(at.toString())
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return None
    return Store(at.toString(), None)


def files_in(store: Store, folder: str, ending: str) -> Iterator[tuple[str, str, int, int]]:
    """(file, its path, bytes, time) of the files folder/file with that ending, and of the parts in folders of such names, as
    Spark writes them. Hidden and empty ones are passed over, as Spark's readers do."""
    hidden = r"(?!\.|_[^=]*$)(?!.*\._COPYING_$)"
    for name, inner, length, changed in store.entries(folder, re.compile(rf"(?s)^{hidden}.*{ending}$")):
        if inner:
            for part, deeper, length, changed in store.entries(f"{folder}/{name}", re.compile(rf"(?s)^{hidden}part-")):
                if length and not deeper:
                    yield name, f"{store.shown}/{folder}/{name}/{part}", length, changed
        elif length:
            yield name, f"{store.shown}/{folder}/{name}", length, changed


def list_files(spark: SparkSession, root: str, corpus: str, ending: str) -> DataFrame | None:
    """corpus, file, path, length, changed of the files root/corpus/file with that ending. One task lists the corpora, and
    one each lists a corpus. None where tasks cannot, or no folder is of that name, which Spark's readers tell better."""
    store = store_of(spark, root)
    if store is None:
        return None

    def folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            names = (name for name, inner, _, _ in store.entries("", re.compile("")) if inner)
            for some in batched(names, NAMES):
                yield pa.record_batch([pa.array(some, pa.string())], names=["folder"])

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for folder in (f for batch in batches for f in batch.column(0).to_pylist()):
            for some in batched(files_in(store, folder, ending), NAMES):
                file, path, length, changed = zip(*some)
                yield pa.record_batch([pa.array([folder] * len(some)), pa.array(file), pa.array(path), pa.array(length, pa.int64()), pa.array(changed, pa.int64())], names=["corpus", "file", "path", "length", "changed"])

    named = spark._jvm.org.apache.hadoop.fs.GlobPattern(corpus).compiled().pattern()  # the store's own globs
    below = spark.range(0, 1, 1, 1).mapInArrow(folders, "folder string").where(F.col("folder").rlike(f"(?s)^(?:{named})$"))
    if below.isEmpty():
        return None
    found = below.repartition(4 * spark.sparkContext.defaultParallelism).mapInArrow(files, "corpus string, file string, path string, length long, changed long")
    names = [F.regexp_replace(c, f"^{c}=", "").alias(c) for c in ("corpus", "file")]
    return found.select(*names, "path", "length", F.timestamp_millis("changed").alias("changed"))


def read_files(spark: SparkSession, root: str, rows: DataFrame, files: int, size: int) -> DataFrame:
    """corpus, file, content of rows (corpus, file, path) that list_files gave, so many files and bytes, dealt out evenly."""
    store = store_of(spark, root)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some: list[tuple[str, str, bytes]] = []
        held = 0

        def batch() -> pa.RecordBatch:
            corpus, file, content = zip(*some)
            return pa.record_batch([pa.array(corpus), pa.array(file), pa.array(content, pa.binary())], names=["corpus", "file", "content"])

        for corpus, file, path in (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns))):
            some.append((corpus, file, store.read(path)))
            held += len(some[-1][2])
            if held >= BATCH_BYTES:
                yield batch()
                some, held = [], 0
        if some:
            yield batch()

    tasks = max(spark.sparkContext.defaultParallelism, files // FILES_PER_TASK, size // BYTES_PER_TASK)
    return rows.select("corpus", "file", "path").repartition(tasks).mapInArrow(run, "corpus string, file string, content binary")

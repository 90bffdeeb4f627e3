"""A growing folder of page files as one table: only files that are new or have changed are read.

What was compacted is written down in a ledger: of each page (corpus, file) its path, size and time, and the run that read
it. A run reads the files that the ledger does not have as they are now, writes their pages under its number, and then its
part of the ledger, which makes them count. A run that fails before that leaves everything as it was, and the next one has
its number and writes over it. Readers take each page from the last run that read it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bilinea.functions.text import page_number
from bilinea.sources.listing import list_files, read_files
from bilinea.sources.readers import files_below, named_by_path

FILE = "corpus string, file string, path string, length long, changed timestamp"
LEDGER = f"{FILE}, run int"
PAGES = "corpus string, file string, page_no long, html string, run int"
KEY = ["corpus", "file"]
STATE = ["path", "length", "changed"]


def stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of runs, empty if nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def files(spark: SparkSession, root: str, corpus: str = "*", content: bool = False) -> DataFrame:
    """corpus, file, path, length, changed of every page file; what is in them is not read unless content is asked for.
    Spark's own listing: the driver holds all files."""
    names = named_by_path(r"\.html")
    found = files_below(spark, "binaryFile", root, corpus, r"\.html").withColumnRenamed("modificationTime", "changed")
    return found.select(*names, *STATE, *["content"] * content)


def pending_of(spark: SparkSession, found: DataFrame, table: str) -> DataFrame:
    """The files found that are new or have changed since they were compacted."""
    ledger = stored(spark, f"{table}/ledger", LEDGER)
    last = ledger.groupBy(*KEY).agg(F.max_by(F.struct(*STATE), "run").alias("l")).select(*KEY, "l.*")
    return found.join(last, [*KEY, *STATE], "left_anti")


def pending_files(spark: SparkSession, root: str, table: str, corpus: str = "*") -> DataFrame:
    """The files below root/corpus that are new or have changed since they were compacted."""
    found = list_files(spark, root, corpus, r"\.html")
    return pending_of(spark, files(spark, root, corpus) if found is None else found, table)


def compact_pages(spark: SparkSession, root: str, table: str, corpus: str = "*") -> int:
    """Brings the table up to the files below root/corpus; how many files it read. Files that are gone keep their page.

    Tasks list the folders and read the pending files, so no list of files comes to the driver; where none is pending, no
    file is opened. In stores that tasks do not reach, Spark lists files, which the driver then holds: content is read under
    a filter on time, which the source applies before it opens a file, and joined with the files that are pending.
    """
    run = (stored(spark, f"{table}/ledger", LEDGER).agg(F.max("run")).first()[0] or 0) + 1
    part = f"run={run}"
    listed = list_files(spark, root, corpus, r"\.html")
    now = files(spark, root, corpus) if listed is None else listed
    pending_of(spark, now, table).select(*KEY, *STATE).write.mode("overwrite").parquet(f"{table}/pending/{part}")
    pending = spark.read.schema(FILE).parquet(f"{table}/pending/{part}")
    n, size, oldest = pending.agg(F.count(F.lit(1)), F.sum("length"), F.min("changed")).first()
    if not n:
        return 0
    if listed is None:
        found = files(spark, root, corpus, content=True).where(F.col("changed") >= F.lit(oldest)).join(pending, [*KEY, *STATE], "left_semi")
    else:
        found = read_files(spark, root, pending, n, size)
    rows = found.select(*KEY, page_number(F.col("file")).alias("page_no"), F.col("content").cast("string").alias("html"))
    rows.write.mode("overwrite").parquet(f"{table}/pages/{part}")
    pending.write.mode("overwrite").parquet(f"{table}/ledger/{part}")  # from now on the run counts
    return n


def read_compacted(spark: SparkSession, table: str) -> DataFrame:
    """corpus, file, page_no, html: each page as the last run found it."""
    last = stored(spark, f"{table}/ledger", LEDGER).groupBy(*KEY).agg(F.max("run").alias("run"))
    return stored(spark, f"{table}/pages", PAGES).join(last, [*KEY, "run"], "left_semi").select("corpus", "file", "page_no", "html")

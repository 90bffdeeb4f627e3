"""Readers: pages, maps, glossary, source tables, aligned records, chunks and corpus meta. All schemas are declared."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bilinea.functions import schemas
from bilinea.functions.ranks import ranked_within
from bilinea.functions.text import is_blank, ordered_join, page_number, strip

#: What cuts lines besides \n, \r and \r\n if lines are to be cut everywhere that Unicode has them end; fixed values.
MORE_LINE_ENDS = r"\x0b\x0c\x1c\x1d\x1e\x85\x{2028}\x{2029}"

#: What files of one write have in common in their names, wherever Spark wrote them; a fixed pattern.
WRITE = r"/part-\d+-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})[^/]*$"
#: The folder of a map's committed runs: readers of data pass over names that begin like this.
COMMITTED = "_committed"
#: Stretches of a database table that are counted to part it.
BINS = 1_024
#: Spark's setting for how many tasks list folders at most.
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def decoded(name: Column) -> Column:
    """A name out of a file path, whose odd characters Spark gives as %XX."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def path_part(path: Column, pattern: str) -> Column:
    return decoded(F.regexp_extract(path, pattern, 1))


def named_by_path(ending: str) -> list[Column]:
    """corpus (the folder) and file (its name) of a file's path corpus/file, or corpus=.../file=... as
    export_chunks writes them, or corpus=.../file=.../part-... as Spark does."""
    path, part = F.col("_metadata.file_path"), "(?:/part-[^/]*)?$"
    corpus, file = path_part(path, rf"([^/]*)/[^/]*{ending}{part}"), path_part(path, rf"([^/]*{ending}){part}")
    return [F.regexp_replace(c, f"^{name}=", "").alias(name) for c, name in ((corpus, "corpus"), (file, "file"))]


def files_below(spark: SparkSession, source: str, root: str, corpus: str, ending: str, **options: bool) -> DataFrame:
    """The files root/corpus/file with that ending, and those in folders of such names, as Spark writes them.

    Spark is given the corpora's folders, not a path for each file: those would all be looked up by the driver, and each
    would be a listing of its own. Folders in them are listed by a few tasks a core; by default there are up to 10,000.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    depth = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).depth()
    name = rf"^[^:/]+:(//[^/]*)?(/[^/]+){{{depth + 1}}}/[^/]*{ending}(/part-[^/]*)?$"
    usual = spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, str(min(int(usual), 4 * spark.sparkContext.defaultParallelism)))
    try:
        found = spark.read.format(source).options(recursiveFileLookup=True, **options).load(f"{root}/{corpus}")
    finally:
        spark.conf.set(LISTING_TASKS, usual)
    return found.where(F.col("_metadata.file_path").rlike(name))


def whole_files(spark: SparkSession, root: str, corpus: str, ending: str) -> DataFrame:
    """corpus, file, value (its text): for files that are one value each."""
    return files_below(spark, "text", root, corpus, ending, wholetext=True).select(*named_by_path(ending), "value")


def numbered_lines(spark: SparkSession, glob: str | list[str], every_line_end: bool = False) -> DataFrame:
    """path, changed, line_no (from 0 in each file), line: files are read in blocks, by many tasks; blank lines are left
    out but counted. every_line_end also cuts at the rarer Unicode line ends.

    A line's number is its place within its block and the lines of the file's earlier blocks, a sum over one row for
    each block. changed: when the file was last written.
    """
    meta = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("changed"), F.col("_metadata.file_block_start").alias("block")]
    line = F.explode(F.split("value", f"[{MORE_LINE_ENDS}]")) if every_line_end else F.col("value")
    rows = spark.read.text(glob).select(*meta, line.alias("line")).withColumn("at", F.monotonically_increasing_id())
    blocks = rows.groupBy("path", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("path", "block", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    out = rows.where(~is_blank(F.col("line"))).join(blocks, ["path", "block"])
    return out.select("path", "changed", (F.col("before") + F.col("at") - F.col("first")).alias("line_no"), "line")


def read_joined(spark: SparkSession, path: str, text: str) -> DataFrame:
    """One row: the lines of all parts of a text that write_lines wrote, in order. For texts that fit into a row."""
    place = F.struct("_metadata.file_name", "_metadata.file_block_start", F.monotonically_increasing_id())
    return spark.read.text(path).select(place.alias("place"), "value").agg(ordered_join(F.col("place"), F.concat("value", F.lit("\n"))).alias(text))


def read_pages(spark: SparkSession, root: str, corpus: str = "*") -> DataFrame:
    """corpus, file, page_no, html: every page below root/corpus. page_no is -1 for names without a number. Many small
    files are best read once and written as Parquet."""
    pages = whole_files(spark, root, corpus, r"\.html")
    return pages.select("corpus", "file", page_number(F.col("file")).alias("page_no"), F.col("value").alias("html"))


def read_para_map(spark: SparkSession, root: str, corpus: str = "*", key: str = "html", files: str = "para_map.jsonl") -> DataFrame:
    """corpus, key, para_start, para_end, pos: the map of each corpus. Of lines with the same key the last one counts and
    stands where the first one stood; pos is that place, from 0 without gaps. Where files matches several of a corpus,
    as after appending, they follow each other by the time they were written, then by name. Files that Spark wrote at once
    go by their names alone, since tasks end in any order: all of them have the time of the first one."""
    path = f"{root}/{corpus}/{files}"
    # Spark names a file by its place and by the write it belongs to; any other file is a write of its own
    mark = F.regexp_extract("path", WRITE, 1)
    named = F.when(mark == "", F.col("path")).otherwise(mark).alias("write")
    written = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("path"), "modificationTime")  # opens no file
    written = written.groupBy(named).agg(F.min("modificationTime").alias("written"))
    lines = numbered_lines(spark, path).select("*", named).join(written, "write")
    at = F.struct("written", "write", "path", "line_no").alias("line_no")
    rows = lines.select(F.regexp_replace(path_part(F.col("path"), "([^/]*)/[^/]*$"), "^corpus=", "").alias("corpus"), at, F.from_json(strip(F.col("line")), f"`{key}` string, para_start int, para_end int").alias("r"))
    return last_wins(rows.select("corpus", F.col(f"r.{key}").alias(key), "r.para_start", "r.para_end", "line_no"), key)


def committed_runs(spark: SparkSession, path: str) -> list[str]:
    """The names of a map's committed runs, in order: a name for each time that pages were located."""
    try:
        found = spark.read.schema("run string, place long").json(f"{path}/{COMMITTED}/*")
        return [r["run"] for r in found.orderBy("place").collect()]
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return []


def read_runs(spark: SparkSession, path: str, key: str = "html") -> DataFrame:
    """corpus, key, para_start, para_end, pos: the map that write_run wrote, of committed runs alone, in their order."""
    runs = committed_runs(spark, path)
    if not runs:
        return spark.createDataFrame([], f"corpus string, `{key}` string, para_start int, para_end int, pos long")
    lines = numbered_lines(spark, [f"{path}/run={run}/*/*.json" for run in runs])
    name = path_part(F.col("path"), "/run=([^/]*)/[^/]*/[^/]*$")
    at = F.struct(F.array_position(F.array(*map(F.lit, runs)), name).alias("run"), "path", "line_no").alias("line_no")
    corpus = F.regexp_replace(path_part(F.col("path"), "([^/]*)/[^/]*$"), "^corpus=", "").alias("corpus")
    rows = lines.select(corpus, at, F.from_json(strip(F.col("line")), f"`{key}` string, para_start int, para_end int").alias("r"))
    return last_wins(rows.select("corpus", F.col(f"r.{key}").alias(key), "r.para_start", "r.para_end", "line_no"), key)


def last_wins(rows: DataFrame, key: str) -> DataFrame:
    """One row for each corpus and key: the values of the last line, the place of the first. Places are counted by ranges
    of all lines, so that a corpus may be of any size."""
    values = [c for c in rows.columns if c not in ("corpus", key, "line_no")]
    out = rows.groupBy("corpus", key).agg(F.max_by(F.struct(*values), "line_no").alias("v"), F.min("line_no").alias("first"))
    placed = ranked_within(out, ["corpus"], ["first", key], "pos")
    return placed.select("corpus", key, *[f"v.{c}" for c in values], "pos")


def read_glossary(spark: SparkSession, path: str) -> DataFrame:
    """id, pali_word out of a CSV file with a header. Rows whose id is no integer or whose word is blank are left out; of
    equal ids the last one counts, by file and place in it."""
    found = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True, encoding="UTF-8").select("id", "pali_word", F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("at"))
    rows = found.select(F.when(strip(F.col("id")).rlike("^[+-]?[0-9]+$"), strip(F.col("id")).try_cast("int")).alias("id"), strip(F.col("pali_word")).alias("pali_word"), F.struct("path", "at").alias("at"))
    return rows.where(F.col("id").isNotNull() & ~is_blank(F.col("pali_word"))).groupBy("id").agg(F.max_by("pali_word", "at").alias("pali_word"))


def jdbc_ranges(spark: SparkSession, url: str, table: str, options: dict[str, str], column: str, parts: int) -> list[str]:
    """Conditions that part a table's rows into about equal shares by ranges of a whole number. The database counts: what
    comes to the driver are its ends, and counts of at most BINS stretches between them; a stretch with half a share or
    more is counted again in as many, so that gaps between numbers make no difference."""
    ask = lambda query: spark.read.jdbc(url, f"({query}) q", properties=options)
    # as the database spells and quotes it
    spelled = next(c for c in spark.read.jdbc(url, table, properties=options).columns if c.lower() == column.lower())
    column = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(spelled)

    def counted(low: int, high: int) -> list[tuple[int, int, int]]:
        """(first, last, rows) of the stretches from low to high that have rows, in order."""
        width = -(-(high - low + 1) // BINS)
        inner = f"SELECT FLOOR(({column} - ({low})) / {width}) AS bin FROM {table} WHERE {column} BETWEEN {low} AND {high}"
        rows = ask(f"SELECT bin, COUNT(*) AS n FROM ({inner}) b GROUP BY bin").collect()
        return sorted((low + int(r[0]) * width, min(high, low + int(r[0]) * width + width - 1), int(r[1])) for r in rows)

    low, high, n = ask(f"SELECT MIN({column}) AS low_end, MAX({column}) AS high_end, COUNT(*) AS n FROM {table}").first()
    if low is None:
        return ["1 = 1"]
    stretches, share = counted(int(low), int(high)), n / parts
    while heavy := [s for s in stretches if s[2] > share / 2 and s[1] > s[0]]:
        stretches = sorted([s for s in stretches if s not in heavy] + [t for a, b, _ in heavy for t in counted(a, b)])
    cuts, so_far = [], 0
    for first, _, here in stretches:
        # a stretch across a share's end goes to the side that most of it is on
        if so_far and len(cuts) < parts - 1 and so_far + here / 2 >= share * (len(cuts) + 1):
            cuts.append(first)
        so_far += here
    edges = [None, *cuts, None]
    out = []
    for a, b in zip(edges[:-1], edges[1:]):
        bounds = [f"{column} >= {a}"] * (a is not None) + [f"{column} < {b}"] * (b is not None)
        out.append(" AND ".join(bounds) or "1 = 1")
    out[0] = f"({out[0]}) OR {column} IS NULL"  # rows without a number are nobody else's
    return out


def read_source_tables(spark: SparkSession, location: str, jdbc: dict[str, str] | None = None, parts: int = 16) -> tuple[DataFrame, DataFrame]:
    """The tables pali_texts and pali_sentences, from Parquet below location, or with jdbc (its options) from the database
    at that URL. A database is read in parts by ranges of paragraph numbers with about as many rows each."""

    def one(name: str, schema: str) -> DataFrame:
        columns = [f.name for f in T.StructType.fromDDL(schema).fields]
        if jdbc is None:
            return spark.read.schema(schema).parquet(f"{location}/{name}")
        found = spark.read.jdbc(location, name, predicates=jdbc_ranges(spark, location, name, jdbc, "paragraph", parts), properties=jdbc)
        types = {f.name: f.dataType for f in T.StructType.fromDDL(schema).fields}
        return found.select(*[F.col(c).cast(types[c]).alias(c) for c in columns])

    return one("pali_texts", schemas.PARAGRAPH), one("pali_sentences", schemas.SENTENCE)


def read_aligned(spark: SparkSession, root: str, corpus: str = "*", files: str = "*.jsonl", every_line_end: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records, bad lines): corpus, file, line and the record's fields; corpus, file, line and the text of lines that are
    no JSON object. Blank lines are passed over. every_line_end also cuts at the rarer Unicode line ends."""
    lines = numbered_lines(spark, f"{root}/{corpus}/{files}", every_line_end)
    folder, name = path_part(F.col("path"), "([^/]*)/[^/]*$"), path_part(F.col("path"), "([^/]*)$")
    return split_records(lines.select(folder.alias("corpus"), name.alias("file"), "line_no", "line"))


def split_records(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, bad lines) out of corpus, file, line_no, line."""
    bare = lines.select("corpus", "file", F.col("line_no").alias("line"), strip(F.col("line")).alias("text"))
    good = F.col("text").startswith("{") & F.try_parse_json("text").isNotNull()
    records = bare.where(good).select("corpus", "file", "line", F.from_json("text", schemas.ALIGNED).alias("r"))
    return records.select("corpus", "file", "line", "r.*"), bare.where(~F.coalesce(good, F.lit(False)))


def read_chunks(spark: SparkSession, root: str, corpus: str = "*") -> DataFrame:
    """corpus, file, text, status: a chapter's text in each file; blank_text where there is nothing to align."""
    files = whole_files(spark, root, corpus, r"\.txt")
    return files.select("corpus", "file", F.col("value").alias("text"), F.when(is_blank(F.col("value")), "blank_text").otherwise("ok").alias("status"))


def read_corpus_meta(spark: SparkSession, root: str, corpus: str = "*", config: DataFrame | None = None, files: str = "meta.json") -> DataFrame:
    """The meta object of each corpus; corpora that only config has get its book and digits."""
    meta = spark.read.schema(schemas.CORPUS_META).json(f"{root}/{corpus}/{files}", multiLine=True)
    if config is None:
        return meta
    rest = config.join(meta.select("corpus"), "corpus", "left_anti").select("corpus", "book_id", "n_digits")
    return meta.unionByName(rest, allowMissingColumns=True)

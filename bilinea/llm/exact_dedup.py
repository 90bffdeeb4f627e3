"""Exact deduplication against a persistent digest index.

The index is a table of one row per distinct text: its SHA-256, the document that stays, and the batch that brought it.
It is bucketed and sorted by digest, so a join on digest neither shuffles nor sorts it as long as each bucket is one
file; compact() makes it so again. A batch of new documents is reduced to one row per digest and sort-merge anti-joined
with what other batches brought; what is new is decided first and appended then. A batch that is run again, after a
failure or by mistake, finds its own rows in the index, decides as before and adds nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bilinea.functions.storage import new_path
from bilinea.llm.common import keep_rows, store

SCHEMA = "digest BINARY, keep_id BIGINT, batch STRING"


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def create_index(spark: SparkSession, table: str, buckets: int | None = None, path: str | None = None) -> None:
    """An empty index, unless the table exists. buckets: by default the session's shuffle partitions. path: by default a
    new folder below the one that driver and executors share."""
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({SCHEMA}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {n} BUCKETS LOCATION '{path or new_path(spark, 'digest-index')}'")


def known(spark: SparkSession, table: str) -> DataFrame:
    """The index, in the order of its files where every bucket is one."""
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    return spark.table(table)


def append(new: DataFrame, table: str) -> None:
    """Adds rows, one file for each bucket."""
    new.repartition("digest").select("digest", "keep_id", "batch").write.insertInto(table)
    new.sparkSession.catalog.refreshTable(table)


def compact(spark: SparkSession, table: str, into: str) -> None:
    """A new index with the rows of table and one file for each bucket."""
    n = next(int(r["data_type"]) for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect() if r["col_name"] == "Num Buckets")
    create_index(spark, into, n)
    append(known(spark, table), into)


def ingest(rows: DataFrame, table: str, batch: str) -> DataFrame:
    """Decides on the texts of rows (doc_id, digest, row_tag), adds the new ones to the index under the batch's name, and
    returns one row per digest of the batch: digest, keep_id, group_size (of the batch), keep_tag (the row that stays;
    null if another batch holds the text). The result is stored before the index changes.

    The smallest doc_id stays, a null one only where all are null; of repeated ones the smallest tag.
    """
    spark = rows.sparkSession
    groups = store(
        rows.groupBy("digest")
        .agg(F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "row_tag")).alias("first"), F.count(F.lit(1)).alias("group_size"))
        .select("digest", F.col("first.doc_id").alias("first_id"), F.col("first.row_tag").alias("first_tag"), "group_size"),
        "digest-groups",
    )
    others = known(spark, table).where(F.col("batch") != batch).select("digest", F.col("keep_id").alias("known_id"), F.lit(True).alias("held"))
    found = groups.hint("merge").join(others.hint("merge"), "digest", "left")
    held = F.col("held").isNotNull()
    decisions = store(found.select("digest", F.when(held, F.col("known_id")).otherwise(F.col("first_id")).alias("keep_id"), "group_size", F.when(~held, F.col("first_tag")).alias("keep_tag")), "digest-decisions")
    fresh = decisions.where("keep_tag is not null").select("digest", "keep_id", F.lit(batch).alias("batch"))
    missing = fresh.hint("merge").join(known(spark, table).select("digest").hint("merge"), "digest", "left_anti")
    append(store(missing, "digest-fresh"), table)
    return decisions


def tagged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return store(docs.select(F.col(id_col).cast("long").alias("doc_id"), digest(F.col(text_col)).alias("digest"), F.monotonically_increasing_id().alias("row_tag")), "digest-rows")


def label(docs: DataFrame, table: str, batches: int = 1, id_col: str = "doc_id", text_col: str = "text", name: str | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    The documents go into the index in so many batches of rising ids, null ids last, as they would if they came one
    after the other; later ones find the copies of earlier ones by anti-join. Null texts equal the empty text. Exactly
    one row of each group of equal texts has kept true, unless a batch of another name in the index holds the text.
    name: what a run must repeat to be the same batch; by default one of its own. Other columns of docs are not read. An empty table gives no rows.
    """
    rows, name = tagged(docs, id_col, text_col), name or uuid.uuid4().hex
    inner = [k / batches for k in range(1, batches)]
    bounds = rows.agg(F.percentile_approx("doc_id", inner)).first()[0] or [] if inner else []
    decided = None
    for k in range(len(bounds) + 1):
        part = rows.where(F.col("doc_id") >= bounds[k - 1]) if k else rows
        part = part.where(F.col("doc_id") < bounds[k]) if k < len(bounds) else part
        if k == len(bounds) and k:
            part = part.unionByName(rows.where("doc_id is null"))
        new = ingest(part, table, f"{name}-{k}")
        decided = new if decided is None else decided.unionByName(new)
    if bounds:
        decided = store(decided.groupBy("digest").agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"), F.max("keep_tag").alias("keep_tag")), "digest-decided")
    return rows.join(decided, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("row_tag") == F.col("keep_tag"), F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, table: str, batch: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns; one row of each group of equal texts, also of rows that repeat
    the id as well as the text. Run again under the same name of the batch it keeps the same; by default a run has a
    name of its own."""
    rows = tagged(docs, id_col, text_col)
    decisions = ingest(rows, table, batch or uuid.uuid4().hex)
    wanted = store(decisions.where("keep_tag is not null").select(F.col("keep_id").alias("doc_id"), F.col("digest").alias("key")), "digest-wanted")
    return keep_rows(docs, id_col, rows, wanted, lambda some: some.withColumn("_key", digest(F.col(f"row.{text_col}"))))


def scratch_index(spark: SparkSession) -> str:
    """A new, empty index under a name of its own."""
    table = f"digest_index_{uuid.uuid4().hex}"
    create_index(spark, table)
    return table

"""What several operators share: stored intermediate tables, words, and ranks that no hot key can pile up in one task."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from bilinea.functions.storage import store

#: The six ASCII white-space characters that part words, as a Java character class.
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"

#: Rows of one key in a bucket at most, about: few enough that the buckets of a hot key spread evenly over the tasks.
ROWS_PER_BUCKET = 1_000


def words(text: Column) -> Column:
    """The maximal runs of other characters than ASCII white space."""
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


def order_hash(*cols: Column) -> Column:
    """32 hex digits that order rows evenly and alike in every run; nulls count as empty."""
    return F.md5(F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]))


def bucket_digits(rows: int) -> int:
    """Hex digits of order_hash to part rows of one key by: 256 buckets at least, of about ROWS_PER_BUCKET at most."""
    return max(2, math.ceil(math.log(max(1, rows / ROWS_PER_BUCKET), 16)))


def ranked(df: DataFrame, key: str, hashed: str, ties: list[str], rows: int, sizes: str | None = None, counted: DataFrame | None = None) -> DataFrame:
    """Adds `rank`, the 0-based place of a row among those of its key in order of the hash and then ties, and with
    sizes also `before`, the sum of sizes ahead of it.

    A window over the key alone would put a hot key in one task. The leading digits of the hash part each key into
    buckets that follow its order; a window ranks within (key, bucket), and sums over earlier buckets are added.
    key and hash must not be null; rows is the row count of the largest key. df is read twice, to count and to rank;
    counted can give the same rows with just key, hash and sizes for the first.
    """
    bucket = F.substring(hashed, 1, bucket_digits(rows)).alias("_bucket")
    part = df.select("*", bucket)
    amount = F.col(sizes) if sizes else F.lit(0)
    earlier = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        (df if counted is None else counted)
        .groupBy(key, bucket)
        .agg(F.count(F.lit(1)).alias("_n"), F.sum(amount).alias("_sum"))
        .select(
            key,
            "_bucket",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"),
            F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_sum0"),
        )
    )
    within = Window.partitionBy(key, "_bucket").orderBy(hashed, *ties)
    so_far = within.rowsBetween(Window.unboundedPreceding, -1)
    out = part.join(base, [key, "_bucket"]).withColumn("rank", F.col("_n0") + F.row_number().over(within) - 1)
    if sizes:
        out = out.withColumn("before", F.col("_sum0") + F.coalesce(F.sum(sizes).over(so_far), F.lit(0)))
    return out.drop("_bucket", "_n0", "_sum0")


def keep_rows(docs: DataFrame, id_col: str, all_rows: DataFrame, wanted: DataFrame, keyed: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The documents that wanted names by id and content key, one row of docs for each row of wanted.

    all_rows (doc_id, ...) has a row per document, wanted (doc_id, key) is stored and has none twice. Ids that one row
    has are enough to find it, so the documents are shuffled once, against ids, and stored nowhere. Documents whose id is
    null or repeated need their key as well: keyed adds it as `_key`, to these only, and equal ones are cut to one.
    """
    mine = f"_id_{uuid.uuid4().hex}"  # a name that no column of docs has
    ids = all_rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null").select(F.col("doc_id").alias(mine))
    unclear = store(ids, "unclear-ids")
    if unclear.isEmpty():
        return docs.join(wanted.select(F.col("doc_id").alias(mine)).hint("merge"), F.col(id_col) == F.col(mine), "left_semi")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    plain = wanted.join(unclear, F.col("doc_id").eqNullSafe(F.col(mine)), "left_anti").select(F.col("doc_id").alias(mine))
    clear = docs.join(plain.hint("merge"), F.col(id_col) == F.col(mine), "left_semi")
    rest = keyed(docs.join(unclear, F.col(id_col).eqNullSafe(F.col(mine)), "left_semi").select(F.col(id_col).alias("_id"), row))
    odd = wanted.select(F.col("doc_id").alias("w_id"), F.col("key").alias("w_key"))
    found = rest.join(odd, F.col("_id").eqNullSafe(F.col("w_id")) & (F.col("_key") == F.col("w_key")), "left_semi").dropDuplicates(["_id", "_key"])
    return clear.unionByName(found.select("row.*"))


def driver_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """The driver's rows as a table, which Spark holds as it is. Given as plain rows each would go through Python on the
    executors, whose workers for that are others than those of mapInArrow and stay for a minute, beside the next stage's."""
    kind = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) or [()] * len(kind)
    arrow = to_arrow_schema(kind)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow), kind)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 1,000 rows, and of about 16 MB unless one row is larger, in this session: texts can be
    long, and a batch is held whole on both sides."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def slices(texts: pa.Array, most_bytes: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """(first row, rows) of runs of rows with about most_bytes of text, one row at least."""
    size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64))
    at = 0
    while at < len(texts):
        done = size[at - 1] if at else 0
        until = max(at + 1, int(np.searchsorted(size, done + most_bytes, side="right")))
        yield at, until - at
        at = until

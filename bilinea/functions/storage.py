"""Where intermediate tables go: a folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local mode a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/bilinea/{label}-{uuid.uuid4().hex}"


def store(df: DataFrame, label: str) -> DataFrame:
    """Writes df to the shared folder and rereads it: the lineage ends there, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

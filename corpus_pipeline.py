"""A training-data pipeline: quality rules, exact dedup, near-dedup, mixing and packing over the documents table.

Each stage is written as Parquet to the shared folder and reread as the next one's documents, so a stage's plan never
holds the ones before, and a lost executor repeats tasks of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bilinea.llm import exact_dedup, mixing, packing, quality, simhash
from bilinea.llm.common import store
from bilinea.llm.queries import tokenizer_file

#: SQL has neither the tokenizer nor the fingerprints' hash; tests hold the stages against brute force.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without the lines that fail."""
    return quality.filtered(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    index = exact_dedup.scratch_index(spark)
    kept = exact_dedup.deduplicate(docs, index)
    spark.sql(f"DROP TABLE {index}")  # the stage reads stored decisions
    return kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that chains of near copies join: the one with the smallest id. Candidates are found by
    the trie walk with a budget of 14 bits, and near copies have a similarity of 0.8 or more on shingles of five words;
    the two bits of op7 are that query's own."""
    return simhash.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in training order: what it takes twice is there twice, what it does not take is gone."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and place."""
    return packing.pack(packing.pieces(docs, tokenizer_file("word_bpe_49k.json"), capacity=4096, end_id=1), capacity=4096)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_duplicates),
    ("near-dedup", near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

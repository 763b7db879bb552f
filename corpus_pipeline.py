"""From documents to packed training sequences: one operator a stage.

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps, with the
columns of documents; the last returns the packed parts. ``run`` writes every stage's
result as Parquet in the shared folder and reads it again, so a lost executor costs no
more than a stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from accordion.llm import common, mixing, ngram_join, packing, substring_dedup, toxicity


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic (operator 4)."""
    common.shipped(spark)
    return toxicity.clean_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest id (operator 3)."""
    common.shipped(spark)
    return ngram_join.one_of_each(docs)


def trimmed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of passages that an earlier document has (operator 9)."""
    common.shipped(spark)
    return substring_dedup.without_repeats(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's weight asks for, once at least (operator 2)."""
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The parts of documents and their places in bins (operator 5)."""
    common.shipped(spark)
    return packing.pack(common.written(packing.packing_rows(docs), "packing"))


STAGES = [("toxicity", clean), ("ngram_join", distinct), ("substring_dedup", trimmed), ("mixing", mixed), ("packing", packed)]

#: Stages 1, 2, 3 and 5 are not expressible in SQL. Tests hold the rows that each stage
#: returns against plain loops over its input (stage 1: against the scores of operator 4,
#: whose network they hold against plain loops).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            common.discard(before)
        before = docs
    return docs

"""Corpus pipeline: quality rules, near duplicates, benchmark leaks, mixing and sharding, one written stage after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallymart.llm import decontamination, mixing, near, rules, sharding
from tallymart.session import delete_path, scratch, scratch_path

SHARDS = 24

#: Near-duplicate grouping iterates, so SQL has no counterpart; the stages are tested against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    NULL and empty texts have no words and go, very long texts are judged whole; repeated rows are judged one by one,
    NULL ids and sources are values like others. An empty table stays empty. Further columns are kept.
    """
    return rules.without_rejects(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates on five-word shingles, the one with the smallest id.

    NULL and empty texts are like nothing and stay; of rows that repeat an id and text one stays. NULL ids are never
    the smallest. An empty table stays empty. Further columns are kept.
    """
    return near.deduplicated(docs, near.Near(shingle=5))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item.

    NULL and empty texts, and NULL and empty items, match nothing; texts are searched whole. Repeated rows go or stay
    together. An empty table stays empty. Further columns are kept.
    """
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix takes.

    Texts without words have no size and are never taken. NULL is a source. Rows that share an id are drawn one by
    one, ties by a hash. An empty table stays empty. Further columns are kept.
    """
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard, slot and position.

    No row is dropped, whatever its columns hold; repeated rows are rows of their own. An empty table stays empty.
    """
    return sharding.interleave(docs, SHARDS)


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared folder and read again.

    What a stage stores for itself goes when its rows are written, and its rows go when those of the next stage are, so
    the folder holds two stages at most.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        path = scratch_path(spark, "pipeline")
        with scratch():
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        if before:
            delete_path(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)

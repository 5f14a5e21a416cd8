"""The corpus pipeline: language, near copies, benchmark passages, source weights, shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlattice.llm import decontaminate, language_id, mixing, set_join, sharding
from starlattice.llm.common import new_folder, table

SHARDS = 16


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model, trained on the labelled ones, does not reject."""
    model = language_id.train(language_id.sample(docs))
    rows = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    return language_id.identify(rows, model).where(~F.col("language.rejected")).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the n-gram Jaccard join links."""
    return set_join.drop_near_copies(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, a document taken twice as two rows."""
    _, copies = mixing.mix(docs)
    return copies.select("doc.*")


def deal_into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and their slot in it."""
    return sharding.shuffle_into_shards(docs, SHARDS)


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_benchmark_passages),
    ("mixing", mix_sources),
    ("sharding", deal_into_shards),
]

# No SQL: the language model cannot be expressed in it. Tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

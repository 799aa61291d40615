"""Corpus preparation: quality rules, near-duplicate removal, decontamination,
mixing and sharding of ``documents``, each stage on what its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmart.llm.common import new_work_path
from starmart.llm.decontamination import decontamination_filter
from starmart.llm.jaccard_join import near_duplicate_filter
from starmart.llm.mixing import mix_filter
from starmart.llm.quality_rules import quality_filter
from starmart.llm.virtual_slots import digest, shard

SHARDS = 16


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules accept."""
    return quality_filter(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_duplicate_filter(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontamination_filter(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled towards the target weights."""
    return mix_filter(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and place of every document."""
    return digest(shard(docs, SHARDS))


STAGES = [("quality_rules", quality_rules), ("jaccard_join", jaccard_join), ("decontamination", decontamination),
          ("mixing", mixing), ("sharding", sharding)]

#: The first stage estimates rule accuracies by expectation-maximisation, which
#: SQL does not express; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_work_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

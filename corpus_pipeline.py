"""The corpus pipeline: documents to a packed token file, in stages.

Each stage takes what the stage before kept, as Parquet, and returns rows with the
columns of ``documents``; the last writes token files and returns their digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hazeframe.llm import common
from hazeframe.llm.decontamination import keep_clean
from hazeframe.llm.mixing import mixed_rows
from hazeframe.llm.near_duplicates import keep_one
from hazeframe.llm.quality_rules import keep_good
from hazeframe.llm.queries import tokenizer_path
from hazeframe.llm.token_output import token_digests


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_good(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, a similarity of 0.8."""
    return keep_one(docs, width=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return keep_clean(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and for each document what was read back from them."""
    return token_digests(spark, docs, tokenizer_path(), end_id=2)


STAGES = [("quality_rules", quality), ("near_duplicates", deduplicate), ("decontamination", decontaminate), ("mixing", mix), ("token_output", tokens)]

# Groups of near duplicates, balanced sampling and token ids are beyond SQL; a test
# holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

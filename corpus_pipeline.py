"""The corpus pipeline: quality rules, near-duplicates, benchmark decontamination, personal
data, mixing.  Each stage reads what its predecessor kept, written as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from halfhourly.llm import mixing, minhash, pii, quality, winnow
from halfhourly.llm.common import materialize, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return winnow.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("personal_data", personal_data),
    ("mixture", mixture),
]

#: Signatures, bootstrapping and pivotal draws are not SQL: tests/llm checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

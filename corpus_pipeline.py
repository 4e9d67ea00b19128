"""A training-data pipeline over ``documents``: five stages, each one of the ``starlattice.llm`` operators.

A stage takes what its predecessor kept, as Parquet read anew. All but the last return the columns of
``documents`` and only take rows away; the last returns the mix, one row per document that is in it:
doc_id, source, size, source_size, target, virtual_finish and taken. Null, empty, repeated and very long texts,
empty tables and further columns are treated as the operators' modules say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starlattice.llm import decontam, exact_dedup, mixing, simhash, toxicity
from starlattice.session import scratch_path


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_duplicates(docs)


def _near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def _decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).filter("taken > 0")


STAGES = [
    ("toxicity", _toxicity),
    ("exact_dedup", _exact_dedup),
    ("near_dedup", _near_dedup),
    ("decontamination", _decontamination),
    ("mixing", _mixing),
]

#: training and trie join are not expressible in SQL; tests/llm/test_pipeline.py compares each stage with a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""The operators as registered queries: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlattice.llm import chat, collocations, decontam, exact_dedup, mixing, pii, quality, repair, secrets, simhash, suffix_dedup, tokens, toxicity
from starlattice.llm.common import materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(_table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontam.benchmark_hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), with_clean_text=True)
    # the texts without their spans are written with the verdicts; the contract's columns hold no text
    return materialize(hits.drop("spans"), "decontaminated").drop("clean_text")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(_table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents")).drop("kept")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


#: what the contract adds to the table: both turns say the template's own marks
MARKS = r"\### Assistant: </turn> ok"


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                 F.lit(MARKS).alias("text"))
    return chat.read_back(chat.format_conversations(turns.unionByName(more)))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.drop("offending", "text_hash")


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.conversation_repairs(_table(spark, sf_dir, "conversations"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_pii, op2_decontamination, op3_exact_dedup, op4_secrets, op5_token_counts,
                                    op6_simhash, op7_suffix_dedup, op8_mixing, op9_chat, op10_toxicity, op11_repair, op12_collocations,
                                    op13_quality, pipeline)}

"""A training-data pipeline: five stages, each written as Parquet and read again.

language ID -> near-duplicates -> benchmark decontamination -> mixing of sources -> token ids.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pathwake.llm import decontaminate, language, mixing, near_dedup, token_store
from pathwake.runtime import stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, or too far from every language, go."""
    return language.drop_rejected(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dedup.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with at least one word in twenty from a benchmark go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, laid out so that every source keeps its share throughout."""
    return mixing.in_mixture_order(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids stored in the order of the mixture: doc_id, start, n_tokens, ids_crc32.

    The order of rows in files is no property of a table, so the slots, which depend on the
    documents alone, are derived again.
    """
    return token_store.stored_tokens(
        mixing.mixed(docs), public_tokenizers.path("byte_bpe_50k.json"), ("_slot", "_place", "doc_id")
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("token_output", token_output),
]

# The classifier and the tokenizer cannot be written in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

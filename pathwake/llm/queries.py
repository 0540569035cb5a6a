"""Registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathwake.llm import conversations, decontaminate, language, merkle, mixing, near_dedup, oracle
from pathwake.llm import private_data, quality_rules, repeated_passages, secret_scan, token_counts, token_store, toxicity

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def op1_token_counts(spark: SparkSession, directory: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, directory, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_near_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, directory, "documents"))


def op3_quality_rules(spark: SparkSession, directory: str) -> DataFrame:
    return quality_rules.quality(_table(spark, directory, "documents"), _table(spark, directory, "labels"))


def op4_token_store(spark: SparkSession, directory: str) -> DataFrame:
    return token_store.stored_tokens(_table(spark, directory, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_mixing(spark: SparkSession, directory: str) -> DataFrame:
    return mixing.mixture(_table(spark, directory, "documents"))


def op6_language(spark: SparkSession, directory: str) -> DataFrame:
    return language.identify(_table(spark, directory, "documents"))


def op7_private_data(spark: SparkSession, directory: str) -> DataFrame:
    return private_data.private_data(_table(spark, directory, "documents"))


def op8_decontamination(spark: SparkSession, directory: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, directory, "documents"), _table(spark, directory, "benchmark"))


def op9_secrets(spark: SparkSession, directory: str) -> DataFrame:
    return secret_scan.secrets(_table(spark, directory, "documents"))


def op10_repeated_passages(spark: SparkSession, directory: str) -> DataFrame:
    return repeated_passages.remove_repeated(_table(spark, directory, "documents"))


def op11_merkle_manifest(spark: SparkSession, directory: str) -> DataFrame:
    """Even hashes of the id are held against the manifest without their line breaks."""
    text = F.col("text")
    claimed = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
    found = merkle.manifest(_table(spark, directory, "documents"), claimed)
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


def op12_toxicity(spark: SparkSession, directory: str) -> DataFrame:
    found = toxicity.toxicity(_table(spark, directory, "documents"), _table(spark, directory, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", F.size("passages").cast("long").alias("n_passages"))


def op13_conversation_repair(spark: SparkSession, directory: str) -> DataFrame:
    return conversations.repair(conversations.damage(_table(spark, directory, "conversations")), F.col("gone"))


QUERIES: dict[str, Query] = {
    "op1_token_counts": op1_token_counts,
    "op2_near_dedup": op2_near_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_token_store": op4_token_store,
    "op5_mixing": op5_mixing,
    "op6_language": op6_language,
    "op7_private_data": op7_private_data,
    "op8_decontamination": op8_decontamination,
    "op9_secrets": op9_secrets,
    "op10_repeated_passages": op10_repeated_passages,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_toxicity": op12_toxicity,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE_SQL: dict[str, str] = oracle.ORACLE_SQL | {
    "op2_near_dedup": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
            FROM documents),
        s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN CAST([] AS VARCHAR[])
                WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle
            FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        links AS (
            SELECT x.doc_id AS a, y.doc_id AS b
            FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
            JOIN n p ON p.doc_id = x.doc_id JOIN n q ON q.doc_id = y.doc_id
            GROUP BY x.doc_id, y.doc_id, p.n, q.n HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))),
        reach(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents
            UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other)
        SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.other) AS component_id, d.doc_id = min(r.other) AS kept
        FROM documents d JOIN reach r ON r.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
        GROUP BY d.doc_id""",
    "op8_decontamination": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM documents),
        b AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM benchmark),
        bw AS (
            SELECT DISTINCT item_id, least(len(words), 13) AS size, array_to_string(words[i:i + 12], ' ') AS win
            FROM b, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS t(i) WHERE len(words) > 0),
        dw AS (
            SELECT doc_id, i, size, array_to_string(words[i:i + size - 1], ' ') AS win
            FROM d, (SELECT DISTINCT size FROM bw), unnest(range(1, len(words) - size + 2)) AS t(i) WHERE len(words) >= size),
        hits AS (SELECT doc_id, i, dw.size, item_id FROM dw JOIN bw ON bw.size = dw.size AND bw.win = dw.win),
        cover AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + size)) AS t(p) GROUP BY doc_id),
        items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
            FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
        SELECT d.doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
        FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN items USING (doc_id)""",
}

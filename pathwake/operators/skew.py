"""Keys that are too large for one task, and joins on keys that may be null."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathwake.runtime import stored

HEAVY_ROWS = 1_000_000
MAX_HEAVY_KEYS = 100_000


def heavy_keys(df: DataFrame, key: str, rows: int = HEAVY_ROWS) -> DataFrame | None:
    """Keys with more rows than one task should take, or None when there are none.

    One narrow scan, combined before its shuffle; the counts are stored, so ``df`` is read
    once. The limit rises with the table so that at most ``MAX_HEAVY_KEYS`` keys can exceed it
    (their counts add up to no more than the table), which bounds the returned list and makes
    it safe to broadcast.
    """
    counts = stored(df.groupBy(key).agg(F.count("*").alias("n")), "key-counts")
    total, largest = counts.agg(F.sum("n"), F.max("n")).first()
    if total is None:
        return None
    limit = max(rows, total // MAX_HEAVY_KEYS)
    if largest <= limit:
        return None
    return counts.filter(F.col("n") > limit).select(key)


def split_heavy(
    df: DataFrame, key: str, rows: int = HEAVY_ROWS, counted: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """Split into rows of ordinary keys and rows of heavy keys (None when there are none).

    ``counted`` are rows to count in place of ``df``, which has to be a part of them.
    """
    heavy = heavy_keys(df if counted is None else counted, key, rows)
    if heavy is None:
        return df, None
    keys = F.broadcast(heavy.withColumnRenamed(key, "_heavy"))
    is_heavy = F.col(key).eqNullSafe(F.col("_heavy"))
    return df.join(keys, is_heavy, "left_anti"), df.join(keys, is_heavy, "left_semi")


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join on equal keys where null equals null; key columns come from the left."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in on})
    match = F.lit(True)
    for k in on:
        match = match & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(renamed, match).drop(*[f"_r_{k}" for k in on])

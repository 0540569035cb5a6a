"""Joins on keys of which a few may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathwake.runtime import stored

PARTS = 64
LEAST_ROWS = 1000
SMALL_ROWS = 100_000  # a table of a few numbers a row is sent to every task up to here, whatever the input
SHARE = 1000


def hot_keys(sizes: DataFrame, keys: list[str], n: str = "n") -> DataFrame | None:
    """Keys that hold at least a thousandth of all rows, from ``sizes`` with one row a key.

    There are at most ``SHARE`` of them whatever the input, so the table may be broadcast. None
    if there is none: nothing is stored then, and joins need no dealing.
    """
    total, most = sizes.agg(F.sum(n), F.max(n)).first()
    least = max(LEAST_ROWS, -(-(total or 0) // SHARE))
    return stored(sizes.filter(F.col(n) >= least).select(*keys), "hot") if (most or 0) >= least else None


def sent(table: DataFrame, rows: int) -> DataFrame:
    """``table``, to be joined by sending it to every task if its ``rows`` are few."""
    return F.broadcast(table) if rows <= SMALL_ROWS else table


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], hot: DataFrame | None, by: Column) -> DataFrame:
    """Inner join of many rows of ``left`` with the one row of ``right`` that has their keys.

    Rows of a hot key are dealt to ``PARTS`` parts by the hash of ``by``, a property of the row
    that a repeated task finds again; its row of ``right`` goes to each part. A table ``right``
    of few rows needs no ``hot``, see :func:`sent`.
    """
    if hot is None:
        return left.join(right, keys)
    marked = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    part = F.when(F.col("_hot"), F.pmod(F.xxhash64(by), F.lit(PARTS))).otherwise(0).cast("int")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))
    dealt = left.join(marked, keys, "left").withColumn("_part", part).drop("_hot")
    copied = right.join(marked, keys, "left").withColumn("_part", F.explode(copies)).drop("_hot")
    return dealt.join(copied, [*keys, "_part"]).drop("_part")

"""Positions and order-dependent columns over groups of any size.

A plain window puts a whole group into one task. The functions here work on blocks of rows:
the data is laid out once by range of (keys, order), each row gets its position within its
group, and later windows run per block of positions, with what they need from earlier rows
carried in. A group that holds most of the table is then spread like any other data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pathwake.operators.skew import null_safe_join
from pathwake.runtime import BROADCAST_ROWS, stored

BLOCK_ROWS = 100_000
_SLOT_BITS = 33  # monotonically_increasing_id keeps the row number in its lower 33 bits


def with_position(
    df: DataFrame, keys: list[str], order: list[str], name: str = "position"
) -> DataFrame:
    """0-based position of each row within its group, in a total order.

    ``keys`` may be empty for a position over the whole table. The range layout is written
    once, because two evaluations of a range partitioning may choose different boundaries.
    """
    layout = [*keys, *order]
    laid = stored(
        df.repartitionByRange(*layout)
        .sortWithinPartitions(*layout)
        .withColumn("_row", F.monotonically_increasing_id()),
        "ordered",
    )
    laid = laid.withColumn("_part", F.shiftright("_row", _SLOT_BITS))
    sizes = laid.groupBy(*keys, "_part").agg(F.count("*").alias("_n"), F.min("_row").alias("_at"))
    # One row per group and partition it lies in; the window adds up the earlier partitions.
    before = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))
    before = before.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    skipped = F.coalesce(F.sum("_n").over(before), F.lit(0))
    starts = sizes.select(*keys, "_part", (skipped - F.col("_at")).alias("_shift"))
    # Without keys there are as many rows as partitions; groups have to be counted.
    if not keys or starts.count() <= BROADCAST_ROWS:
        starts = F.broadcast(starts)
    return (
        null_safe_join(laid, starts, [*keys, "_part"])
        .withColumn(name, F.col("_row") + F.col("_shift"))
        .drop("_row", "_part", "_shift")
    )


def over_recent_rows(
    positioned: DataFrame,
    keys: list[str],
    add: Callable[[DataFrame, WindowSpec], DataFrame],
    rows: int,
    block: int = BLOCK_ROWS,
    name: str = "position",
) -> DataFrame:
    """Window columns that look back at most ``rows`` rows.

    ``add`` adds them, given the rows and a window that is partitioned and ordered. The last
    ``rows`` rows of each block are repeated in front of the next one, and the copies dropped
    again.
    """
    block = max(block, rows)
    home = F.floor(F.col(name) / block).cast("bigint")
    carried = F.col(name) % block >= block - rows
    blocks = F.when(carried, F.array(home, home + 1)).otherwise(F.array(home))
    window = W.partitionBy(*keys, "_block").orderBy(name)
    spread = positioned.withColumn("_block", F.explode(blocks))
    return add(spread, window).filter(F.col("_block") == home).drop("_block")


def running(
    positioned: DataFrame,
    keys: list[str],
    values: dict[str, tuple[str, Column]],
    block: int = BLOCK_ROWS,
    position: str = "position",
) -> DataFrame:
    """Running aggregates up to and including each row.

    ``values`` maps a name to ``("sum", column)`` or ``("last", column)``, the latter being
    the last value that is not null. ``positioned`` is read twice: for the totals of the
    blocks, and for the rows, which take over the totals of all earlier blocks.
    """
    home = F.floor(F.col(position) / block).cast("bigint")
    rows = positioned.withColumn("_block", home)
    inside = W.partitionBy(*keys, "_block").orderBy(position).rowsBetween(W.unboundedPreceding, 0)
    earlier = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    totals, carries, local, combined = [], [], {}, {}
    for name, (how, value) in values.items():
        total, carry = f"_total_{name}", f"_carry_{name}"
        if how == "sum":
            totals.append(F.sum(value).alias(total))
            carries.append(F.sum(total).over(earlier).alias(carry))
            local[name] = F.coalesce(F.sum(value).over(inside), F.lit(0))
            combined[name] = F.col(name) + F.coalesce(F.col(carry), F.lit(0))
        elif how == "last":
            at = F.when(value.isNotNull(), F.col(position))
            totals.append(F.max_by(value, at).alias(total))
            carries.append(F.last(total, ignorenulls=True).over(earlier).alias(carry))
            local[name] = F.last(value, ignorenulls=True).over(inside)
            combined[name] = F.coalesce(F.col(name), F.col(carry))
        else:
            raise ValueError(f"unknown running aggregate: {how}")
    per_block = rows.groupBy(*keys, "_block").agg(*totals)
    before = per_block.select(*keys, "_block", *carries)
    joined = null_safe_join(rows.withColumns(local), before, [*keys, "_block"])
    return joined.withColumns(combined).drop("_block", *[f"_carry_{name}" for name in values])

"""Batch timings of a consumer: periods, proximity to the poll limit, stage trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pathwake.functions.columns import proximity_label
from pathwake.operators.ordering import BLOCK_ROWS, over_recent_rows, with_position

# Stages in report order, window length, slope limit (ms per batch).
STAGES = ["pg_events", "valkey", "pg_sessions"]
WINDOW_BATCHES = 100
SLOPE_LIMIT = 0.5
MAX_POLL_INTERVAL_MS = 300_000
PERIOD_MS = 30_000

READER = ["group_id", "instance"]
# Short blocks keep the running sums small, and with them their rounding errors.
SLOPE_BLOCK_ROWS = 500


def _stage_ms() -> Column:
    total = F.col(f"{STAGES[0]}_ms")
    for stage in STAGES[1:]:
        total = total + F.col(f"{stage}_ms")
    return total


def _loop_ms() -> Column:
    return F.col("poll_ms") + _stage_ms() + F.col("commit_ms")


def _fill() -> Column:
    sized = F.col("max_batch_size") > 0
    return F.when(sized, F.col("batch_size") / F.col("max_batch_size")).otherwise(F.lit(0.0))


def _proximity(max_poll_ms: int) -> Column:
    return _loop_ms() / F.lit(float(max_poll_ms)) if max_poll_ms > 0 else F.lit(0.0)


def poll_proximity(batches: DataFrame, max_poll_ms: int = MAX_POLL_INTERVAL_MS) -> DataFrame:
    """Share of the poll limit each loop took, and its severity."""
    return batches.select(
        *READER,
        "batch_id",
        _proximity(max_poll_ms).alias("proximity"),
    ).withColumn("severity", proximity_label(F.col("proximity")))


def _idle(window) -> Column:
    """Time between the previous commit and this poll; 0 for the first batch."""
    started = F.col("end_ms") - _loop_ms()
    return F.coalesce(started - F.lag("end_ms").over(window), F.lit(0.0))


def idle_gap(batches: DataFrame, block: int = BLOCK_ROWS) -> DataFrame:
    """Idle time before each batch of a reader."""
    return _with_idle(batches, block).select(*READER, "batch_id", "idle_ms")


def _with_idle(batches: DataFrame, block: int) -> DataFrame:
    positioned = with_position(batches, READER, ["batch_id"])
    return over_recent_rows(
        positioned, READER, lambda df, w: df.withColumn("idle_ms", _idle(w)), 1, block
    )


def _add_slopes(df: DataFrame, window) -> DataFrame:
    """Least-squares slope of each stage time over the latest batches, 0 for a single one.

    With evenly spaced x the slope needs two sums over the window, each the difference of two
    running sums; the work per row does not depend on the window length.
    """
    running = window.rowsBetween(W.unboundedPreceding, 0)
    row, n = F.row_number().over(window), F.least(F.col("position") + 1, F.lit(WINDOW_BATCHES))
    df = df.withColumns({"_row": row, "_n": n.cast("double")})
    sums = {}
    for stage in STAGES:
        sums[f"_y_{stage}"] = F.sum(f"{stage}_ms").over(running)
        sums[f"_xy_{stage}"] = F.sum(F.col("_row") * F.col(f"{stage}_ms")).over(running)
    df = df.withColumns(sums)

    def inside(name: str) -> Column:
        return F.col(name) - F.lag(name, WINDOW_BATCHES, 0.0).over(window)

    middle = F.col("_row") - (F.col("_n") - 1) / 2
    weight = F.col("_n") * (F.col("_n") * F.col("_n") - 1) / 12
    slopes = {
        f"{stage}_slope": F.when(
            F.col("_n") < 2, F.lit(0.0)
        ).otherwise((inside(f"_xy_{stage}") - middle * inside(f"_y_{stage}")) / weight)
        for stage in STAGES
    }
    return df.withColumns(slopes).drop("_row", "_n", *sums)


def stage_trend_rolling(batches: DataFrame, block: int = SLOPE_BLOCK_ROWS) -> DataFrame:
    """Slope of every stage at each batch over the latest 100 batches."""
    positioned = with_position(batches, READER, ["batch_id"])
    rolled = over_recent_rows(positioned, READER, _add_slopes, WINDOW_BATCHES, block)
    return rolled.select(*READER, "batch_id", *[f"{stage}_slope" for stage in STAGES])


def stage_slopes(batches: DataFrame) -> DataFrame:
    """Slope, first and last value per stage over each reader's latest 100 batches.

    The rank filter is applied map-side, so at most 100 rows per reader and task move.
    """
    newest = W.partitionBy(*READER).orderBy(F.desc("batch_id"))
    window = batches.withColumn("age", F.row_number().over(newest)).filter(
        F.col("age") <= WINDOW_BATCHES
    )
    stages = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("stage_order"),
                    F.lit(stage).alias("stage"),
                    F.col(f"{stage}_ms").alias("ms"),
                )
                for i, stage in enumerate(STAGES)
            ]
        )
    )
    return (
        window.select(*READER, "age", stages)
        .groupBy(*READER, "stage", "stage_order")
        .agg(
            F.coalesce(F.regr_slope("ms", -F.col("age")), F.lit(0.0)).alias("slope"),
            F.max_by("ms", "age").alias("first_ms"),
            F.min_by("ms", "age").alias("last_ms"),
        )
    )


def stage_trends(batches: DataFrame, limit: float = SLOPE_LIMIT) -> DataFrame:
    """Stages whose time rises by more than ``limit`` ms per batch, with first and last value."""
    return stage_slopes(batches).filter(F.col("slope") > limit).drop("stage_order")


def bottleneck_stage(batches: DataFrame, limit: float = SLOPE_LIMIT) -> DataFrame:
    """The stage rising fastest per reader, null where none rises by more than ``limit``."""
    slope = F.when(F.col("slope") > limit, F.col("slope"))
    steepest = F.when(slope.isNotNull(), F.struct(slope, -F.col("stage_order")))
    return (
        stage_slopes(batches)
        .groupBy(*READER)
        .agg(F.max_by("stage", steepest).alias("bottleneck_stage"))
    )


def _bottleneck() -> Column:
    """Steepest stage of a row that carries all slopes; equal slopes go to the earlier."""
    slopes = [F.col(f"{stage}_slope") for stage in STAGES]
    best = F.greatest(*slopes)
    named = F.lit(None).cast("string")
    for stage, slope in reversed(list(zip(STAGES, slopes))):
        named = F.when(slope == best, stage).otherwise(named)
    return F.when(best > SLOPE_LIMIT, named)


def batch_indicators(
    batches: DataFrame,
    rebalances: DataFrame | None = None,
    period_ms: int = PERIOD_MS,
    max_poll_ms: int = MAX_POLL_INTERVAL_MS,
    block: int = SLOPE_BLOCK_ROWS,
) -> DataFrame:
    """Indicators per reader and period: the samples :func:`backpressure_report` takes.

    ``ts`` is the end of the period in seconds; ``rebalances`` (group_id, instance, ts) are
    counted over the 300 seconds up to it.
    """
    period = F.floor(F.col("end_ms") / period_ms).cast("bigint")
    rows = over_recent_rows(
        with_position(batches, READER, ["batch_id"]),
        READER,
        lambda df, w: _add_slopes(df, w).withColumn("idle_ms", _idle(w)),
        WINDOW_BATCHES,
        block,
    ).withColumns({"period": period, "bottleneck": _bottleneck()})
    result = rows.groupBy(*READER, "period").agg(
        F.count("*").alias("loops"),
        F.avg(_fill()).alias("fill_ratio"),
        F.max(_proximity(max_poll_ms)).alias("poll_proximity"),
        F.avg("idle_ms").alias("idle_ms"),
        F.max_by("bottleneck", "batch_id").alias("bottleneck_stage"),
    ).withColumn("ts", F.expr(f"(period + 1) * {period_ms} div 1000"))
    if rebalances is None:
        return result.withColumn("rebalance_count", F.lit(0).cast("bigint"))
    return _count_recent(result, rebalances, period_ms)


def _count_recent(periods: DataFrame, rebalances: DataFrame, period_ms: int) -> DataFrame:
    """Add the rebalances of a reader in the 300 s up to each period's end.

    Each rebalance is sent to the period ends it counts for (their number depends on the
    period length only), which makes the range condition an equality.
    """
    seconds, step = 300, max(1, period_ms // 1000)
    first = F.ceil(F.col("ts") / step) * step
    ends = F.sequence(first, F.floor((F.col("ts") + seconds) / step) * step, F.lit(step))
    reach = F.floor((F.col("ts") + seconds) / step) * step >= first
    counted = (
        rebalances.filter(reach)
        .select(*READER, F.explode(ends.cast("array<bigint>")).alias("ts"))
        .groupBy(*READER, "ts")
        .agg(F.count("*").alias("rebalance_count"))
    )
    joined = periods.join(counted, [*READER, "ts"], "left")
    return joined.withColumn("rebalance_count", F.coalesce("rebalance_count", F.lit(0)))


def batch_summary(
    batches: DataFrame, period_ms: int | None = PERIOD_MS, block: int = BLOCK_ROWS
) -> DataFrame:
    """Throughput and averages per reader and period, or over its lifetime (``None``).

    Headroom is the idle share of the loop in percent. A period counts as ``period_ms``
    long; a lifetime lasts from the start of the first loop to the end of the last.
    """
    rows = _with_idle(batches, block)
    keys = list(READER)
    if period_ms is None:
        span = F.max("end_ms") - F.min(F.col("end_ms") - _loop_ms())
        elapsed = span / 1000
    else:
        rows = rows.withColumn("period", F.floor(F.col("end_ms") / period_ms).cast("bigint"))
        keys.append("period")
        elapsed = F.lit(period_ms / 1000)
    result = rows.groupBy(*keys).agg(
        F.count("*").alias("batches"),
        F.sum("batch_size").alias("events"),
        elapsed.alias("elapsed"),
        F.avg(_stage_ms()).alias("avg_batch_ms"),
        *[F.avg(f"{stage}_ms").alias(f"avg_{stage}_ms") for stage in STAGES],
        F.avg("poll_ms").alias("avg_poll_ms"),
        F.avg("commit_ms").alias("avg_commit_ms"),
        F.avg("idle_ms").alias("avg_idle_ms"),
        F.avg(_fill()).alias("avg_fill"),
    )
    loop = F.col("avg_poll_ms") + F.col("avg_commit_ms") + F.col("avg_idle_ms")
    rate = F.when(F.col("elapsed") > 0, F.col("events") / F.col("elapsed")).otherwise(F.lit(0.0))
    return result.withColumns(
        {
            "events_per_sec": rate,
            "headroom": F.when(loop > 0, F.col("avg_idle_ms") / loop * 100).otherwise(F.lit(0.0)),
        }
    ).drop("elapsed")


def batch_report(
    batches: DataFrame,
    rebalances: DataFrame,
    max_poll_ms: int = MAX_POLL_INTERVAL_MS,
    limit: float = SLOPE_LIMIT,
    block: int = BLOCK_ROWS,
) -> DataFrame:
    """The closing report of each reader: lifetime figures, worst proximity, rebalances, trends.

    ``trends`` lists the stages that rise by more than ``limit`` ms per batch over the latest
    hundred, in their order, as ``stage first > last`` in whole milliseconds. ``sessions`` is
    the number of sessions written, 0 where ``batches`` has no such column.
    """
    written = F.sum("sessions") if "sessions" in batches.columns else F.lit(0).cast("bigint")
    worst = batches.groupBy(*READER).agg(
        F.max(_proximity(max_poll_ms)).alias("max_poll_proximity"), F.coalesce(written, F.lit(0)).alias("sessions")
    )
    moved = rebalances.groupBy(*READER).agg(F.count("*").alias("rebalances"))
    text = F.concat(
        "stage", F.lit(" "), F.floor("first_ms").cast("string"), F.lit(" > "), F.floor("last_ms").cast("string")
    )
    rising = stage_slopes(batches).filter(F.col("slope") > limit)
    trends = rising.groupBy(*READER).agg(
        F.array_sort(F.collect_list(F.struct("stage_order", text.alias("text")))).alias("t")
    ).select(*READER, F.array_join("t.text", " | ").alias("trends"))
    joined = (
        batch_summary(batches, None, block).join(worst, READER).join(moved, READER, "left").join(trends, READER, "left")
    )
    return joined.withColumns(
        {"rebalances": F.coalesce("rebalances", F.lit(0)), "trends": F.coalesce("trends", F.lit(""))}
    )

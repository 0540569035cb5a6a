"""Benchmark results: runs, load ramps, sampled throughput and stalls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pathwake.functions.columns import event_time
from pathwake.operators.ordering import BLOCK_ROWS, over_recent_rows, running, with_position
from pathwake.runtime import stored

SAMPLE_SECONDS = 5
STALL_POLLS = 30


def bench_filter(
    runs: DataFrame,
    environment: str | None = None,
    since_ms: int | None = None,
    until_ms: int | None = None,
) -> DataFrame:
    """Runs of an environment within ``[since, until]``, start time cut to the minute."""
    if environment is not None:
        runs = runs.filter(F.col("environment") == environment)
    if since_ms is not None:
        runs = runs.filter(F.col("ts_ms") >= since_ms)
    if until_ms is not None:
        runs = runs.filter(F.col("ts_ms") <= until_ms)
    return runs.withColumn("started", F.date_trunc("minute", event_time(F.col("ts_ms"))))


def bench_throughput(runs: DataFrame) -> DataFrame:
    """Events per second of each run, halves rounded to even."""
    rate = F.bround(F.col("events_consumed") / F.col("duration_sec")).cast("bigint")
    return runs.withColumn("events_per_sec", F.when(F.col("duration_sec") > 0, rate))


def bench_summary(runs: DataFrame) -> DataFrame:
    """Number of runs, range of dates and min, max and whole average throughput."""
    day = F.to_date(event_time(F.col("ts_ms")))
    return runs.groupBy("environment").agg(
        F.count("*").alias("runs"),
        F.min("throughput").alias("min_throughput"),
        F.max("throughput").alias("max_throughput"),
        F.expr("sum(throughput) div count(throughput)").alias("avg_throughput"),
        F.min(day).alias("first_date"),
        F.max(day).alias("last_date"),
    )


def ramp_steps(samples: DataFrame) -> DataFrame:
    """Per run and step: average throughput (floor), last lag, dominant trend, samples.

    The dominant trend is the most frequent one, the first seen where several are; a missing
    trend reads as unknown. Rows lacking step, rate, throughput or lag are left out.
    """
    needed = ["step", "rate_target", "consumer_throughput", "total_lag"]
    read = samples.dropna(subset=needed).fillna("unknown", ["lag_trend"])
    by_trend = read.groupBy("run_id", "step", "lag_trend").agg(
        F.count("*").alias("n"),
        F.sum("consumer_throughput").alias("throughput"),
        F.min("seq").alias("first_seq"),
        F.max("seq").alias("last_seq"),
        F.min_by("rate_target", "seq").alias("rate_target"),
        F.max_by("total_lag", "seq").alias("total_lag"),
    )
    votes = F.struct(F.col("n"), -F.col("first_seq"))
    return by_trend.groupBy("run_id", "step").agg(
        F.min_by("rate_target", "first_seq").alias("rate_target"),
        F.expr("sum(throughput) - pmod(sum(throughput), sum(n))").alias("whole"),
        F.max_by("total_lag", "last_seq").alias("final_lag"),
        F.max_by("lag_trend", votes).alias("dominant_trend"),
        F.sum("n").alias("samples"),
    ).select(
        "run_id", "step", "rate_target", F.expr("whole div samples").alias("avg_throughput"),
        "final_lag", "dominant_trend", "samples",
    )


def ramp_saturation(samples: DataFrame) -> DataFrame:
    """Rate of the first growing step, and of the last step that kept up, per run."""
    growing = F.when(F.col("dominant_trend") == "growing", F.col("step"))
    kept_up = F.when(F.col("dominant_trend").isin("stable", "shrinking"), F.col("step"))
    return (
        ramp_steps(samples)
        .groupBy("run_id")
        .agg(
            F.min_by("rate_target", growing).alias("saturation_rate"),
            F.max_by("rate_target", kept_up).alias("peak_sustainable_rate"),
            F.sum("samples").alias("total_samples"),
            F.count("*").alias("steps_completed"),
        )
    )


def ramp_runs(samples: DataFrame) -> DataFrame:
    """Runs by their earliest sample."""
    runs = samples.groupBy("run_id").agg(
        F.min("ts_ms").alias("started_ms"),
        F.max("ts_ms").alias("ended_ms"),
        F.count("*").alias("samples"),
    )
    return runs.orderBy("started_ms", "run_id")


def ramp_latest_run(samples: DataFrame) -> DataFrame:
    """All samples of the run with the newest sample (earliest in the file among equals)."""
    named = samples.filter(F.coalesce(F.col("run_id") != "", F.lit(False)))
    newest = named.select(
        F.max_by("run_id", F.struct(F.col("ts_ms"), -F.col("seq"))).alias("run_id")
    )
    return samples.filter(F.col("run_id") == newest.scalar())


def _with_known_counts(polls: DataFrame, block: int) -> DataFrame:
    """Polls in order of step and time.

    ``known`` is the last count that was read (0 before the first), ``before`` the one known
    at the poll before, ``step_before`` that poll's step, ``read_polls`` the number of polls
    read so far.
    """
    keys = ["run_id"]
    read = F.col("count") != -1
    positioned = with_position(polls, keys, ["step", "ts_ms", "seq"])
    known = running(
        positioned,
        keys,
        {
            "known": ("last", F.when(read, F.col("count"))),
            "read_polls": ("sum", F.when(read, 1).otherwise(0)),
        },
        block,
    ).withColumn("known", F.coalesce("known", F.lit(0)))

    def add(df, window):
        return df.withColumns(
            {
                "before": F.coalesce(F.lag("known").over(window), F.lit(0)),
                "step_before": F.lag("step").over(window),
            }
        )

    return over_recent_rows(known, keys, add, 1, block)


def sample_throughput(
    polls: DataFrame, seconds: int = SAMPLE_SECONDS, block: int = BLOCK_ROWS
) -> DataFrame:
    """Whole events per second between samples, never negative.

    A failed poll (-1) repeats the known count. The first sample of a step only sets its
    baseline and is left out.
    """
    # Below zero the result is cut to zero, so the direction of rounding does not matter there.
    gained = F.expr(f"cast(known - before as bigint) div {seconds}")
    rows = _with_known_counts(polls, block)
    return rows.filter(F.col("step_before") == F.col("step")).select(
        "run_id", "step", "seq", F.greatest(F.lit(0), gained).alias("throughput")
    )


def stall_detection(
    polls: DataFrame, limit: int, stall_polls: int = STALL_POLLS, block: int = BLOCK_ROWS
) -> DataFrame:
    """Progress in percent of ``limit`` and successive polls without change, per poll.

    A failed poll neither counts as standing still nor ends a standstill. ``stalled`` holds
    from ``stall_polls`` unchanged polls on.
    """
    moved = (F.col("count") != -1) & (F.col("known") != F.col("before"))
    rows = stored(
        _with_known_counts(polls, block).select(
            "run_id", "seq", "position", "known", "read_polls", moved.alias("moved")
        ),
        "polls",
    )
    last_move = F.when(F.col("moved"), F.col("read_polls"))
    rows = running(rows, ["run_id"], {"at_move": ("last", last_move)}, block)
    unchanged = F.col("read_polls") - F.coalesce(F.col("at_move"), F.lit(0))
    share = F.bround(F.col("known") / F.lit(limit) * 100).cast("bigint")
    percent = F.least(F.lit(100), share) if limit > 0 else F.lit(0)
    return rows.select(
        "run_id",
        "seq",
        percent.cast("bigint").alias("percent"),
        unchanged.cast("bigint").alias("unchanged_polls"),
    ).withColumn("stalled", F.col("unchanged_polls") >= stall_polls)

"""Reader lag: offsets, sample history, trend and the consolidated report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathwake.functions.columns import (
    count_where,
    fill_label,
    idle_label,
    now_or_latest,
    proximity_label,
    trend_class,
)
from pathwake.operators.ordering import BLOCK_ROWS, over_recent_rows, with_position

HISTORY_SECONDS, TREND_SECONDS, LATEST_SECONDS = 300, 120, 60
LAG_RETENTION_SECONDS, BACKPRESSURE_RETENTION_SECONDS = 3600, 300


def consumer_lag(
    committed: DataFrame, end: DataFrame, topic: str | None = None
) -> DataFrame:
    """Messages behind per topic partition; partitions without a commit (-1) are skipped."""
    known = committed.filter(F.col("committed") >= 0)
    if topic is not None:
        known = known.filter(F.col("topic") == topic)
    lag = F.greatest(F.lit(0), F.col("end_offset") - F.col("committed"))
    return known.join(end, ["topic", "part"]).select("topic", "part", lag.alias("lag"))


def live_lag(positions: DataFrame, end: DataFrame) -> DataFrame:
    """Lag of a running reader. Null where position or end offset is unknown."""
    known = F.when(
        (F.col("committed") >= 0) & F.col("end_offset").isNotNull(),
        F.greatest(F.lit(0), F.col("end_offset") - F.col("committed")),
    )
    return positions.join(end, ["topic", "part"], "left").select(
        "topic", "part", known.cast("bigint").alias("lag")
    )


def total_live_lag(lags: DataFrame) -> DataFrame:
    """Total over the known partitions of each topic."""
    return lags.groupBy("topic").agg(
        F.coalesce(F.sum("lag"), F.lit(0)).alias("total_lag"),
        F.count("lag").alias("known_partitions"),
    )


def partitions_at_end(
    assigned: DataFrame, end: DataFrame, revoked: DataFrame | None = None
) -> DataFrame:
    """Whether every assigned partition of a topic is read to its end."""
    if revoked is not None:
        assigned = assigned.join(revoked.select("topic", "part"), ["topic", "part"], "left_anti")
    reached = F.coalesce(F.col("committed") >= F.col("end_offset"), F.lit(False))
    return (
        assigned.join(end, ["topic", "part"], "left")
        .groupBy("topic")
        .agg(
            F.count("*").alias("assigned"),
            count_where(reached).alias("finished"),
            F.bool_and(reached).alias("all_at_end"),
        )
    )


def topic_message_counts(end: DataFrame) -> DataFrame:
    """Messages per topic, internal topics left out."""
    visible = ~F.col("topic").startswith("__") & ~F.col("topic").contains("__assignor")
    return end.filter(visible).groupBy("topic").agg(F.sum("end_offset").alias("messages"))


def recent(samples: DataFrame, seconds: int | None, now: int | None = None) -> DataFrame:
    """Samples of the last ``seconds`` before ``now`` (the newest sample if not given).

    ``None`` seconds take all samples.
    """
    if seconds is None:
        return samples
    return samples.filter(F.col("ts") >= now_or_latest(samples, "ts", now) - F.lit(seconds))


def sample_retention(samples: DataFrame, seconds: int, now: int | None = None) -> DataFrame:
    """Samples that are still kept: strictly younger than ``seconds``."""
    return samples.filter(F.col("ts") > now_or_latest(samples, "ts", now) - F.lit(seconds))


def _partition_lags(samples: DataFrame) -> DataFrame:
    """Lag per second and partition; the last report of a partition counts."""
    return samples.groupBy("group_id", "ts", "part").agg(F.max_by("lag", "seq").alias("lag"))


def lag_history(
    samples: DataFrame, seconds: int | None = HISTORY_SECONDS, now: int | None = None
) -> DataFrame:
    """Lag per second over all instances: map of partitions in order, and the total."""
    entries = F.array_sort(F.collect_list(F.struct("part", "lag")))
    return (
        _partition_lags(recent(samples, seconds, now))
        .groupBy("group_id", "ts")
        .agg(F.map_from_entries(entries).alias("partitions"), F.sum("lag").alias("total"))
        .orderBy("group_id", "ts")
    )


def seen_partitions(samples: DataFrame) -> DataFrame:
    return samples.select("part").distinct()


def lag_history_pivot(
    samples: DataFrame,
    partitions: list[int] | None = None,
    seconds: int | None = HISTORY_SECONDS,
    now: int | None = None,
) -> DataFrame:
    """The history with one column ``p<n>`` per partition; a missing report is null.

    Columns are the partitions seen in the samples, unless a list of them is given.
    """
    lags = _partition_lags(recent(samples, seconds, now))
    if partitions is None:
        partitions = sorted(r.part for r in seen_partitions(samples).collect())
    columns = [F.max(F.when(F.col("part") == p, F.col("lag"))).alias(f"p{p}") for p in partitions]
    return (
        lags.groupBy("group_id", "ts")
        .agg(*columns, F.sum("lag").alias("total"))
        .orderBy("group_id", "ts")
    )


def total_lags(samples: DataFrame) -> DataFrame:
    """Total lag per group and second."""
    return (
        _partition_lags(samples).groupBy("group_id", "ts").agg(F.sum("lag").alias("total"))
    )


def lag_trend(
    samples: DataFrame, seconds: int | None = TREND_SECONDS, now: int | None = None
) -> DataFrame:
    """Trend class of each group's total lag by linear regression over the window."""
    totals = total_lags(recent(samples, seconds, now))
    fits = totals.groupBy("group_id").agg(
        F.count("*").alias("samples"),
        (F.max("ts") > F.min("ts")).alias("spread"),
        F.regr_slope("total", "ts").alias("slope"),
        F.avg("total").alias("mean"),
    )
    return fits.select("group_id", "samples", _class().alias("trend"))


def _class() -> Column:
    return trend_class(F.col("samples"), F.col("spread"), F.col("slope"), F.col("mean"))


def lag_trend_rolling(samples: DataFrame, rows: int = 24, block: int = BLOCK_ROWS) -> DataFrame:
    """Trend class at each sample over the ``rows`` latest samples of its group."""
    positioned = with_position(total_lags(samples), ["group_id"], ["ts"])

    def fit(df, window):
        frame = window.rowsBetween(1 - rows, 0)
        return df.withColumns(
            {
                "samples": F.count("*").over(frame),
                "spread": F.max("ts").over(frame) > F.min("ts").over(frame),
                "slope": F.regr_slope("total", "ts").over(frame),
                "mean": F.avg("total").over(frame),
            }
        )

    rolled = over_recent_rows(positioned, ["group_id"], fit, rows, block)
    return rolled.select("group_id", "ts", "total", _class().alias("trend"))


def backpressure_report(samples: DataFrame) -> DataFrame:
    """Worst case over the latest sample of each instance of a group.

    Missing indicators read as 0. The bottleneck is that of the instance nearest its poll
    limit; equal instances are decided by the lower number.
    """
    fields = ["ts", "fill_ratio", "poll_proximity", "idle_ms", "rebalance_count",
              "bottleneck_stage"]
    latest = (
        samples.groupBy("group_id", "instance")
        .agg(F.max_by(F.struct(*fields), "ts").alias("s"))
        .select("group_id", "instance", "s.*")
        .na.fill(0)
    )
    nearest = F.struct(F.col("poll_proximity"), -F.col("instance"))
    return latest.groupBy("group_id").agg(
        F.max("fill_ratio").alias("fill_ratio"),
        F.max("poll_proximity").alias("poll_proximity"),
        F.min("idle_ms").alias("idle_ms"),
        F.sum("rebalance_count").alias("rebalance_count"),
        F.max_by("bottleneck_stage", nearest).alias("bottleneck_stage"),
        F.count("*").alias("instance_count"),
        F.max("ts").alias("ts"),
    )


def with_labels(report: DataFrame) -> DataFrame:
    return report.withColumns(
        {
            "fill_status": fill_label(F.col("fill_ratio")),
            "proximity_status": proximity_label(F.col("poll_proximity")),
            "idle_status": idle_label(F.col("idle_ms")),
        }
    )


def lag_latest(
    samples: DataFrame, seconds: int = LATEST_SECONDS, now: int | None = None
) -> DataFrame:
    """Total lag of the newest sample per group within the window."""
    totals = total_lags(recent(samples, seconds, now))
    return totals.groupBy("group_id").agg(F.max_by("total", "ts").alias("consumer_lag"))


def lag_report(
    samples: DataFrame,
    backpressure: DataFrame,
    latest_seconds: int = LATEST_SECONDS,
    trend_seconds: int = TREND_SECONDS,
    now: int | None = None,
) -> DataFrame:
    """Lag, trend, backpressure and status labels per group that has any of them."""
    lags = lag_latest(samples, latest_seconds, now)
    trends = lag_trend(samples, trend_seconds, now).select("group_id", "trend")
    report = with_labels(backpressure_report(backpressure)).drop("ts")
    joined = lags.join(report, "group_id", "full").join(trends, "group_id", "left")
    return joined.withColumn(
        "lag_trend", F.coalesce("trend", F.lit("unknown"))
    ).drop("trend")


def current_rate(samples: DataFrame, seconds: int = 60, now: int | None = None) -> DataFrame:
    """Counts per second over the window, per source; null with fewer than two moments.

    ``samples_count`` counts all samples of the source.
    """
    inside = F.col("ts") >= now_or_latest(samples, "ts", now) - F.lit(seconds)
    ts = F.when(inside, F.col("ts"))
    span = F.max(ts) - F.min(ts)
    gained = F.max_by("count", ts) - F.min_by("count", ts)
    return samples.groupBy("source").agg(
        F.when(span > 0, gained / span).alias("current_rate"),
        F.count("*").alias("samples_count"),
    )


def rebalance_stability(
    rebalances: DataFrame, seconds: int = 300, limit: int = 2, now: int | None = None
) -> DataFrame:
    """Rebalances of the last ``seconds`` per reader; more than ``limit`` is unstable.

    A reader is an instance of a group: groups number their instances independently.
    """
    inside = F.col("ts") >= now_or_latest(rebalances, "ts", now) - F.lit(seconds)
    counted = rebalances.groupBy("group_id", "instance").agg(count_where(inside).alias("rebalance_count"))
    return counted.withColumn("unstable", F.col("rebalance_count") > limit)

"""Column expressions used by several operators. All stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def optional_id(text: Column) -> Column:
    """Text to long; empty, zero and unreadable text become null."""
    return F.nullif(text.try_cast("bigint"), F.lit(0).cast("bigint"))


def event_time(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def iso_text(ms: Column) -> Column:
    """ISO-8601 UTC text; the fraction is left out on whole seconds."""
    moment = F.timestamp_millis(ms)
    whole = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ssxxx")
    fine = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.when(F.pmod(ms, F.lit(1000)) == 0, whole).otherwise(fine)


def document_id() -> Column:
    return F.concat_ws("_", "visitor_id", "timestamp", "event", "item_id")


def ratio(part: Column, whole: Column, factor: float = 1.0) -> Column:
    """``part / whole * factor``, 0 where ``whole`` is not positive."""
    return F.when(whole > 0, part / whole * F.lit(factor)).otherwise(F.lit(0.0))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def trend_class(samples: Column, spread: Column, slope: Column, mean: Column) -> Column:
    """Class of a lag series: growing, shrinking, stable or unknown.

    ``spread`` tells whether the x values differ. A slope counts when it is at least one
    percent of the mean per x unit, or at least one where the mean is zero.
    """
    direction = F.when(slope > 0, "growing").otherwise("shrinking")
    return (
        F.when((samples < 2) | ~spread, "unknown")
        .when(mean == 0, F.when(F.abs(slope) < 1, "stable").otherwise(direction))
        .when(F.abs(slope) / mean < 0.01, "stable")
        .otherwise(direction)
    )


def fill_label(fill: Column) -> Column:
    return F.when(fill >= 0.95, "saturated").when(fill >= 0.80, "high").otherwise("normal")


def proximity_label(proximity: Column) -> Column:
    return (
        F.when(proximity > 0.9, "critical").when(proximity > 0.7, "warning").otherwise("healthy")
    )


def idle_label(idle_ms: Column) -> Column:
    return (
        F.when(idle_ms < 5, "minimal headroom")
        .when(idle_ms < 50, "low headroom")
        .otherwise("healthy")
    )


def now_or_latest(df: DataFrame, column: str, now: int | None) -> Column:
    """A given moment, or the largest value of ``column`` as a scalar subquery."""
    if now is not None:
        return F.lit(now).cast("bigint")
    return df.select(F.max(column).alias("latest")).scalar()


def json_rows(report: DataFrame) -> DataFrame:
    """A report as JSON text, one object per row, unknown values as null."""
    fields = F.struct(*report.columns)
    return report.select(F.to_json(fields, {"ignoreNullFields": "false"}).alias("json"))

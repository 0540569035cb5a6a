"""One table over the state of the whole system."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathwake.operators.lag import current_rate, topic_message_counts
from pathwake.operators.sessions import active_sessions
from pathwake.operators.traffic import table_counts


def status_overview(
    tables: dict[str, DataFrame],
    end_offsets: DataFrame,
    state: DataFrame,
    as_of: Column,
    counters: DataFrame,
    rate_seconds: int = 60,
) -> DataFrame:
    """Table counts, messages per topic, active sessions and rates as (metric, value) rows."""

    def rows(df: DataFrame, label: Column, value: str) -> DataFrame:
        return df.select(label.alias("metric"), F.col(value).cast("double").alias("value"))

    parts = [
        rows(table_counts(**tables), F.concat(F.lit("table "), "table_name"), "rows"),
        rows(topic_message_counts(end_offsets), F.concat(F.lit("topic "), "topic"), "messages"),
        rows(active_sessions(state, as_of), F.lit("active sessions"), "active_sessions"),
        rows(
            current_rate(counters, rate_seconds), F.concat(F.lit("rate "), "source"),
            "current_rate",
        ),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result

"""File sources: event CSV, result CSV, stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pathwake.schemas import RAMP_RESULT, RAW_CSV, RUN_RESULT


def _named(spark: SparkSession, layout: T.StructType) -> DataFrameReader:
    """Reader that refuses files whose header differs from the layout, instead of shifting columns."""
    return spark.read.schema(layout).option("header", True).option("enforceSchema", False)


def scan_events_csv(spark: SparkSession, path: str) -> DataFrame:
    """Event CSV with a header, columns as in the file."""
    return _named(spark, RAW_CSV).csv(path)


def scan_results_csv(
    spark: SparkSession, path: str, layout: T.StructType | None = None
) -> DataFrame:
    """Result CSV with a header; rows without a readable timestamp are skipped.

    Files may have more columns than ``layout`` (per-partition lags, network figures); these
    are read as text. The header decides which columns are there, so only it is looked at.
    """
    header = spark.read.option("header", True).csv(path).columns
    known = {f.name: f for f in (layout or RUN_RESULT)}
    found = T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in header])
    rows = _named(spark, found).csv(path)
    moment = F.col("timestamp").try_cast("timestamp")
    return rows.withColumn("ts_ms", F.unix_millis(moment)).filter(F.col("ts_ms").isNotNull())


def scan_ramp_csv(spark: SparkSession, path: str) -> DataFrame:
    return scan_results_csv(spark, path, RAMP_RESULT)


def scan_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)

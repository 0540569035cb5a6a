"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Upper bound of rows a lookup table may have to be broadcast (about 40 bytes a row).
BROADCAST_ROWS = 1_000_000
TASK_ROWS = 20_000
LEAST_TASKS = 12


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings the results depend on: UTC, and the state store streams need."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    # A batch then commits what it changed in place of a snapshot, and its changes can be read.
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a fresh temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="pathwake-"))
    return context.getCheckpointDir()


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def tasks_of(rows: int, each: int = TASK_ROWS) -> int:
    """Tasks that ``rows`` narrow rows are worth, in proportion to them and never very few."""
    return max(LEAST_TASKS, -(-rows // each))


def stored(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a result is read more than once, so that the work is not repeated, its rows
    cannot differ between reads, and a lost executor does not force a recomputation. ``rows`` is
    an upper bound of the rows of the last step, if known: few rows go to few tasks and files.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    if rows is not None:
        df = df.coalesce(tasks_of(rows))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

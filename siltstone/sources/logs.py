"""Structured log lines."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fields of a log entry.
LOG_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("timestamp", "level", "message", "batch_id", "partition_key")]
    + [T.StructField("file_count", T.LongType())]
    + [T.StructField(name, T.StringType()) for name in ("table", "error")]
)


def scan_logs(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """JSON log lines; lines that are not JSON are left out."""
    return spark.read.schema(LOG_SCHEMA).option("mode", "DROPMALFORMED").json(list(paths))


def select_logs(
    logs: DataFrame,
    level: str | None = None,
    batch_contains: str | None = None,
    last: int | None = None,
    tie_break: tuple[str, ...] = (),
) -> DataFrame:
    """Entries of a level and batch; ``last`` keeps the newest n, newest first."""
    if level:
        logs = logs.filter(F.upper("level") == level.upper())
    if batch_contains:
        logs = logs.filter(F.col("batch_id").contains(batch_contains))
    if last:
        order = [F.col(c).desc() for c in ("timestamp", *tie_break)]
        logs = logs.orderBy(*order).limit(last)
    return logs

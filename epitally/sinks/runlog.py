"""Run log: parameters and metrics of each run as rows."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from epitally.sinks.compact import compact, distinct_rows

SCHEMA = "run_id string, kind string, key string, value string, logged_at timestamp"


def log_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    params: Mapping[str, object] | None = None,
    metrics: Mapping[str, object] | None = None,
) -> None:
    """Append the parameters and metrics of a run to the log table in one write."""
    now = datetime.now(timezone.utc)
    rows = [
        (run_id, kind, key, None if value is None else str(value), now)
        for kind, found in (("param", params), ("metric", metrics))
        for key, value in (found or {}).items()
    ]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All logged rows, each once, also while a compaction is under way."""
    return distinct_rows(spark.read.schema(SCHEMA).parquet(path))


def compact_log(spark: SparkSession, path: str, **options) -> int:
    """Rewrite the log's many small files as few; options as :func:`compact`."""
    return compact(spark, path, SCHEMA, **options)

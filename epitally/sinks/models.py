"""Saved models and their registry."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from epitally.sinks.compact import compact

# Default model name and the version format.
MODEL_NAME = "random_forest_deaths_predictor"
VERSION_FORMAT = "%Y%m%d_%H%M%S"

REGISTRY_SCHEMA = (
    "name string, version string, path string, registered_at timestamp, "
    "metrics map<string, double>"
)


def new_version(now: datetime | None = None) -> str:
    return (now or datetime.now(timezone.utc)).strftime(VERSION_FORMAT)


def model_path(base: str, name: str, version: str) -> str:
    return f"{base}/{name}_v{version}"


def save_model(
    model: PipelineModel,
    base: str,
    name: str = MODEL_NAME,
    version: str | None = None,
    overwrite: bool = True,
    metrics: Mapping[str, float | None] | None = None,
) -> str:
    """Save one copy under a versioned path and add it to the registry; returns the version.

    A version not given is the time to the second with a random ending, so no two saves
    share a path. A version given again replaces the model, and its registry row with it.
    """
    version = version or f"{new_version()}_{uuid.uuid4().hex[:8]}"
    path = model_path(base, name, version)
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)
    spark = SparkSession.active()
    spark.createDataFrame(
        [(name, version, path, datetime.now(timezone.utc), dict(metrics or {}))],
        REGISTRY_SCHEMA,
    ).coalesce(1).write.mode("append").parquet(f"{base}/registry")
    return version


def registry(spark: SparkSession, base: str) -> DataFrame:
    """All registered versions, each by its last row; empty where nothing has been registered."""
    try:
        rows = spark.read.schema(REGISTRY_SCHEMA).parquet(f"{base}/registry")
        last = W.partitionBy("name", "version").orderBy(F.desc("registered_at"))
        return rows.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], REGISTRY_SCHEMA)


def compact_registry(spark: SparkSession, base: str, **options) -> int:
    """Rewrite the registry's small files as few; options as :func:`compact`.

    Versions that were registered again keep all their rows; the last one still counts.
    """
    return compact(spark, f"{base}/registry", REGISTRY_SCHEMA, **options)


def load_model(
    spark: SparkSession, base: str, name: str = MODEL_NAME, version: str | None = None
) -> PipelineModel:
    """A registered model: the given version, or the last one registered."""
    found = registry(spark, base).where(F.col("name") == name)
    if version is not None:
        found = found.where(F.col("version") == version)
    row = found.orderBy(F.desc("registered_at"), F.desc("version")).first()
    if row is None:
        raise LookupError(f"No model {name} version {version or 'any'} under {base}")
    return PipelineModel.load(row["path"])

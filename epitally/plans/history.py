"""Keyed history kept by day in Parquet, with versions and a manifest.

Under the history's path, ``data/v=<version>/updated_day=<day>/`` holds the rows of a day as a
batch left them, and ``manifests/<number>.json`` says which version of each day counts; the
highest number is the one in force. A merge writes the days it touches to a new version and
then publishes a manifest that names it, by one rename. Until then readers see the history as
it was, from then on as it is; nothing that is read is ever overwritten.

There may be one writer at a time; a second one fails when it publishes.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epitally.operators.upsert import MYSQL, MergeRule, merge
from epitally.plans.manifest import current, drop_old, names, publish
from epitally.schema import CASES
from epitally.workspace import delete, discard, tasks_for, written

DAY = "updated_day"
VERSION = "v"


def with_day(df: DataFrame) -> DataFrame:
    """Add the partition column: the UTC day of ``updated``. It depends on the key alone."""
    return df.withColumn(
        DAY, F.date_from_unix_date(F.floor(F.col("updated") / 86_400_000).cast("int"))
    )


def read_history(
    spark: SparkSession,
    path: str,
    schema: T.StructType = CASES,
    days: Sequence[str] | None = None,
) -> DataFrame:
    """The history with its partition column, or some of its days; empty where there is none."""
    full = T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])
    _, versions = current(spark, path)
    wanted = versions if days is None else {d: versions[d] for d in days if d in versions}
    folders = [f"{path}/data/{VERSION}={v}/{DAY}={d}" for d, v in sorted(wanted.items())]
    if not folders:
        # The filter lets the optimizer see that there is nothing to join with.
        return spark.createDataFrame([], full).where(F.lit(False))
    version = T.StructField(VERSION, T.StringType())
    rows = spark.read.schema(T.StructType([*full.fields, version]))
    return rows.option("basePath", f"{path}/data").parquet(*folders).drop(VERSION)


def _write_days(rows: DataFrame, path: str, version: str) -> None:
    """The rows by day: few files for each, a large day split over tasks."""
    rows.hint("rebalance", DAY).write.partitionBy(DAY).parquet(f"{path}/data/{VERSION}={version}")


def _clean(spark: SparkSession, path: str) -> None:
    """Delete what neither the manifest in force nor the one before names.

    The one before is kept for readers that have begun with it. Also deletes what a merge left
    that was broken off before it published.
    """
    named = {(v, d) for kept in drop_old(spark, path) for d, v in kept.items()}
    versions = {v for v, _ in named}
    for folder in names(spark, f"{path}/data"):
        version = folder.removeprefix(f"{VERSION}=")
        if version not in versions:
            delete(spark, f"{path}/data/{folder}")
            continue
        for day in names(spark, f"{path}/data/{folder}"):
            if day.startswith(f"{DAY}=") and (version, day.removeprefix(f"{DAY}=")) not in named:
                delete(spark, f"{path}/data/{folder}/{day}")


def merge_into_history(
    staging: DataFrame,
    path: str,
    rule: MergeRule = MYSQL,
    schema: T.StructType = CASES,
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Merge a batch into the history at ``path``; returns the history.

    Only the days in the batch are read, merged and written, each once. Their names go
    through the driver: as many as the batch touches partition folders. After a failure at
    any point the same call can be repeated: before the manifest is published the history is
    as it was, and after it merging the batch again changes nothing.
    """
    spark = staging.sparkSession
    batch = written(with_day(staging), "batch")
    try:
        found = batch.select(F.col(DAY).cast("string")).distinct().collect()
        days = sorted(r[0] for r in found if r[0] is not None)
        number, versions = current(spark, path)
        target = read_history(spark, path, schema, days)
        # Both are files, whose footers have the number of rows.
        tasks = tasks_for(batch.count() + target.count())
        merged = merge(target.drop(DAY), batch, rule, on_duplicate, order_by, tasks)
        # A row without a key has no day; it fails in the merge.
        if found:
            version = uuid.uuid4().hex
            _write_days(with_day(merged), path, version)
            publish(spark, path, number + 1, {**versions, **dict.fromkeys(days, version)})
            _clean(spark, path)
    finally:
        discard(spark, batch)
    return read_history(spark, path, schema)

"""Keyed table in buckets of its key, so that a merge shuffles the batch alone.

Under the table's path ``data/v=<version>/`` holds Parquet files, one for each bucket, and a
manifest names the version in force and its number of buckets. Rows are dealt to buckets by
Spark's own hash of the key. A merge joins bucket with bucket: the target is read where it lies,
only the batch is dealt to the same buckets, and the result is written by the same tasks, again
one file a bucket. The new version is put in force by one rename; readers see the old one until
then. One writer at a time; a second one fails when it publishes.

This suits a target that takes batches touching much of it. For batches that touch few days,
:mod:`epitally.plans.history` reads and writes only those.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from epitally.operators.upsert import MYSQL, MergeRule, merge
from epitally.plans.manifest import current, drop_old, names, publish
from epitally.schema import CASES, KEYS
from epitally.workspace import delete


def _write(rows: DataFrame, path: str, version: str, buckets: int, keys: Sequence[str]) -> None:
    """Rows dealt by key to ``buckets`` partitions already; each task writes its bucket."""
    name = f"epitally_{uuid.uuid4().hex}"
    writer = rows.write.format("parquet").option("path", f"{path}/data/v={version}")
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    # The session's entry was only needed to write in buckets; the files stay.
    rows.sparkSession.sql(f"DROP TABLE {name}")


def _publish(spark: SparkSession, path: str, number: int, version: str, buckets: int) -> None:
    publish(spark, path, number, {"version": version, "buckets": str(buckets)})
    kept = {m["version"] for m in drop_old(spark, path)}
    for folder in names(spark, f"{path}/data"):
        if folder.removeprefix("v=") not in kept:
            delete(spark, f"{path}/data/{folder}")


def write_bucketed(
    rows: DataFrame, path: str, buckets: int, keys: Sequence[str] = KEYS
) -> None:
    """Write ``rows`` as the table's new version.

    A merge takes a task for each bucket and sorts its rows and the batch's: choose ``buckets`` by
    :func:`epitally.workspace.tasks_for`, and write the table anew when it has outgrown them.
    """
    spark = rows.sparkSession
    number, _ = current(spark, path)
    version = uuid.uuid4().hex
    _write(rows.repartition(buckets, *keys), path, version, buckets, keys)
    _publish(spark, path, number + 1, version, buckets)


def read_bucketed(
    spark: SparkSession, path: str, schema: T.StructType = CASES, keys: Sequence[str] = KEYS
) -> DataFrame:
    """The version in force as a bucketed scan; joins and aggregates on the key need no shuffle."""
    number, state = current(spark, path)
    if not number:
        raise LookupError(f"No bucketed table at {path}")
    name = f"epitally_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    by = ", ".join(f"`{k}`" for k in keys)
    location = f"{path}/data/v={state['version']}".replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {state['buckets']} BUCKETS "
        f"LOCATION '{location}'"
    )
    found = spark.table(name)
    # Resolved already: the frame keeps the buckets, and no entry is left in the catalog.
    spark.sql(f"DROP TABLE {name}")
    return found


def merged_buckets(
    staging: DataFrame,
    path: str,
    rule: MergeRule = MYSQL,
    schema: T.StructType = CASES,
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
) -> DataFrame:
    """The rows of :func:`epitally.operators.upsert.merge` with the table as target.

    The only shuffle is that of the batch to the table's buckets; the check for repeated keys
    and the join both use it.
    """
    spark = staging.sparkSession
    target = read_bucketed(spark, path, schema, rule.keys)
    buckets = int(current(spark, path)[1]["buckets"])
    return merge(target, staging.repartition(buckets, *rule.keys), rule, on_duplicate, order_by)


def merge_into_bucketed(
    staging: DataFrame,
    path: str,
    rule: MergeRule = MYSQL,
    schema: T.StructType = CASES,
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Merge a batch into the table; returns it as it then is.

    A merge broken off before it publishes leaves the table as it was and can be repeated.
    """
    spark = staging.sparkSession
    number, state = current(spark, path)
    rows = merged_buckets(staging, path, rule, schema, on_duplicate, order_by)
    version, buckets = uuid.uuid4().hex, int(state["buckets"])
    _write(rows, path, version, buckets, rule.keys)
    _publish(spark, path, number + 1, version, buckets)
    return read_bucketed(spark, path, schema, rule.keys)

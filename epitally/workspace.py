"""Shared scratch folder for written tables that cut lineage."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder, which is then this
    session's checkpoint folder. A cluster session without it is an error, because a
    machine-local folder would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        # "local-cluster[...]" has executors of its own, as a cluster has.
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="epitally-"))
    return context.getCheckpointDir()


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package's code, once for each application.

    Spark serves the archive to every executor, later ones included.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[1]
        target = tempfile.mkdtemp(prefix="epitally-")
        archive = shutil.make_archive(f"{target}/epitally-code", "zip", root, "epitally")
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def new_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet and return a scan of it.

    Later jobs read columns from files instead of repeating the plan, and a lost executor
    costs only its running tasks. The scan has the schema of ``df`` and remembers its path
    for :func:`discard`.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._written_path = path
    return table


# Rows that one task of a join sorts and aggregates in some hundred MB; tasks of a small one.
ROWS_PER_TASK = 400_000
LEAST_TASKS = 8


def tasks_for(rows: int) -> int:
    """Tasks among which so many narrow rows are dealt, whatever the session's number."""
    return max(LEAST_TASKS, -(-rows // ROWS_PER_TASK))


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables of :func:`written` that nothing reads any more."""
    for table in tables:
        path = getattr(table, "_written_path", None)
        if path is None:
            raise ValueError("Not a table written to the shared folder")
        delete(spark, path)


def file_system(spark: SparkSession, path: str):
    """Spark's file system for a path, and the path in its terms."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    files, found = file_system(spark, path)
    return files.exists(found)


def delete(spark: SparkSession, path: str) -> None:
    files, found = file_system(spark, path)
    files.delete(found, True)


def dealt(df: DataFrame, keys: Sequence[str], partitions: int) -> DataFrame:
    """Rows dealt to ``partitions`` by a hash of their keys, in order inside each.

    The same rows are in the same place whatever the files they come from and wherever it
    runs. For operators that draw at random by partition and position, as a forest does.
    """
    rows = df.repartition(partitions, F.xxhash64(*keys))
    return rows.sortWithinPartitions(*keys, *[c for c in df.columns if c not in keys])

"""Compaction of tables that grow by one small file a run: the run log and the model registry."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from epitally.workspace import delete, file_system

# A table with fewer files than this is left alone.
LEAST_FILES = 8
FILE_BYTES = 128 * 1024 * 1024
DRAFT = "_compacting-"


def data_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Paths and sizes of the table's own files; none where there is no table."""
    files, folder = file_system(spark, path)
    if not files.exists(folder):
        return []
    found = [(s.getPath(), s.getLen()) for s in files.listStatus(folder) if s.isFile()]
    return sorted((p.toString(), n) for p, n in found if p.getName()[0] not in "._")


def compact(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    least_files: int = LEAST_FILES,
    file_bytes: int = FILE_BYTES,
) -> int:
    """Rewrite the files there are now as few larger ones; returns how many files remain.

    The rows are written to a hidden folder, moved in under new names and the old files deleted.
    For a moment both copies can be seen, so rows must be facts that count once when they occur
    twice; readers of such tables drop equal rows (:func:`distinct_rows`). A compaction broken off
    at any point loses nothing, and repeating it ends in the same rows. Files appended meanwhile
    are not touched.
    """
    files, folder = file_system(spark, path)
    old = data_files(spark, path)
    if files.exists(folder):
        for status in files.listStatus(folder):
            if status.getPath().getName().startswith(DRAFT):
                files.delete(status.getPath(), True)
    wanted = max(1, -(-sum(n for _, n in old) // file_bytes))
    if len(old) < least_files or len(old) <= wanted:
        return len(old)
    draft = f"{path.rstrip('/')}/{DRAFT}{uuid.uuid4().hex}"
    rows = spark.read.schema(schema).parquet(*[p for p, _ in old])
    distinct_rows(rows).repartition(wanted).write.parquet(draft)
    for made, _ in data_files(spark, draft):
        _, source = file_system(spark, made)
        _, target = file_system(spark, f"{path.rstrip('/')}/compacted-{uuid.uuid4().hex}.parquet")
        if not files.rename(source, target):
            raise RuntimeError(f"Could not move {made} into {path}")
    for gone, _ in old:
        delete(spark, gone)
    delete(spark, draft)
    return len(data_files(spark, path))


def distinct_rows(rows: DataFrame) -> DataFrame:
    """Each row once. Maps are compared by their entries, as they cannot be grouped by."""
    maps = [f.name for f in rows.schema if isinstance(f.dataType, T.MapType)]
    if not maps:
        return rows.distinct()
    keyed = rows.selectExpr(
        "*", *[f"to_json(map_from_entries(sort_array(map_entries(`{m}`)))) AS `_{m}`" for m in maps]
    )
    plain = [c for c in rows.columns if c not in maps]
    return keyed.dropDuplicates([*plain, *[f"_{m}" for m in maps]]).select(*rows.columns)

"""Small manifests that say which versions of a table's parts are in force.

``manifests/<number>.json`` under a table's path maps names to versions; the highest number
counts. A new one is put in force by one rename, which must be atomic and refuse an existing
name, as on HDFS and local file systems.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

from epitally.workspace import delete, file_system


def names(spark: SparkSession, folder: str) -> list[str]:
    files, path = file_system(spark, folder)
    if not files.exists(path):
        return []
    return [s.getPath().getName() for s in files.listStatus(path)]


def numbers(spark: SparkSession, path: str) -> list[int]:
    found = [n.removesuffix(".json") for n in names(spark, f"{path}/manifests")]
    return sorted(int(n) for n in found if n.isdigit())


def read_manifest(spark: SparkSession, path: str, number: int) -> dict[str, str]:
    """Version by name. As many entries as the table has parts."""
    files, found = file_system(spark, f"{path}/manifests/{number:012}.json")
    stream = files.open(found)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def current(spark: SparkSession, path: str) -> tuple[int, dict[str, str]]:
    """Number and content of the manifest in force; 0 and nothing without one."""
    found = numbers(spark, path)
    return (found[-1], read_manifest(spark, path, found[-1])) if found else (0, {})


def publish(spark: SparkSession, path: str, number: int, versions: dict[str, str]) -> None:
    """Put the manifest in force with one rename."""
    files, folder = file_system(spark, f"{path}/manifests")
    files.mkdirs(folder)
    _, draft = file_system(spark, f"{path}/manifests/.draft-{uuid.uuid4().hex}")
    stream = files.create(draft)
    try:
        stream.write(bytearray(json.dumps(versions, sort_keys=True).encode()))
    finally:
        stream.close()
    _, final = file_system(spark, f"{path}/manifests/{number:012}.json")
    if files.exists(final) or not files.rename(draft, final):
        files.delete(draft, False)
        raise RuntimeError(f"Another writer has published manifest {number} of {path}")


def drop_old(spark: SparkSession, path: str) -> list[dict[str, str]]:
    """Delete all manifests but the last two, and drafts; returns the contents of those two.

    The one before is kept for readers that have begun with it.
    """
    found = numbers(spark, path)
    for n in found[:-2]:
        delete(spark, f"{path}/manifests/{n:012}.json")
    for name in names(spark, f"{path}/manifests"):
        if name.startswith(".draft-"):
            delete(spark, f"{path}/manifests/{name}")
    return [read_manifest(spark, path, n) for n in found[-2:]]

"""Landed files read once: a ledger of the files that earlier batches took.

A batch lists the landed files, leaves out those the ledger has with the same modification
time and length, reads the rest and, once its work is done, commits them. A file that was
changed since counts as new. A batch that fails before its commit finds the same files again;
one that commits and is repeated finds none. One reader at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epitally.schema import CASES
from epitally.sources.landing import read_cases
from epitally.workspace import exists

SCHEMA = "path string, modificationTime timestamp, length long, batch string"
IDENTITY = ("path", "modificationTime", "length")


def landed_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """``(path, modificationTime, length)`` of the files under ``folder``, unread."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return files.option("pathGlobFilter", pattern).load(folder).select(*IDENTITY)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """Files committed so far; none where there is no ledger yet."""
    if not exists(spark, ledger):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(ledger)


@dataclass(frozen=True)
class NewFiles:
    """Files a batch is to read, and their rows; ``commit`` when the batch is done."""

    spark: SparkSession
    ledger: str
    batch: str
    files: tuple
    cases: DataFrame

    def commit(self) -> None:
        """Enter the files in the ledger, in one write. To repeat it does no harm."""
        if self.files:
            rows = [(*f, self.batch) for f in self.files]
            entries = self.spark.createDataFrame(rows, SCHEMA)
            entries.coalesce(1).write.mode("append").parquet(self.ledger)


def new_cases(
    spark: SparkSession,
    folder: str,
    ledger: str,
    batch: str,
    pattern: str = "*",
    **options,
) -> NewFiles:
    """The rows of landed files that the ledger does not have; options as ``read_cases``.

    Only the names of the new files pass through the driver. No file is opened to find them,
    and none that was committed is opened again.
    """
    seen = read_ledger(spark, ledger).select(*IDENTITY)
    fresh = landed_files(spark, folder, pattern).join(seen, list(IDENTITY), "left_anti")
    files = tuple(tuple(r) for r in fresh.orderBy("path").collect())
    if files:
        cases = read_cases(spark, [f[0] for f in files], **options)
    else:
        cases = spark.createDataFrame([], CASES).where(F.lit(False))
    return NewFiles(spark, ledger, batch, files, cases)

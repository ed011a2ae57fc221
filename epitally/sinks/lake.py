"""Lake export: a columnar main copy and a copy for analysts."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial
from threading import Event, Thread

from pyspark import InheritableThread, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epitally.functions.expressions import instant

MAIN_FORMATS = ("parquet", "orc", "json")
ANALYST_FORMATS = ("csv", "parquet")
# "overwrite_partitions" replaces the partitions that the rows have, and no others.
MODES = ("overwrite", "append", "overwrite_partitions")

# The dialect of the analyst CSV. Null is an empty field and an empty string
# is "", so a reader must be told to keep them apart; by default both come back as null.
CSV_OPTIONS = {
    "header": "true",
    "delimiter": ",",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
}


@dataclass(frozen=True)
class LakeConfig:
    """Where and how to export.

    ``analyst_files`` is the number of files of the analyst CSV; None leaves the data as
    it is spread. One file means one task writes everything, so ask for it only where the
    copy is small.
    """

    base: str
    main_format: str = "parquet"
    mode: str = "overwrite"
    partition_by: tuple[str, ...] = ()
    analyst_format: str = "csv"
    analyst_files: int | None = None
    order_by: tuple[str, ...] = ()
    bloom: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        _one_of("main_format", self.main_format, MAIN_FORMATS)
        _one_of("analyst_format", self.analyst_format, ANALYST_FORMATS)
        _check_partitions(_one_of("mode", self.mode, MODES), self.partition_by)
        if self.analyst_files is not None and self.analyst_files < 1:
            raise ValueError("analyst_files must be at least 1, or None")

    def main_path(self, dataset: str) -> str:
        return f"{self.base}/main/{dataset}"

    def analyst_path(self, dataset: str) -> str:
        return f"{self.base}/analyst/{dataset}"


def _one_of(name: str, value: str, allowed: Sequence[str]) -> str:
    if value.lower() not in allowed:
        raise ValueError(f"Unsupported {name}={value} ({'|'.join(allowed)})")
    return value.lower()


def _check_partitions(mode: str, partition_by: Sequence[str]) -> None:
    if mode == "overwrite_partitions" and not partition_by:
        raise ValueError("overwrite_partitions needs partition_by columns")


def stamp(df: DataFrame, batch_micros: int | None = None) -> DataFrame:
    """Add ``ingest_ts`` and ``ingest_date``, one value for the whole batch.

    A literal, because ``current_timestamp()`` differs between the jobs of one export.
    """
    micros = time.time_ns() // 1000 if batch_micros is None else batch_micros
    return df.withColumn("ingest_ts", instant(micros)).withColumn(
        "ingest_date", F.to_date("ingest_ts")
    )


def write_main(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    order_by: Sequence[str] = (),
    bloom: Sequence[str] = (),
    row_group_bytes: int | None = None,
) -> None:
    """Columnar (or JSON) copy, optionally partitioned.

    Before a partitioned write rows are rebalanced by the partition columns: each value
    goes to few, evenly sized files, and a value with very many rows is split over tasks.

    ``overwrite_partitions`` replaces only the partitions of which ``df`` has rows, each whole.

    ``order_by`` deals rows to files by ranges of these columns, and sorts inside a file, so that
    files and row groups hold short ranges, which a filter on them skips by their statistics. In
    a partitioned write the ranges are inside a partition. ``bloom`` adds Bloom filters to Parquet
    row groups, by which a search for single values skips those without them, in any order.
    """
    fmt = _one_of("main_format", fmt, MAIN_FORMATS)
    mode = _one_of("mode", mode, MODES)
    _check_partitions(mode, partition_by)
    if bloom and fmt != "parquet":
        raise ValueError("Bloom filters are written to parquet only")
    if order_by:
        order = [*partition_by, *order_by]
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    dynamic = mode == "overwrite_partitions"
    writer = df.write.format(fmt).mode("overwrite" if dynamic else mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option(
            "partitionOverwriteMode", "dynamic" if dynamic else "static"
        )
    if fmt == "parquet":
        writer = writer.option("compression", "snappy")
        if row_group_bytes is not None:
            writer = writer.option("parquet.block.size", row_group_bytes)
        for name in bloom:
            writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    writer.save(path)


def write_analyst(df: DataFrame, path: str, fmt: str = "csv", files: int | None = None) -> None:
    """Analyst copy; it always replaces the one before."""
    fmt = _one_of("analyst_format", fmt, ANALYST_FORMATS)
    if fmt == "csv":
        if files is not None:
            # Only the writers are reduced in number; the work before them stays parallel.
            df = df.repartition(files)
        df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    else:
        df.write.mode("overwrite").parquet(path)


def read_main(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet"
) -> DataFrame:
    """Main copy in the column order of ``schema``; partition values keep their types."""
    fmt = _one_of("main_format", fmt, MAIN_FORMATS)
    return spark.read.schema(schema).format(fmt).load(path).select(*schema.fieldNames())


def read_analyst(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "csv",
    multi_line: bool = False,
) -> DataFrame:
    """Analyst copy. ``multi_line`` is for texts with line breaks; files then do not split."""
    fmt = _one_of("analyst_format", fmt, ANALYST_FORMATS)
    reader = spark.read.schema(schema)
    if fmt == "parquet":
        return reader.parquet(path)
    return reader.options(**CSV_OPTIONS).option("multiLine", multi_line).csv(path)


def dual_write(
    df: DataFrame, config: LakeConfig, dataset: str, batch_micros: int | None = None
) -> DataFrame:
    """Stamp the batch and write both copies at the same time; returns the stamped frame.

    Two Spark jobs from two driver threads. Fails if either fails, after both have ended;
    the copies are not atomic with each other. ``df`` should be a scan of files, since both
    jobs run its plan.
    """
    stamped = stamp(df, batch_micros)
    jobs: list[Callable[[], None]] = [
        partial(
            write_main,
            stamped,
            config.main_path(dataset),
            config.main_format,
            config.mode,
            config.partition_by,
            config.order_by,
            config.bloom,
        ),
        partial(
            write_analyst,
            stamped,
            config.analyst_path(dataset),
            config.analyst_format,
            config.analyst_files,
        ),
    ]
    spark = df.sparkSession
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    for job in running:
        job.result()
    return stamped


def export(
    df: DataFrame,
    config: LakeConfig,
    dataset: str,
    batch_micros: int | None = None,
    timeout_seconds: float | None = None,
) -> DataFrame:
    """Dual write that returns when both copies are complete, or raises.

    After ``timeout_seconds`` the Spark jobs of this export are cancelled, which raises;
    nothing is left writing in the background.
    """
    context = df.sparkSession.sparkContext
    tag = f"lake-export-{time.time_ns()}"
    ended = Event()

    def cancel_late() -> None:
        # Again each second, since a cancelled write may have a further job to submit.
        wait = timeout_seconds
        while not ended.wait(wait):
            context.cancelJobsWithTag(tag)
            wait = 1.0

    context.addJobTag(tag)
    try:
        if timeout_seconds is not None:
            Thread(target=cancel_late, daemon=True).start()
        return dual_write(df, config, dataset, batch_micros)
    finally:
        ended.set()
        context.removeJobTag(tag)


def export_in_background(
    df: DataFrame, config: LakeConfig, dataset: str, batch_micros: int | None = None
) -> InheritableThread:
    """Start an export and return its thread; join it before stopping Spark."""
    thread = InheritableThread(
        target=lambda: export(df, config, dataset, batch_micros), session=df.sparkSession
    )
    thread.start()
    return thread

"""What several text operators share: reading, words of an Arrow batch, ranks without a global sort."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from epitally.workspace import new_path, ship_code, written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Texts are worked on in slices of about this many bytes, however large the Arrow batch is.
SLICE_BYTES = 1 << 20
# Rows sent to Python at once, unless the session has another number than the default: whole
# texts are large rows, and a batch is held on both sides.
BATCH_KEY, BATCH_DEFAULT, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def ship(spark: SparkSession, batch_rows: str | None = BATCH_ROWS) -> None:
    """Give the executors this package's code, once for each application.

    Spark serves the archive to every executor, later ones included. A session that still has
    Spark's default number of rows in a batch to Python gets ``batch_rows``, for all its queries;
    None leaves the session as it is.
    """
    if batch_rows is not None and spark.conf.get(BATCH_KEY) == BATCH_DEFAULT:
        spark.conf.set(BATCH_KEY, batch_rows)
    ship_code(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def whole_text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``limit`` bytes of text each; no row is cut."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    piece = np.cumsum(sizes) // limit
    edges = [0, *(np.flatnonzero(np.diff(piece)) + 1), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row and the offsets of each; a null text is empty."""
    column = pc.fill_null(column, "")
    large = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if large else np.int32
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    if data is None:
        return np.empty(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs without ASCII white space, and each text's first word.

    The third array has one more entry than there are texts: words ``first[i]`` to
    ``first[i + 1]`` belong to text ``i``.
    """
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    starts_here = inside[1:-1] & ~inside[:-2]
    ends_here = inside[1:-1] & ~inside[2:]
    begin = offsets[:-1][np.diff(offsets) > 0]
    starts_here[begin] = inside[begin + 1]
    last = begin[begin > 0] - 1
    ends_here[last] = inside[last + 1]
    starts = np.flatnonzero(starts_here)
    return starts, np.flatnonzero(ends_here) + 1, np.searchsorted(starts, offsets)


_FACTOR = 0x9E3779B97F4A7C15 | 1


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _FACTOR, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of every span; spans are not empty."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    before = np.cumsum(lengths) - lengths
    inner = np.arange(before[-1] + lengths[-1]) - np.repeat(before, lengths)
    values = data[inner + np.repeat(starts, lengths)].astype(np.uint64) + np.uint64(1)
    values *= _powers(int(lengths.max()))[inner]
    return mixed(np.add.reduceat(values, before) + lengths.astype(np.uint64))


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive word hashes."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out *= np.uint64(_FACTOR)
        out += words[i : i + n]
    return mixed(out)


def hash_pair(*columns: Column) -> list[Column]:
    """128 bits of hash in two BIGINT columns."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit(20011), *columns)]


def smallest_hashes(rows: DataFrame, group: str, n: int) -> DataFrame:
    """Up to ``n`` rows of each group, those with the smallest ``h0`` (unsigned) and ``h1``.

    Rows are different and ``h0`` spreads evenly, so a cut of its range at twice the share leaves
    about ``2 * n`` rows of a group, whatever their number and that of the tasks, and only these
    are ranked in one place. A group of up to ``2 * n`` rows is not cut.
    """
    counts = written(rows.groupBy(group).agg(F.count(F.lit(1)).alias("_count")), "counts")
    # Of the unsigned hash, as a fraction.
    place = F.shiftrightunsigned("h0", 1) / F.lit(float(1 << 63))
    near = rows.join(counts, group).where(
        (F.col("_count") <= 2 * n) | (place * F.col("_count") < F.lit(2.0 * n))
    )
    unsigned = F.col("h0").bitwiseXOR(F.lit(-(1 << 63)).cast("long"))
    rank = F.row_number().over(W.partitionBy(group).orderBy(unsigned, "h1"))
    return near.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank", "_count")


def ranked(df: DataFrame, order: Sequence[Column], rank: str, label: str) -> DataFrame:
    """Rows with their place from 0 in ``order``, which should tell all rows apart.

    Rows are dealt to tasks by ranges of the order and sorted there, so a hot value of its
    first column spreads over tasks as long as the later columns differ. The rows are written
    with their place inside the task, so a repeated task cannot number them anew; the only
    other step is a running total over one row for each task. ``df`` should be narrow.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    place = f"{rank}_place"
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(place, F.monotonically_increasing_id())
        .write.parquet(path)
    )
    kept = spark.read.parquet(path)
    task, inside = F.shiftright(place, 33), F.col(place).bitwiseAND(F.lit((1 << 33) - 1))
    kept = kept.withColumn(f"{rank}_task", task)
    totals = kept.groupBy(f"{rank}_task").agg(F.count(F.lit(1)).alias(f"{rank}_n"))
    earlier = W.orderBy(f"{rank}_task").rowsBetween(W.unboundedPreceding, -1)
    bases = totals.select(
        f"{rank}_task", F.coalesce(F.sum(f"{rank}_n").over(earlier), F.lit(0)).alias(f"{rank}_base")
    )
    # One row for each task that wrote rows: bounded by the number of partitions.
    return (
        kept.join(F.broadcast(bases), f"{rank}_task")
        .withColumn(rank, F.col(f"{rank}_base") + inside)
        .drop(place, f"{rank}_task", f"{rank}_base")
    )

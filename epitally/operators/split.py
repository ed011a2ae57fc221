"""Train and test split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from epitally.functions.expressions import HASH_BITS, hash_bucket, hash_place
from epitally.workspace import written

BUCKETS = 10_000
# Cells of the hash's range in which a stratum is counted, as a power of two.
CELL_BITS = 16


def hash_split(
    df: DataFrame, keys: Sequence[str], ratio: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the key: the same rows on any partitioning and after any retry."""
    bucket = hash_bucket(keys, seed, BUCKETS)
    threshold = F.lit(float(ratio)) * BUCKETS
    return df.where(bucket < threshold), df.where(bucket >= threshold)


def random_split(
    df: DataFrame, ratio: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Spark's seeded random split.

    The draw follows the row order inside partitions. Give it a written table: then both
    halves read the same partitions, also after a lost executor, and no row is drawn twice.
    """
    train, test = df.randomSplit([ratio, 1.0 - ratio], seed)
    return train, test


def _same(names: Sequence[str], other: str) -> list[Column]:
    return [F.col(n).eqNullSafe(F.col(f"{other}{i}")) for i, n in enumerate(names)]


def stratum_cuts(
    df: DataFrame,
    strata: Sequence[str],
    keys: Sequence[str],
    ratio: float = 0.8,
    seed: int = 42,
    cell_bits: int = CELL_BITS,
) -> DataFrame:
    """``(s0, s1, ..., rows, quota, cut)``: one row for each stratum, written.

    ``quota`` is ``ratio`` of the stratum's rows, rounded half up, and ``cut`` the hash and key of
    the last row inside it, null for a quota of zero.
    """
    place = hash_place(keys, seed)
    names = [f"s{i}" for i in range(len(strata))]
    placed = df.select(
        *[F.col(c).alias(n) for c, n in zip(strata, names)],
        F.shiftright(place, HASH_BITS - cell_bits).alias("cell"),
        F.struct(place.alias("place"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]).alias("at"),
    )
    cells = placed.groupBy(*names, "cell").agg(F.count(F.lit(1)).alias("n"))
    whole = W.partitionBy(*names)
    before = whole.orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    # At most 2^cell_bits rows for a stratum, however many it has.
    counted = cells.select(
        "*",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("below"),
        F.sum("n").over(whole).alias("rows"),
    ).withColumn("quota", F.floor(F.col("rows") * F.lit(float(ratio)) + 0.5).cast("long"))
    edges = counted.groupBy(*names).agg(
        F.first("rows").alias("rows"),
        F.first("quota").alias("quota"),
        F.max_by("cell", F.when(F.col("below") < F.col("quota"), F.col("cell"))).alias("edge"),
        F.max(F.when(F.col("below") < F.col("quota"), F.col("below"))).alias("below"),
    )
    edges = written(edges, "edges")
    # Only the rows of one cell of each stratum are ordered.
    other = edges.select(*[F.col(n).alias(f"o{i}") for i, n in enumerate(names)], "edge", "quota", "below")
    last = placed.join(other, [*_same(names, "o"), F.col("cell") == F.col("edge")])
    rank = F.row_number().over(W.partitionBy(*names).orderBy("at"))
    last = last.withColumn("rank", rank).where(F.col("below") + F.col("rank") == F.col("quota"))
    found = last.select(*[F.col(n).alias(f"o{i}") for i, n in enumerate(names)], F.col("at").alias("cut"))
    return written(
        edges.join(found, _same(names, "o"), "left").select(*names, "rows", "quota", "cut"), "cuts"
    )


def stratified_split(
    df: DataFrame,
    strata: Sequence[str],
    keys: Sequence[str],
    ratio: float = 0.8,
    seed: int = 42,
    cell_bits: int = CELL_BITS,
) -> tuple[DataFrame, DataFrame]:
    """Split so that of every stratum exactly the same share of rows, rounded, is in the first part.

    Rows of a stratum, the combinations of ``strata`` with null as a value of its own, are in the
    order of a hash of their key, which must be unique; the first ones make the quota. The
    choice depends on the rows alone, not on partitioning or on the number of a retry.

    No stratum is sorted as a whole, however large: a count by cells of the hash's range finds
    the cell the quota ends in, and only the rows of that cell, one of 65,536, are put in order.
    ``df`` should be a scan of files, as it is read three times.
    """
    cuts = stratum_cuts(df, strata, keys, ratio, seed, cell_bits)
    columns = df.columns
    fields = [hash_place(keys, seed).alias("place")]
    fields += [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]
    found = cuts.select(
        *[F.col(f"s{i}").alias(f"_s{i}") for i in range(len(strata))], F.col("cut").alias("_cut")
    )
    joined = df.join(found, _same(strata, "_s"))
    first = F.coalesce(F.struct(*fields) <= F.col("_cut"), F.lit(False))
    return joined.where(first).select(*columns), joined.where(~first).select(*columns)

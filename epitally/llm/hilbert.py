"""Sharding along a Hilbert curve, in DataFrame functions only.

Metadata columns are quantised to sixteen cells each, and the cells are numbered along a
Hilbert curve, so that documents close on the curve are close in every column and each run of
it can be pruned by any of them. All documents are ranked by curve number and key, and the
ranks are cut into equal runs.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epitally.llm.common import ranked
from epitally.workspace import written

BITS = 4
SHARDS = 8


def curve(dimensions: int, bits: int = BITS) -> list[int]:
    """The place on the curve of every cell, cells counted with the first column outermost.

    A cell's coordinates are turned into the curve's transposed index by undoing, from the
    highest bit down, the exchange and inversion of axes in each sub-cube, then Gray-coded.
    """
    top = 1 << (bits - 1)
    out = []
    for cell in range(1 << (dimensions * bits)):
        x = [(cell >> (bits * (dimensions - 1 - d))) & ((1 << bits) - 1) for d in range(dimensions)]
        q = top
        while q > 1:
            low = q - 1
            for d in range(dimensions):
                if x[d] & q:
                    x[0] ^= low
                else:
                    swap = (x[0] ^ x[d]) & low
                    x[0] ^= swap
                    x[d] ^= swap
            q >>= 1
        for d in range(1, dimensions):
            x[d] ^= x[d - 1]
        flip, q = 0, top
        while q > 1:
            if x[-1] & q:
                flip ^= q - 1
            q >>= 1
        x = [v ^ flip for v in x]
        place = 0
        for bit in range(bits - 1, -1, -1):
            for v in x:
                place = place << 1 | (v >> bit & 1)
        out.append(place)
    return out


def with_ordinals(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` with the text ``columns`` replaced by the rank of their value among all values.

    Whole strings are compared. Values are ranked by ranges, each once, and joined back with
    their rank; Spark broadcasts a small table of values by its size, and else splits a value
    that very many rows have. Null stays null.
    """
    for c in columns:
        values = rows.where(F.col(c).isNotNull()).select(F.col(c).alias("_value")).distinct()
        order = written(ranked(values, [F.col("_value")], "_ordinal", "values"), "ordinals")
        rows = rows.join(order, F.col(c) == F.col("_value"), "left")
        rows = rows.withColumn(c, F.col("_ordinal").cast("double")).drop("_value", "_ordinal")
    return rows


def _below(value: Column):
    return lambda step: step < value


def hilbert_index(rows: DataFrame, columns: list[str], bits: int = BITS) -> Column:
    """The curve number of every row, by quantiles of the numeric ``columns``.

    One pass takes the quantiles: a few numbers a column, whatever the size of the data. A null
    value lies in the first cell.
    """
    parts = 1 << bits
    fractions = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    cuts = rows.agg(
        *[F.percentile_approx(c, fractions, F.lit(1_000)).alias(f"c{i}") for i, c in enumerate(columns)]
    ).first()
    cell = F.lit(0)
    for i, c in enumerate(columns):
        steps = F.array(*[F.lit(v) for v in cuts[f"c{i}"] or []]).cast("array<double>")
        value = F.col(c).cast("double")
        at = F.when(value.isNull(), 0).otherwise(F.size(F.filter(steps, _below(value))))
        cell = cell * parts + at
    # The table has as many entries as there are cells: 4,096 for three columns.
    return F.get(F.array(*[F.lit(p) for p in curve(len(columns), bits)]), cell)


def shard(
    docs: DataFrame,
    dimensions: Mapping[str, Column],
    key: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
) -> DataFrame:
    """``(key, size, text_crc32, hilbert, shard, slot)``: every row of ``docs`` in a shard.

    Shards are runs of the rank by curve number, key, checksum and size, and hold equally many
    rows, give or take one; slots count from 0 in each. Null keys come first in a cell, rows
    equal in all of these in any order. A null text has size 1 and checksum 0. ``dimensions`` are
    named columns, numbers or texts; of a text the whole value counts, by its rank among all
    values. Documents' texts are never shuffled.
    """
    bytes_of = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    narrow = docs.select(
        F.col(key).alias("_key"),
        (bytes_of + 1).alias("_size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("_crc"),
        *[c.alias(f"_dim_{i}") for i, c in enumerate(dimensions.values())],
    )
    names = [f"_dim_{i}" for i in range(len(dimensions))]
    texts = [c for c in names if isinstance(narrow.schema[c].dataType, T.StringType)]
    if texts:
        narrow = with_ordinals(written(narrow, "dimensions"), texts)
    narrow = narrow.withColumns({c: F.col(c).cast("double") for c in names if c not in texts})
    place = hilbert_index(narrow, [f"_dim_{i}" for i in range(len(dimensions))])
    rows = narrow.select("_key", "_size", "_crc", place.alias("_place"))
    order = [F.col(c) for c in ("_place", "_key", "_crc", "_size")]
    placed = ranked(rows, order, "_rank", "hilbert")
    n = max(1, placed.count())
    # In whole numbers: floor(rank * shards / n), and the first rank of each shard.
    number = F.expr(f"(_rank * {shards}) div {n}")
    begin = F.expr(f"(_shard * {n}L + {shards - 1}) div {shards}")
    return placed.withColumn("_shard", number).select(
        F.col("_key").alias(key),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.col("_place").alias("hilbert"),
        F.col("_shard").cast("int").alias("shard"),
        (F.col("_rank") - begin).alias("slot"),
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str, key: str = "doc_id") -> None:
    """Write ``docs`` as one folder a shard, in slot order inside each file.

    Keys must be unique. Rows are dealt by shard and slot ranges, so a shard is many files,
    each a short run of the curve with narrow column statistics.
    """
    rows = docs.join(placed.select(key, "shard", "slot", "hilbert"), key)
    (
        rows.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )

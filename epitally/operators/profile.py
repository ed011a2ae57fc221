"""Counts, null counts and ranges, all from one scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epitally.functions.expressions import null_flag
from epitally.schema import REQUIRED


def _null_sums(columns: Sequence[str]) -> list[Column]:
    return [
        F.coalesce(F.sum(null_flag(c)), F.lit(0)).cast("long").alias(f"{c}_nulls")
        for c in columns
    ]


def _ranges() -> list[Column]:
    return [
        F.min("cases").alias("min_cases"),
        F.max("cases").alias("max_cases"),
        F.avg("population").alias("avg_population"),
    ]


def _size(columns: Sequence[str]) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(columns)).cast("long").alias("column_count"),
    ]


def size(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(*_size(df.columns))


def null_counts(df: DataFrame, columns: Sequence[str] = REQUIRED) -> DataFrame:
    """One row with ``<column>_nulls`` for every column; zeros for an empty input."""
    return df.agg(*_null_sums(columns))


def ranges(df: DataFrame) -> DataFrame:
    """One row: smallest and largest ``cases``, mean ``population``; nulls when empty."""
    return df.agg(*_ranges())


def profile_columns(columns: Sequence[str], required: Sequence[str] = REQUIRED) -> list[Column]:
    """The aggregates of :func:`profile` for a frame of ``columns``."""
    return [*_size(columns), *_null_sums(required), *_ranges()]


def profile(df: DataFrame, columns: Sequence[str] = REQUIRED) -> DataFrame:
    """Size, null counts and ranges as one aggregate over one scan."""
    return df.agg(*profile_columns(df.columns, columns))

"""Scalar expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_missing(df: DataFrame, name: str) -> Column:
    """True for null, and for NaN where the column can hold one."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.col(name).isNull() | F.isnan(name)
    return F.col(name).isNull()


def null_flag(name: str) -> Column:
    """1 where the column is null, else 0."""
    return F.when(F.col(name).isNull(), 1).otherwise(0)


def null_where(name: str, condition: Column) -> Column:
    """The column with its value removed wherever the condition holds."""
    return F.when(condition, None).otherwise(F.col(name)).alias(name)


def per_million(count: str, population: str) -> Column:
    """Integer division of ``count`` scaled to one million by ``population``; null for 0."""
    return F.expr(f"(`{count}` * 1000000L) div nullif(`{population}`, 0L)")


def whole(name: str) -> Column:
    """A number read from JSON as BIGINT; fractions are cut towards zero."""
    return F.col(name).cast("long")


def absolute_error(label: str = "label", prediction: str = "prediction") -> Column:
    return F.abs(F.col(label) - F.col(prediction))


def epoch_millis(df: DataFrame, name: str) -> Column:
    """Milliseconds since 1970 of a timestamp column, whatever the session time zone.

    A TIMESTAMP is an instant already. A TIMESTAMP_NTZ is wall-clock time and is taken as
    UTC, so it must not be cast through the session zone; its distance from 1970 is an
    interval, which casts to whole seconds.
    """
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return F.expr(
            f"CAST((`{name}` - TIMESTAMP_NTZ '1970-01-01 00:00:00') * 1000 AS BIGINT)"
        )
    return F.unix_millis(name)


def _keyed_digest(keys: Iterable[str], seed: int) -> Column:
    text = F.concat(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]), F.lit(str(seed)))
    return F.md5(text)


def hash_bucket(keys: Iterable[str], seed: int, buckets: int = 10_000) -> Column:
    """Bucket of a row from the MD5 of its key and a seed.

    It depends on the row alone, so repartitioning, retries and other engines agree on it.
    """
    digits = F.substring(_keyed_digest(keys, seed), 1, 8)
    return F.conv(digits, 16, 10).cast("long") % buckets


HASH_BITS = 60


def hash_place(keys: Iterable[str], seed: int) -> Column:
    """A number of ``HASH_BITS`` bits from the MD5 of the key and a seed, evenly spread."""
    digits = F.substring(_keyed_digest(keys, seed), 1, HASH_BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


def instant(epoch_micros: int) -> Column:
    """A literal timestamp, independent of session and driver time zones."""
    return F.timestamp_micros(F.lit(epoch_micros).cast("long"))

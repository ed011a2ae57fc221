"""Feature vectors for the regressors."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epitally.functions.expressions import is_missing
from epitally.schema import FEATURES, STRICT_FEATURES, TARGET


def check_columns(
    df: DataFrame, features: Sequence[str] = FEATURES, target: str = TARGET
) -> None:
    missing = [c for c in (*features, target) if c not in df.columns]
    if missing:
        raise ValueError(f"Input DataFrame missing required columns: {', '.join(missing)}")


def assembler(
    features: Sequence[str] = FEATURES, handle_invalid: str = "skip"
) -> VectorAssembler:
    """Columns to a ``features`` vector; ``skip`` drops rows with a null or NaN input."""
    return VectorAssembler(
        inputCols=list(features), outputCol="features", handleInvalid=handle_invalid
    )


def prepare(
    df: DataFrame,
    features: Sequence[str] = FEATURES,
    target: str = TARGET,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``features`` and ``label`` (and ``keep``) of the rows with complete features."""
    check_columns(df, features, target)
    return assembler(features).transform(df).select(
        *keep, "features", F.col(target).alias("label")
    )


def prepare_strict(
    df: DataFrame,
    features: Sequence[str] = STRICT_FEATURES,
    target: str = TARGET,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The same with the strict column order; a null or NaN input fails the job."""
    check_columns(df, features, target)
    return assembler(features, "error").transform(df).select(
        *keep, "features", F.col(target).alias("label")
    )


def _any_missing(df: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [is_missing(df, c) for c in columns])


def usable_rows(
    df: DataFrame,
    features: Sequence[str] = FEATURES,
    target: str = TARGET,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Feature columns and ``label`` of the rows a model can learn from.

    The same rows as :func:`prepare`, less those without a label, still as plain columns:
    narrower to cache than vectors, and the fitted pipeline assembles them itself.
    """
    check_columns(df, features, target)
    inputs = list(dict.fromkeys([*keep, *features]))
    return df.where(~_any_missing(df, [*features, target])).select(
        *inputs, F.col(target).alias("label")
    )


def dropped_rows(
    df: DataFrame, features: Sequence[str] = FEATURES, target: str = TARGET
) -> DataFrame:
    """One row: how many rows there are, and how many lack a feature or only the label."""
    check_columns(df, features, target)
    no_feature = _any_missing(df, features)
    no_label = ~no_feature & is_missing(df, target)
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(no_feature.cast("long")), F.lit(0)).alias("invalid_features"),
        F.coalesce(F.sum(no_label.cast("long")), F.lit(0)).alias("missing_labels"),
    )

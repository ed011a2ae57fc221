"""Totals kept over batches: partial sums of each day, recomputed only for days that changed.

A day of the history is read again only when the version of it that the history's manifest
names is another than the one its partial sums were taken from. Partial sums lie by day under
the state's own path, with a manifest that maps each day to ``<history's version>:<own>``; a
refresh writes the touched days to a new version and publishes it by one rename. Any summary
then adds some rows for each day, whatever the number of cases behind them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epitally.plans.history import DAY, VERSION, read_history
from epitally.plans.manifest import current, drop_old, names, publish
from epitally.schema import CASES
from epitally.workspace import delete

# Sums are decimals, exact beyond a BIGINT; an average is kept as its sum and its count.
PARTIALS = T.StructType(
    [
        T.StructField("continent", T.StringType()),
        T.StructField("total_countries", T.LongType()),
        *[T.StructField(c, T.DecimalType(38, 0)) for c in ("cases", "deaths", "population", "rate")],
        T.StructField("rates", T.LongType()),
        T.StructField(DAY, T.DateType()),
    ]
)


def day_partials(history: DataFrame) -> DataFrame:
    """One row for each day and continent, from which any coarser summary can be added up."""
    exact = {"cases": "cases", "deaths": "deaths", "population": "population", "rate": "deathsPerOneMillion"}
    return history.groupBy(DAY, "continent").agg(
        F.count(F.lit(1)).alias("total_countries"),
        *[
            F.sum(F.col(c).cast("decimal(20,0)")).cast("decimal(38,0)").alias(n)
            for n, c in exact.items()
        ],
        F.count("deathsPerOneMillion").alias("rates"),
    ).select(*PARTIALS.fieldNames())


def stale_days(spark: SparkSession, history: str, state: str) -> tuple[dict[str, str], list[str]]:
    """Days to compute, with the history's version of each, and days the history has no more."""
    _, there = current(spark, history)
    _, kept = current(spark, state)
    stale = {d: v for d, v in there.items() if kept.get(d, "").partition(":")[0] != v}
    return stale, [d for d in kept if d not in there]


def refresh(
    spark: SparkSession, history: str, state: str, schema: T.StructType = CASES
) -> list[str]:
    """Bring the partial sums up to the history; returns the days that were read.

    Nothing is read or written when no day changed. A refresh broken off can be repeated.
    """
    stale, gone = stale_days(spark, history, state)
    if not stale and not gone:
        return []
    number, kept = current(spark, state)
    version = uuid.uuid4().hex
    if stale:
        rows = day_partials(read_history(spark, history, schema, list(stale)))
        rows.repartition(DAY).write.partitionBy(DAY).parquet(f"{state}/data/{VERSION}={version}")
    versions = {d: v for d, v in kept.items() if d not in gone}
    versions |= {d: f"{v}:{version}" for d, v in stale.items()}
    publish(spark, state, number + 1, versions)
    named = {v.partition(":")[2] for m in drop_old(spark, state) for v in m.values()}
    for folder in names(spark, f"{state}/data"):
        if folder.removeprefix(f"{VERSION}=") not in named:
            delete(spark, f"{state}/data/{folder}")
    return sorted(stale)


def read_partials(spark: SparkSession, state: str) -> DataFrame:
    """The partial sums in force; empty where there are none."""
    _, versions = current(spark, state)
    folders = [
        f"{state}/data/{VERSION}={v.partition(':')[2]}/{DAY}={d}" for d, v in sorted(versions.items())
    ]
    if not folders:
        return spark.createDataFrame([], PARTIALS)
    version = T.StructField(VERSION, T.StringType())
    rows = spark.read.schema(T.StructType([*PARTIALS.fields, version]))
    return rows.option("basePath", f"{state}/data").parquet(*folders).drop(VERSION)


def kept_summary(spark: SparkSession, state: str, *by: str) -> DataFrame:
    """The summary of the whole history, or by ``continent`` or day, from the partial sums."""
    rate = F.sum("rate") / F.nullif(F.sum("rates"), F.lit(0))
    grouped = read_partials(spark, state).groupBy(*by)
    return grouped.agg(
        F.coalesce(F.sum("total_countries"), F.lit(0)).alias("total_countries"),
        *[F.sum(c).cast("long").alias(f"global_{c}") for c in ("cases", "deaths", "population")],
        F.round(rate.cast("double"), 2).alias("avg_deaths_per_million"),
    )

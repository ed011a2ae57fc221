"""Top-k, global and per-continent summaries, and the trend of each country."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from epitally.schema import REPORT_COLUMNS

VIEW = "epidemic"
DAY_MILLIS = 86_400_000


def register_view(df: DataFrame, name: str = VIEW) -> None:
    """Give the frame a name for SQL."""
    df.createOrReplaceTempView(name)


def report_rows(df: DataFrame) -> DataFrame:
    """The nine report columns of every row."""
    return df.select(*REPORT_COLUMNS)


def top_countries(df: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` rows with most cases; equal counts are ordered by country, nulls last."""
    return report_rows(df).orderBy(F.desc("cases"), F.asc("country")).limit(k)


def _total(name: str, wide: bool) -> Column:
    return F.sum(F.col(name).cast("decimal(20,0)") if wide else F.col(name))


def _summary(wide: bool) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_countries"),
        _total("cases", wide).alias("global_cases"),
        _total("deaths", wide).alias("global_deaths"),
        _total("population", wide).alias("global_population"),
        F.round(F.avg("deathsPerOneMillion"), 2).alias("avg_deaths_per_million"),
    ]


def global_summary(df: DataFrame, wide: bool = False) -> DataFrame:
    """One row of totals. ``wide`` sums as decimals, for totals beyond a BIGINT."""
    return df.agg(*_summary(wide))


def continent_summary(df: DataFrame, wide: bool = False) -> DataFrame:
    """The global summary for each continent."""
    return df.groupBy("continent").agg(*_summary(wide))


def trend(
    df: DataFrame,
    measures: Sequence[str] = ("cases", "deaths", "recovered"),
    resolution: int = DAY_MILLIS,
) -> DataFrame:
    """Change of each measure since the country's previous ``updated``.

    Keys must be unique and present; a null in one fails. ``df`` should be a scan of files,
    since it is read twice: for the rows and for the ends of pieces.

    Adds ``previous_updated`` and ``<measure>_change``, null on a country's first row.

    One country may hold a large share of the rows, so its history is not sorted in one
    task. Time is cut into pieces of ``resolution`` milliseconds; rows look back inside their
    (country, piece), and the first row of a piece takes the last row of the country's piece
    before it. Any resolution gives the same result. As keys are unique, a piece has at most
    ``resolution`` rows of a country, and a country at most one end for each piece of the time
    covered; choose it so that both are small, a day for a feed of some rows a minute.
    """
    no_key = F.raise_error("Row with a null key").cast("bigint")
    keyless = F.col("country").isNull() | F.col("updated").isNull()
    at = F.when(keyless, no_key).otherwise(F.col("updated"))
    pieces = df.withColumn("_piece", F.floor(at / F.lit(resolution)))
    inside = W.partitionBy("country", "_piece").orderBy("updated")
    state = F.struct("updated", *measures)
    looked_back = pieces.withColumn("_before", F.lag(state).over(inside))

    # One row per country and piece. Separate max_by columns hash-aggregate before the
    # shuffle; a max over the struct would have to sort.
    ends = pieces.groupBy("country", "_piece").agg(
        F.max("updated").alias("updated"),
        *[F.max_by(m, "updated").alias(m) for m in measures],
    )
    across = W.partitionBy("country").orderBy("_piece")
    carried = ends.select(
        "country", "_piece", F.lag(state).over(across).alias("_carried")
    ).where(F.col("_carried").isNotNull())

    joined = looked_back.join(carried, ["country", "_piece"], "left").withColumn(
        "_before", F.coalesce("_before", "_carried")
    )
    return joined.select(
        *df.columns,
        F.col("_before.updated").alias("previous_updated"),
        *[(F.col(m) - F.col(f"_before.{m}")).alias(f"{m}_change") for m in measures],
    )

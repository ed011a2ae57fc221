from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from epitally.functions.expressions import per_million  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("epitally-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def base():
    return SMALL


@pytest.fixture
def shared(spark):
    """A fresh folder under the session's shared folder."""
    from epitally.workspace import new_path

    return new_path(spark, "test")


def valid_rows(spark, n: int) -> DataFrame:
    """Complete model inputs of ``n`` made-up countries, larger ones with more of everything."""
    people = F.lit(40_000) + F.col("id") * 3_571
    counters = {
        "population": people,
        "cases": F.floor(people / 9) + F.col("id") % 17,
        "tests": F.floor(people / 2),
        "active": F.floor(people / 70) + F.col("id") % 5,
        "critical": F.floor(people / 900),
        "deaths": F.floor(people / 450),
    }
    rows = spark.range(n).select(*[c.cast("long").alias(name) for name, c in counters.items()])
    return rows.withColumns(
        {f"{c}PerOneMillion": per_million(c, "population") for c in ("cases", "deaths")}
    )


def case_rows(spark, rows: list[dict]) -> DataFrame:
    """Contract rows from partial dicts; columns not given are null."""
    from epitally.schema import CASES

    names = CASES.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], CASES)


def as_dicts(df: DataFrame) -> list[dict]:
    return [r.asDict() for r in df.collect()]

from __future__ import annotations

import random

import pytest
from conftest import as_dicts, case_rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from epitally.operators import summary as sm
from epitally.schema import REPORT_COLUMNS


def test_top_orders_by_cases_then_country_with_nulls_last(spark):
    rows = case_rows(
        spark,
        [
            {"country": "N", "cases": None},
            {"country": "B", "cases": 5},
            {"country": "A", "cases": 5},
            {"country": "C", "cases": 9},
        ],
    )
    assert [r["country"] for r in sm.top_countries(rows).collect()] == ["C", "A", "B", "N"]
    top = sm.top_countries(rows, 2)
    assert top.columns == list(REPORT_COLUMNS)
    assert [r["country"] for r in top.collect()] == ["C", "A"]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_summaries(spark):
    rows = case_rows(
        spark,
        [
            {"continent": "X", "cases": 1, "deaths": 1, "population": 10, "deathsPerOneMillion": 1},
            {"continent": "X", "cases": 2, "deathsPerOneMillion": 2},
            {"continent": "X", "deathsPerOneMillion": 2},
            {"continent": None, "cases": 4},
        ],
    )
    assert as_dicts(sm.global_summary(rows)) == [
        {
            "total_countries": 4,
            "global_cases": 7,
            "global_deaths": 1,
            "global_population": 10,
            "avg_deaths_per_million": 1.67,
        }
    ]
    by_continent = {r["continent"]: r for r in sm.continent_summary(rows).collect()}
    assert by_continent["X"]["total_countries"] == 3
    assert by_continent[None]["global_cases"] == 4
    assert by_continent[None]["avg_deaths_per_million"] is None


def test_empty_summary(spark):
    row = sm.global_summary(case_rows(spark, [])).first()
    assert row["total_countries"] == 0 and row["global_cases"] is None


def test_wide_totals_go_beyond_a_bigint(spark):
    huge = 2**62
    rows = case_rows(spark, [{"cases": huge}] * 4)
    assert int(sm.global_summary(rows, wide=True).first()["global_cases"]) == 4 * huge
    with pytest.raises(Exception, match="(?i)overflow"):
        sm.global_summary(rows).collect()


def test_view(spark):
    sm.register_view(case_rows(spark, [{"country": "A"}]))
    assert spark.sql("SELECT country FROM epidemic").collect() == [("A",)]


def expected_trend(rows):
    out, last = {}, {}
    for country, updated, cases in sorted(rows):
        before = last.get(country)
        out[(country, updated)] = (
            before and before[0],
            None if before is None or None in (before[1], cases) else cases - before[1],
        )
        last[country] = (updated, cases)
    return out


def check_trend(spark, rows, resolution):
    df = spark.createDataFrame(rows, "country string, updated bigint, cases bigint")
    found = {
        (r["country"], r["updated"]): (r["previous_updated"], r["cases_change"])
        for r in sm.trend(df, ["cases"], resolution).collect()
    }
    assert found == expected_trend(rows)


@pytest.mark.parametrize("resolution", [1, 7, 100, 10**6])
def test_trend_with_one_hot_country(spark, resolution):
    rng = random.Random(5)
    hot = [("H", u, rng.randrange(100)) for u in range(400)]
    others = [(f"C{rng.randrange(30)}", 1000 * i + 7, rng.randrange(9)) for i in range(150)]
    check_trend(spark, hot + others, resolution)


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.dictionaries(
        st.tuples(st.sampled_from("ABC"), st.integers(-9, 30)),
        st.one_of(st.none(), st.integers(-5, 5)),
        min_size=1,
        max_size=25,
    ),
    st.sampled_from([1, 3, 8, 50]),
)
def test_trend_equals_a_sorted_walk(spark, table, resolution):
    check_trend(spark, [(c, u, v) for (c, u), v in table.items()], resolution)


def test_trend_sorts_by_country_and_piece(spark):
    rows = spark.createDataFrame([("H", 1, 1)], "country string, updated bigint, cases bigint")
    plan = sm.trend(rows, ["cases"])._jdf.queryExecution().optimizedPlan().toString()
    by_row = next(x for x in plan.splitlines() if "Window" in x and "updated" in x)
    assert "country" in by_row and "_piece" in by_row


def test_trend_of_nothing(spark):
    empty = spark.createDataFrame([], "country string, updated bigint, cases bigint")
    assert sm.trend(empty, ["cases"]).collect() == []


def test_trend_needs_keys(spark):
    for row in ((None, 1, 2), ("A", None, 2)):
        bad = spark.createDataFrame(
            [("B", 1, 1), row], "country string, updated bigint, cases bigint"
        )
        with pytest.raises(Exception, match="(?i)null"):
            sm.trend(bad, ["cases"]).collect()

from __future__ import annotations

import pytest
from conftest import as_dicts, case_rows, valid_rows
from pyspark.sql import functions as F

from epitally.operators import profile as pf
from epitally.operators import quality as q
from epitally.schema import REQUIRED
from epitally.workspace import discard, written


def test_profile_of_rows(spark):
    rows = case_rows(
        spark,
        [
            {"country": "A", "cases": 5, "population": 10},
            {"country": None, "cases": 7, "population": 20},
            {"country": "C"},
        ],
    )
    found = pf.profile(rows).first().asDict()
    assert found["row_count"] == 3
    assert found["column_count"] == 14
    assert (found["country_nulls"], found["cases_nulls"], found["tests_nulls"]) == (1, 1, 3)
    assert (found["min_cases"], found["max_cases"], found["avg_population"]) == (5, 7, 15.0)
    parts = {}
    for part in (pf.size, pf.null_counts, pf.ranges):
        parts |= part(rows).first().asDict()
    assert parts == found


def test_empty_profile_has_zero_nulls_and_no_range(spark):
    found = pf.profile(case_rows(spark, [])).first().asDict()
    assert found["row_count"] == 0
    assert all(found[f"{c}_nulls"] == 0 for c in REQUIRED)
    assert found["min_cases"] is None and found["avg_population"] is None


def test_profile_scans_once(spark, base):
    rows = spark.read.parquet(f"{base}/customer.parquet").selectExpr(
        "c_name AS country", "c_custkey AS cases", "c_custkey AS population"
    )
    found = pf.profile(rows, ["country", "cases", "population"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in plan


def checks_of(df) -> dict:
    return {r["check"]: r for r in df.collect()}


def test_valid_rows_pass(spark):
    checks = q.validate(valid_rows(spark, 20).selectExpr("*", "'X' AS country"))
    assert q.require(checks) == []
    assert all(r["passed"] for r in checks.collect())


def test_empty_fails(spark):
    checks = q.validate(case_rows(spark, []))
    assert not checks_of(checks)["non_empty"]["passed"]
    with pytest.raises(q.QualityError, match="Dataset is empty!"):
        q.require(checks)


def test_few_rows_only_warn(spark):
    checks = q.validate(case_rows(spark, [{"country": "A", "cases": 1}]))
    assert q.require(checks) == ["enough_rows"]
    ten = q.validate(valid_rows(spark, 10).selectExpr("*", "'X' AS country"))
    assert q.require(ten) == []


def test_missing_columns_are_named(spark):
    rows = case_rows(spark, [{"country": "A"}] * 12).drop("tests", "cases")
    assert q.missing_columns(rows, REQUIRED) == ["cases", "tests"]
    with pytest.raises(q.QualityError, match="Missing required columns: cases, tests"):
        q.require(q.validate(rows))


def test_nulls_and_ranges_are_metrics_unless_limited(spark):
    rows = case_rows(
        spark, [{"country": "A", "cases": i if i % 2 else None} for i in range(12)]
    )
    assert q.require(q.validate(rows)) == []
    with pytest.raises(q.QualityError, match="cases_nulls"):
        q.require(q.validate(rows, max_null_ratio={"cases": 0.4}))
    assert q.require(q.validate(rows, max_null_ratio={"cases": 0.5})) == []
    with pytest.raises(q.QualityError, match="max_cases"):
        q.require(q.validate(rows, bounds={"max_cases": (None, 10)}))
    assert q.require(q.validate(rows, bounds={"max_cases": (0, 11)})) == []


def test_bound_on_a_missing_metric_fails(spark):
    rows = case_rows(spark, [{"country": "A"}] * 12)
    with pytest.raises(q.QualityError, match="min_cases"):
        q.require(q.validate(rows, bounds={"min_cases": (0, None)}))


def test_key_checks(spark):
    rows = case_rows(
        spark,
        [
            {"country": "A", "updated": 1},
            {"country": "A", "updated": 1},
            {"country": "A", "updated": 1},
            {"country": "A", "updated": 2},
            {"country": None, "updated": 2},
            {"country": "B"},
        ],
    )
    found = checks_of(q.key_checks(rows))
    assert found["keys_unique"]["value"] == 2 and not found["keys_unique"]["passed"]
    assert found["keys_not_null"]["value"] == 2 and not found["keys_not_null"]["passed"]
    clean = checks_of(q.key_checks(rows.where("updated = 2 AND country = 'A'")))
    assert all(r["passed"] for r in clean.values())
    assert as_dicts(q.key_checks(case_rows(spark, [])).select("value")) == [
        {"value": 0.0},
        {"value": 0.0},
    ]


def jobs(spark, work) -> int:
    """How many jobs ``work`` starts."""
    context, name = spark.sparkContext, f"group-{id(work)}"
    context.setJobGroup(name, "counted")
    try:
        work()
    finally:
        context._jsc.clearJobGroup()
    return len(context.statusTracker().getJobIdsForGroup(name))


@pytest.mark.parametrize("rows", [0, 5, 20])
def test_observed_checks_equal_checks_by_a_scan(spark, rows):
    df = valid_rows(spark, rows).selectExpr("*", "'X' AS country")
    observed, seen = q.observe_profile(df)
    assert observed.columns == df.columns
    limits = {"max_null_ratio": {"deaths": 0.1}, "bounds": {"min_cases": (0, 9)}}
    written(observed, "observed")
    assert as_dicts(seen.checks(spark, **limits)) == as_dicts(q.validate(df, **limits))


def test_observed_checks_start_no_job_over_the_data(spark):
    df = written(valid_rows(spark, 20).selectExpr("*", "'X' AS country"), "rows")
    observed, seen = q.observe_profile(df)
    assert jobs(spark, lambda: written(observed, "observed")) == jobs(
        spark, lambda: written(df, "plain")
    )
    plan = seen.checks(spark)._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" not in plan


def test_observed_checks_name_missing_columns(spark):
    df = valid_rows(spark, 12).drop("cases", "tests")
    observed, seen = q.observe_profile(df)
    written(observed, "observed")
    checks = {r.check: r.passed for r in seen.checks(spark).collect()}
    assert not checks["has_cases"] and not checks["has_country"] and checks["has_deaths"]


def test_quarantine(spark):
    rows = case_rows(
        spark,
        [
            {"country": "good", "updated": 1, "cases": 5, "deaths": 1},
            {"country": None, "updated": 1, "cases": -5, "deaths": 1},
            {"country": "nulls break no rule", "updated": 1},
            {"country": "dead", "updated": 1, "cases": 5, "deaths": 9, "recovered": 6},
        ],
    )
    parts = q.quarantine(rows)
    assert (parts.rows, parts.bad_rows) == (4, 2)
    bad = {r.country: r.broken for r in parts.bad.collect()}
    assert bad == {
        None: ["country_missing", "cases_negative", "deaths_over_cases"],
        "dead": ["deaths_over_cases", "recovered_over_cases"],
    }
    assert parts.by_rule["deaths_over_cases"] == 2 and parts.by_rule["tests_negative"] == 0
    assert parts.good.columns == rows.columns and parts.good.count() == 2
    # Neither part reads the files of the other.
    assert not set(_files(parts.good)) & set(_files(parts.bad))
    discard(spark, parts.good)


def _files(df) -> list[str]:
    return [r[0] for r in df.select(F.input_file_name()).distinct().collect()]


def test_quarantine_is_one_pass(spark):
    df = written(valid_rows(spark, 50), "rows")
    assert jobs(spark, lambda: q.quarantine(df, {"few": F.col("cases") > 10_000})) == jobs(
        spark, lambda: written(df, "plain")
    )


def test_quarantine_of_nothing_and_without_rules(spark):
    empty = q.quarantine(valid_rows(spark, 0))
    assert (empty.rows, empty.bad_rows, empty.good.count(), empty.bad.count()) == (0, 0, 0, 0)
    sure = q.quarantine(valid_rows(spark, 3), {})
    assert (sure.rows, sure.bad_rows, sure.by_rule) == (3, 0, {})
    with pytest.raises(ValueError, match="broken"):
        q.flag_rows(valid_rows(spark, 1).withColumn("broken", F.lit(1)))

"""The catalogue against its SQL twins, on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as entry_points
from compare import TABLES, normal
from epitally.plans.catalog import QUERIES
from epitally.plans.oracle import ORACLE

TWINS = ORACLE


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return connection


def test_every_twin_has_a_query():
    assert set(TWINS) == set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_equals_its_twin(spark, db, name):
    ours = entry_points.queries()[name](spark, SMALL)
    result = db.execute(TWINS[name])
    columns = [d[0] for d in result.description]
    assert sorted(ours.columns) == sorted(columns)
    assert normal(ours.columns, ours.collect()) == normal(columns, result.fetchall())


@pytest.mark.parametrize(
    "name", ["top_countries", "trend", "history_merge", "lake_dual_write", "audit_columns"]
)
def test_results_do_not_depend_on_the_session_zone(spark, db, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        ours = entry_points.queries()[name](spark, SMALL)
        rows = normal(ours.columns, ours.collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    result = db.execute(TWINS[name])
    assert rows == normal([d[0] for d in result.description], result.fetchall())


def test_entry(spark):
    rows = entry_points.entry(spark)
    assert rows.count() == 20


def test_snapshot_counts_lines_before_joining(spark):
    """One order with a third of the lines must not reach the join as raw rows."""
    from epitally.sources.tables import snapshot

    plan = snapshot(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Aggregate [l_orderkey") :]
    assert "Join" not in below

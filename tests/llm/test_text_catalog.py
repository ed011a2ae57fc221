"""Queries of the text operators against their SQL twins."""

from __future__ import annotations

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as entry_points
from compare import TABLES, normal
from epitally.llm.catalog import ORACLE, QUERIES


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return connection


def test_all_and_the_pipeline_are_registered():
    names = entry_points.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_twin(spark, db, name):
    ours = QUERIES[name](spark, SMALL)
    result = db.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(ours.columns) == sorted(columns)
    assert normal(ours.columns, ours.collect()) == normal(columns, result.fetchall())


@pytest.mark.parametrize("name", ["op1_line_dedup", "op6_imatch", "op10_hilbert_shards", "op12_merkle"])
def test_native_plans_run_no_python(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "InArrow"))

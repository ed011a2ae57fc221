"""Statements and options only: no database is started here."""

from __future__ import annotations

from unittest.mock import MagicMock, call, patch

import pytest
from conftest import case_rows

from epitally.operators.upsert import WITH_DAY_COUNTERS
from epitally.sinks import jdbc

MY = jdbc.JdbcTarget("jdbc:mysql://host/db", "com.mysql.cj.jdbc.Driver", user="u", password="p")
PG = jdbc.JdbcTarget("jdbc:postgresql://host/db", "org.postgresql.Driver")


def test_options():
    assert MY.options() == {
        "url": "jdbc:mysql://host/db",
        "driver": "com.mysql.cj.jdbc.Driver",
        "dbtable": "epidemic_cases",
        "user": "u",
        "password": "p",
    }
    assert "user" not in PG.options()
    assert "password='p'" not in repr(MY)


def test_scan_options():
    assert jdbc.read_options(PG) == PG.options()
    split = jdbc.read_options(PG, "t", column="updated", bounds=(0, 9), partitions=4)
    assert split["dbtable"] == "t"
    assert (split["partitionColumn"], split["lowerBound"]) == ("updated", "0")
    assert (split["upperBound"], split["numPartitions"]) == ("9", "4")
    with pytest.raises(ValueError, match="needs column, bounds and partitions"):
        jdbc.read_options(PG, column="updated")


def test_write_options(spark):
    options = MY.write_options(case_rows(spark, []))
    assert options["batchsize"] == "10000" and "numPartitions" not in options
    assert options["createTableColumnTypes"] == (
        "country VARCHAR(100), iso2 VARCHAR(5), iso3 VARCHAR(5), continent VARCHAR(50)"
    )
    assert "createTableColumnTypes" not in MY.write_options(spark.range(1))


# Fixed values in the statements below: the contract's column lists, in the contract's order.


def test_mysql_statement():
    assert jdbc.merge_statement(MY) == (
        "INSERT INTO epidemic_cases (country, updated, iso2, iso3, continent, population, "
        "cases, deaths, recovered, active, critical) "
        "SELECT country, updated, iso2, iso3, continent, population, "
        "cases, deaths, recovered, active, critical FROM epidemic_cases_staging "
        "ON DUPLICATE KEY UPDATE iso2 = VALUES(iso2), iso3 = VALUES(iso3), "
        "continent = VALUES(continent), population = VALUES(population), "
        "cases = VALUES(cases), deaths = VALUES(deaths), recovered = VALUES(recovered), "
        "active = VALUES(active), critical = VALUES(critical)"
    )


def test_postgres_statement():
    statement = jdbc.merge_statement(PG)
    assert statement.endswith(
        "ON CONFLICT (country, updated) DO UPDATE SET cases = EXCLUDED.cases, "
        "deaths = EXCLUDED.deaths, recovered = EXCLUDED.recovered, "
        "active = EXCLUDED.active, critical = EXCLUDED.critical"
    )
    wide = jdbc.merge_statement(PG, WITH_DAY_COUNTERS)
    assert "cases, today_cases, deaths, today_deaths, recovered" in wide
    assert "today_cases = EXCLUDED" not in wide


def test_merge_is_one_transaction():
    connection = MagicMock()
    jdbc.run_merge(lambda: connection, "MERGE")
    work = connection.createStatement.return_value
    assert connection.mock_calls == [
        call.setAutoCommit(False),
        call.createStatement(),
        call.createStatement().execute("MERGE"),
        call.commit(),
        call.createStatement().close(),
        call.close(),
    ]
    work.execute.side_effect = RuntimeError("refused")
    connection.reset_mock()
    with pytest.raises(RuntimeError, match="refused"):
        jdbc.run_merge(lambda: connection, "MERGE")
    connection.commit.assert_not_called()
    connection.rollback.assert_called_once()
    connection.close.assert_called_once()


def test_upsert_fills_staging_then_merges(spark):
    steps = []
    rows = case_rows(spark, [{"country": "A", "updated": 1}])

    def fill(df, target):
        steps.append(("fill", df.columns, target.staging_table))

    def merge(connect, statement):
        steps.append(("merge", statement.split(" ON ")[1]))

    with patch.object(jdbc, "fill_staging", fill), patch.object(jdbc, "run_merge", merge):
        jdbc.upsert(rows, PG)
    assert steps[0] == ("fill", list(jdbc.POSTGRES.insert), "epidemic_cases_staging")
    assert steps[1][1].startswith("CONFLICT (country, updated)")

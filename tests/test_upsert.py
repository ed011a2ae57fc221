from __future__ import annotations

import duckdb
import pytest
from conftest import case_rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from epitally.operators import upsert as up
from epitally.plans import history
from epitally.plans.history import DAY, merge_into_history, read_history
from epitally.schema import CASES, COLUMNS
from epitally.sinks.jdbc import JdbcTarget, merge_statement

VALUES = tuple(c for c in COLUMNS if c not in up.MYSQL.keys)


def table_of(df) -> dict:
    rows = [r.asDict() for r in df.collect()]
    found = {(r["country"], r["updated"]): r for r in rows}
    assert len(found) == len(rows)
    return found


def expected(target: list[dict], staging: list[dict], rule: up.MergeRule) -> dict:
    """The merge rule on Python dicts."""
    blank = dict.fromkeys(COLUMNS)
    out = {(r["country"], r["updated"]): {**blank, **r} for r in target}
    for row in staging:
        key, full = (row["country"], row["updated"]), {**blank, **row}
        if key in out:
            out[key] = {**out[key], **{c: full[c] for c in rule.update}}
        else:
            out[key] = {**blank, **{c: full[c] for c in rule.insert}}
    return out


def test_rules():
    assert len(up.MYSQL.insert) == 11 and len(up.MYSQL.update) == 9
    assert len(up.POSTGRES.insert) == 11 and len(up.POSTGRES.update) == 5
    assert len(up.WITH_DAY_COUNTERS.insert) == 13 and len(up.WITH_DAY_COUNTERS.update) == 5
    assert set(up.ALL_COLUMNS.update) == set(VALUES)
    with pytest.raises(ValueError, match="Key columns cannot be updated"):
        up.MergeRule(insert=("country", "updated"), update=("country",))
    with pytest.raises(ValueError, match="Columns not inserted: cases"):
        up.MergeRule(insert=("country", "updated"), update=("cases",))


OLD = {"country": "A", "updated": 1, "iso2": "O", "continent": "Old", "cases": 1, "tests": 9}
NEW = {"country": "A", "updated": 1, "iso2": "N", "continent": None, "cases": None, "tests": 7}


@pytest.mark.parametrize(
    ("rule", "iso2", "continent", "tests"),
    [
        (up.MYSQL, "N", None, 9),
        (up.POSTGRES, "O", "Old", 9),
        (up.ALL_COLUMNS, "N", None, 7),
    ],
)
def test_staged_null_wins_only_in_update_columns(spark, rule, iso2, continent, tests):
    found = table_of(up.merge(case_rows(spark, [OLD]), case_rows(spark, [NEW]), rule))
    row = found[("A", 1)]
    assert (row["cases"], row["iso2"], row["continent"], row["tests"]) == (
        None,
        iso2,
        continent,
        tests,
    )


def test_insert_leaves_other_columns_null(spark):
    found = table_of(up.merge(case_rows(spark, []), case_rows(spark, [NEW]), up.MYSQL))
    assert found[("A", 1)]["tests"] is None and found[("A", 1)]["iso2"] == "N"


row_values = st.fixed_dictionaries(
    {
        "iso2": st.sampled_from(["X", None]),
        "cases": st.one_of(st.none(), st.integers(0, 9)),
        "active": st.one_of(st.none(), st.integers(0, 9)),
        "tests": st.one_of(st.none(), st.integers(0, 9)),
    }
)
tables = st.dictionaries(
    st.tuples(st.sampled_from("ABC"), st.integers(0, 3)), row_values, max_size=8
)


def rows_of(table: dict) -> list[dict]:
    return [{"country": c, "updated": u, **v} for (c, u), v in table.items()]


@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(tables, tables, st.sampled_from([up.MYSQL, up.POSTGRES, up.ALL_COLUMNS]))
def test_merge_equals_a_dictionary(spark, target, staging, rule):
    old, new = rows_of(target), rows_of(staging)
    merged = up.merge(case_rows(spark, old), case_rows(spark, new), rule)
    assert merged.schema.fieldNames() == list(COLUMNS)
    assert table_of(merged) == expected(old, new, rule)
    again = up.merge(merged, case_rows(spark, new), rule)
    assert table_of(again) == table_of(merged)
    broadcast = up.merge_batch(
        case_rows(spark, old), case_rows(spark, new), rule, strategy="broadcast"
    )
    assert broadcast.schema.fieldNames() == list(COLUMNS)
    assert table_of(broadcast) == table_of(merged)


def test_repeated_or_null_keys_fail(spark):
    target = case_rows(spark, [OLD])
    with pytest.raises(Exception, match="Staged key occurs more than once"):
        up.merge(target, case_rows(spark, [NEW, NEW])).collect()
    with pytest.raises(Exception, match="Staged key occurs more than once"):
        up.merge_batch(target, case_rows(spark, [NEW, NEW]), strategy="broadcast").collect()
    for bad in ({**NEW, "country": None}, {**NEW, "updated": None}):
        with pytest.raises(Exception, match="Staged row with a null key"):
            up.merge(target, case_rows(spark, [bad])).collect()
        with pytest.raises(Exception, match="Staged row with a null key"):
            up.merge(
                target, case_rows(spark, [bad]), on_duplicate="latest", order_by=["cases"]
            ).collect()


def test_the_check_is_kept_when_only_keys_are_read(spark):
    merged = up.merge(case_rows(spark, [OLD]), case_rows(spark, [NEW, NEW]))
    with pytest.raises(Exception, match="Staged key occurs more than once"):
        merged.select("country").collect()


def test_latest_keeps_the_greatest_whatever_the_partitioning(spark):
    copies = [{**NEW, "cases": c, "population": p} for c, p in ((3, 1), (9, 5), (9, 4), (1, 9))]
    staging = case_rows(spark, copies)
    for parts in (1, 4):
        merged = up.merge(
            case_rows(spark, [OLD]),
            staging.repartition(parts),
            on_duplicate="latest",
            order_by=["cases"],
        )
        row = table_of(merged)[("A", 1)]
        assert (row["cases"], row["population"]) == (9, 5)


def test_duplicate_options(spark):
    rows = case_rows(spark, [OLD])
    with pytest.raises(ValueError, match="Unsupported on_duplicate=first"):
        up.merge(rows, rows, on_duplicate="first")
    with pytest.raises(ValueError, match="needs order_by"):
        up.merge(rows, rows, on_duplicate="latest")
    with pytest.raises(ValueError, match="Target lacks merge columns: iso2"):
        up.merge(rows.drop("iso2"), rows)


def test_the_check_adds_no_shuffle(spark, base):
    from epitally.sources.tables import order_history, shipment_batch
    from epitally.workspace import written

    target = written(order_history(spark, base), "t")
    staging = written(shipment_batch(spark, base), "s")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = up.merge(target, staging)
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("+- Sort [") + plan.count(":- Sort [") == 2


def test_broadcast_merge_leaves_the_target_in_place(spark, base):
    from epitally.sources.tables import order_history, shipment_batch
    from epitally.workspace import written

    target = written(order_history(spark, base), "t")
    staging = written(shipment_batch(spark, base), "s")
    merged = up.merge_batch(target, staging, strategy="broadcast")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    # Every shuffle is of staged rows, for the check of their keys.
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "tests" not in line
    assert table_of(merged) == table_of(up.merge(target, staging))
    joined = up.merge_batch(target, staging)
    assert "FullOuter" in joined._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="larger than the 1000 bytes"):
        up.merge_batch(target, staging, strategy="broadcast", max_bytes=1000)
    with pytest.raises(ValueError, match="Unsupported strategy=guess"):
        up.merge_batch(target, staging, strategy="guess")


def test_null_keys_fail_before_the_shuffle(spark, base):
    from epitally.sources.tables import shipment_feed

    for how, order in (("error", []), ("latest", ["sequence"])):
        rows = up.one_per_key(shipment_feed(spark, base), up.MYSQL, how, order)
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("null key") > plan.index("Window")
        assert how == "error" or "WindowGroupLimit" in plan


def test_day_counters_are_renamed(spark):
    landed = spark.createDataFrame([(1, 2)], "todayCases bigint, todayDeaths bigint")
    assert up.rename_day_counters(landed).columns == ["today_cases", "today_deaths"]


def test_batch_size_check(spark):
    rows = case_rows(spark, [{"country": "x" * 1000, "updated": i} for i in range(10)])
    assert up.fits_broadcast(rows)
    assert up.fits_broadcast(rows, max_bytes=11_760)
    assert not up.fits_broadcast(rows, max_bytes=11_759)
    assert up.fits_broadcast(case_rows(spark, []), max_bytes=0)


def test_statement_agrees_with_the_merge(spark):
    """The staged statement, run by DuckDB, and the Spark merge give the same table."""
    target = JdbcTarget("jdbc:postgresql://host/db", "org.postgresql.Driver")
    old = [OLD, {"country": "B", "updated": 2, "cases": 4, "active": 5}]
    new = [NEW, {"country": "C", "updated": 3, "cases": 6, "tests": 1}]
    db = duckdb.connect()
    kinds = {"string": "VARCHAR", "bigint": "BIGINT"}
    columns = ", ".join(f'"{f.name}" {kinds[f.dataType.simpleString()]}' for f in CASES)
    for name, rows in (("epidemic_cases", old), ("epidemic_cases_staging", new)):
        db.execute(f"CREATE TABLE {name} ({columns}, PRIMARY KEY (country, updated))")
        for r in rows:
            marks = ", ".join("?" * len(COLUMNS))
            db.execute(f"INSERT INTO {name} VALUES ({marks})", [r.get(c) for c in COLUMNS])
    for rule in (up.POSTGRES, up.MYSQL):
        db.execute("BEGIN")
        db.execute(merge_statement(target, rule))
        result = db.execute("SELECT * FROM epidemic_cases").fetchall()
        db.execute("ROLLBACK")
        theirs = {(r[1], r[0]): dict(zip(COLUMNS, r)) for r in result}
        assert table_of(up.merge(case_rows(spark, old), case_rows(spark, new), rule)) == theirs


DAY_MS = 86_400_000


def day_rows(spec) -> list[dict]:
    return [{"country": c, "updated": d * DAY_MS + 5, "cases": n} for c, d, n in spec]


def day_files(spark, path: str, day: str) -> set[str]:
    return {f for f in read_history(spark, path).inputFiles() if f"{DAY}={day}" in f}


def test_history_keeps_untouched_days(spark, shared):
    first = day_rows([("A", 0, 1), ("B", 0, 2), ("A", 1, 3), ("A", 2, 4)])
    merge_into_history(case_rows(spark, first), shared)
    untouched = day_files(spark, shared, "1970-01-02")
    second = day_rows([("A", 0, 9), ("C", 2, 7), ("D", 5, 8)])
    merged = merge_into_history(case_rows(spark, second), shared)
    found = table_of(merged.drop(DAY))
    assert found == expected(first, second, up.MYSQL)
    assert untouched and day_files(spark, shared, "1970-01-02") == untouched
    repeated = merge_into_history(case_rows(spark, second), shared)
    assert table_of(repeated.drop(DAY)) == found


@pytest.mark.parametrize("step", ["_write_days", "publish", "_clean"])
@pytest.mark.parametrize("after", [False, True])
def test_a_broken_merge_can_be_repeated(spark, shared, monkeypatch, step, after):
    first = day_rows([("A", 0, 1), ("B", 0, 2), ("A", 1, 3)])
    second = day_rows([("A", 0, 9), ("C", 1, 7), ("D", 5, 8)])
    merge_into_history(case_rows(spark, first), shared)
    real = getattr(history, step)

    def broken(*given):
        if after:
            real(*given)
        raise OSError("stopped here")

    with monkeypatch.context() as patch:
        patch.setattr(history, step, broken)
        with pytest.raises(OSError, match="stopped here"):
            merge_into_history(case_rows(spark, second), shared)
    seen = table_of(read_history(spark, shared).drop(DAY))
    assert seen in (expected(first, [], up.MYSQL), expected(first, second, up.MYSQL))
    merged = merge_into_history(case_rows(spark, second), shared)
    assert table_of(merged.drop(DAY)) == expected(first, second, up.MYSQL)


def test_a_reader_that_has_begun_can_finish(spark, shared):
    first = day_rows([("A", 0, 1), ("B", 0, 2)])
    begun = merge_into_history(case_rows(spark, first), shared)
    merge_into_history(case_rows(spark, day_rows([("A", 0, 9)])), shared)
    assert table_of(begun.drop(DAY)) == expected(first, [], up.MYSQL)
    for n in range(3):
        merge_into_history(case_rows(spark, day_rows([("A", 0, n)])), shared)
    versions = {f.split("/data/v=")[1].split("/")[0] for f in spark.read.option(
        "recursiveFileLookup", "true").parquet(f"{shared}/data").inputFiles()}
    assert len(versions) == 2


def test_a_second_writer_is_refused(spark, shared):
    merge_into_history(case_rows(spark, day_rows([("A", 0, 1)])), shared)
    with pytest.raises(RuntimeError, match="Another writer"):
        history.publish(spark, shared, 1, {})
    assert read_history(spark, shared).count() == 1


def test_history_reads_only_wanted_days(spark, shared):
    merge_into_history(case_rows(spark, day_rows([("A", d, d) for d in range(4)])), shared)
    wanted = read_history(spark, shared).where(f"{DAY} = DATE '1970-01-03'")
    assert [r["cases"] for r in wanted.collect()] == [2]
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({DAY}" in plan
    assert len(read_history(spark, shared, days=["1970-01-02"]).inputFiles()) == 1


def test_merge_leaves_no_scratch_tables(spark, shared, monkeypatch):
    seen = []
    real = history.written
    monkeypatch.setattr(history, "written", lambda *a: seen.append(real(*a)) or seen[-1])
    merge_into_history(case_rows(spark, day_rows([("A", 0, 1)])), shared)
    with pytest.raises(Exception, match="null key"):
        merge_into_history(case_rows(spark, [{"country": "A"}]), shared)
    assert len(seen) == 2
    for table in seen:
        with pytest.raises(Exception, match="(?i)does not exist|not found"):
            table.collect()


def test_empty_batch_changes_nothing(spark, shared):
    nothing = case_rows(spark, [])
    assert merge_into_history(nothing, shared).collect() == []
    first = day_rows([("A", 0, 1)])
    merge_into_history(case_rows(spark, first), shared)
    merged = merge_into_history(nothing, shared)
    assert table_of(merged.drop(DAY)) == expected(first, [], up.MYSQL)


def test_missing_history_is_empty(spark, shared):
    assert read_history(spark, shared).collect() == []

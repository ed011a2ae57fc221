"""Merges whose number of tasks grows with the rows, whatever the session's number."""

from __future__ import annotations

import os
from datetime import datetime, timedelta

import pytest
from conftest import as_dicts, case_rows

from epitally import workspace
from epitally.operators import upsert as up
from epitally.plans import bucketed, catalog, history
from epitally.sources import tables as tb
from epitally.workspace import file_system, tasks_for


@pytest.fixture
def few_rows(monkeypatch):
    """Tasks of 300 rows: 25 for 6,000 line items and 1,500 orders."""
    monkeypatch.setattr(workspace, "ROWS_PER_TASK", 300, raising=False)


def test_tasks_grow_with_the_rows():
    assert [tasks_for(n) for n in (0, 4_000_000, 40_000_001)] == [8, 10, 101]


def test_tables_are_joined_in_as_many_tasks(spark, base, few_rows, capsys):
    tasks = tb.shipment_tasks(spark, base)
    assert tasks >= 25
    tb.shipment_batch(spark, base).explain()
    plan = capsys.readouterr().out
    assert plan.count(f", {tasks}), REPARTITION_BY_NUM") == 2


@pytest.mark.parametrize("query", ["upsert_mysql_rule", "upsert_latest"])
def test_merges_are_dealt(spark, base, few_rows, capsys, query):
    catalog.QUERIES[query](spark, base).explain()
    plan = capsys.readouterr().out
    tasks = tb.shipment_tasks(spark, base)
    assert plan.count(f", {tasks}), REPARTITION_BY_NUM") == (5 if query == "upsert_latest" else 4)


@pytest.mark.parametrize(
    "query",
    [
        "upsert_all_columns",
        "upsert_day_counters",
        "upsert_mysql_rule",
        "upsert_postgres_rule",
        "upsert_written_batch",
    ],
)
def test_no_count_is_left_to_the_session(spark, base, few_rows, capsys, query):
    catalog.QUERIES[query](spark, base).explain()
    plan = capsys.readouterr().out
    assert "REPARTITION_BY_NUM" in plan and "ENSURE_REQUIREMENTS" not in plan


def test_counts_in_parts_are_whole(spark, shared, few_rows):
    """A hot order and customer, lines that come twice, and nulls."""
    day = [datetime(2024, 1, 1), datetime(2024, 1, 31), datetime(2024, 2, 1)]
    orders = [(i, i % 2, "FOP"[i % 3], 1.0 * i, day[i % 3], "1-URGENT") for i in range(30)]
    orders += [(30, 1, None, None, day[0], None)]
    marks = [("R", "F"), ("A", "O"), ("N", None), (None, "F")]
    lines = [(0 if i % 3 else i % 40, i % 7 or None, *marks[i % 4], day[i % 3]) for i in range(3000)]
    lines += [(None, 1, "R", "F", day[0])] * 3
    lines = [(o, None, None, n, None, None, None, None, r, s, d) for o, n, r, s, d in lines]
    for name, rows in (("orders", orders), ("lineitem", lines)):
        spark.createDataFrame(rows, tb.TABLES[name]).write.parquet(f"{shared}/{name}.parquet")

    def counts(rows):
        by_key = {}
        for customer, when, *flags in rows:
            found = by_key.setdefault((f"C{customer}", when.month), [0] * 6)
            for i, flag in enumerate((True, *flags)):
                found[i] += bool(flag)
        return by_key

    def found(df):
        # ``active`` is null by the day number in a batch.
        return {
            (r["country"], (datetime(1970, 1, 1) + timedelta(milliseconds=r["updated"])).month): [
                r[c] for c in tb.COUNTS
            ]
            for r in as_dicts(df)
        }

    placed = counts(
        (o[1], o[4], o[2] == "F", o[2] == "O", o[2] == "P", o[5] == "1-URGENT", o[3] is not None)
        for o in orders
    )
    assert found(tb.order_history(spark, shared)) == placed
    owner = {o[0]: o[1] for o in orders}
    shipped = counts(
        (owner[x[0]], x[10], x[8] == "R", x[8] == "A", x[8] == "N", x[9] == "F", x[3] is not None)
        for x in lines
        if x[0] in owner
    )
    batch = found(tb.shipment_batch(spark, shared))
    assert batch.keys() == shipped.keys()
    for key, row in batch.items():
        assert row[3] in (None, shipped[key][3])
        assert row[:3] + row[4:] == shipped[key][:3] + shipped[key][4:]


def test_buckets_are_dealt(spark, base, few_rows, monkeypatch):
    found, write = [], bucketed.write_bucketed
    monkeypatch.setattr(
        bucketed, "write_bucketed", lambda rows, path, n: found.append(n) or write(rows, path, n)
    )
    catalog.bucketed_merge(spark, base)
    assert found == [tb.shipment_tasks(spark, base)] and found[0] > 8


def test_history_is_dealt(spark, base, few_rows, monkeypatch):
    found, merge = [], history.merge
    monkeypatch.setattr(history, "merge", lambda *a: found.append(a[5]) or merge(*a))
    catalog.history_merge(spark, base)
    assert len(found) == 2 and found[1] > 8


def test_a_landed_feed_is_compressed(spark, base, shared, monkeypatch):
    monkeypatch.setattr(catalog, "new_path", lambda *_: shared)
    catalog.upsert_landed_day_counters(spark, base)
    files, folder = file_system(spark, shared)
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    parts = [n for n in names if n.startswith("part-")]
    assert parts and all(os.path.splitext(n)[1] == ".gz" for n in parts)


@pytest.mark.parametrize("how", up.ON_DUPLICATE)
def test_a_dealt_merge_gives_the_same_rows(spark, how):
    old = [{"country": f"C{i}", "updated": i % 3, "cases": i} for i in range(20)]
    # One key with very many copies, equal in what orders them.
    copies = range(200) if how == "latest" else range(1)
    new = [{"country": "C1", "updated": 1, "cases": i, "deaths": i // 50} for i in copies]
    new += [{"country": f"C{i}", "updated": 7, "cases": -i} for i in range(30)]
    target, staging = case_rows(spark, old), case_rows(spark, new)
    found = [
        as_dicts(
            up.merge(target, staging, up.MYSQL, how, ["deaths"], partitions=n).orderBy("country", "updated")
        )
        for n in (None, 5)
    ]
    assert found[0] == found[1] and len(found[0]) == 50
    assert [r["cases"] for r in found[0] if r["country"] == "C1"][0] == (199 if how == "latest" else 0)


def test_dealt_keys_are_still_checked(spark):
    target = case_rows(spark, [])
    for rows in ([{"country": "C", "updated": 1}] * 2, [{"updated": 1}]):
        with pytest.raises(Exception, match="Staged"):
            up.merge(target, case_rows(spark, rows), partitions=3).collect()

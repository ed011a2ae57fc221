from __future__ import annotations

import json

import pytest
from conftest import as_dicts
from pyspark.sql import functions as F

from epitally.operators.quality import fraction_counts
from epitally.schema import CASES, COLUMNS, NARROW
from epitally.sources import landing


def element(country: str, **changes) -> dict:
    row = {
        "updated": 1700000000123,
        "country": country,
        "countryInfo": {"iso2": "AA", "iso3": "AAA", "flag": "x"},
        "continent": "Europe",
        "population": 1000,
        "cases": 10,
        "todayCases": 3,
        "deaths": 2,
        "todayDeaths": 1,
        "recovered": 5,
        "active": 3,
        "critical": 1,
        "tests": 100,
        "casesPerOneMillion": 10000,
        "deathsPerOneMillion": 2000,
    }
    return {**row, **changes}


@pytest.fixture
def documents(tmp_path):
    """Three pretty-printed documents of two, one and no elements."""
    for name, countries in (("a", ["A", "B"]), ("b", ["C"]), ("c", [])):
        body = json.dumps([element(c) for c in countries], indent=2)
        (tmp_path / f"{name}.json").write_text(body)
    return str(tmp_path)


def test_documents_give_one_row_per_element(spark, documents):
    rows = landing.read_cases(spark, documents)
    assert rows.schema == CASES
    assert sorted(r["country"] for r in rows.collect()) == ["A", "B", "C"]
    assert {r["updated"] for r in rows.collect()} == {1700000000123}
    assert rows.select("iso2", "iso3").distinct().collect() == [("AA", "AAA")]


def test_lines_hold_arrays_or_objects(spark, tmp_path):
    lines = [json.dumps([element("A"), element("B")]), json.dumps(element("C"))]
    (tmp_path / "feed.json").write_text("\n".join(lines))
    rows = landing.read_cases(spark, str(tmp_path), layout="lines")
    assert sorted(r["country"] for r in rows.collect()) == ["A", "B", "C"]


def test_fraction_is_cut_and_its_neighbours_survive(spark, tmp_path):
    body = [element("A", cases=1.5), element("B", cases=None), element("C", cases=7)]
    (tmp_path / "d.json").write_text(json.dumps(body))
    raw = landing.scan_json(spark, str(tmp_path))
    cases = {r["country"]: r["cases"] for r in landing.flatten(raw).collect()}
    assert cases == {"A": 1, "B": None, "C": 7}
    assert as_dicts(fraction_counts(raw, ["cases", "deaths"])) == [
        {"cases_fractions": 1, "deaths_fractions": 0}
    ]


def test_absent_key_is_null_when_declared_and_an_error_when_inferred(spark, tmp_path):
    body = element("A")
    del body["tests"]
    (tmp_path / "d.json").write_text(json.dumps([body]))
    assert landing.read_cases(spark, str(tmp_path)).first()["tests"] is None
    with pytest.raises(ValueError, match="lacks contract fields: tests"):
        landing.read_cases(spark, str(tmp_path), schema="infer")


def test_inferred_equals_declared(spark, documents):
    inferred = landing.read_cases(spark, documents, schema="infer")
    assert inferred.schema == CASES
    declared = landing.read_cases(spark, documents)
    assert sorted(inferred.collect()) == sorted(declared.collect())


def test_day_counters_on_request(spark, documents):
    raw = landing.scan_json(spark, documents)
    assert "todayCases" not in landing.flatten(raw).columns
    row = landing.flatten(raw, day_counters=True).first()
    assert (row["todayCases"], row["todayDeaths"]) == (3, 1)


def test_malformed_document_fails_or_is_dropped(spark, documents, tmp_path):
    (tmp_path / "z.json").write_text('[{"country": "Z", ')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        landing.read_cases(spark, documents).collect()
    kept = landing.read_cases(spark, documents, mode="DROPMALFORMED").collect()
    assert {"A", "B", "C"} <= {r["country"] for r in kept}


def test_only_needed_fields_are_parsed(spark, documents):
    scan = landing.read_cases(spark, documents).select("country")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<country:string>" in plan


def test_unknown_options(spark, documents):
    with pytest.raises(ValueError, match="Unsupported layout=rows"):
        landing.scan_json(spark, documents, layout="rows")
    with pytest.raises(ValueError, match="Unsupported schema=guess"):
        landing.scan_json(spark, documents, schema="guess")


def test_parse_documents(spark):
    bodies = [
        json.dumps([element("A", tests=1.9), element("B", population=None)]),
        json.dumps([]),
        json.dumps([element("C")]),
    ]
    table = spark.createDataFrame([(b,) for b in bodies], "body string")
    rows = landing.parse_documents(table)
    assert rows.schema == NARROW
    found = {r["country"]: r for r in rows.collect()}
    assert sorted(found) == ["A", "B", "C"]
    assert found["A"]["tests"] == 1
    assert found["B"]["population"] is None


def test_to_raw_is_the_inverse_of_flatten(spark, documents):
    rows = landing.read_cases(spark, documents)
    again = landing.flatten(landing.to_raw(rows))
    assert again.columns == list(COLUMNS)
    assert sorted(again.collect()) == sorted(rows.collect())


def test_a_document_is_a_task_each(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"{i}.json").write_text(json.dumps([element(f"C{i}")]))
    rows = landing.read_cases(spark, str(tmp_path))
    assert rows.count() == 40
    assert rows.select(F.input_file_name()).distinct().count() == 40


def test_counters_are_exact(spark, tmp_path):
    values = [2**53 + 1, 2**63 - 1, -(2**53) - 1, 0]
    body = [element(f"C{i}", cases=v) for i, v in enumerate(values)] + [element("F", cases=1.5)]
    (tmp_path / "d.json").write_text("\n".join(json.dumps(e) for e in body))
    rows = landing.read_cases(spark, str(tmp_path), layout="lines").orderBy("country")
    assert [r["cases"] for r in rows.collect()] == [*values, 1]
    table = spark.createDataFrame([(json.dumps(body),)], "body string")
    found = landing.parse_documents(table).orderBy("country").collect()
    assert [r["cases"] for r in found] == [*values, 1]


@pytest.mark.parametrize("layout", ["lines", "documents"])
def test_bad_documents_are_set_aside(spark, tmp_path, layout):
    good, bad = json.dumps([element("A"), element("B", cases=1.5)]), '[{"country": "Z", "cases": '
    if layout == "lines":
        (tmp_path / "d.json").write_text(f"{good}\n{bad}\n{json.dumps(element('C'))}")
    else:
        for i, text in enumerate((good, bad, json.dumps([element("C")]))):
            (tmp_path / f"{i}.json").write_text(text)
    rows, rejects = landing.read_with_rejects(spark, str(tmp_path), layout)
    assert rows.schema == CASES
    assert sorted(r["country"] for r in rows.collect()) == ["A", "B", "C"]
    assert [r["document"].strip() for r in rejects.collect()] == [bad.strip()]
    assert rejects.count() == 1

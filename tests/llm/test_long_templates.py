"""A license clause longer than the usual block is found wherever it stands."""

from __future__ import annotations

import pytest

from epitally.llm import license_scan


def test_built_in_templates_keep_the_usual_blocks():
    assert license_scan.stride_for(license_scan.TEMPLATES) == license_scan.STRIDE


@pytest.mark.parametrize("length", [34, 64, 100])
def test_long_clause_at_any_place(spark, length):
    clause = " ".join(f"clause{i}" for i in range(length))
    rows = [(at, "filler " * at + clause + " filler" * 50) for at in range(0, 150, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = license_scan.scan(docs, given=(("own", clause),), threshold=1.0).collect()
    assert [r.doc_id for r in found if r.labels != "own"] == []

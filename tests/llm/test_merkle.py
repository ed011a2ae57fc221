"""The Merkle manifest against a plain tree, on small and on awkward tables."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from epitally.llm import catalog, merkle
from epitally.llm.common import documents

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values) -> str:
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(leaves: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root, and each leaf's siblings before and after its node, level by level."""
    steps, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for i, place in enumerate(at):
            run = level[place // 3 * 3 : place // 3 * 3 + 3]
            steps[i].append(("".join(run[: place % 3]), "".join(run[place % 3 + 1 :])))
            at[i] = place // 3
        level = [h(*level[i : i + 3]) for i in range(0, len(level), 3)]
    return level[0], steps


def plain(rows):
    """Leaf, subroot, root and steps of every ``(doc_id, text, lang, source, n_chars)``."""
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append((r[0], leaf((r[0], r[3], r[2], r[4], r[1]))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made, roots = {}, []
    for s in names:
        made[s] = sorted(groups[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        roots.append(tree([d for _, d in made[s]]))
    root, top = tree([r for r, _ in roots])
    return sorted(
        (
            (k, d, roots[i][0], root, tuple(roots[i][1][j] + top[i]))
            for i, s in enumerate(names)
            for j, (k, d) in enumerate(made[s])
        ),
        key=repr,
    )


def ours(df):
    found = merkle.manifest(df).collect()
    return sorted(
        (
            (r.doc_id, r.leaf, r.subroot, r.root, tuple((s.before, s.after) for s in r.steps))
            for r in found
        ),
        key=repr,
    )


def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


# One leaf, a short last run, a run of one, a full piece, two bands of levels.
@pytest.mark.parametrize("n", [1, 10, 729, 2188])
def test_trees_of_all_shapes(spark, n):
    rows = [(i * 7 % n if n % 7 else i, f"text {i}", "en", "one", i) for i in range(n)]
    assert ours(docs(spark, rows).repartition(4)) == plain(rows)


def test_groups_of_many_sizes(spark):
    rng = random.Random(1)
    rows = []
    for g, n in enumerate([1, 1, 2, 3, 4, 7, 9, 28, 82, 300, 730]):
        rows += [(rng.randrange(10**9), "x" * rng.randrange(5), "en", f"s{g}", None) for _ in range(n)]
    rows += [(rng.randrange(10**9), None, None, None, 3) for _ in range(11)]
    rows += [(rng.randrange(10**9), "é🙂", "de", "Ä", 3) for _ in range(4)]
    rng.shuffle(rows)
    assert ours(docs(spark, rows)) == plain(rows)


def test_more_groups_than_a_piece(spark):
    rows = [(i, "t", "en", f"g{i % 900:04}", 1) for i in range(1000)]
    assert ours(docs(spark, rows)) == plain(rows)


def test_edges(spark):
    """Nulls in any column, empty and very long texts, repeated rows and keys."""
    rows = [
        (1, None, None, None, None),
        (None, "a", "en", "s", 1),
        (None, None, "en", "s", 1),
        (2, "", "en", "s", 0),
        (2, "", "en", "s", 0),
        (2, "other", "en", "s", 5),
        (-5, "x" * 300_000, "en", "", 300_000),
    ]
    assert ours(docs(spark, rows)) == plain(rows)
    assert ours(docs(spark, [])) == []
    extra = {c: F.lit("own") for c in ("k", "g", "digest", "gid", "pos", "n", "piece", "leaf", "steps", "d", "up", "rank")}
    assert ours(docs(spark, rows).withColumns(extra)) == plain(rows)


def test_null_and_empty_differ():
    assert leaf((None,)) != leaf(("",)) and leaf(("a", "b")) != leaf(("ab", ""))


def test_query_proves_and_refutes(spark):
    source = {r.doc_id: r for r in documents(spark, SMALL).collect()}
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in source.values()]
    want = {k: (d, sub, root, steps) for k, d, sub, root, steps in plain(rows)}
    refuted = 0
    for r in catalog.op12_merkle(spark, SMALL).collect():
        d, sub, root, steps = want[r.doc_id]
        assert (r.leaf, r.subroot, r.root) == (d, sub, root)
        assert r.proof_sha256 == h(*[a + b for a, b in steps])
        text = source[r.doc_id].text
        if zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and text is not None:
            text = text.replace("\n", "")
        o = source[r.doc_id]
        folded = leaf((o.doc_id, o.source, o.lang, o.n_chars, text))
        for a, b in steps:
            folded = h(a, folded, b)
        assert r.folded_root == folded and r.verified == (folded == root)
        assert r.verified == (text == o.text)
        refuted += not r.verified
    assert 10 < refuted < len(want)


def test_a_hot_group_is_cut_into_pieces(spark):
    """Windows go over pieces of 729 rows, not over a group, so that no task sorts a group."""
    rows = spark.range(5000).selectExpr(
        "id AS doc_id", "'t' AS text", "'en' AS lang", "'hot' AS source", "id AS n_chars"
    )
    found = merkle.manifest(rows)
    assert found.select("root").distinct().count() == 1 and found.count() == 5000
    nodes = rows.selectExpr("doc_id % 1 AS gid", "doc_id AS pos", "5000L AS n", "md5(text) AS digest")
    plan = merkle._band(nodes)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(gid") == 1 == plan.count("Exchange ")
    assert "hashpartitioning(gid#" in plan and "piece#" in plan.split("hashpartitioning(", 1)[1][:40]

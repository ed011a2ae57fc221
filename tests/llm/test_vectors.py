"""Nearest neighbours and whitening against plain numpy, on small and on awkward tables."""

from __future__ import annotations

import math

import numpy as np
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from epitally.llm import block_search, catalog, whiten
from epitally.llm.common import table

VECTORS = "vec_id long, embedding array<float>, label int"
DOUBLES = "vec_id long, embedding array<double>"
INF, NAN = float("inf"), float("nan")


def frame(spark, vectors, first=0):
    rows = [(first + i, None if v is None else [None if c is None else float(c) for c in v], 0)
            for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, VECTORS)


def nearest(df, step=20, **options):
    found = block_search.nearest_neighbours(df, F.col("vec_id") % step == 0, **options).collect()
    out = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def brute(ids, x, step=20, k=20):
    out = {}
    for q in np.flatnonzero(ids % step == 0):
        score = (x * x[q]).sum(1)
        others = [i for i in range(len(ids)) if i != q]
        order = sorted(others, key=lambda i: (-score[i], ids[i]))[:k]
        out[int(ids[q])] = [(n + 1, int(ids[i]), score[i]) for n, i in enumerate(order)]
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [r[:2] for r in got[q]] == [r[:2] for r in want[q]]
        assert np.allclose([r[2] for r in got[q]], [r[2] for r in want[q]], rtol=1e-12, atol=1e-12)


# Nearest neighbours


def test_the_query_finds_all_neighbours(spark):
    df = table(spark, SMALL, "embeddings")
    rows = df.collect()
    ids = np.array([r.vec_id for r in rows])
    same(nearest(df), brute(ids, np.array([r.embedding for r in rows], np.float64)))


@pytest.mark.parametrize("block, lane", [(7, 16), (1, 1 << 12), (1 << 17, 8)])
def test_blocks_and_lanes_change_nothing(spark, monkeypatch, block, lane):
    monkeypatch.setattr(block_search, "LANE", lane)
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(300, 5)), 1).astype(np.float32)
    df = frame(spark, x).repartition(3)
    same(nearest(df, 10, nearest=6, block=block), brute(np.arange(300), x.astype(float), 10, 6))


def test_quantisation_bounds_hold():
    rng = np.random.default_rng(5)
    u, v = rng.normal(size=(200, 9)) * rng.uniform(1e-3, 1e3, (200, 1)), rng.normal(size=(150, 9))
    cu, su, au, ru = block_search.quantise(u)
    cv, sv, av, rv = block_search.quantise(v)
    near = cu.astype(float) @ cv.astype(float).T * su[:, None] * sv
    error = au[:, None] * rv + ru[:, None] * (av + rv)
    assert (np.abs(u @ v.T - near) <= error * (1 + 1e-9) + 1e-12).all()
    # And they are of use: a hundredth of the lengths or so.
    assert np.median(error / (au[:, None] * av)) < 0.02


def test_ties_copies_and_hot_groups(spark):
    """A third of all rows are one vector; ties go to the smaller key, beyond twenty of them."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(240, 4)).astype(np.float32)
    x[::3] = x[0]
    df = frame(spark, x)
    same(nearest(df), brute(np.arange(240), x.astype(float)))
    plus_minus = frame(spark, [[1.0], [-1.0]] * 30)
    same(nearest(plus_minus), brute(np.arange(60), np.array([[1.0], [-1.0]] * 30)))


def test_vectors_that_take_no_part(spark):
    bad = [None, [], [0.0, 0.0], [1.0, None], [NAN, 1.0], [INF, 1.0], [-INF, 0.0]]
    good = [[1.0, 0.0], [0.5, 0.5], [-1.0, 0.1]]
    df = frame(spark, bad, 100).union(frame(spark, good))
    assert nearest(df, 1).keys() == {0, 1, 2}
    assert [i for _, i, _ in nearest(df, 1)[0]] == [1, 2]
    for some in ([], [None], [[1.0, 2.0]]):
        assert nearest(frame(spark, some), 1) == {}


def test_null_and_repeated_keys_and_other_columns(spark):
    rows = [(0, [1.0]), (0, [2.0]), (None, [3.0]), (20, [4.0]), (7, [3.0])]
    df = spark.createDataFrame(rows, DOUBLES)
    extra = {c: F.lit("own") for c in ("id", "no", "strip", "role", "code", "score", "rank", "query_id")}
    found = block_search.nearest_neighbours(df.withColumns(extra), F.col("vec_id") % 20 == 0).collect()
    # Either row of key 0 is asked for, and each is the other's neighbour; null keys come last.
    assert len(found) == 12
    assert [r.vec_id for r in sorted((r for r in found if r.query_id == 20), key=lambda r: r.rank)] == [7, None, 0, 0]
    assert sorted(r.score for r in found if r.query_id == 0) == [2, 2, 3, 3, 4, 6, 6, 8]


def test_large_small_and_unlike_vectors(spark):
    rows = [(i, [v, -v / 3]) for i, v in enumerate([1e300, 1e-300, 5e-324, 1.0, 3.5e155, -2e-9])]
    rows += [(i, [1.0, 2.0, 3.0]) for i in range(6, 9)]
    got = nearest(spark.createDataFrame(rows, DOUBLES), 1)
    assert all(len(got[i]) == 5 for i in range(6)) and all(len(got[i]) == 2 for i in range(6, 9))
    x = np.array([v for _, v in rows[:6]])
    with np.errstate(all="ignore"):
        want = brute(np.arange(6), x, 1)
    for q in range(6):
        assert [r[2] for r in got[q]] == [r[2] for r in want[q]]


# Whitening


def expected(x):
    scaled = np.floor(1024 * x.astype(np.float64)).astype(np.int64) + 100_000
    n, s = len(x), scaled.sum(0)
    away = n * scaled - s
    c = away / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    return n, (away * away).sum(1), c, values[::-1], vectors[:, ::-1]


def collected(df):
    rows = whiten.whiten(df).collect()
    keys = sorted({r.vec_id for r in rows})
    k = max((r.component for r in rows), default=0)
    white = np.zeros((len(keys), k))
    for r in rows:
        white[keys.index(r.vec_id), r.component - 1] = r.whitened
    return rows, keys, white


def check(rows, keys, white, x):
    n, deviation, c, values, vectors = expected(x)
    k = min(8, x.shape[1], int((values > 1e-9 * values[0]).sum()))
    assert white.shape == (n, k) and len(rows) == n * k
    want = c @ vectors[:, :k] / np.sqrt(values[:k])
    assert np.allclose(np.abs(white), np.abs(want), atol=1e-9)
    assert np.allclose(white.T @ white / n, np.eye(k), atol=1e-10)
    assert {r.vec_id: r.deviation for r in rows} == dict(zip(keys, deviation.tolist()))
    share = {r.component: r.explained for r in rows}
    assert np.allclose([share[i + 1] for i in range(k)], values[:k] / values.sum(), rtol=1e-10)
    assert {r.n for r in rows} == {n} and len({r.identity_error for r in rows}) == 1
    assert abs(rows[0].identity_error - np.abs(white.T @ white / n - np.eye(k)).max()) < 1e-10


def test_whitening_of_the_table(spark):
    df = table(spark, SMALL, "embeddings")
    rows = df.orderBy("vec_id").collect()
    check(*collected(df), np.array([r.embedding for r in rows], np.float32))
    assert catalog.op13_whitening(spark, SMALL).count() == 8 * len(rows)


@pytest.mark.parametrize("shape, scale", [((40, 3), 1.0), ((30, 12), 0.01), ((9, 20), 50.0), ((2, 4), 1.0), ((50, 1), 3.0)])
def test_whitening_of_small_tables(spark, shape, scale):
    rng = np.random.default_rng(shape[0])
    x = (rng.normal(size=shape) * scale).astype(np.float32)
    check(*collected(frame(spark, x).repartition(3)), x)


def test_the_polynomial_is_exact(spark):
    rng = np.random.default_rng(1)
    b = rng.integers(-50, 50, (6, 6)).astype(object)
    a = (b @ b.T).tolist()
    p = whiten.characteristic_polynomial(spark, a)
    # Horner's rule with whole matrices: every matrix solves its own equation.
    m, total = np.array(a, object), np.zeros((6, 6), object)
    for c in reversed(p):
        total = total @ m + np.eye(6, dtype=int).astype(object) * c
    assert not total.any() and p[-1] == 1 and p[-2] == -sum(a[i][i] for i in range(6))


def test_roots_are_counted_and_isolated():
    p = [1]
    for root in (3, 3, 7, 10, 0, 0):
        p = [(p[i - 1] if i else 0) - root * (p[i] if i < len(p) else 0) for i in range(len(p) + 1)]
    nonzero = p[2:]
    assert [whiten.roots_above(nonzero, m, 0) for m in (0, 2, 3, 6, 7, 9, 10)] == [4, 4, 2, 2, 1, 1, 0]
    found = whiten.greatest_roots(p, 8)
    assert [(round(m / (1 << bits), 12), n) for m, bits, n in found] == [(10, 1), (7, 1), (3, 2)]
    assert [n for *_, n in whiten.greatest_roots(p, 1)] == [1]
    assert whiten.greatest_roots([0, 0, 1], 8) == []
    # Two roots 2^-40 apart are told apart.
    s = 1 << 40
    near = [s * (s + 1), -(2 * s + 1), 1]
    found = whiten.greatest_roots(near, 2)
    assert [n for *_, n in found] == [1, 1] and found[0][0] * (1 << found[1][1]) > found[1][0] * (1 << found[0][1])


def test_equal_eigenvalues_get_an_orthonormal_basis(spark):
    x = np.array([[1, 1], [1, -1], [-1, 1], [-1, -1]], np.float32)
    rows, _, white = collected(frame(spark, x))
    assert np.allclose(white.T @ white / 4, np.eye(2), atol=1e-12) and len(rows) == 8
    assert {round(r.explained, 12) for r in rows} == {0.5}


def test_large_entries_are_summed_exactly():
    rng = np.random.default_rng(2)
    for reach in (1 << 20, 1 << 40, (1 << 62) - 1):
        y = rng.integers(-reach, reach, (5000 if reach < 1 << 60 else 700, 3))
        want = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for j in range(3)] for i in range(3)]
        assert whiten.gram(y).tolist() == want


def test_whitening_of_large_entries(spark):
    rows = [(i, [2.0**51 - i * i, float(i % 3)]) for i in range(12)]
    found = whiten.whiten(spark.createDataFrame(rows, DOUBLES)).collect()
    y = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows]
    s = [sum(c) for c in zip(*y)]
    want = {i: sum((12 * c - t) ** 2 for c, t in zip(v, s)) for i, v in enumerate(y)}
    assert {r.vec_id: r.deviation for r in found} == want
    huge = whiten.whiten(spark.createDataFrame([(0, [2.0**51]), (1, [-(2.0**51)])], DOUBLES)).collect()
    assert [r.deviation for r in huge] == [None, None] and {abs(round(r.whitened, 9)) for r in huge} == {1.0}


def test_vectors_left_out_of_whitening(spark):
    rng = np.random.default_rng(4)
    good = rng.normal(size=(20, 3)).astype(np.float32)
    bad = [None, [], [1.0, None, 2.0], [NAN, 1.0, 1.0], [INF, 0.0, 0.0], [1e30, 0.0, 0.0], [1.0, 2.0]]
    df = frame(spark, good).union(frame(spark, bad, 100))
    extra = {c: F.lit("own") for c in ("id", "vector", "slot", "whitened", "component", "n", "d", "place")}
    check(*collected(df.withColumns(extra)), good)


@pytest.mark.parametrize("vectors", [[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 5])
def test_tables_without_variance_give_no_rows(spark, vectors):
    df = whiten.whiten(frame(spark, vectors))
    assert df.collect() == [] and df.columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    ]


def test_repeated_rows_and_null_keys_count(spark):
    x = [[1.0, 0.0], [0.0, 2.0], [0.5, 0.25]]
    rows = [(1, x[0]), (1, x[0]), (None, x[1]), (2, x[2])]
    found = whiten.whiten(spark.createDataFrame(rows, DOUBLES)).collect()
    assert sorted((r.vec_id is None, r.vec_id) for r in found if r.component == 1) == [
        (False, 1), (False, 1), (False, 2), (True, None)
    ]
    assert found[0].n == 4 and found[0].identity_error < 1e-9

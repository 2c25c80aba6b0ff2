"""Whitening and near-duplicate embeddings: against whole-number arithmetic and all pairs."""

import math
from decimal import Decimal

import duckdb
import numpy as np
import pytest

import brute
from netpulse.llm import cover_tree, whitening
from netpulse.llm.catalog import QUERIES
from netpulse.llm.common import read

INF, NAN = float("inf"), float("nan")
WHITE = "vec_id long, embedding array<double>"
NEAR = "vec_id long, embedding array<double>, label int"


def whole(vector):
    return [math.floor(64 * float(c)) + 1_000_000 for c in vector]


def check_whitened(rows, vectors):
    """``rows`` of the operator against Python integers and an eigensolver of its own."""
    own = [(i, whole(v)) for i, v in vectors]
    fit = sorted({tuple(x) for _, x in own})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(d)]
    centred = [[n * x[k] - sums[k] for k in range(d)] for x in fit]
    spread = np.array([[sum(r[i] * r[j] for r in centred) / n**3 for j in range(d)] for i in range(d)])
    values, axes = np.linalg.eigh(spread)
    values, axes = values[::-1], axes[:, ::-1]
    k = max(r.component for r in rows)
    assert k == min(16, int((values > d * 2.3e-16 * values[0]).sum()))
    assert {r.n for r in rows} == {n} and all(0 <= r.identity_error <= 1e-4 for r in rows) and len({r.identity_error for r in rows}) == 1
    far = sorted((i, sum((n * x[j] - sums[j]) ** 2 for j in range(d))) for i, x in own)
    assert sorted((r.vec_id, int(r.deviation)) for r in rows if r.component == 1) == far
    for c in range(1, k + 1):
        found = sorted((r.vec_id, r.whitened) for r in rows if r.component == c)
        assert all(abs(r.explained - values[c - 1] / np.trace(spread)) <= 1e-6 * r.explained for r in rows if r.component == c)
        gaps = [abs(values[c - 1] - values[o]) for o in (c - 2, c) if 0 <= o < d]
        if min(gaps) > 1e-6 * values[0]:
            axis = axes[:, c - 1]
            expected = sorted((i, float(np.array([n * x[j] - sums[j] for j in range(d)]) / n @ axis) / math.sqrt(values[c - 1])) for i, x in own)
            sign = np.sign(sum(a[1] * b[1] for a, b in zip(found, expected)))
            assert [a[0] for a in found] == [b[0] for b in expected]
            assert np.allclose([a[1] for a in found], [sign * b[1] for b in expected], rtol=1e-6, atol=1e-6)


def test_whitening_of_the_table(spark, sf_dir):
    rows = QUERIES["op11_whitening"](spark, sf_dir).collect()
    vectors = duckdb.sql(f"SELECT vec_id, embedding FROM '{sf_dir}/embeddings.parquet'").fetchall()
    assert len(rows) == 16 * len(vectors)
    check_whitened(rows, vectors)


@pytest.mark.parametrize("scale", [1.0, 3e4, 1e9])
def test_whitening_counts_equal_vectors_once(spark, scale):
    """Columns of very different ranges (one takes several words of bits), equal rows, repeated and missing ids."""
    random = np.random.default_rng(5)
    vectors = [(i, (random.normal(size=4) * [scale, 1, 0.1, 50]).tolist()) for i in range(300)]
    vectors += [(i % 7, vectors[3][1]) for i in range(200)]
    odd = [(900, None), (901, [1.0, NAN, 1.0, 1.0]), (902, [1.0, None, 1.0, 1.0]), (903, [INF, 1.0, 1.0, 1.0]), (904, []), (905, [1.0, 2.0])]
    frame = spark.createDataFrame([(*r, 1, "x") for r in [*vectors, *odd]], WHITE + ", n int, component string").repartition(5)
    check_whitened(whitening.whiten(frame).collect(), vectors)
    missing = whitening.whiten(spark.createDataFrame([(None, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 3.0])], WHITE)).collect()
    assert sorted((str(r.vec_id), r.component) for r in missing) == [(i, c) for i in ("1", "2", "None") for c in (1, 2)]


def test_whitening_without_variance(spark):
    for rows in ([], [(1, None)], [(1, [2.0, 3.0])], [(1, [2.0, 3.0]), (2, [2.0, 3.0])], [(1, [])]):
        assert whitening.whiten(spark.createDataFrame(rows, WHITE)).collect() == []
    flat = whitening.whiten(spark.createDataFrame([(1, [2.0, 3.0]), (2, [2.0, 5.0])], WHITE)).collect()
    assert [(r.component, r.explained, abs(r.whitened)) for r in flat] == [(1, 1.0, 1.0)] * 2


def test_cross_products_are_exact():
    random = np.random.default_rng(3)
    x = np.stack([random.integers(0, 2**b, 5000, dtype=np.uint64) for b in (1, 7, 24, 25, 62)] + [np.full(5000, 9, np.uint64)], axis=1).astype(np.int64)
    layout = whitening.Layout(x.min(axis=0), x.max(axis=0))
    columns = len(layout.digits) + 1
    low, high = np.zeros((columns, columns), np.int64), np.zeros((columns, columns), np.int64)
    away = layout.distances(x)
    for at in range(0, len(x), whitening.BLOCK):
        whitening.add_cross_products(low, high, away[at : at + whitening.BLOCK], layout)
    exact = [[(int(v) >> s) & ((1 << b) - 1) for v in away[:, i]] for i, s, b in layout.digits] + [[1] * len(x)]
    for i in range(columns):
        for j in range(i, columns):
            assert (int(high[i, j]) << whitening.HALF) + int(low[i, j]) == sum(a * b for a, b in zip(exact[i], exact[j]))


def test_deviation_beyond_a_long(spark):
    vectors = [(i, [1e12 * i, float(i % 3)]) for i in range(50)]
    rows = whitening.whiten(spark.createDataFrame(vectors, WHITE)).collect()
    assert max(r.deviation for r in rows) > Decimal(2**63)
    check_whitened(rows, vectors)


def near(spark, rows, **given):
    found = cover_tree.near_vectors(spark.createDataFrame([(*r, 1, 2) for r in rows], NEAR + ", gid int, node int").repartition(3), **given)
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_near_vectors_of_the_table(spark, sf_dir):
    rows = duckdb.sql(f"SELECT vec_id, embedding, label FROM '{sf_dir}/embeddings.parquet'").fetchall()
    assert sorted((tuple(r) for r in QUERIES["op13_near_vectors"](spark, sf_dir).collect()), key=str) == brute.near_vectors(rows)


def clustered(random, n, dims, spread):
    centres = random.normal(size=(6, dims))
    return (centres[random.integers(0, 6, n)] + random.normal(size=(n, dims)) * random.choice(spread, n)[:, None]).tolist()


@pytest.mark.parametrize("node_rows", [40, 100_000])
def test_near_vectors_of_clusters(spark, node_rows):
    """Tight and loose clusters, equal vectors, multiples of one vector, two labels; split by Spark and in one task."""
    random = np.random.default_rng(7)
    vectors = clustered(random, 500, 5, [0.01, 0.1, 0.4])
    vectors += [vectors[0]] * 60 + [[x * (1 + k / 7) for x in vectors[1]] for k in range(150)]
    rows = [(i % 650, v, int(random.integers(0, 2))) for i, v in enumerate(vectors)]
    assert near(spark, rows, node_rows=node_rows) == brute.near_vectors(rows)


def test_near_vectors_of_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v, 1), (2, v, 1), (2, [2.0, 4.0, 6.1], 1), (3, v, None), (4, None, 1), (5, [1.0, NAN, 1.0], 1), (6, [1.0, None, 1.0], 1),
        (7, [0.0, 0.0, 0.0], 1), (8, [], 1), (9, [1.0, 2.0], 1), (10, [1e300, 2e300, 3e300], 1), (11, [1e-310, 2e-310, 3e-310], 1),
        (None, v, 2), (None, v, 2), (12, v, 2), (None, [-3.0, 0.0, 1.0], 2), (13, [INF, 1.0, 1.0], 1), (14, [-0.0, 1.0, 0.0], 3), (15, [0.0, 1.0, 0.0], 3),
    ]
    expected = [(i, n, c, i == c) for i, n, c, _ in brute.near_vectors(rows)]
    assert near(spark, rows) == sorted(expected, key=str)
    assert near(spark, [(None, v, 1)]) == [(None, 0, None, True)]
    assert cover_tree.near_vectors(spark.createDataFrame([], NEAR)).collect() == []


def test_bounds_prune_and_include():
    """In tight, far clusters hardly any rows are compared one by one."""
    random = np.random.default_rng(9)
    centres = np.eye(8)
    unit = cover_tree.directions(np.repeat(centres, 300, axis=0) + random.normal(size=(2400, 8)) * 0.005)[1]
    seen = []

    class Counting(cover_tree.Links):
        def some(self, a, b, linked):
            seen.append(linked.size)
            super().some(a, b, linked)

    links = Counting(np.ones(len(unit), np.int64))
    root = cover_tree.grow(unit, np.arange(len(unit)))
    cover_tree.traverse(unit, root, root, links, 0.93)
    assert (links.counts == 299).all() and len(set(links.label.tolist())) == 8
    assert sum(seen) < 0.02 * len(unit) ** 2

"""Exact top-k by sorted lists against plain products."""

import numpy as np
import pyarrow.parquet as pq
import pytest

import brute
from netpulse.llm import exact_topk


def scanned(vectors, ids, every, k, block, bounds=None):
    asked = np.flatnonzero(ids % every == 0)
    best = [exact_topk.Best(k, None) for _ in asked]
    read = exact_topk.cell_topk(vectors, ids, vectors[asked], ids[asked], best, block)
    return {int(ids[i]): list(zip(b.scores.tolist(), b.ids.tolist())) for i, b in zip(asked, best)}, read / (len(asked) * vectors.size)


@pytest.mark.parametrize("block", [7, 100, 512])
@pytest.mark.parametrize("kind", ["clustered", "ties", "opposed", "short"])
def test_cells_against_products(kind, block):
    rng = np.random.default_rng(4)
    vectors = {
        "clustered": rng.normal(0, 40, (30, 16))[rng.integers(0, 30, 900)] + rng.normal(0, 9, (900, 16)),
        "ties": rng.integers(-1, 2, (900, 4)),
        "opposed": -np.abs(rng.normal(0, 40, (900, 6))) * np.where(np.arange(900) % 20 == 0, -1, 1)[:, None],
        "short": rng.normal(0, 40, (4, 3)),
    }[kind].astype(np.int64)
    ids = rng.permutation(len(vectors)).astype(np.int64)
    found, _ = scanned(vectors, ids, 20, 5, block)
    assert found == brute.best_products(vectors, ids, 20, 5)


def test_large_numbers_are_exact():
    rng = np.random.default_rng(5)
    vectors = rng.integers(-40, 40, (300, 5))
    vectors[::3] *= 10**9
    vectors[::7] = vectors[::7] // 2 + 2**56
    vectors[11] = 2**63 - 1
    ids = np.arange(300)
    found, _ = scanned(vectors, ids, 10, 4, 64)
    assert found == brute.best_products(vectors, ids, 10, 4)


def test_entries_stay_unread(sf_dir):
    """The bounds end the reading early, the earlier the more rows a block is held against."""
    table = pq.read_table(f"{sf_dir.replace('sf0.001', 'sf0.1')}/embeddings.parquet")
    good = [(i, v) for i, v in zip(table["vec_id"].to_pylist(), table["embedding"].to_pylist()) if v is not None and None not in v and np.isfinite(v).all()]
    ids, vectors = np.array([i for i, _ in good]), np.floor(np.array([v for _, v in good], np.float64) * 256).astype(np.int64)
    found, share = scanned(vectors, ids, 50, 5, 128)
    assert found == brute.best_products(vectors, ids, 50, 5)
    assert len(ids) > 1000 and share < 0.9
    rng = np.random.default_rng(7)
    groups = np.repeat(rng.normal(0, 32, (60, 64)), 50, axis=0) + rng.normal(0, 8, (3000, 64))
    order = rng.permutation(3000)
    found, share = scanned(groups[order].astype(np.int64), order, 50, 5, 600)
    assert found == brute.best_products(groups[order].astype(np.int64), order, 50, 5) and share < 0.5


def test_whole_query(spark):
    """Many cells, repeated ids, ties, odd rows, empty and large vectors, clashing names."""
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(0, 1, 6).round(1).tolist(), 1, 2) for i in range(400)]
    rows += [(1000, [70000.0] * 6, 1, 2), (1001, [70000.0, 1.0, 1.0, 1.0, 1.0, 1.0], 1, 2), (1050, [], 1, 2), (1051, [], 1, 2)]
    odd = [(None, [1.0] * 6, 1, 2), (2000, None, 1, 2), (2050, [None] * 6, 1, 2), (2100, [float("inf")] * 6, 1, 2), (1000, [70001.0] * 6, 1, 2)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, d int, cell int")
    found = {}
    for r in exact_topk.top_k(frame, 5, 50).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(found[r.query_id])
    ids, vectors = np.array([r[0] for r in rows[:402]]), np.floor(np.array([r[1] for r in rows[:402]]) * 256).astype(np.int64)
    expected = {**brute.best_products(vectors, ids, 50, 5), 1050: [(0, 1051)]}
    assert found == expected

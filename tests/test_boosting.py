"""Second-order boosted trees: against plain loops over rows, and for any partitioning."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from netpulse.operators import boosting, targets
from netpulse.session import stage

FEATURES = ["a", "b", "c", "d", "e"]


@pytest.fixture(scope="module")
def rows(spark):
    """An interaction, a threshold, noise, a feature of few values and a constant one; some rows are equal."""
    rng = random.Random(4)
    out = []
    for i in range(900):
        x = [rng.gauss(0, 1), rng.uniform(-5, 5), rng.gauss(0, 1), float(rng.randrange(3)), 7.0]
        logit = 2 * x[0] * (x[1] > 0) - 1.5 * (x[3] == 1) - 0.5
        out.append((i, *x, int(rng.random() < 1 / (1 + math.exp(-logit)))))
    out += out[:60]
    return stage(spark.createDataFrame(out, "id long, a double, b double, c double, d double, e double, failure_next_30m int"))


def fit(rows, **given):
    given = {"positive_weight": 2.5, "depth": 3, "trees": 4, **given}
    return boosting.fit_boosted_trees(rows, FEATURES, targets.TARGET, **given)


def split_value(rows, bounds, gradients, hessians):
    """Best (gain, feature, threshold) by trying every threshold on every feature; None where nothing is allowed."""
    best = None
    total = sum(gradients) ** 2 / (sum(hessians) + 1)
    for f in range(len(FEATURES)):
        for t in bounds[f]:
            left = [i for i, r in enumerate(rows) if r[f] <= t]
            gl, hl = sum(gradients[i] for i in left), sum(hessians[i] for i in left)
            gr, hr = sum(gradients) - gl, sum(hessians) - hl
            if hl < 1 or hr < 1:
                continue
            gain = 0.5 * (gl**2 / (hl + 1) + gr**2 / (hr + 1) - total)
            if best is None or gain > best[0] + 1e-9:
                best = (gain, f, t)
    return best


def test_trees_equal_a_plain_version(spark, rows):
    """All rows and features: every split is the best of all, every leaf is -step * G / (H + 1)."""
    model = fit(rows, step=0.3, row_fraction=1.0, feature_fraction=1.0)
    held = [tuple(r) for r in rows.collect()]
    points, labels = [r[1:6] for r in held], [r[6] for r in held]
    bounds = [sorted({p[f] for p in points})[:-1] for f in range(5)]
    key_count = len({p[0] for p in points})
    if key_count > boosting.BINS:  # the edges are quantiles then: read them off the function under test
        keyed = rows.withColumn("key", F.xxhash64(*sorted(rows.columns)))
        bounds = [list(e) for e in boosting.edges_of(keyed, FEATURES, len(held))]
        assert all(len(b) < boosting.BINS for b in bounds) and list(bounds[3]) == [0.0, 1.0] and not len(bounds[4])
    margin = [0.0] * len(points)
    for tree in model.trees:
        p = [1 / (1 + math.exp(-m)) for m in margin]
        w = [2.5 if y else 1.0 for y in labels]
        g, h = [wi * (pi - y) for wi, pi, y in zip(w, p, labels)], [wi * pi * (1 - pi) for wi, pi in zip(w, p)]
        waiting = [(0, list(range(len(points))), 0)]
        while waiting:
            node, own, level = waiting.pop()
            best = split_value([points[i] for i in own], bounds, [g[i] for i in own], [h[i] for i in own]) if level < 3 else None
            assert tree.cover[node] == pytest.approx(sum(h[i] for i in own), rel=1e-6)
            if tree.feature[node] < 0:
                assert best is None or best[0] <= 1e-5
                leaf = -0.3 * sum(g[i] for i in own) / (sum(h[i] for i in own) + 1)
                assert tree.value[node] == pytest.approx(leaf, abs=1e-7)
                for i in own:
                    margin[i] += tree.value[node]
                continue
            assert tree.gain[node] == pytest.approx(best[0], rel=1e-5) and (tree.feature[node], tree.threshold[node]) == best[1:]
            for child, inside in ((tree.left[node], True), (tree.right[node], False)):
                waiting.append((int(child), [i for i in own if (points[i][best[1]] <= best[2]) == inside], level + 1))
    scored = {r["id"]: r["p"] for r in model.score(rows, "p").collect()}
    assert all(scored[r[0]] == pytest.approx(1 / (1 + math.exp(-m)), abs=1e-9) for r, m in zip(held, margin))


def test_same_trees_for_any_partitioning(rows, monkeypatch):
    first = fit(rows.repartition(1)).nodes()
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)
    for parts in (4, 7):
        assert first.equals(fit(rows.repartition(parts)).nodes())


def test_each_tree_sees_a_share_of_rows_and_features(rows, monkeypatch):
    monkeypatch.setattr(boosting, "CHECKPOINT_EVERY", 2)
    model = fit(rows, trees=5, row_fraction=0.8, feature_fraction=0.4)
    covers = [t.cover[0] for t in model.trees]
    whole = [t.cover[0] for t in fit(rows, trees=1, row_fraction=1.0).trees][0]
    assert 0.7 < covers[0] / whole < 0.9 and len(set(covers)) == 5
    assert all(len(set(t.feature[t.feature >= 0])) <= 2 for t in model.trees)
    assert sum(model.importances().values()) == pytest.approx(1) and model.importances()["e"] == 0


def test_drawn_rows_are_independent_between_trees():
    keys = np.random.default_rng(1).integers(0, 2**63, 20_000, dtype=np.uint64)
    a, b = boosting.drawn_rows(keys, 3, 0.8), boosting.drawn_rows(keys, 4, 0.8)
    assert abs(a.mean() - 0.8) < 0.02 and abs((a & b).mean() - 0.64) < 0.02


def test_saved_model_scores_the_same(spark, rows, tmp_path):
    model = fit(rows)
    model.save(spark, str(tmp_path / "m"))
    again = boosting.BoostedTrees.load(spark, str(tmp_path / "m"))
    points = np.array([r[1:6] for r in rows.limit(50).collect()])
    assert (again.log_odds(points) == model.log_odds(points)).all() and again.features == FEATURES


def test_one_class_and_no_rows(rows):
    single = fit(rows.where(f"{targets.TARGET} = 1"), trees=2)
    assert all(len(t.feature) == 1 or (t.feature >= -1).all() for t in single.trees)
    assert single.log_odds(np.zeros((1, 5)))[0] > 0
    empty = fit(rows.limit(0), trees=2)
    assert empty.log_odds(np.zeros((1, 5))).tolist() == [0.0]


def test_the_driver_gets_no_histograms(rows, monkeypatch):
    """Of every level it gets six numbers per (node, feature), however many tasks add up the bins."""
    from pyspark import RDD

    sizes, real = [], RDD.collect

    def collect(rdd):
        got = real(rdd)
        if got and isinstance(got[0], tuple):  # not the counts of blocks that number them
            sizes.append(sum(value.size for _, value in got))
        return got

    def whole(*_):
        raise AssertionError("histograms merged into the driver")

    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)
    monkeypatch.setattr(RDD, "collect", collect)
    monkeypatch.setattr(RDD, "treeReduce", whole)
    fit(rows.repartition(6), trees=2, feature_fraction=1.0)
    assert 2 <= len(sizes) <= 2 * 3 and max(sizes) <= 4 * len(FEATURES) * 6


def test_levels_neither_decode_blocks_nor_start_needless_tasks(rows, monkeypatch):
    """Blocks are kept as bytes, and the sums of six tasks meet in one; the trees are those of a single task."""
    from pyspark import RDD

    kept, met, persist, reduce = [], [], RDD.persist, RDD.reduceByKey
    monkeypatch.setattr(RDD, "persist", lambda rdd, level: kept.append(level) or persist(rdd, level))
    monkeypatch.setattr(RDD, "reduceByKey", lambda rdd, add, n: met.append((rdd.getNumPartitions(), n)) or reduce(rdd, add, n))
    single = fit(rows.repartition(1), trees=2).nodes()
    assert not met and len(kept) == 3 and all(level.deserialized and level.useDisk for level in kept)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)
    monkeypatch.setattr(boosting, "TASK_BLOCKS", 2)
    assert fit(rows.repartition(6), trees=2).nodes().equals(single)
    assert len(met) == 6 and all(tasks > 1 and n == 1 for tasks, n in met)
    monkeypatch.setattr(boosting, "REDUCE_FROM", 1)
    assert fit(rows.repartition(6), trees=2).nodes().equals(single) and met[-1][1] == min(met[-1][0], 4)


def test_nodes_by_bytes_equal_plain_lookups(rows):
    """Both ways to find a row's node, the plain one for trees of more than 255 nodes."""
    codes = np.random.default_rng(2).integers(0, 256, (5, boosting.CHUNK_ROWS + 7), dtype=np.uint8)
    for tree in fit(rows, depth=4).trees:
        tree.cut[tree.feature >= 0] = np.arange((tree.feature >= 0).sum()) * 16 + 5
        assert (boosting.nodes_of(codes, tree, 4) == tree.leaves(codes, tree.cut, 4)).all()

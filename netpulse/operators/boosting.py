"""Gradient-boosted trees of second order, grown on histograms by Spark jobs.

After Chen and Guestrin, "XGBoost: A Scalable Tree Boosting System" (2016).  Rows
are cut into at most ``BINS`` bins per feature once and kept in blocks of arrays.
One job per level adds up gradients and Hessians per (node, feature, bin); each
feature's sums meet in one task, which looks for the nodes' best splits, and the driver
picks among the features.  It gets a few numbers per (node, feature), whatever the
number of rows and tasks.

Gradients are rounded to a grid on which their sums are exact, and rows are drawn
by a hash of their content, so the trees do not depend on the partitioning.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from netpulse import fixed
from netpulse.session import ensure_checkpoint_dir, ship_package, stage

BINS = 256
# Rows whose quantiles become the bins' edges, at most; rows of a block and about the most of a task; blocks that
# another task is worth its start for; rows worked on at a time, to stay in the processor's cache; tasks that a level's sums meet in, at most, and tasks
# of blocks that another of them is worth its start for (the sums are few); trees between two checkpoints.
EDGE_ROWS = 20_000
BLOCK_ROWS = 65_536
TASK_ROWS = 4_000_000
TASK_BLOCKS = 8
CHUNK_ROWS = 1 << 15
REDUCE_TASKS = 4
REDUCE_FROM = 16
CHECKPOINT_EVERY = 25
# Blocks are bytes already: kept as such, no level has to decode them first.
KEPT = StorageLevel.MEMORY_AND_DISK_DESER
# Penalty on leaf values, least Hessian of a child, least gain of a split.
PENALTY = 1.0
LEAST_HESSIAN = 1.0
LEAST_GAIN = 1e-6

NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, value double, cover double, gain double"


@dataclass
class Tree:
    """Nodes in arrays; feature -1 is a leaf.  ``cut`` is the threshold as a bin, ``value`` counts in leaves only."""

    feature: np.ndarray
    cut: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    gain: np.ndarray

    def leaves(self, columns: np.ndarray, bounds: np.ndarray, steps: int) -> np.ndarray:
        """Node reached by every row (a row of ``columns`` holds one feature) after ``steps`` splits."""
        children = np.stack([np.where(self.feature < 0, np.arange(len(self.feature)), side) for side in (self.left, self.right)], axis=1).ravel()
        feature, rows = np.maximum(self.feature, 0), np.arange(columns.shape[1])
        node = np.zeros(columns.shape[1], np.int64)
        for _ in range(steps):
            node = children[2 * node + (columns[feature[node], rows] > bounds[node])]
        return node


@dataclass
class BoostedTrees:
    """A fitted ensemble: the log-odds of a row are ``base`` plus its leaf's value in every tree."""

    features: list[str]
    depth: int
    trees: list[Tree]
    base: float = 0.0

    def nodes(self) -> pd.DataFrame:
        """One row per node: tree, node, feature, threshold, left, right, value, cover, gain."""
        columns = ["feature", "threshold", "left", "right", "value", "cover", "gain"]
        parts = [pd.DataFrame({"tree": i, "node": np.arange(len(t.feature)), **{c: getattr(t, c) for c in columns}}) for i, t in enumerate(self.trees)]
        return pd.concat(parts, ignore_index=True)

    def importances(self) -> dict[str, float]:
        """Mean gain of a feature's splits, as a share of the sum over features."""
        nodes = self.nodes()
        means = nodes[nodes["feature"] >= 0].groupby("feature")["gain"].mean()
        total = float(means.sum()) or 1.0
        return {name: float(means.get(i, 0.0)) / total for i, name in enumerate(self.features)}

    def log_odds(self, points: np.ndarray) -> np.ndarray:
        """Log-odds of rows (features in the columns of ``points``)."""
        columns = np.ascontiguousarray(points.T)
        total = np.full(len(points), self.base)
        for tree in self.trees:
            total += tree.value[tree.leaves(columns, tree.threshold, self.depth)]
        return total

    def score(self, df: DataFrame, name: str) -> DataFrame:
        """Add the probability to every row; the model is bounded by its trees and is broadcast."""
        spark = df.sparkSession
        ship_package(spark)
        shared = spark.sparkContext.broadcast(self)

        @F.pandas_udf("double")
        def probability(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in batches:
                points = np.column_stack([c.to_numpy(dtype=float) for c in columns])
                yield pd.Series(_sigmoid(shared.value.log_odds(points)))

        return df.withColumn(name, probability(*[F.col(c).cast("double") for c in self.features]))

    def save(self, spark: SparkSession, path: str) -> None:
        about = json.dumps({"features": self.features, "depth": self.depth, "base": self.base})
        nodes = spark.createDataFrame(self.nodes(), NODE_SCHEMA).withColumn("model", F.lit(about))
        nodes.coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTrees:
        nodes = spark.read.parquet(f"{path}/trees").toPandas().sort_values(["tree", "node"])
        about = json.loads(nodes["model"].iloc[0])
        trees = [
            Tree(**{c: t[c].to_numpy() for c in ("feature", "threshold", "left", "right", "value", "cover", "gain")}, cut=np.zeros(len(t), np.int64))
            for _, t in nodes.groupby("tree")
        ]
        return cls(about["features"], about["depth"], trees, about["base"])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -700, 700)))


# ---- rows as blocks of arrays --------------------------------------------------


@dataclass
class Block:
    """Some rows: bin codes (a row per feature), whether positive, random keys, and their log-odds so far."""

    codes: np.ndarray
    label: np.ndarray
    key: np.ndarray
    margin: np.ndarray

    def chunks(self) -> Iterator[Block]:
        """Views of at most ``CHUNK_ROWS`` rows."""
        for at in range(0, len(self.label), CHUNK_ROWS):
            part = slice(at, at + CHUNK_ROWS)
            yield Block(self.codes[:, part], self.label[part], self.key[part], self.margin[part])


def edges_of(rows: DataFrame, features: list[str], n: int, bins: int = BINS) -> list[np.ndarray]:
    """Upper edges of every feature's bins but the last: quantiles of at most ``EDGE_ROWS`` rows drawn by key."""
    share = F.pmod("key", F.lit(1 << 40)) / F.lit(float(1 << 40))
    thinned = rows.where(share * n < 1.25 * EDGE_ROWS)
    sample = thinned.select(share.alias("draw"), *features).orderBy("draw", *features).limit(EDGE_ROWS).toPandas()
    edges = []
    for name in features:
        values = np.unique(sample[name].to_numpy(dtype=float))
        if len(values) > bins:
            values = np.unique(np.quantile(sample[name].to_numpy(dtype=float), np.arange(1, bins + 1) / bins, method="inverted_cdf"))
        edges.append(values[:-1])
    return edges


def _packed(block: Block) -> bytes:
    out = io.BytesIO()
    np.savez(out, codes=block.codes, label=block.label, key=block.key)
    return out.getvalue()


def _unpacked(data: bytes) -> Block:
    held = np.load(io.BytesIO(data))
    return Block(held["codes"], held["label"], held["key"], np.zeros(len(held["label"])))


def blocks_of(rows: DataFrame, features: list[str], edges: list[np.ndarray], n: int) -> RDD:
    """Stage the binned rows, one binary value per block, and deal the blocks evenly: every level waits for the task with most."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[Block] = []

        def joined() -> pa.RecordBatch:
            whole = Block(*[np.concatenate([getattr(p, c) for p in parts], axis=-1) for c in ("codes", "label", "key", "margin")])
            return pa.RecordBatch.from_pydict({"block": pa.array([_packed(whole)], pa.binary())})

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
            codes = np.stack([np.searchsorted(e, c, side="left").astype(np.uint8) for e, c in zip(edges, columns)])
            label, key = columns[len(features) :]
            parts.append(Block(codes, label.astype(bool), key.astype(np.uint64), np.zeros(len(label))))
            if sum(len(p.label) for p in parts) >= BLOCK_ROWS:
                yield joined()
                parts = []
        if parts:
            yield joined()

    cores = rows.sparkSession.sparkContext.defaultParallelism
    blocks, tasks = -(-n // BLOCK_ROWS), cores * max(1, -(-n // (cores * TASK_ROWS)))
    source = rows.select(*features, "label", "key")
    source = source.coalesce(max(1, min(source.rdd.getNumPartitions(), blocks)))
    staged = stage(source.mapInArrow(work, "block binary"), "boosting").rdd.map(lambda row: bytes(row["block"]))
    dealt = staged.zipWithIndex().map(lambda numbered: numbered[::-1]).partitionBy(max(1, min(-(-blocks // TASK_BLOCKS), tasks)), int)
    return dealt.values().map(_unpacked)


# ---- growing -------------------------------------------------------------------


@dataclass(frozen=True)
class Growth:
    """Parameters of a fit."""

    depth: int
    trees: int
    step: float
    row_fraction: float
    feature_fraction: float
    seed: int
    positive_weight: float = 1.0
    penalty: float = PENALTY
    least_hessian: float = LEAST_HESSIAN
    bins: int = BINS


def drawn_rows(key: np.ndarray, tree: int, fraction: float) -> np.ndarray:
    """The tree's share of the rows: a hash of their keys and the tree's number."""
    mixed = (key ^ np.uint64(tree * 0x9E3779B97F4A7C15 & (2**64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return (mixed >> np.uint64(11)) * 2.0**-53 < fraction


def nodes_of(codes: np.ndarray, tree: Tree, levels: int) -> np.ndarray:
    """Node reached by every row of bin codes; splits are numbered before their children.

    A split moves the rows of its node by arithmetic on bytes, which is far quicker than
    looking up every row's own split, as long as a byte holds all nodes.
    """
    if len(tree.feature) > 255:
        return tree.leaves(codes, tree.cut, levels)
    node = np.zeros(codes.shape[1], np.uint8)
    for at in np.flatnonzero(tree.feature >= 0):
        left, right = int(tree.left[at]), int(tree.right[at])
        step = (codes[tree.feature[at]] > int(tree.cut[at])).view(np.uint8) * np.uint8(right - left) + np.uint8(left - at)
        node += step * (node == at).view(np.uint8)
    return node


def add_histograms(total: np.ndarray, block: Block, tree: Tree, number: int, slots: np.ndarray, level: int, used: np.ndarray, grid: float, growth: Growth) -> None:
    """Add a block's gradients and Hessians, in units of the grid, to ``total`` [feature, gradient or Hessian, open node, bin]."""
    n_slots = total.shape[2]
    for part in block.chunks():
        slot = slots.take(nodes_of(part.codes, tree, level))
        rows = np.flatnonzero(drawn_rows(part.key, number, growth.row_fraction) & (slot >= 0))
        slot, label, p = slot.take(rows) * growth.bins, part.label.take(rows), _sigmoid(part.margin.take(rows))
        weight = np.where(label, growth.positive_weight, 1.0)
        gradient, hessian = np.rint(weight * (p - label) * grid), np.rint(weight * p * (1 - p) * grid)
        for i, f in enumerate(used):
            at = slot + part.codes[f].take(rows)
            for k, values in enumerate((gradient, hessian)):
                total[i, k] += np.bincount(at, values, n_slots * growth.bins).reshape(n_slots, growth.bins)


def best_splits(sums: np.ndarray, penalty: float, least_hessian: float) -> np.ndarray:
    """One feature's best split of every node: gain, last bin of the left side, the left side's sums, the node's sums.

    ``sums`` is [gradient or Hessian, node, bin].  Of equal gains the lowest bin wins.
    """
    left = sums.cumsum(axis=2)
    total = left[..., -1:]
    right = total - left
    worth = lambda s: s[0] ** 2 / (s[1] + penalty)
    gain = 0.5 * (worth(left) + worth(right) - worth(total))
    gain[(left[1] < least_hessian) | (right[1] < least_hessian)] = -np.inf
    gain[:, -1] = -np.inf
    at, nodes = gain.argmax(axis=1), np.arange(len(gain))
    return np.stack([gain[nodes, at], at, *left[:, nodes, at], *total[:, :, 0]], axis=1)


class _Growing:
    """The nodes of one tree while it grows."""

    def __init__(self, features: int, edges: list[np.ndarray]):
        self.edges, self.rows, self.open = edges, [], [0]
        self.add(0.0, 0.0)

    def add(self, gradient: float, hessian: float) -> int:
        self.rows.append({"feature": -1, "cut": 0, "threshold": 0.0, "left": -1, "right": -1, "gradient": gradient, "cover": hessian, "gain": 0.0})
        return len(self.rows) - 1

    def slots(self) -> np.ndarray:
        slots = np.full(len(self.rows), -1, np.int64)
        slots[self.open] = np.arange(len(self.open))
        return slots

    def split(self, found: np.ndarray, used: np.ndarray) -> None:
        """Split the open nodes by ``found`` [feature, node, see best_splits]; of equal gains the first feature wins."""
        grown = []
        for slot, place in enumerate(found[:, :, 0].argmax(axis=0)):
            row = self.rows[self.open[slot]]
            gain, cut, g, h, row["gradient"], row["cover"] = map(float, found[place, slot])
            if gain > LEAST_GAIN:
                feature = int(used[place])
                row |= {"feature": feature, "cut": int(cut), "threshold": float(self.edges[feature][int(cut)]), "gain": gain}
                row["left"], row["right"] = self.add(g, h), self.add(row["gradient"] - g, row["cover"] - h)
                grown += [row["left"], row["right"]]
        self.open = grown

    def tree(self, growth: Growth) -> Tree:
        columns = {name: np.array([r[name] for r in self.rows]) for name in self.rows[0]}
        value = -growth.step * columns.pop("gradient") / (columns["cover"] + growth.penalty)
        return Tree(**columns, value=np.where(columns["feature"] < 0, value, 0.0))


def grow_tree(state: RDD, number: int, edges: list[np.ndarray], grid: float, growth: Growth) -> Tree:
    """One tree: a job per level adds up the histograms of its open nodes, by feature, and finds their best splits."""
    rng = np.random.default_rng([growth.seed, number])
    n_used = max(1, int(round(growth.feature_fraction * len(edges))))
    used = np.sort(rng.choice(len(edges), n_used, replace=False))
    growing, tasks = _Growing(len(edges), edges), state.getNumPartitions()
    for level in range(growth.depth):
        if not growing.open:
            break
        tree, slots = growing.tree(growth), growing.slots()

        def summed(blocks: Iterator[Block]) -> Iterator[tuple[int, np.ndarray]]:
            total = np.zeros((len(used), 2, int(slots.max()) + 1, growth.bins))
            for block in blocks:
                add_histograms(total, block, tree, number, slots, level, used, grid, growth)
            yield from enumerate(total)

        def split(sums: np.ndarray) -> np.ndarray:
            return best_splits(sums / grid, growth.penalty, growth.least_hessian)

        sums = state.mapPartitions(summed)
        if tasks > 1:  # a single task has them whole
            sums = sums.reduceByKey(np.add, min(REDUCE_TASKS, len(used), -(-tasks // REDUCE_FROM)))
        found = dict(sums.mapValues(split).collect())
        growing.split(np.stack([found[place] for place in range(len(used))]), used)
    return growing.tree(growth)


def advanced(state: RDD, tree: Tree, depth: int) -> RDD:
    """The blocks with the tree's values added to their log-odds."""

    def moved(block: Block) -> Block:
        value = np.concatenate([tree.value.take(nodes_of(part.codes, tree, depth)) for part in block.chunks()])
        return Block(block.codes, block.label, block.key, block.margin + value)

    return state.map(moved)


def fit_boosted_trees(
    train: DataFrame, features: list[str], label: str, positive_weight: float, depth: int, trees: int,
    step: float = fixed.BOOSTING["step"], row_fraction: float = fixed.BOOSTING["row_fraction"],
    feature_fraction: float = fixed.BOOSTING["feature_fraction"], seed: int = fixed.SEED,
) -> BoostedTrees:
    """Fit on complete rows; positives weigh ``positive_weight``, negatives one.

    Every tree sees ``row_fraction`` of the rows (drawn by a hash of their columns, so
    equal rows go together) and ``feature_fraction`` of the features.  An empty frame
    gives a model of single leaves.  Blocks are held in memory or on disk and come back
    from the staged rows or the last checkpoint when an executor is lost.
    """
    spark = train.sparkSession
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    growth = Growth(depth, trees, step, row_fraction, feature_fraction, seed, float(positive_weight))
    positive = F.col(label) == 1
    key = F.xxhash64(*sorted(train.columns))
    rows = train.select(
        *[F.col(c).cast("double").alias(c) for c in features], F.coalesce(positive, F.lit(False)).alias("label"), key.alias("key"),
    )
    n = rows.count()
    edges = edges_of(rows, features, n)
    # whole numbers up to 2**52 add up exactly in any order
    grid = 2.0 ** min(40, 52 - int(np.ceil(np.log2(max(n, 1) * max(positive_weight, 1.0) + 1))))
    state = blocks_of(rows, features, edges, n).persist(KEPT)
    model = BoostedTrees(list(features), depth, [])
    for number in range(trees):
        model.trees.append(grow_tree(state, number, edges, grid, growth))
        following = advanced(state, model.trees[-1], depth).persist(KEPT)
        if (number + 1) % CHECKPOINT_EVERY == 0:
            following.checkpoint()
            following.count()
        if number:
            before.unpersist()
        before, state = state, following
    state.unpersist()
    if trees:
        before.unpersist()
    return model

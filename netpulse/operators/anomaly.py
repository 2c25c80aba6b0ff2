"""Isolation forest: sampled trees fitted per group, every observation scored.

After Liu, Ting and Zhou, "Isolation Forest" (2008).  Trees see a bounded
sample whatever the data size; scoring runs over all rows in Arrow batches.
Splits are drawn uniformly between a feature's extremes, so standardising the
features first would not change the distribution of the trees.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from netpulse import fixed
from netpulse import functions as fn
from netpulse.operators.ordering import exact_percentiles
from netpulse.operators.sampling import DIGEST, in_shares, sample_cap, spare, with_digest
from netpulse.session import ship_package, stage

__all__ = ["anomaly_results", "average_path", "fit_isolation_forest", "flag_anomalies", "minmax_score", "sample_cap", "score_isolation_forest"]

EULER_GAMMA = 0.5772156649015329
TREE_SCHEMA = "tree int, sample int, node int, feature int, threshold double, left int, right int, path double"


def average_path(n):
    """Mean unsuccessful-search depth in a binary tree of ``n`` points."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    depth = 2.0 * (np.log(big - 1.0) + EULER_GAMMA) - 2.0 * (big - 1.0) / big
    return np.where(n > 2, depth, np.where(n == 2, 1.0, 0.0))


def _height(sample: int) -> int:
    """Depth limit of a tree: the mean depth of a balanced one."""
    return max(1, math.ceil(math.log2(max(sample, 2))))


def _grow(points: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Nodes (id, feature, threshold, left, right, path) of one tree; feature -1 is a leaf."""
    nodes: list[tuple] = []
    pending = [(0, points, 0)]
    created = 1
    while pending:
        node, part, depth = pending.pop()
        spread = np.flatnonzero(part.max(axis=0) > part.min(axis=0)) if len(part) > 1 else np.array([], int)
        if depth >= limit or not len(spread):
            nodes.append((node, -1, 0.0, -1, -1, depth + float(average_path(len(part)))))
            continue
        feature = int(rng.choice(spread))
        values = part[:, feature]
        threshold = float(rng.uniform(values.min(), values.max()))
        goes_left = values <= threshold
        nodes.append((node, feature, threshold, created, created + 1, 0.0))
        pending.append((created, part[goes_left], depth + 1))
        pending.append((created + 1, part[~goes_left], depth + 1))
        created += 2
    return nodes


def _mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def tree_samples(df: DataFrame, feats: list[str], trees: int, sample: int, seed: int) -> DataFrame:
    """(tree, draw, features) of a little over ``sample`` rows per tree, the lowest draws of all rows.

    A row's draw for a tree is a hash of its digest, its copy number and the tree.
    Rows below the draw that ``sample`` rows are expected to stay under are kept where they
    are; the lowest ones of such sets are the lowest of all, however the rows are dealt.
    """
    columns = [F.col(c).cast("double").alias(c) for c in feats]
    inputs = with_digest(df).select(*columns, *DIGEST).dropna(how="any", subset=feats).where(~reduce(or_, [F.isnan(c) for c in feats]))
    counted = inputs.groupBy(*DIGEST).agg(F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in feats])
    counted = stage(counted, "distinct")
    total = counted.agg(F.sum("copies")).first()[0] or 0
    limit = np.uint64(min(2.0**64 - 2**11, spare(sample) / max(total, 1) * 2.0**64))
    offsets = _mixed(np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            copies = (frame["last"] - frame["first"] + 1).to_numpy()
            row = np.repeat(np.arange(len(frame)), copies)
            number = np.arange(len(row)) - np.repeat(np.cumsum(copies) - copies, copies) + frame["first"].to_numpy()[row]
            first, second = (frame[c].to_numpy().view(np.uint64) for c in DIGEST)
            name = _mixed(_mixed(first[row] ^ _mixed(second[row])) + number.astype(np.uint64))
            for tree, offset in enumerate(offsets):
                draws = _mixed(name ^ offset)
                low = np.flatnonzero(draws <= limit)
                if len(low):
                    part = frame.loc[row[low], feats].reset_index(drop=True)
                    part.insert(0, "draw", (draws[low] >> np.uint64(1)).astype(np.int64))
                    part.insert(0, "tree", np.int32(tree))
                    yield part

    schema = "tree int, draw long, " + ", ".join(f"`{c}` double" for c in feats)
    return in_shares(counted).select("first", "last", *DIGEST, *feats).mapInPandas(work, schema)


def fit_isolation_forest(
    df: DataFrame, feats: list[str] | None = None, trees: int = fixed.ISOLATION_TREES,
    sample: int = fixed.ISOLATION_SAMPLE, seed: int = fixed.SEED,
) -> DataFrame:
    """Node table of ``trees`` isolation trees, each grown on ``sample`` rows drawn without replacement.

    The forest depends on the rows and the seed alone, not on their partitioning.  A
    tree's group holds a little over ``sample`` rows, whatever the data size.
    """
    feats = list(feats or fixed.ANOMALY_FEATURES)
    ship_package(df.sparkSession)

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree"].iloc[0])
        points = group.sort_values(["draw", *feats])[feats].to_numpy(dtype=float)[:sample]
        points = points[np.lexsort(points.T)]  # rows arrive in any order
        nodes = _grow(points, np.random.default_rng([seed, tree]), _height(len(points)))
        table = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "left", "right", "path"])
        table.insert(0, "sample", len(points))
        table.insert(0, "tree", tree)
        return table

    # Little data but real work per tree: keep adaptive execution from merging the groups.
    tasks = min(trees, df.sparkSession.sparkContext.defaultParallelism)
    return tree_samples(df, feats, trees, sample, seed).repartition(tasks, "tree").groupBy("tree").applyInPandas(grow, TREE_SCHEMA)


def _as_arrays(nodes: pd.DataFrame) -> list[tuple[np.ndarray, ...]]:
    """Per tree (feature, threshold, children, path), children as [left, right] of each node in turn.

    Leaves lead to themselves, so every row takes the same number of steps.
    """
    trees = []
    for _, part in nodes.sort_values(["tree", "node"]).groupby("tree"):
        own, leaf = part["node"].to_numpy(), part["feature"].to_numpy() < 0
        children = np.stack([np.where(leaf, own, part[side].to_numpy()) for side in ("left", "right")], axis=1)
        trees.append((
            np.where(leaf, 0, part["feature"].to_numpy()).astype(np.int64), part["threshold"].to_numpy(),
            children.ravel().astype(np.int64), part["path"].to_numpy(),
        ))
    return trees


def _mean_path(points: np.ndarray, trees: list[tuple[np.ndarray, ...]], steps: int) -> np.ndarray:
    """Mean path length of each row (features in the columns of ``points``)."""
    n = len(points)
    flat, rows = np.ascontiguousarray(points.T).ravel(), np.arange(n)
    total = np.zeros(n)
    for feature, threshold, children, path in trees:
        node = np.zeros(n, dtype=np.int64)
        for _ in range(steps):
            right = flat.take(feature.take(node) * n + rows) > threshold.take(node)
            node = children.take(2 * node + right)
        total += path.take(node)
    return total / max(len(trees), 1)


def score_isolation_forest(
    forest: DataFrame, df: DataFrame, feats: list[str] | None = None, name: str = "raw_score"
) -> DataFrame:
    """Add ``2 ** (-mean path / c(sample))`` to every row; no row is left out.

    The forest is bounded by ``trees * 2 * sample`` nodes, whatever the data size.
    """
    feats = list(feats or fixed.ANOMALY_FEATURES)
    spark = df.sparkSession
    ship_package(spark)
    nodes = forest.toPandas()
    shared = spark.sparkContext.broadcast(_as_arrays(nodes))
    sample = int(nodes["sample"].max())
    norm, steps = max(float(average_path(sample)), 1.0), _height(sample)

    @F.pandas_udf("double")
    def isolation_score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            points = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            yield pd.Series(np.exp2(-_mean_path(points, shared.value, steps) / norm))

    return df.withColumn(name, isolation_score(*[F.col(c).cast("double") for c in feats]))


def minmax_score(df: DataFrame, column: str = "raw_score", name: str = "anomaly_score") -> DataFrame:
    """Scale to 0..100 over the whole frame, rounded half-even to two places; constant input gives 0."""
    edges = df.agg(F.struct(F.min(column).alias("low"), F.max(column).alias("high")).alias("edges")).scalar()
    low, high = edges.getField("low"), edges.getField("high")
    share = F.coalesce(F.try_divide(F.col(column) - low, high - low), F.when(F.col(column).isNotNull(), 0.0))
    return df.withColumn(name, fn.round_half_even(share * 100.0, 2))


def flag_anomalies(
    df: DataFrame, c: float = fixed.CONTAMINATION, column: str = "raw_score", name: str = "is_anomaly"
) -> DataFrame:
    """1 strictly above the exact (1 - c) percentile of the scores.

    Only the threshold reaches the driver: pass a stored frame.
    """
    found = exact_percentiles(df, [column], [1.0 - c], interpolate=True).first()
    threshold = F.lit(found["values"][0] if found else None).cast("double")
    return df.withColumn(name, fn.flag(F.col(column) > threshold))


def anomaly_results(scored: DataFrame, c: float = fixed.CONTAMINATION) -> DataFrame:
    """Anomaly table from raw scores: pass a stored frame, it is read three times."""
    flagged = flag_anomalies(minmax_score(scored), c)
    return flagged.select(*fixed.ANOMALY_IDS, "anomaly_score", "is_anomaly", *fixed.ANOMALY_FEATURES)

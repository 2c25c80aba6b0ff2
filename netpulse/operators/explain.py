"""Additive explanations of tree and linear failure models.

Tree attributions follow Lundberg et al., "From local explanations to global
understanding with explainable AI for trees" (2020), path-dependent form.  A
leaf only involves the few features on its path, and each of them is either
inside or outside its interval; so the attributions of neighbouring leaves are
tabulated once for every outcome of the splits on their paths, and a row costs
one comparison per split and one table lookup per group of leaves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from netpulse.operators.boosting import BoostedTrees
from netpulse.operators.cleaning import arg_max
from netpulse.operators.models import rank_importance
from netpulse.session import ship_package

PREFIX = "shap_"
BASE = "shap_base"
# Splits that decide one table's row, at most; a single leaf takes those of its path.
GROUP_SPLITS = 8


@lru_cache(maxsize=None)
def _subsets(d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For d features: membership [subset, feature], containment [pattern, subset], Shapley weight [subset]."""
    sets = np.arange(1 << d)
    member = ((sets[:, None] >> np.arange(d)) & 1).astype(bool)
    contained = (sets[None, :] & ~sets[:, None]) == 0
    size = np.minimum(member.sum(axis=1), d - 1)  # the full set is never used
    weight = np.array([math.factorial(s) * math.factorial(d - s - 1) / math.factorial(d) for s in size])
    return member, contained, weight


def _shapley_table(value: float, ratios: np.ndarray) -> np.ndarray:
    """Attributions [pattern, feature] of one leaf; bit k of a pattern: feature k is inside.

    A known feature contributes 1 when inside and nothing when outside, an
    unknown one its cover ratio; so only subsets contained in the pattern count.
    """
    d = len(ratios)
    member, contained, weight = _subsets(d)
    unknown = np.where(member[:, None, :] | np.eye(d, dtype=bool)[None, :, :], 1.0, ratios)
    share = np.where(member, 0.0, weight[:, None] * unknown.prod(axis=2))  # [subset, explained feature]
    return value * (member - ratios) * (contained @ share)


def _leaves_below(by_id: dict, node, path: dict, splits: tuple) -> Iterator[tuple]:
    """Leaves under ``node``: (value, {feature: cover ratio}, ((split's node, whether left), ...))."""
    if node.left < 0:
        yield node.value, path, splits
        return
    for child_id, goes_left in ((node.left, True), (node.right, False)):
        child = by_id[child_id]
        ratio = path.get(node.feature, 1.0) * child.cover / node.cover
        yield from _leaves_below(by_id, child, {**path, node.feature: ratio}, (*splits, (node.node, goes_left)))


def _tree_tables(nodes: pd.DataFrame, width: int) -> tuple[float, list[tuple]]:
    """Expected log-odds and, per tree, (features, thresholds, groups).

    The first two are the splits of the tree.  A group is leaves that lie together, as (the
    splits on their paths, attributions [pattern, feature]); bit k of a pattern: the row
    goes left at the group's k-th split.  Groups are as large as ``GROUP_SPLITS`` allows.
    """
    trees, base = [], 0.0
    for _, tree in nodes.groupby("tree"):
        by_id = {row.node: row for row in tree.itertuples()}
        order = {n: i for i, n in enumerate(sorted(n for n, row in by_id.items() if row.left >= 0))}
        groups, pending = [], [(by_id[0], {}, ())]
        while pending:
            node, path, splits = pending.pop()
            below = list(_leaves_below(by_id, node, path, splits))
            used = sorted({order[at] for _, _, steps in below for at, _ in steps})
            if len(used) > GROUP_SPLITS and node.left >= 0:
                for child_id, goes_left in ((node.left, True), (node.right, False)):
                    child = by_id[child_id]
                    ratio = path.get(node.feature, 1.0) * child.cover / node.cover
                    pending.append((child, {**path, node.feature: ratio}, (*splits, (node.node, goes_left))))
                continue
            bits = (np.arange(1 << len(used))[:, None] >> np.arange(len(used))) & 1 == 1
            table = np.zeros((len(bits), width))
            for value, ratios, steps in below:
                features = sorted(ratios)
                ratio = np.array([ratios[f] for f in features])
                base += value * float(np.prod(ratio))
                if not features or value == 0.0:
                    continue
                pattern = np.zeros(len(bits), np.int64)
                for k, f in enumerate(features):
                    own = [bits[:, used.index(order[at])] == left for at, left in steps if by_id[at].feature == f]
                    pattern += np.logical_and.reduce(own).astype(np.int64) << k
                table[:, features] += _shapley_table(value, ratio)[pattern]
            if used:
                groups.append((used, table))
        inner = [by_id[n] for n in order]
        trees.append(([int(n.feature) for n in inner], [float(n.threshold) for n in inner], groups))
    return base, trees


def _attributed(columns: np.ndarray, trees: list[tuple]) -> np.ndarray:
    """Attributions [row, feature] of rows (a row of ``columns`` holds one feature)."""
    total = np.zeros(columns.shape[::-1])
    for features, thresholds, groups in trees:
        left = [(~(columns[f] > t)).view(np.uint8) for f, t in zip(features, thresholds)]
        for used, table in groups:
            pattern = np.zeros(columns.shape[1], np.uint8 if len(used) <= 8 else np.int64)
            for k, split in enumerate(used):
                pattern += left[split] * pattern.dtype.type(1 << k)
            total += table.take(pattern, axis=0)
    return total


def tree_shap(model: BoostedTrees, df: DataFrame) -> DataFrame:
    """Add one ``shap_<feature>`` column per feature and ``shap_base``, in log-odds.

    ``shap_base`` plus the attributions is the log-odds of the predicted
    probability.  The tables depend on the model alone and are broadcast; rows
    are explained where they are.
    """
    features = model.features
    ship_package(df.sparkSession)
    # Bounded by the model's size: about trees * 2 ** depth / 4 tables of 2 ** GROUP_SPLITS rows.
    base, trees = _tree_tables(model.nodes(), len(features))
    base += model.base
    shared = df.sparkSession.sparkContext.broadcast(trees)

    @F.pandas_udf("array<double>")
    def attributions(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            points = np.stack([c.to_numpy(dtype=float) for c in columns])
            yield pd.Series(list(_attributed(points, shared.value)))

    explained = df.withColumn("__shap", attributions(*[F.col(c).cast("double") for c in features]))
    return explained.select(
        *df.columns,
        *[F.col("__shap")[i].alias(PREFIX + name) for i, name in enumerate(features)],
        F.lit(base).alias(BASE),
    )


def linear_shap(df: DataFrame, coefficients: dict[str, float], background: DataFrame) -> DataFrame:
    """Attributions of a linear score: ``coefficient * (value - background mean)``."""
    means = background.agg(F.struct(*[F.avg(name).alias(name) for name in coefficients]).alias("m")).scalar()
    return df.select("*", *[
        ((F.col(name) - means.getField(name)) * F.lit(float(weight))).alias(PREFIX + name)
        for name, weight in coefficients.items()
    ])


def _explained(df: DataFrame) -> list[str]:
    return [c[len(PREFIX):] for c in df.columns if c.startswith(PREFIX) and c != BASE]


def shap_importance(shap: DataFrame) -> DataFrame:
    """Mean absolute attribution per feature, largest first."""
    rows = F.array(*[
        F.struct(F.lit(name).alias("feature"), F.avg(F.abs(F.col(PREFIX + name))).alias("mean_abs_shap"))
        for name in _explained(shap)
    ])
    return rank_importance(shap.agg(rows.alias("rows")).select(F.inline("rows")), "mean_abs_shap")


def explain_top(
    shap: DataFrame, k: int | None = 10, by: str = "failure_probability", ties: tuple[str, ...] = ("timestamp", "cell_id")
) -> DataFrame:
    """Feature, value and impact of the highest-risk row, by falling impact size."""
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("feature"), F.col(name).cast("double").alias("feature_value"),
            F.col(PREFIX + name).alias("shap_impact"), F.abs(F.col(PREFIX + name)).alias("abs_impact"),
        ) for name in _explained(shap)
    ])
    return rank_importance(arg_max(shap, by, *ties).select(F.inline(rows)), "shap_impact", k)


def risk_drivers(local: DataFrame, k: int = 5) -> DataFrame:
    """Strongest features that push towards failure; pass all features of the row (``k=None``)."""
    return rank_importance(local.filter(F.col("shap_impact") > 0), "shap_impact", k)

"""Exact top-k inner products by aggregation without random access.

Candidates are dealt into cells and worked on in blocks.  A block holds one list per
component, sorted by value, which a query reads from the end that its own component
favours.  All lists are read down to one common contribution, so a query's heavy
components are read deepest, and a row's unread entries add at most that much each:
the row's upper bound is what was read plus that contribution for every unread list,
its lower bound the same with the least contribution of the block.  Reading stops
when few rows can still reach the k-th best score known; only their final scores are
resolved.  The k-th score goes from block to block, and from a small opening share
of all rows to every cell.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netpulse.llm.common import partitions, ship_package, stage

SCALE = 256
# Rows of the opening (at most, and at most an eighth of all), of a cell, of a block with its lists; queries of a cell.
OPENING, CELL_VECTORS, BLOCK_VECTORS, CELL_QUERIES = 4096, 32_768, 8192, 16_384
# A cell is cut down to this many rows where there would be fewer cells than shuffle partitions.
LEAST_CELL = 4096
# Contributions at which the bounds are looked at, as shares of the k-th score per component; then all is read.
LEVELS = (1 / 2, 1 / 8, -1 / 4, -1.0)
LONGEST, LEAST_SCORE = 2**63 - 1, -(2**63)


def quantised(embedding: Column) -> Column:
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * SCALE))


def usable(embedding: Column) -> Column:
    """Present, and every component finite."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return embedding.isNotNull() & F.coalesce(finite, F.lit(False))


class Block:
    """Rows of a cell and, per component, their numbers and values in ascending order."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        self.vectors, self.ids, self.doubles = vectors, ids, vectors.astype(np.float64)
        columns = np.ascontiguousarray(self.doubles.T)
        self.order = np.argsort(columns, axis=1, kind="stable")
        self.values = np.take_along_axis(columns, self.order, axis=1)
        self.reach = np.abs(self.doubles).max(axis=1, initial=0)

    def edges(self, queries: np.ndarray, levels: np.ndarray) -> np.ndarray:
        """Place (query, level, list) up to which a list is read at a level, after its start."""
        n_queries, n_levels = levels.shape
        n = len(self.ids)
        out = np.zeros((n_queries, n_levels + 2, queries.shape[1]), np.int64)
        with np.errstate(divide="ignore", invalid="ignore"):
            for j, values in enumerate(self.values):
                weight = queries[:, j]
                limit = levels / weight[:, None]
                up, down = weight > 0, weight < 0
                out[up, 0, j] = n
                out[up, 1:-1, j] = np.searchsorted(values, limit[up], "left")
                out[down, 1:-1, j] = np.searchsorted(values, limit[down], "right")
                out[down, -1, j] = n  # the last level reads the whole list
        return out

    def scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Exact inner products; beyond a long the nearest long."""
        weight = float(np.abs(query.astype(np.float64)).sum())
        if self.reach.max() * weight < 2**52:  # whole numbers that doubles hold
            return (self.doubles[rows] @ query.astype(np.float64)).astype(np.int64)
        held = self.vectors[rows]
        fits = self.reach[rows] * weight < 2**62
        out = np.empty(len(rows), np.int64)
        out[fits] = held[fits] @ query
        for i in np.flatnonzero(~fits):
            out[i] = min(max(sum(a * b for a, b in zip(held[i].tolist(), query.tolist())), LEAST_SCORE), LONGEST)
        return out


class Best:
    """The k best (score, id) of a query so far, and the score an outsider has to reach."""

    def __init__(self, k: int, bound: int | None):
        self.k, self.bound = k, bound
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if self.bound is not None:
            reach = scores >= self.bound
            scores, ids = scores[reach], ids[reach]
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        # ~score turns the order round without leaving the range of a long
        first = np.lexsort((ids, ~scores))[: self.k]
        self.scores, self.ids = scores[first], ids[first]
        if len(first) == self.k:
            kth = int(self.scores[-1])
            self.bound = kth if self.bound is None else max(kth, self.bound)

    def least(self) -> float:
        return -np.inf if self.bound is None or self.bound == LEAST_SCORE else float(self.bound)


def scan(block: Block, queries: np.ndarray, query_ids: np.ndarray, best: list[Best]) -> int:
    """Read the block's lists for each query into ``best``; the number of entries read."""
    weights = queries.astype(np.float64)
    n, lists = len(block.ids), (weights != 0).sum(axis=1)
    least = np.array([b.least() for b in best])
    with np.errstate(invalid="ignore"):
        levels = np.where(least[:, None] > 0, least[:, None] / np.maximum(lists, 1)[:, None] * np.array(LEVELS), -np.inf)
    edges = block.edges(weights, levels)
    worst = np.minimum(weights * block.values[:, 0], weights * block.values[:, -1]).min(axis=1, initial=0)
    # what rounding can do to a bound; none of it where whole numbers fit a double
    slack = block.reach.max() * np.abs(weights).sum(axis=1) * (weights.shape[1] + 4) * 2.0**-50
    total = 0
    for i, (query, own) in enumerate(zip(queries, query_ids)):
        partial, seen = np.zeros(n), np.zeros(n, np.int64)
        other = block.ids != own
        alive = other
        starts, stops = np.minimum(edges[i, :-1], edges[i, 1:]), np.maximum(edges[i, :-1], edges[i, 1:])
        ahead = (stops - starts).sum(axis=1)
        for at, contribution in enumerate([*levels[i], -np.inf]):
            if not ahead[at]:
                continue
            spans = [(j, a, b) for j, (a, b) in enumerate(zip(starts[at].tolist(), stops[at].tolist())) if a < b]
            rows = np.concatenate([block.order[j, a:b] for j, a, b in spans])
            read = np.concatenate([block.values[j, a:b] for j, a, b in spans])
            read *= np.repeat([weights[i, j] for j, _, _ in spans], [b - a for _, a, b in spans])
            total += len(rows)
            partial += np.bincount(rows, read, n)
            seen += np.bincount(rows, minlength=n)
            unread = lists[i] - seen
            upper = partial + (0 if contribution == -np.inf else contribution * unread)
            lower = np.where(other, partial + worst[i] * unread, -np.inf)
            k = best[i].k
            kth = np.partition(lower, n - k)[n - k] if n > k else -np.inf
            # scores that count as the same nearest long are ties
            needed = min(max(least[i], kth), float(LONGEST)) - 2 * slack[i]
            alive = other & ((upper >= needed) | (needed <= LEAST_SCORE))
            if alive.sum() * lists[i] <= ahead[at + 1 :].sum():
                break
        rows = np.flatnonzero(alive)
        best[i].add(block.scores(rows, query), block.ids[rows])
    return total


def cell_topk(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, best: list[Best], block_vectors: int = BLOCK_VECTORS) -> int:
    """All rows of a cell, block after block; the number of list entries read."""
    return sum(scan(Block(vectors[at : at + block_vectors], ids[at : at + block_vectors]), queries, query_ids, best) for at in range(0, len(ids), block_vectors))


def _matched(held: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, score: the k best of each (cell, query), of those that reach the query's bound."""

    def matrix(column: pd.Series) -> np.ndarray:
        return np.stack(column.to_list()).astype(np.int64)

    def work(held: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        best = []
        if len(held) and len(asking):
            best = [Best(k, None if missing else int(bound)) for bound, missing in zip(asking["bound"], asking["bound"].isna())]
            cell_topk(matrix(held["v"]), held["vec_id"].to_numpy(), matrix(asking["v"]), asking["vec_id"].to_numpy(), best)
        query_ids = np.repeat(asking["vec_id"].to_numpy(np.int64), [len(b.ids) for b in best]) if best else np.empty(0, np.int64)
        parts = [np.concatenate([np.empty(0, np.int64), *(getattr(b, c) for b in best)]) for c in ("ids", "scores")]
        return pd.DataFrame({"query_id": query_ids, "vec_id": parts[0], "score": parts[1]})

    cell = ["d", "cell", "query_cell"]
    return held.groupBy(*cell).cogroup(asked.groupBy(*cell)).applyInPandas(work, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """The k best-scoring other rows of each query: query_id, rank, vec_id, score.

    Queries are the rows whose vec_id is divisible by ``every``.  Vectors that are
    null or hold null or non-finite components take no part, nor do rows without
    vec_id; of rows that repeat a vec_id the smallest vector counts.  Only vectors of
    the same length are compared; empty ones have product 0.  Equal scores go to the
    smaller vec_id.  A component or score beyond a long counts as the nearest long.
    Stages the vectors and what the opening found.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = stage(
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
        .where(F.col("vec_id").isNotNull() & usable(F.col("v")))
        .groupBy("vec_id").agg(F.min(quantised(F.col("v"))).alias("v"))
        .withColumn("d", F.size("v")),
        "topk-vectors",
    )
    is_query = F.pmod("vec_id", F.lit(every)) == 0
    n, n_queries = rows.agg(F.count("*"), F.sum(is_query.cast("int"))).first()
    slices = max(8, -(-n // OPENING))
    cells = max(1, -(-n // CELL_VECTORS), min(partitions(spark), n // LEAST_CELL))
    query_cells = max(1, -(-(n_queries or 0) // CELL_QUERIES))

    opens = F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(slices)) == 0
    held = rows.withColumn("cell", F.when(opens, -1).otherwise(F.pmod(F.xxhash64("vec_id"), F.lit(cells)).cast("int")))
    held = held.withColumn("query_cell", F.explode(F.sequence(F.lit(0), F.lit(query_cells - 1))))
    # named anew, as both sides of a cogroup come from the same rows
    asked = rows.where(is_query).select(*(F.col(c).alias(c) for c in ("vec_id", "v", "d"))).withColumn("query_cell", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(query_cells)).cast("int"))

    first = asked.withColumn("cell", F.lit(-1)).withColumn("bound", F.lit(None).cast("long"))
    opening = stage(_matched(held.where(F.col("cell") < 0), first, k), "topk-opening")
    bounds = opening.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("bound"))
    later = asked.join(bounds.withColumnRenamed("query_id", "vec_id"), "vec_id", "left")
    later = later.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))
    found = opening.unionByName(_matched(held.where(F.col("cell") >= 0), later, k))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Near-duplicate embeddings: exact threshold pairs by a dual traversal of cover trees.

Directions are compared by their angle.  A tree's nodes hold rows, a centre and a
covering radius, the largest angle between centre and rows, measured on all of
them; the separation of the centres halves from level to level.  Two nodes whose
centres are further apart than both radii and the threshold hold no link; two
whose whole extent lies within the threshold are linked row by row without looking
at the rows.  All other node pairs go down a level, and leaves are compared
exactly.

Nodes above ``NODE_ROWS`` are split by Spark, one level a round, and their pairs
traversed as tables; smaller nodes are split and traversed inside one task.  What
leaves a task is one row per linked vector, its number of links and one partner
of its component there, never the pairs themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from math import acos, pi

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netpulse.llm.common import ship_package, stage
from netpulse.llm.components import connected_components
from netpulse.llm.vectors import binary, matrices, matrix_of

THRESHOLD = 0.93
# Rows of a node that one task takes whole, of its leaves, centres of a split, rows they are chosen from.
NODE_ROWS = 2048
LEAF_ROWS = 128
CENTRES = 64
SAMPLE = 256
# Bounds prune and include only beyond this angle, far above the rounding of an arc cosine.
MARGIN = 1e-6
# A node of smaller radius is of one direction: splitting it goes by number.
POINT = 1e-5


def directions(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which rows are not zero, those rows at length 1)."""
    largest = np.abs(matrix).max(axis=1, initial=0.0)
    rows = np.flatnonzero(largest > 0)
    scaled = matrix[rows] / largest[rows, None]
    return rows, scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1.0, 1.0))


def separated(unit: np.ndarray, radius: float, most: int) -> list[int]:
    """Row numbers of at most ``most`` centres, each further than ``radius`` from those before it."""
    chosen: list[int] = []
    free = np.ones(len(unit), bool)
    while len(chosen) < most and free.any():
        chosen.append(int(np.argmax(free)))
        free &= angles(unit, unit[chosen[-1:]])[:, 0] > radius
        free[chosen[-1]] = False
    return chosen


@dataclass
class Node:
    """Rows under a centre, all within ``radius`` of it."""

    rows: np.ndarray
    centre: np.ndarray
    radius: float
    separation: float
    children: list[Node] = field(default_factory=list)


def grow(unit: np.ndarray, rows: np.ndarray, separation: float = pi / 2, leaf_rows: int = LEAF_ROWS) -> Node:
    """The nested levels over ``rows``: covered and uncovered rows of each centre, separations halving."""

    def node(own: np.ndarray, centre: np.ndarray, apart: float) -> Node:
        return Node(own, centre, float(angles(unit[own], centre[None, :]).max()), apart)

    root = node(rows, unit[rows[0]], separation)
    waiting = [root]
    while waiting:
        at = waiting.pop()
        if len(at.rows) <= leaf_rows or at.radius < POINT:
            continue
        apart = min(at.separation, at.radius / 2)
        chosen = at.rows[separated(unit[at.rows], apart, max(2, min(16, 2 * len(at.rows) // leaf_rows)))]
        far = angles(unit[at.rows], unit[chosen])
        nearest, covered = far.argmin(axis=1), far.min(axis=1) <= apart
        for c in range(len(chosen)):
            own, inside = at.rows[nearest == c], covered[nearest == c]
            # a few rows on one side are not worth a node of their own: the radius is measured anyway
            shells = [own[inside], own[~inside]] if len(own) / 8 <= inside.sum() <= len(own) * 7 / 8 else [own]
            at.children += [node(part, unit[chosen[c]], apart / 2) for part in shells]
        waiting += at.children
    return root


class Links:
    """Link counts and components of the rows of one task."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.counts = np.zeros(len(weights), np.int64)
        self.label = np.arange(len(weights))

    def join(self, rows: np.ndarray) -> None:
        own = np.unique(self.label[rows])
        if len(own) > 1:
            self.label[np.isin(self.label, own[1:])] = own[0]

    def whole(self, a: np.ndarray, b: np.ndarray) -> None:
        """All rows of ``a`` are linked with all of ``b``."""
        self.counts[a] += self.weights[b].sum()
        if a is b:
            self.counts[a] -= self.weights[a]
        else:
            self.counts[b] += self.weights[a].sum()
        self.join(np.concatenate([a, b]))

    def some(self, a: np.ndarray, b: np.ndarray, linked: np.ndarray) -> None:
        if a is b:
            np.fill_diagonal(linked, False)
        self.counts[a] += linked @ self.weights[b]
        if a is not b:
            self.counts[b] += linked.T @ self.weights[a]
        i, j = np.nonzero(linked)
        i, j = a[i], b[j]
        while len(i):
            apart = self.label[i] != self.label[j]
            i, j = i[apart], j[apart]
            if len(i):
                self.join(np.array([i[0], j[0]]))


def traverse(unit: np.ndarray, a: Node, b: Node, links: Links, threshold: float) -> None:
    """All links between the rows of two nodes, or within one where both are the same."""
    limit = acos(threshold)
    waiting = [(a, b)]
    while waiting:
        a, b = waiting.pop()
        left, right = (a.children or [a]), (b.children or [b])
        between = angles(np.stack([n.centre for n in left]), np.stack([n.centre for n in right]))
        radii = np.array([n.radius for n in left])[:, None] + np.array([n.radius for n in right])
        for i, j in zip(*np.nonzero(between - radii <= limit + MARGIN)):
            if a is b and j < i:
                continue
            x, y = left[i], right[j]
            if between[i, j] + radii[i, j] <= limit - MARGIN:
                links.whole(x.rows, y.rows)
            elif x.children or y.children:
                waiting.append((x, y))
            else:
                links.some(x.rows, y.rows, unit[x.rows] @ unit[y.rows].T >= threshold)


def node_links(unit: np.ndarray, weights: np.ndarray, second: np.ndarray, threshold: float, leaf_rows: int = LEAF_ROWS) -> Links:
    """Links within the rows, or between the first and the second node's where ``second`` marks some."""
    links = Links(weights)
    if second.any():
        traverse(unit, *(grow(unit, np.flatnonzero(second == side), leaf_rows=leaf_rows) for side in (False, True)), links, threshold)
    else:
        root = grow(unit, np.arange(len(unit)), leaf_rows=leaf_rows)
        traverse(unit, root, root, links, threshold)
    return links


def usable_vectors(vectors: DataFrame, kind: str) -> DataFrame:
    """vec_id, class (the label and the length) and v of the rows that take part in links."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, matrix in matrices(batch.column(2)):
                at = at[directions(matrix)[0]]
                d = matrix.shape[1]
                if len(at):
                    own = matrix[directions(matrix)[0]].astype(kind) + 0.0  # one zero
                    labels = [f"{label}|{d}" for label in batch.column(1).take(pa.array(at)).to_pylist()]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(labels), pa.array(np.full(len(at), d, np.int32)), binary(own)], ["vec_id", "class", "d", "v"])

    rows = vectors.select("vec_id", F.col("label").cast("string").alias("label"), "embedding").where("label IS NOT NULL")
    return rows.mapInArrow(work, "vec_id long, class string, d int, v binary")


def node_pairs_within(pairs: DataFrame, nodes: DataFrame, kind: str, threshold: float) -> DataFrame:
    """``pairs`` (a, b) that may hold links, each with ``whole`` where every two rows are linked."""
    limit = acos(threshold)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            keep = np.zeros(len(frame), np.int8)
            for d, own in frame.groupby("d").indices.items():
                left, right = (directions(matrix_of(batch.column(c).take(pa.array(own)), kind, d))[1] for c in (3, 4))
                between = np.arccos(np.clip((left * right).sum(axis=1), -1.0, 1.0))
                radii = frame["ra"].to_numpy()[own] + frame["rb"].to_numpy()[own]
                keep[own] = (between - radii <= limit + MARGIN).astype(np.int8) + (between + radii <= limit - MARGIN)
            good = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(good), batch.column(1).take(good), pa.array(keep[keep > 0] == 2)], ["a", "b", "whole"])

    left = nodes.select(F.col("node").alias("a"), "d", F.col("centre").alias("ca"), F.col("radius").alias("ra"))
    right = nodes.select(F.col("node").alias("b"), F.col("centre").alias("cb"), F.col("radius").alias("rb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "d", "ca", "cb", "ra", "rb").mapInArrow(judged, "a string, b string, whole boolean")


def chosen_centres(members: DataFrame, large: DataFrame, kind: str, separation: float, node_rows: int) -> DataFrame:
    """(node, parts, centres) of every large node: separated rows out of a sample of ``SAMPLE`` by hash.

    The sample only places the centres; every row is then dealt to its nearest one.
    """

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        first = frame.iloc[0]
        unit = directions(matrix_of(pa.array(frame["v"]), kind, int(first["d"])))[1]
        apart = min(separation, float(first["radius"]) / 2)
        parts = -(-int(first["n"]) // node_rows)
        at = separated(unit, apart, max(2, min(CENTRES, 2 * parts))) if apart >= POINT else [0]
        return pd.DataFrame([(first["node"], parts, apart, b"".join(frame["v"].iloc[i] for i in at))], columns=["node", "parts", "apart", "centres"])

    order = Window.partitionBy("node").orderBy(F.xxhash64("gid"), "gid")
    sample = members.select("node", "gid", "d", "v").join(large.select("node", "n", "radius"), "node").withColumn("at", F.row_number().over(order)).where(F.col("at") <= SAMPLE)
    return sample.groupBy("node").applyInPandas(work, "node string, parts int, apart double, centres binary")


def dealt(members: DataFrame, centres: DataFrame, kind: str) -> DataFrame:
    """``members`` of split nodes in their new nodes: the nearest centre's rows within its separation, and beyond.

    A node's rows come in salted shares, each with the node's centres, so a hot node
    is spread over as many tasks as it has parts.
    """

    def work(rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(own):
            return pd.DataFrame(columns=["gid", "class", "d", "v", "m", "path", "node", "centre", "angle"])
        d, apart, parts = int(rows["d"].iloc[0]), float(own["apart"].iloc[0]), int(own["parts"].iloc[0])
        raw = np.frombuffer(own["centres"].iloc[0], dtype=kind).reshape(-1, d)
        unit = directions(matrix_of(pa.array(rows["v"]), kind, d))[1]
        far = angles(unit, directions(raw)[1])
        nearest, angle = far.argmin(axis=1), far.min(axis=1)
        shell = np.where(angle <= apart, "+", "-")
        if apart < POINT:  # one direction: deal by number, another way on every level
            mixed = (rows["gid"].to_numpy().astype(np.uint64) + np.uint64(len(rows["path"].iloc[0]))) * np.uint64(0x9E3779B97F4A7C15)
            shell = ((mixed >> np.uint64(33)) % np.uint64(2 * parts)).astype(str)
        rows["node"] = [f"{node}/{c}{s}" for node, c, s in zip(rows["node"], nearest, shell)]
        rows["centre"] = [raw[c].tobytes() for c in nearest]
        rows["angle"] = angle
        rows["path"] = [[*path, node] for path, node in zip(rows["path"], rows["node"])]
        return rows.drop(columns=["shares", "salt"])

    shares = centres.select("node", F.col("parts").cast("long").alias("shares"))
    salted = members.join(shares, "node").withColumn("salt", F.pmod(F.xxhash64("gid"), F.col("shares")))
    copies = centres.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1)))
    grouped = salted.groupBy("node", "salt").cogroup(copies.groupBy("node", "salt"))
    return grouped.applyInPandas(work, "gid long, class string, d int, v binary, m long, path array<string>, node string, centre binary, angle double")


def summaries(placed: DataFrame) -> DataFrame:
    return placed.groupBy("node").agg(
        F.count("*").alias("n"), F.sum("m").alias("m"), F.max("angle").alias("radius"), F.min("gid").alias("rep"),
        F.first("centre").alias("centre"), F.first("d").alias("d"),
    )


@dataclass
class Traversal:
    """What the levels leave: rows in their last nodes, all nodes, and the node pairs to compare or to take whole."""

    members: DataFrame
    nodes: DataFrame
    open_pairs: DataFrame
    whole_pairs: list[DataFrame]


def descend(distinct: DataFrame, kind: str, threshold: float, node_rows: int) -> Traversal:
    """Split nodes above ``node_rows`` level by level, and follow the pairs of nodes that the bounds leave."""
    members = distinct.select("gid", "class", "d", "v", "m", F.array("class").alias("path"), F.col("class").alias("node"))
    whole_angle = F.lit(pi)
    nodes = members.withColumns({"angle": whole_angle, "centre": F.col("v")})
    nodes = stage(summaries(nodes), "nodes")
    pairs, settled, seen = nodes.select(F.col("node").alias("a"), F.col("node").alias("b")), [], [nodes]
    separation, wholes = pi / 2, []
    current = nodes
    while current.where(F.col("n") > node_rows).take(1):
        large = current.where(F.col("n") > node_rows)
        centres = stage(chosen_centres(members, large, kind, separation, node_rows), "centres")
        settled.append(members.join(centres.select("node"), "node", "left_anti"))
        placed = stage(dealt(members, centres, kind), "members")
        current = stage(summaries(placed), "nodes")
        # a pair's next ones: the children of both, or the node itself where it was not split
        children = placed.select(F.element_at("path", -2).alias("node"), F.col("node").alias("child")).distinct()
        kept = seen_nodes(seen).join(centres.select("node"), "node", "left_anti").select("node", F.col("node").alias("child"))
        below = stage(children.union(kept), "children")
        seen.append(current)
        down = pairs.join(below.select(F.col("node").alias("a"), F.col("child").alias("x")), "a")
        down = down.join(below.select(F.col("node").alias("b"), F.col("child").alias("y")), "b").where("a <> b OR x <= y")
        moved = down.where("a <> x OR b <> y").select(F.col("x").alias("a"), F.col("y").alias("b"))
        still = down.where("a = x AND b = y").select("a", "b")
        judged = stage(node_pairs_within(moved, seen_nodes(seen), kind, threshold), "node-pairs")
        wholes.append(judged.where("whole").select("a", "b"))
        pairs = stage(judged.where("NOT whole").select("a", "b").union(still), "open-pairs")
        members = placed.select("gid", "class", "d", "v", "m", "path", "node")
        separation /= 2
    return Traversal(reduce(DataFrame.unionByName, settled, members), seen_nodes(seen), pairs, wholes)


def seen_nodes(levels: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, levels)


def compared(found: Traversal, kind: str, threshold: float) -> DataFrame:
    """(gid, links, partner) of rows linked in some open pair of nodes."""

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        unit = directions(matrix_of(pa.array(frame["v"]), kind, int(frame["d"].iloc[0])))[1]
        links = node_links(unit, frame["m"].to_numpy(), frame["side"].to_numpy() == 1, threshold)
        gids, own = frame["gid"].to_numpy(), np.flatnonzero(links.counts)
        return pd.DataFrame({"gid": gids[own], "links": links.counts[own], "partner": gids[links.label[own]]})

    sides = F.array(F.struct(F.col("a").alias("node"), F.lit(0).alias("side")), F.struct(F.col("b").alias("node"), F.lit(1).alias("side")))
    sided = found.open_pairs.select("a", "b", F.explode(F.when(F.col("a") == F.col("b"), F.slice(sides, 1, 1)).otherwise(sides)).alias("s"))
    work_rows = sided.select("a", "b", "s.node", "s.side").join(found.members.select("node", "gid", "d", "v", "m"), "node")
    return work_rows.groupBy("a", "b").applyInPandas(work, "gid long, links long, partner long")


def taken_whole(found: Traversal) -> DataFrame | None:
    """(gid, links, partner) of rows whose node is linked whole with another or with itself."""
    if not found.whole_pairs:
        return None
    pairs = reduce(DataFrame.union, found.whole_pairs)
    both = pairs.select("a", "b").union(pairs.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b")))
    partner = found.nodes.select(F.col("node").alias("b"), F.col("m").alias("added"), F.col("rep").alias("partner"))
    own = found.nodes.select(F.col("node").alias("a"), "rep")
    sides = stage(both.join(partner, "b").join(own, "a").select("a", "added", "partner", "rep", (F.col("a") == F.col("b")).alias("same")), "whole-pairs")
    per_node = sides.groupBy(F.col("a").alias("node")).agg(
        F.sum("added").alias("added"), F.min("partner").alias("partner"), F.max(F.col("same").cast("int")).alias("same")
    )
    rows = found.members.select("gid", "m", F.explode("path").alias("node")).join(per_node, "node")
    rows = rows.select("gid", (F.col("added") - F.when(F.col("same") == 1, F.col("m")).otherwise(0)).alias("links"), "partner")
    return rows.union(sides.select(F.col("rep").alias("gid"), F.lit(0).cast("long").alias("links"), "partner"))


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, node_rows: int = NODE_ROWS) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors of equal, non-null label and equal length are linked where their cosine, in
    double precision, is at least ``threshold`` (0 < threshold < 1).  Vectors that are
    null, empty, zero, or hold null or non-finite components link with nothing:
    ``n_links`` is 0 and ``component_id`` their own vec_id.  Equal vectors of a label are
    links of each other and are carried as one row with a count.  Repeated vec_ids are
    vectors of their own; ``kept`` is true where vec_id is the component's smallest, so
    for every row that repeats it.  A missing vec_id is ignored as a component's
    smallest; where nothing else is reachable, ``component_id`` is null and the row
    kept.  An empty table gives no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    kind = "<f4" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "<f8"
    all_rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    rows = stage(usable_vectors(all_rows, kind), "vectors")
    distinct = rows.groupBy("class", "d", "v").agg(F.count("*").alias("m"), F.min("vec_id").alias("least"))
    distinct = stage(distinct.withColumn("gid", F.monotonically_increasing_id()), "distinct-vectors")
    found = descend(distinct, kind, threshold, node_rows)
    links = compared(found, kind, threshold)
    whole = taken_whole(found)
    links = stage(links if whole is None else links.union(whole), "vector-links")
    components = connected_components(links.select(F.col("gid").alias("a"), F.col("partner").alias("b")))
    per_row = links.groupBy("gid").agg(F.sum("links").alias("links"))
    judged = distinct.join(per_row, "gid", "left").join(components.withColumnRenamed("id", "gid"), "gid", "left")
    judged = judged.select("class", "v", "least", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("component", "gid").alias("component"))
    smallest = judged.groupBy("component").agg(F.min("least").alias("component_id"))
    judged = judged.join(smallest, "component").select("class", "v", "n_links", "component_id")
    linked = rows.join(judged, ["class", "v"]).select("vec_id", "n_links", "component_id")
    rest = left_out(all_rows)
    out = linked.union(rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def left_out(vectors: DataFrame) -> DataFrame:
    """vec_id of the rows that ``usable_vectors`` leaves out."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.ones(batch.num_rows, bool)
            labelled = ~batch.column(1).is_null().to_numpy(zero_copy_only=False)
            for at, matrix in matrices(batch.column(2)):
                at = at[directions(matrix)[0]]
                out[at[labelled[at]]] = False
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.flatnonzero(out)))], ["vec_id"])

    return vectors.select("vec_id", F.col("label").cast("string").alias("label"), "embedding").mapInArrow(work, "vec_id long")

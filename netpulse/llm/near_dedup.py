"""Near-duplicate documents by a chosen-path set similarity join.

Equal shingle sets are first reduced to one representative.  Then independent
trees branch the representatives: the root parts them by one minwise value, and a
part that is still crowded sends each row down ``PATHS`` paths, by the minwise
values at coordinates that the part's own path selects, level by level.  A similar
pair shares a path with a probability equal to its similarity, which makes more
than one shared path a level; the number of trees follows from the probability
that all shared paths end, however deep the trees grow.
Parts up to ``NODE_LIMIT`` rows are compared exhaustively.  Where paths would not
thin a crowded part out, because its rows share most of their shingles, it is
dealt into blocks by size and hash of which every two that can hold a pair meet.
Rows are compared by signatures first, then on their full sets.  Links that
survive are contracted to components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache, partial
from math import comb, log
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netpulse.llm.common import documents_of, grouped_batches, partitions, ship_package, stage, unused
from netpulse.llm.components import connected_components
from netpulse.llm.shingles import COORDINATES, chunked, shingle_sets, summaries

# Least similarity in percent where none is given, rows of a node compared as it is, levels of branching below the root.
SIMILARITY = 85
NODE_LIMIT = 512
LEVELS = 16
# Paths of a row out of a crowded node; rows of a block in units of NODE_LIMIT.
PATHS = 3
BLOCK = 2
# Bits of the filter that keeps texts out of the shuffle (8 MB).
FILTER_BITS = 1 << 26
# Share of the pairs at just the least similarity that may part in all trees, and again that may fall below the cut.
MISS = 3e-7


class Rule(NamedTuple):
    """What follows from the least similarity: trees, and minwise values that a candidate pair shares at least."""

    percent: int
    trees: int
    least_shared: int


def _binomial(n: int, k: int, p: float) -> float:
    return comb(n, k) * p**k * (1 - p) ** (n - k)


def _fixed_point(step: Callable[[float], float]) -> float:
    """The least solution of q = step(q) that is not negative, approached from below."""
    q = 0.0
    for _ in range(20_000):
        q, before = step(q), q
        if q - before < 1e-15:
            break
    return q


def miss_rate(similarity: float, trees: int) -> float:
    """Probability that a pair of this similarity parts in all ``trees``, however deep they grow.

    Of the pair's minwise values a number agrees, and so do some of the trees' roots
    among them.  Below a root, all shared paths of a pair whose values agree at rate p
    end at some depth with probability q, the least solution of q = (1 - p + p q)**PATHS.
    """
    total = 0.0
    for agree in range(COORDINATES + 1):
        p = agree / COORDINATES
        ends = _fixed_point(lambda q: (1 - p + p * q) ** PATHS)
        roots = [comb(agree, g) * comb(COORDINATES - agree, trees - g) / comb(COORDINATES, trees) for g in range(trees + 1)]
        total += _binomial(COORDINATES, agree, similarity) * sum(r * ends**g for g, r in enumerate(roots))
    return total


@cache
def rule_of(percent: int) -> Rule:
    """The fewest trees and the highest cut that each lose at most ``MISS`` of the pairs at ``percent``.

    Similarities too low for that take all coordinates as roots.
    """
    s = percent / 100
    trees = next((t for t in range(1, COORDINATES) if miss_rate(s, t) <= MISS), COORDINATES)
    below, least = 0.0, 0
    while (below := below + _binomial(COORDINATES, least, s)) <= MISS:
        least += 1
    return Rule(percent, trees, least)


def _bytes_of(texts: pd.Series) -> list[bytes]:
    return [t.encode("utf-8", "replace") for t in texts]


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, the set's two fingerprints and its signature, per row of ``docs``."""
    ship_package(docs.sparkSession)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            n, a, b, s = summaries(_bytes_of(frame["text"]))
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "n_shingles": n, "print_a": a, "print_b": b, "signature": s})

    return documents_of(docs).mapInPandas(work, "doc_id long, n_shingles long, print_a long, print_b long, signature binary")


def _value(signature: Column, coordinate: Column) -> Column:
    return F.substring(signature, coordinate * 4 + 1, F.lit(4))


def _counted(rows: DataFrame) -> DataFrame:
    """``rows`` of nodes of two or more, with the node's size and, where crowded, its rows by size class."""
    counts = rows.groupBy("node", "class").agg(F.count(F.lit(1)).alias("c"))
    held = counts.groupBy("node").agg(F.sum("c").alias("size"), F.map_from_entries(F.collect_list(F.struct("class", "c"))).alias("held"))
    kept = held.where("size > 1").withColumn("held", F.when(F.col("size") > NODE_LIMIT, F.col("held")))
    return rows.join(kept, "node")


def _blocks(crowded: DataFrame) -> DataFrame:
    """Rows of crowded nodes, dealt so that every two blocks of the same or neighbouring size classes meet in a node."""

    def number(of: Column) -> Column:
        """Blocks of a size class; classes come as ``held`` counts them."""
        return F.ceil(F.coalesce(F.try_element_at("held", of), F.lit(0)) / (BLOCK * NODE_LIMIT)).cast("long")

    def code(of: Column, block: Column) -> Column:
        return of.cast("long") * (1 << 32) + block

    near = F.filter(F.array(*[F.col("class") + k for k in (-1, 0, 1)]), lambda c: F.try_element_at("held", c).isNotNull())
    others = F.flatten(F.transform(near, lambda c: F.transform(F.sequence(F.lit(0).cast("long"), number(c) - 1), lambda b: code(c, b))))
    dealt = crowded.withColumn("own", code(F.col("class"), F.pmod(F.xxhash64("rep", "node"), number(F.col("class")))))
    met = dealt.withColumn("other", F.explode(others))
    met = met.withColumn("node", F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other")))
    return met.withColumn("side", F.when(F.col("own") == F.col("other"), -1).otherwise((F.col("own") > F.col("other")).cast("int")))


def _paths() -> list[Column]:
    """A row's children of ``node``: minwise values at ``PATHS`` different coordinates that the node selects."""
    first = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(COORDINATES))
    apart = F.pmod(F.xxhash64("node", F.lit(2)), F.lit(COORDINATES // PATHS)) + 1
    at = [F.pmod(first + apart * k, F.lit(COORDINATES)).cast("int") for k in range(PATHS)]
    return [F.xxhash64("node", c, _value(F.col("signature"), c)) for c in at]


def _leaves(members: DataFrame, rule: Rule) -> DataFrame:
    """(node, rep, n, signature, tree, side, branched) of all nodes that are compared exhaustively.

    ``members`` holds rep, n and signature.  ``side`` is -1, or 0 and 1 where only
    rows of different sides are to be compared; ``branched`` has a bit per tree whose
    root node of this row was sent down paths.  Two rows that can reach the least
    similarity have size classes at most one apart.
    """
    columns = ["node", "rep", "n", "signature", "tree", "side"]
    width = 1.0001 * -log(rule.percent / 100)
    members = members.where("n > 0").withColumn("class", F.floor(F.log(F.col("n").cast("double")) / width).cast("int"))
    rooted = members.select("rep", "class", "signature", F.explode(F.sequence(F.lit(0), F.lit(rule.trees - 1))).alias("tree"))
    rooted = rooted.select("tree", "rep", "class", F.xxhash64("tree", _value(F.col("signature"), F.col("tree"))).alias("node"))
    shared = stage(_counted(rooted), "roots")
    rows = stage(shared.join(members.drop("class"), "rep").withColumn("side", F.lit(-1)), "members")
    leaves = rows.where(F.col("size") <= NODE_LIMIT).select(*columns)

    block = BLOCK * NODE_LIMIT
    branched = None
    for _ in range(LEVELS):
        crowded = rows.where(F.col("size") > NODE_LIMIT)
        many = crowded.where(F.col("size") > block)
        if not many.take(1):
            break
        # the rows that blocks make of a child of c rows, against those that they make of the node
        parts = many.select("node", "size", F.explode(F.array(*_paths())).alias("path")).groupBy("node", "size", "path").agg(F.count(F.lit(1)).cast("double").alias("c"))
        cost = F.when(F.col("c") > 1, F.greatest(F.col("c"), F.col("c") * F.col("c") / block)).otherwise(0.0)
        costs = parts.groupBy("node", "size").agg(F.sum(cost).alias("cost"))
        worth = stage(costs.where(F.col("cost") < F.col("size").cast("double") * F.col("size") / block).select("node"), "worth")
        leaves = leaves.unionByName(_blocks(crowded.join(worth, "node", "left_anti")).select(*columns))
        below = many.join(worth, "node", "left_semi").drop("size", "held")
        if branched is None:
            branched = below.groupBy("rep").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("tree"))).alias("branched"))
        rows = stage(_counted(stage(below.withColumn("node", F.explode(F.array(*_paths()))), "branches")), "members")
        leaves = leaves.unionByName(rows.where(F.col("size") <= NODE_LIMIT).select(*columns))
    leaves = leaves.unionByName(_blocks(rows.where(F.col("size") > NODE_LIMIT)).select(*columns))
    if branched is None:
        return leaves.withColumn("branched", F.lit(0).cast("long"))
    return leaves.join(stage(branched, "branched"), "rep", "left").withColumn("branched", F.coalesce("branched", F.lit(0).cast("long")))


def _candidates(c: dict[str, np.ndarray], rule: Rule) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row pairs (i < j) of equal nodes that can reach the least similarity, with the values they share.

    Rows come sorted by node; offset by offset, each row is held against the row
    that stands so far behind it.  A pair that meets in an earlier tree's root counts
    there only, unless that root was branched and the pair may have parted below it.
    """
    node, n, tree, side, values = c["node"], c["n"], c["tree"], c["side"], c["values"]
    sure = (c["branched"][:, None] >> np.arange(rule.trees)) & 1 == 0
    left, right, shared = [], [], []
    at = np.arange(len(node))
    for k in range(1, len(node)):
        at = at[: np.searchsorted(at, len(node) - k)]
        at = at[node[at] == node[at + k]]
        if not len(at):
            break
        i, j = at, at + k
        fits = np.maximum(n[i], n[j]) * rule.percent <= np.minimum(n[i], n[j]) * 100
        fits &= (side[i] < 0) | (side[i] != side[j])
        i, j = i[fits], j[fits]
        same = (values[i] == values[j]).sum(1)
        likely = same >= rule.least_shared
        i, j, same = i[likely], j[likely], same[likely]
        met = (values[i, : rule.trees] == values[j, : rule.trees]) & (np.arange(rule.trees)[None, :] < tree[i][:, None]) & sure[i]
        own = ~met.any(1)
        left.append(i[own])
        right.append(j[own])
        shared.append(same[own])
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(left), np.concatenate(right), np.concatenate(shared)


def _columns(table: pa.Table) -> dict[str, np.ndarray]:
    out = {c: table.column(c).to_numpy() for c in ("node", "rep", "n", "tree", "side", "branched")}
    out["values"] = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint32).reshape(table.num_rows, COORDINATES)
    return out


def _with_candidates(table: pa.Table, rule: Rule) -> pa.Table:
    """The rows that have a candidate pair in their node."""
    i, j, _ = _candidates(_columns(table), rule)
    mask = np.zeros(table.num_rows, bool)
    mask[i], mask[j] = True, True
    return table.filter(pa.array(mask))


def _linked(table: pa.Table, rule: Rule) -> pa.Table:
    """A spanning forest (a, b) of the links that full sets confirm, node by node."""
    c = _columns(table)
    sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
    i, j, shared = _candidates(c, rule)
    order = np.lexsort((-shared, c["node"][i]))
    i, j = i[order], j[order]
    parent = list(range(table.num_rows))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out: list[tuple[int, int]] = []
    cuts = np.flatnonzero(np.diff(c["node"][i])) + 1
    for pi, pj in zip(np.split(i, cuts), np.split(j, cuts)):
        if len(pi) > 1500:
            rows, where = np.unique(np.concatenate([pi, pj]), return_inverse=True)
            both = _intersections([sets[r] for r in rows])[where[: len(pi)], where[len(pi) :]]
        else:
            both = None
        for k, (x, y) in enumerate(zip(pi.tolist(), pj.tolist())):
            rx, ry = root(x), root(y)
            if rx == ry:
                continue
            common = int(both[k]) if both is not None else len(np.intersect1d(sets[x], sets[y], assume_unique=True))
            if 100 * common >= rule.percent * (len(sets[x]) + len(sets[y]) - common):
                parent[rx] = ry
                out.append((int(c["rep"][x]), int(c["rep"][y])))
    return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, exact, from 0/1 matrices of a few thousand shingles at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = often[column] > 1
    owner, column = owner[keep], column[keep]
    both = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for low in range(0, int(column.max(initial=-1)) + 1, 4096):
        a, b = np.searchsorted(column, (low, low + 4096))
        if a == b:
            continue
        dense = np.zeros((len(sets), 4096), np.float32)
        dense[owner[a:b], column[a:b] - low] = 1
        both += dense @ dense.T
    return both


def _by_node(rows: DataFrame, work, schema: str) -> DataFrame:
    dealt = rows.repartition(partitions(rows.sparkSession), "node").sortWithinPartitions("node", "rep")
    return dealt.mapInArrow(lambda batches: grouped_batches(batches, "node", work), schema)


_LEAF = "node long, rep long, n long, signature binary, tree int, side int, branched long"


def near_duplicates(docs: DataFrame, percent: int = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Words are split at ASCII white space with A-Z lowered; sets hold distinct
    5-word shingles, or the whole sequence of a shorter text.  Documents with
    100 * |intersection| >= ``percent`` * |union| are linked, and component_id is the
    smallest doc_id reachable.  Texts without words (null, empty, blank) link with
    nothing.  Rows without doc_id take no part: component_id null, kept.  Rows that
    share a doc_id are one vertex.
    """
    ship_package(docs.sparkSession)
    signed = stage(signatures(docs), "signatures")
    key = ["print_a", "print_b", "n_shingles"]
    groups = signed.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*key).agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature"))
    groups = stage(groups, "groups")
    links = verified_links(docs, groups.select("rep", F.col("n_shingles").alias("n"), "signature"), percent)
    # rows that repeat a doc_id with other texts tie their groups together
    ids = signed.where("n_shingles > 0 AND doc_id IS NOT NULL").select("doc_id", *key).distinct()
    repeated = ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("doc_id")
    ties = ids.join(repeated, "doc_id").join(groups.drop("signature"), key).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    labels = connected_components(links.unionByName(ties))
    named = groups.drop("signature").join(labels, F.col("rep") == F.col("id"), "left").select(*key, F.coalesce("component", "rep").alias("component"))
    joined = signed.drop("signature").join(named, key, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")))
    return joined.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def _likely(rows: DataFrame, needed: DataFrame) -> DataFrame:
    """``rows`` whose doc_id may be among ``needed``: all that are, and few others, judged without a shuffle.

    The ids set bits of a filter of ``FILTER_BITS``; its words are broadcast, at most
    one in 64 bits of them, 16 bytes each, however many ids there are.
    """
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    words = needed.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("__word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % 64).cast("int"))).alias("__bits")
    )
    marked = rows.join(F.broadcast(words), F.shiftright(bit, 6) == F.col("__word"))
    held = F.call_function("shiftrightunsigned", F.col("__bits"), (bit % 64).cast("int")) % 2 != 0
    return marked.where(held).select(*rows.columns)


def verified_links(docs: DataFrame, members: DataFrame, percent: int = SIMILARITY) -> DataFrame:
    """Links (a, b) between representatives that connect every pair found similar; full sets are confirmed."""
    rule = rule_of(percent)
    leaves = stage(_by_node(_leaves(members, rule).select("node", "rep", "n", "signature", "tree", "side", "branched"), partial(_with_candidates, rule=rule), _LEAF), "leaves")
    needed = stage(leaves.select(F.col("rep").alias("doc_id")).distinct(), "needed")
    texts = _likely(documents_of(docs), needed).join(needed, "doc_id", "left_semi")

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sets = []
            for part in chunked(_bytes_of(frame["text"])):
                values, counts = shingle_sets(part)
                sets += [s.tobytes() for s in np.split(values, np.cumsum(counts)[:-1])]
            yield pd.DataFrame({"rep": frame["doc_id"].astype("int64"), "shingles": sets})

    found = texts.mapInPandas(work, "rep long, shingles binary")
    full = leaves.join(found, "rep").where(F.length("shingles") == F.col("n") * 8)
    return stage(_by_node(full.select("node", "rep", "n", "signature", "tree", "side", "branched", "shingles"), partial(_linked, rule=rule), "a long, b long"), "links")


def without_near_copies(docs: DataFrame, percent: int = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, all columns as they were, whatever their names.

    Rows that repeat a doc_id stay or go together; rows without a doc_id, words or text stay.
    """
    name = unused(docs, "dropped_id")
    dropped = near_duplicates(docs, percent).where("NOT kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(dropped, F.col("doc_id").cast("long") == F.col(name), "left_anti")

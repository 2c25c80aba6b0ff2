"""Whitening of embeddings from exact cross-products, counted on bit planes.

Every component becomes a whole number.  Its distance from the column's least
value is cut into bit planes, and each plane is packed across rows into 64-bit
words.  The cross-product of two columns is then the sum, over their planes, of
the number of rows that have both bits, weighted by the planes' powers of two: an
AND and a population count.  Tasks add up such counts, Spark adds up the tasks,
and the driver centres the result as whole numbers before its only division.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netpulse.llm.common import ship_package, stage
from netpulse.llm.vectors import binary, matrices, matrix_of

# Fixed values of the contract: x = floor(SCALE * c) + SHIFT, and the components kept.
SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
# floor(SCALE * c) is held within this, so that x fits a long.
LARGEST = 1 << 62
# Rows packed at once (64 words), bits of a column, bits of the lower half of a sum.
BLOCK = 4096
DIGIT = 24
HALF = 30


def whole_numbers(matrix: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        scaled = np.floor(SCALE * matrix)
    return np.clip(scaled, -float(LARGEST), float(LARGEST)).astype(np.int64) + SHIFT


@dataclass
class Layout:
    """Least and greatest value of each dimension, and how the distances are stored and cut."""

    least: np.ndarray
    most: np.ndarray

    @property
    def dims(self) -> int:
        return len(self.least)

    @property
    def bits(self) -> list[int]:
        return [int(m - l).bit_length() for l, m in zip(self.least.tolist(), self.most.tolist())]

    @property
    def kind(self) -> str:
        """Narrowest unsigned type that holds all distances."""
        widest = max(self.bits)
        return next(k for k, room in (("u1", 8), ("<u2", 16), ("<u4", 32), ("<u8", 64)) if widest <= room)

    @property
    def digits(self) -> list[tuple[int, int, int]]:
        """(dimension, shift, bits) of every column: a distance of more than DIGIT bits takes several."""
        return [(i, s, min(DIGIT, b - s)) for i, b in enumerate(self.bits) for s in range(0, max(b, 1), DIGIT)]

    def distances(self, x: np.ndarray) -> np.ndarray:
        return (x - self.least).astype(self.kind)


def bit_planes(block: np.ndarray, layout: Layout) -> np.ndarray:
    """(planes, words) of a block's rows: the planes of every column in turn, then one of ones."""
    n = len(block)
    words = -(-n // 64)
    wide = block.astype(np.uint64)
    planes = []
    for i, shift, bits in layout.digits:
        column = wide[:, i] >> np.uint64(shift)
        planes += [((column >> np.uint64(p)) & np.uint64(1)).astype(np.uint8) for p in range(bits)]
    planes.append(np.ones(n, np.uint8))
    rows = np.zeros((len(planes), words * 64), np.uint8)
    rows[:, :n] = planes
    return np.packbits(rows, axis=1).view(np.uint64)


def add_cross_products(low: np.ndarray, high: np.ndarray, block: np.ndarray, layout: Layout) -> None:
    """Add a block's cross-products of all columns (and the column of ones) to sums kept in two halves.

    A block's own sums stay below 2**(12 + 2 * DIGIT), so they fit a long.
    """
    widths = [bits for _, _, bits in layout.digits] + [1]
    starts = np.concatenate([[0], np.cumsum(widths)])
    weights = np.concatenate([1 << np.arange(w, dtype=np.int64) for w in widths])
    planes = bit_planes(block, layout)
    filled = [c for c, w in enumerate(widths) if w]
    for at, i in enumerate(filled):
        rest = filled[at:]
        total = np.zeros(len(rest), np.int64)
        for p in range(widths[i]):
            shared = np.bitwise_count(planes[starts[i] + p] & planes[starts[i] :]).sum(axis=1, dtype=np.int64)
            total += np.add.reduceat(shared * weights[starts[i] :], starts[rest] - starts[i]) << p
        low[i, rest] += total & ((1 << HALF) - 1)
        high[i, rest] += total >> HALF


@dataclass
class Whitener:
    """What the rows need: the layout, n, sums S of x, components (dims x k), their eigenvalues and shares."""

    layout: Layout
    n: int
    sums: list[int]  # of distances
    vectors: np.ndarray
    values: np.ndarray
    shares: np.ndarray

    def centred(self, distances: np.ndarray) -> np.ndarray:
        """n times the distance from the mean, exact: longs where they fit, Python integers elsewhere."""
        room = max(self.layout.bits) + self.n.bit_length() + 1
        kind = np.int64 if room < 63 else object
        return distances.astype(kind) * self.n - np.array(self.sums, dtype=kind)

    def deviations(self, centred: np.ndarray) -> list[int]:
        if centred.dtype != object and centred.shape[1] * (int(np.abs(centred).max(initial=0)) ** 2) < 2**63:
            return (centred * centred).sum(axis=1).tolist()
        return [sum(int(v) ** 2 for v in row) for row in centred]

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(np.float64) @ self.vectors / np.sqrt(self.values)


def principal(layout: Layout, cross: dict[tuple[int, int], int], components: int) -> Whitener | None:
    """Centre the cross-products as whole numbers, divide once, and take the leading eigenvectors."""
    digits, d = layout.digits, layout.dims
    ones = len(digits)
    n = cross.get((ones, ones), 0)
    if not n or not d:
        return None
    sums = [0] * d
    products = [[0] * d for _ in range(d)]
    for (a, b), value in cross.items():
        if a == ones:
            continue
        i, s, _ = digits[a]
        if b == ones:
            sums[i] += value << s
            continue
        j, t, _ = digits[b]
        value <<= s + t
        products[i][j] += value
        if a != b:
            products[j][i] += value
    spread = np.array([[(n * products[i][j] - sums[i] * sums[j]) / (n * n) for j in range(d)] for i in range(d)])
    values, vectors = np.linalg.eigh(spread)
    order = np.argsort(values)[::-1][:components]
    order = order[values[order] > d * np.finfo(float).eps * max(values.max(), 0.0)]
    return Whitener(layout, n, sums, vectors[:, order], values[order], values[order] / np.trace(spread))


def layout_of(rows: DataFrame) -> Layout | None:
    """Ranges of the dimensions, over the usable vectors of the commonest length (ties: the longest)."""

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            for at, matrix in matrices(batch.column(0)):
                if len(at) and matrix.shape[1]:
                    x = whole_numbers(matrix)
                    own = found.setdefault(x.shape[1], [x.min(axis=0), x.max(axis=0), 0])
                    own[:] = np.minimum(own[0], x.min(axis=0)), np.maximum(own[1], x.max(axis=0)), own[2] + len(x)
        for d, (least, most, n) in found.items():
            yield pa.RecordBatch.from_pydict({"d": [d] * d, "at": list(range(d)), "least": least, "most": most, "n": [n] * d}, SPANS)

    spans = rows.select("embedding").mapInArrow(ranges, "d int, at int, least long, most long, n long")
    spans = stage(spans.groupBy("d", "at").agg(F.min("least").alias("least"), F.max("most").alias("most"), F.sum("n").alias("n")), "spans")
    commonest = spans.where("at = 0").orderBy(F.desc("n"), F.desc("d")).first()
    if commonest is None:
        return None
    own = sorted(spans.where(F.col("d") == commonest["d"]).collect(), key=lambda r: r["at"])
    return Layout(np.array([r["least"] for r in own]), np.array([r["most"] for r in own]))


SPANS = pa.schema([("d", pa.int32()), ("at", pa.int32()), ("least", pa.int64()), ("most", pa.int64()), ("n", pa.int64())])
CROSS = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("low", pa.int64()), ("high", pa.int64())])


def distinct_distances(rows: DataFrame, layout: Layout) -> DataFrame:
    """The fit list: each distinct x vector once, as its packed distances."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, matrix in matrices(batch.column(0)):
                if len(matrix) and matrix.shape[1] == layout.dims:
                    yield pa.RecordBatch.from_arrays([binary(layout.distances(whole_numbers(matrix)))], ["x"])

    return rows.select("embedding").mapInArrow(packed, "x binary").distinct()


def cross_products(fit: DataFrame, layout: Layout) -> dict[tuple[int, int], int]:
    """Exact cross-products of all columns over the fit list; a column of ones gives sums and the number of rows."""
    columns = len(layout.digits) + 1

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.zeros((columns, columns), np.int64), np.zeros((columns, columns), np.int64)
        for batch in batches:
            x = matrix_of(batch.column(0), layout.kind, layout.dims)
            for at in range(0, len(x), BLOCK):
                add_cross_products(low, high, x[at : at + BLOCK], layout)
        i, j = np.nonzero(low | high)
        for at in range(0, len(i), 1 << 16):
            a, b = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(low[a, b]), pa.array(high[a, b])], schema=CROSS)

    parts = fit.mapInArrow(counted, "i int, j int, low long, high long")
    totals = parts.groupBy("i", "j").agg(F.sum("low").alias("low"), F.sum("high").alias("high")).collect()
    return {(r["i"], r["j"]): (r["high"] << HALF) + r["low"] for r in totals}


def identity_error(fit: DataFrame, model: Whitener) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity."""
    k = len(model.values)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            w = model.whitened(model.centred(matrix_of(batch.column(0), model.layout.kind, model.layout.dims)))
            w = np.hstack([w, np.ones((len(w), 1))])
            total += w.T @ w
        yield pa.RecordBatch.from_pydict({"at": np.arange(total.size), "value": total.ravel()})

    sums = fit.mapInArrow(moments, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    total = np.zeros((k + 1) ** 2)
    total[[r["at"] for r in sums]] = [r["value"] for r in sums]
    total = total.reshape(k + 1, k + 1) / model.n
    return float(np.abs(total[:k, :k] - np.outer(total[:k, k], total[:k, k]) - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null, hold null or non-finite entries, are empty, or differ from
    the commonest length (ties: the longest) give no rows.  Rows that repeat a vec_id or
    lack one give rows of their own; equal x vectors count once in the fit.  Components
    without variance are left out, so a table of one distinct vector, or an empty one,
    gives no rows.  ``deviation`` is decimal(38, 0), exact.  Other columns are not read.
    Entries beyond 2**62 / 64 are taken as that.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    layout = layout_of(rows)
    fit = stage(distinct_distances(rows, layout), "fit-list") if layout else None
    model = principal(layout, cross_products(fit, layout), components) if layout else None
    if model is None or not len(model.values):
        return spark.createDataFrame([], schema)
    error, k = identity_error(fit, model), len(model.values)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, matrix in matrices(batch.column(1)):
                if not len(at) or matrix.shape[1] != model.layout.dims:
                    continue
                centred = model.centred(model.layout.distances(whole_numbers(matrix)))
                far = [Decimal(v) if v < 10**38 else None for v in model.deviations(centred)]
                m = len(at) * k
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(np.repeat(at, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                        pa.array(np.full(m, model.n)), pa.array(far, pa.decimal128(38, 0)).take(pa.array(np.repeat(np.arange(len(at)), k))),
                        pa.array(model.whitened(centred).ravel()), pa.array(np.tile(model.shares, len(at))), pa.array(np.full(m, error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(projected, schema)

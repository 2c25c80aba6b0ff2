"""Exact global positions, running totals, cuts and order statistics without a one-task sort.

A window without PARTITION BY moves every row into one task.  These helpers get
the same answers from Spark's range partitioning, or from a few narrow
aggregations whose results are bounded, whatever the data size or skew.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from netpulse.session import stage

SLICE, OFFSET = "__slice", "__offset"

BINS_PER_E = 1000  # value bins per factor e
FINE_BINS = 4096  # parts into which a bin that holds a wanted rank is cut


def total_order(df: DataFrame, *order: Column) -> list[Column]:
    """``order``, then all columns by name, so that only equal rows tie."""
    return [*order, *[F.asc_nulls_last(name) for name in sorted(df.columns)]]


def stage_in_order(df: DataFrame, *order: Column) -> DataFrame:
    """Range-sort ``df`` and store it with each row's slice and offset inside it.

    Slices follow each other in the given order.  A hot value of the first key
    is split by the later ones, so the order should be total.  The positions
    are written with the rows: later passes cannot see another partitioning,
    whatever is recomputed.
    """
    place = F.monotonically_increasing_id()
    placed = df.orderBy(*order).withColumn("__place", place)
    return stage(placed, "ordered").select(
        *df.columns,
        F.shiftright("__place", 33).cast("int").alias(SLICE),
        F.col("__place").bitwiseAND((1 << 33) - 1).alias(OFFSET),
    )


def _before_each_slice(placed: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Per-slice totals of everything in earlier slices: one row per slice."""
    per_slice = placed.groupBy(SLICE).agg(*[column.alias(name) for name, column in totals.items()])
    earlier = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return per_slice.select(
        SLICE, *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"__before_{name}") for name in totals]
    )


def with_rank(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """1..N in the given total order."""
    placed = stage_in_order(df, *order)
    before = _before_each_slice(placed, {"n": F.count(F.lit(1))})
    return placed.join(F.broadcast(before), SLICE).select(
        *df.columns, (F.col("__before_n") + F.col(OFFSET) + 1).cast("bigint").alias(name)
    )


def with_running_sums(df: DataFrame, sums: dict[str, str], *order: Column) -> DataFrame:
    """Add ``{new column: summed column}`` running totals, the current row included."""
    placed = stage_in_order(df, *order)
    before = _before_each_slice(placed, {source: F.sum(source) for source in sums.values()})
    so_far = Window.partitionBy(SLICE).orderBy(OFFSET).rowsBetween(Window.unboundedPreceding, 0)
    return placed.join(F.broadcast(before), SLICE).select(
        *df.columns,
        *[
            (F.col(f"__before_{source}") + F.sum(source).over(so_far)).alias(name)
            for name, source in sums.items()
        ],
    )


def _literal(value: str, data_type: T.DataType) -> Column:
    return F.lit(value).cast(data_type)


def _group_holding(df: DataFrame, key: Column, position: int) -> tuple[str, int, int] | None:
    """The key group holding 0-based ``position``: (key, rows before it, rows in it)."""
    counts = df.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.orderBy(F.asc_nulls_first("key")).rowsBetween(Window.unboundedPreceding, 0)
    found = (
        counts.withColumn("upto", F.sum("n").over(upto))
        .filter(F.col("upto") > position)
        .orderBy("upto").limit(1)
        .select(F.col("key").cast("string").alias("key"), (F.col("upto") - F.col("n")).alias("before"), "n")
        .collect()
    )
    return (found[0]["key"], found[0]["before"], found[0]["n"]) if found else None


def first_rows(df: DataFrame, n: int, ts: str, ties: list[str]) -> Column:
    """Condition that holds for exactly the first ``n`` rows by (``ts``, ``ties``).

    The cut is located by ever finer histograms: hours, seconds of one hour,
    instants of one second, then tie values of one instant.  Each histogram is
    pre-aggregated and bounded by its own grain, so hot instants do no harm,
    and the result is a comparison with literals: no shuffle, and it can be
    pushed into the scan.  Rows equal in every key cannot be told apart and
    must not straddle the cut; ``ValueError`` asks for one more tie column.

    Runs a few small jobs over the key columns: pass a stored frame.
    """
    ts_type = df.schema[ts].dataType
    inside, left = df, n
    cut = None
    for grain in ("hour", "second", None):
        key = F.date_trunc(grain, ts).cast(ts_type) if grain else F.col(ts)
        group = _group_holding(inside, key, left)
        if group is None:
            return F.lit(True)
        cut, left = _literal(group[0], ts_type), left - group[1]
        if left == 0:
            return F.col(ts) < cut
        inside = inside.filter(key == cut)
    chosen = F.col(ts) < cut
    equal = F.col(ts) == cut
    for tie in ties:
        group = _group_holding(inside, F.col(tie), left)
        value, left = _literal(group[0], df.schema[tie].dataType), left - group[1]
        smaller = F.col(tie).isNull() & value.isNotNull() | (F.col(tie) < value)
        chosen = chosen | (equal & F.coalesce(smaller, F.lit(False)))
        same = F.col(tie).eqNullSafe(value)
        equal, inside = equal & same, inside.filter(same)
        if left == 0:
            return chosen
    raise ValueError(f"rows equal in {[ts, *ties]} straddle the cut; add a tie column")


def _bin(value: Column) -> Column:
    """Monotone integer bins of constant relative width, so no extremes need to be known first."""
    size = F.floor(F.least(F.log(F.abs(value)), F.lit(750.0)) * BINS_PER_E) + 800 * BINS_PER_E
    return F.when(value == 0, F.lit(0)).otherwise(F.signum(value) * size).cast("bigint")


def _melted(df: DataFrame, columns: list[str]) -> DataFrame:
    """(place of the column, bin, value), missing values left out."""
    cells = [F.struct(F.lit(i).alias("k"), F.col(name).cast("double").alias("v")) for i, name in enumerate(columns)]
    present = df.select(F.inline(F.array(*cells))).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    return present.select("k", _bin(F.col("v")).alias("bin"), "v")


def _ranks(fraction: float, n: int, interpolate: bool) -> list[int]:
    """1-based ranks whose values make up a percentile: one, or two neighbours."""
    if not interpolate:
        return [max(1, math.ceil(fraction * n))]
    lower = math.floor(fraction * (n - 1)) + 1
    return [lower, min(lower + 1, n)]


@dataclass(frozen=True)
class _Held:
    """The values of a column that lie in [low, high]; ``before`` of the column's values are smaller."""

    k: int
    low: float
    high: float
    before: int


def _coarse(df: DataFrame, columns: list[str]) -> DataFrame:
    """(k, bin, held, low, high, before, n): the bins of every column, in order."""
    upto = Window.partitionBy("k").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    return _melted(df, columns).groupBy("k", "bin").agg(
        F.count(F.lit(1)).alias("held"), F.min("v").alias("low"), F.max("v").alias("high")
    ).withColumns({"before": F.coalesce(F.sum("held").over(upto), F.lit(0)), "n": F.sum("held").over(Window.partitionBy("k"))})


def _finer(df: DataFrame, columns: list[str], opened: list[_Held]) -> DataFrame:
    """(at, bin, held, low, high, before): the parts of the ``opened`` intervals, in order.

    An interval is cut into parts of equal width, which keeps the values' order, so
    its range shrinks by ``FINE_BINS`` and only counts per part are ever gathered.
    """
    cells = []
    for i, h in enumerate(opened):
        v = F.col(columns[h.k]).cast("double")
        inside = v.between(h.low, h.high) & ~F.isnan(v)
        part = F.least(F.floor((v - h.low) / F.lit(h.high - h.low) * FINE_BINS), F.lit(FINE_BINS - 1))
        cells.append(F.when(inside, F.struct(F.lit(i).alias("at"), part.cast("int").alias("bin"), v.alias("v"))))
    present = df.select(F.explode(F.filter(F.array(*cells), lambda c: c.isNotNull())).alias("c")).select("c.*")
    upto = Window.partitionBy("at").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    return present.groupBy("at", "bin").agg(
        F.count(F.lit(1)).alias("held"), F.min("v").alias("low"), F.max("v").alias("high")
    ).withColumn("before", F.coalesce(F.sum("held").over(upto), F.lit(0)))


def _holding(ranks: dict[int, list[int]], key: str) -> Column:
    """Rows of a counted frame that hold one of a key's ranks."""
    held = [
        (F.col(key) == k) & reduce(or_, [(F.col("before") < r) & (F.col("before") + F.col("held") >= r) for r in own])
        for k, own in ranks.items()
    ]
    return reduce(or_, held)


def exact_percentiles(
    df: DataFrame, columns: list[str], fractions: list[float], interpolate: bool = False
) -> DataFrame:
    """Exact percentiles of several columns: one row per column, (column, n, values).

    Without interpolation a percentile is the smallest value whose cumulative
    share reaches the fraction; with it, linear between neighbouring ranks.
    NULL and NaN are left out; a column without values has no row.

    A selection by repeated refinement: counts per bin of constant relative width
    tell which bins hold the wanted ranks; those are cut finer, again and again, until
    each holds one value.  Every pass combines map-side and gathers counts per bin only,
    however the values lie; the bins that hold a rank reach the driver.

    Runs a few jobs over the columns: pass a stored frame.
    """
    spark = df.sparkSession
    schema = "column string, n bigint, values array<double>"
    coarse = stage(_coarse(df, columns), "bins")
    sizes = {r["k"]: r["n"] for r in coarse.groupBy("k").agg(F.max("n").alias("n")).collect()}
    if not sizes:
        return spark.createDataFrame([], schema)
    wanted = {k: [r for f in fractions for r in _ranks(f, n, interpolate)] for k, n in sizes.items()}
    values: dict[tuple[int, int], float] = {}

    def placed(rows: list, opened: list[_Held] | None) -> dict[_Held, list[int]]:
        """Note the ranks that are settled; the intervals of the others with their ranks inside."""
        left: dict[_Held, list[int]] = {}
        for row in rows:
            k, before = (row["k"], row["before"]) if opened is None else (opened[row["at"]].k, opened[row["at"]].before + row["before"])
            for rank in set(wanted[k]):
                if before < rank <= before + row["held"]:
                    if row["low"] == row["high"]:
                        values[k, rank] = row["low"]
                    else:
                        left.setdefault(_Held(k, row["low"], row["high"], before), []).append(rank)
        return left

    left = placed(coarse.where(_holding(wanted, "k")).collect(), None)
    while left:
        opened = list(left)
        ranks = {i: [r - h.before for r in left[h]] for i, h in enumerate(opened)}
        left = placed(_finer(df, columns, opened).where(_holding(ranks, "at")).collect(), opened)

    def percentile(k: int, fraction: float) -> float:
        own = [values[k, r] for r in _ranks(fraction, sizes[k], interpolate)]
        position = fraction * (sizes[k] - 1)
        return own[0] if len(own) == 1 else own[0] + (own[1] - own[0]) * (position - math.floor(position))

    found = [(columns[k], n, [percentile(k, f) for f in fractions]) for k, n in sorted(sizes.items())]
    return spark.createDataFrame(found, schema)

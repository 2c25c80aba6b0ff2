"""Exact positions, running sums, cuts and percentiles, hot values included."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from netpulse.operators import ordering, targets
from netpulse.session import stage


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one score; half of those also share one timestamp."""
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        hot = i % 3 == 0
        rows.append((i, 0.5 if hot else rng.random(), 0 if hot and i % 2 else i, i % 5))
    return spark.createDataFrame(rows, "id long, score double, t long, n long").repartition(7)


def test_rank_equals_a_global_window(skewed):
    order = [F.desc("score"), F.asc("t"), F.asc("id")]
    got = {r["id"]: r["rank"] for r in ordering.with_rank(skewed, "rank", *order).collect()}
    want = {r["id"]: r["rank"] for r in skewed.withColumn("rank", F.row_number().over(Window.orderBy(*order))).collect()}
    assert got == want


def test_hot_values_are_spread_over_slices(spark, skewed):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = ordering.stage_in_order(skewed, F.desc("score"), F.asc("t"), F.asc("id"))
        sizes = [r["count"] for r in placed.groupBy(ordering.SLICE).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(sizes) >= 3 and max(sizes) < 0.6 * sum(sizes)


def test_running_sums_equal_a_global_window(skewed):
    order = [F.desc("score"), F.asc("t"), F.asc("id")]
    got = {r["id"]: r["total"] for r in ordering.with_running_sums(skewed, {"total": "n"}, *order).collect()}
    window = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    want = {r["id"]: r["total"] for r in skewed.withColumn("total", F.sum("n").over(window)).collect()}
    assert got == want


@pytest.mark.parametrize("fractions", [[0.0, 0.25, 0.5, 0.75, 0.99, 1.0]])
def test_percentiles_match_numpy(spark, fractions):
    rng = np.random.default_rng(3)
    data = np.concatenate([rng.normal(0, 1e-3, 500), np.full(400, 7.25), rng.lognormal(3, 4, 300), [-1e9, 1e12, 0.0]])
    other = np.concatenate([rng.integers(-5, 5, 700).astype(float), np.full(503, np.nan)])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(data, other)], "a double, b double").repartition(5)
    for interpolate, method in ((True, "linear"), (False, "inverted_cdf")):
        got = {r["column"]: r for r in ordering.exact_percentiles(df, ["a", "b"], fractions, interpolate).collect()}
        for name, values in (("a", data), ("b", other[~np.isnan(other)])):
            assert got[name]["n"] == len(values)
            np.testing.assert_allclose(got[name]["values"], np.quantile(values, fractions, method=method), rtol=1e-12)


def test_percentile_of_one_and_of_no_value(spark):
    df = spark.createDataFrame([(5.0, None)], "a double, b double")
    rows = ordering.exact_percentiles(df, ["a", "b"], [0.5], interpolate=True).collect()
    assert [(r["column"], r["values"]) for r in rows] == [("a", [5.0])]


def frame(spark, rows):
    return spark.createDataFrame(rows, "t string, cell_id string, v int").select(
        F.col("t").cast("timestamp_ntz").alias("timestamp"), "cell_id", "v"
    )


@pytest.mark.parametrize("fraction", [0.1, 0.35, 0.5, 0.8, 0.99, 1.0])
def test_split_is_exact_with_heavy_ties(spark, fraction):
    rng = random.Random(1)
    # Most rows share one instant; fractions of a second and repeated cells too.
    rows = [("2024-01-01 10:00:00" if rng.random() < 0.6 else f"2024-01-0{rng.randint(1, 3)} 1{rng.randint(0, 2)}:00:0{rng.randint(0, 9)}.{rng.randint(0, 3)}",
             f"CELL_{rng.randint(0, 9):04d}", i) for i in range(500)]
    split = targets.time_split(frame(spark, rows), fraction)
    marked = [(r["timestamp"], r["cell_id"], r["v"], r["split"]) for r in split.collect()]
    cut = int(500 * fraction)
    assert [m[3] for m in sorted(marked)] == ["train"] * cut + ["test"] * (500 - cut)


def test_indistinguishable_rows_at_the_cut_are_refused(spark):
    df = frame(spark, [("2024-01-01 10:00:00", "CELL_0001", 1)] * 10)
    with pytest.raises(ValueError, match="tie column"):
        targets.time_split(df, 0.5)


def test_split_plan_has_no_shuffle(spark):
    df = frame(spark, [(f"2024-01-01 10:00:0{i}", "CELL_0001", i) for i in range(10)])
    plan = targets.time_split(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_percentiles_of_crowded_values(spark, monkeypatch):
    """A million distinct values inside one percent of the range: no pass gathers more than its parts."""
    sizes, real = [], ordering._finer
    monkeypatch.setattr(ordering, "_finer", lambda *a: sizes.append(real(*a).count()) or real(*a))
    n = 1_000_000
    df = spark.range(n).select((F.lit(1000.0) + F.col("id") / n * 10).alias("v"), F.when(F.col("id") < 3, F.col("id") * 1e300 - 1e300).alias("w"))
    df = stage(df.union(spark.createDataFrame([(0.0, float("nan")), (2000.0, None)], "v double, w double")))
    found = {r["column"]: r for r in ordering.exact_percentiles(df, ["v", "w"], [0.25, 0.5, 1.0]).collect()}
    values = sorted([1000.0 + i / n * 10 for i in range(n)] + [0.0, 2000.0])
    assert found["v"]["values"] == [values[math.ceil(f * len(values)) - 1] for f in (0.25, 0.5, 1.0)]
    assert (found["w"]["n"], found["w"]["values"]) == (3, [-1e300, 0.0, 1e300])
    assert sizes and max(sizes) <= 2 * ordering.FINE_BINS


def test_percentiles_of_extreme_and_tied_values(spark):
    values = [5e-324, -1.7e308, 1.7e308, 0.0, -0.0, 1.0, 1.0 + 2**-52, 1.0 + 2**-51, 1.0, -5e-324, 1e-320, 1e-320 + 5e-324] * 3
    df = spark.createDataFrame([(v,) for v in values], "v double")
    fractions = [0.0, 0.1, 0.3, 0.5, 0.7, 0.9, 1.0]
    expected = [sorted(values)[max(1, math.ceil(f * len(values))) - 1] for f in fractions]
    assert ordering.exact_percentiles(df, ["v"], fractions).first()["values"] == expected
    assert ordering.exact_percentiles(df.limit(0), ["v"], fractions).collect() == []

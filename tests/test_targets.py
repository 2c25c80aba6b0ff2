"""Future-failure targets against plain windows, on skewed and tied histories."""

import random
from contextlib import contextmanager

import pytest
from pyspark.sql import Window, functions as F

from netpulse.operators import targets


def history(spark, seed=5, rows=1500):
    """One cell holds most rows; timestamps repeat and have gaps longer than a slot."""
    rng = random.Random(seed)
    data = []
    for i in range(rows):
        cell = "CELL_0001" if rng.random() < 0.7 else f"CELL_{rng.randint(2, 6):04d}"
        second = rng.choice([rng.randint(0, 7200), rng.randint(0, 400_000), 3600 * rng.randint(0, 50)])
        data.append((second, cell, int(rng.random() < 0.08), float(i)))
    df = spark.createDataFrame(data, "s long, cell_id string, failure_event int, latency_ms double")
    return df.select(F.timestamp_seconds("s").alias("timestamp"), "cell_id", "failure_event", "latency_ms")


def as_rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def many_slices(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("n, parts", [(1, 1), (6, 4), (6, 7), (40, 13)])
def test_next_rows(spark, many_slices, n, parts):
    df = history(spark)
    window = Window.partitionBy("cell_id").orderBy("timestamp", "latency_ms").rowsBetween(1, n)
    want = df.withColumn("target", F.max("failure_event").over(window))
    with shuffled(spark, parts):
        assert as_rows(targets.future_failure_rows(df, n, "target")) == as_rows(want)


@pytest.mark.parametrize("sec, parts", [(1800, 1), (1800, 4), (1800, 13), (1, 7)])
def test_next_seconds(spark, many_slices, sec, parts):
    df = history(spark, 9)
    window = Window.partitionBy("cell_id").orderBy(F.unix_timestamp("timestamp")).rangeBetween(1, sec)
    want = df.withColumn("target", F.max("failure_event").over(window))
    with shuffled(spark, parts):
        assert as_rows(targets.future_failure_range(df, sec, "target")) == as_rows(want)


@contextmanager
def shuffled(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hot_cell_and_hot_second_are_spread(spark, many_slices):
    """One cell holds 40 percent of the rows, half of them in one second: no slice holds much more than its share."""
    rows = [(0 if i % 2 else i, "CELL_0001" if i % 5 < 2 else f"CELL_{i % 997:04d}", int(i % 11 == 0), float(i)) for i in range(20_000)]
    df = spark.createDataFrame(rows, "s long, cell_id string, failure_event int, latency_ms double")
    df = df.select(F.timestamp_seconds("s").alias("timestamp"), "cell_id", "failure_event", "latency_ms")
    with shuffled(spark, 10):
        placed = targets.stage_in_order(df, *targets._latest_first(df, ["latency_ms"]))
        sizes = [r["count"] for r in placed.groupBy(targets.SLICE).count().collect()]
        assert len(sizes) == 10 and max(sizes) < 1.5 * sum(sizes) / len(sizes)
        window = Window.partitionBy("cell_id").orderBy("timestamp", "latency_ms").rowsBetween(1, 6)
        want = df.withColumn("target", F.max("failure_event").over(window))
        assert as_rows(targets.future_failure_rows(df, 6, "target")) == as_rows(want)


def test_tied_observations_follow_their_columns(spark, many_slices):
    """Rows of one instant, equal in every tie column: the other columns order them, for any partitioning."""
    rows = [(0, "A", int(i == 3), 5.0, f"s{i}") for i in range(9)] + [(0, "A", 0, 5.0, "s0")]
    df = spark.createDataFrame(rows, "s long, cell_id string, failure_event int, latency_ms double, site_id string")
    df = df.select(F.timestamp_seconds("s").alias("timestamp"), "cell_id", "failure_event", "latency_ms", "site_id")
    found = set()
    for parts in (1, 4, 7):
        with shuffled(spark, parts):
            found.add(tuple(as_rows(targets.future_failure_rows(df.repartition(parts), 2, "target"))))
    assert len(found) == 1


def test_missing_cells_and_instants(spark):
    df = spark.createDataFrame([(None, "A", 1), (5, None, 0), (6, None, 1), (7, "A", 0)], "s long, cell_id string, failure_event int")
    df = df.select(F.timestamp_seconds("s").alias("timestamp"), "cell_id", "failure_event")
    got = {(r["cell_id"], r["failure_event"]): r["y"] for r in targets.future_failure_range(df, name="y").collect()}
    assert got == {("A", 1): None, (None, 0): 1, (None, 1): None, ("A", 0): None}
    got = {(r["cell_id"], r["failure_event"]): r["y"] for r in targets.future_failure_rows(df, name="y").collect()}
    assert got == {("A", 1): 0, (None, 0): 1, (None, 1): None, ("A", 0): None}


def small(spark, rows):
    return spark.createDataFrame(rows, "t string, cell_id string, failure_event int").select(
        F.col("t").cast("timestamp").alias("timestamp"), "cell_id", "failure_event"
    )


def test_own_failure_is_not_seen_and_the_last_row_is_unknown(spark):
    df = small(spark, [("2024-01-01 00:00:00", "A", 1), ("2024-01-01 00:05:00", "A", 0)])
    got = [r[-1] for r in targets.future_failure_rows(df, name="y").orderBy("timestamp").collect()]
    assert got == [0, None]


def test_same_second_does_not_count_in_the_range_target(spark):
    df = small(spark, [("2024-01-01 00:00:00", "A", 0), ("2024-01-01 00:00:00", "A", 1), ("2024-01-01 00:30:00", "A", 0),
                       ("2024-01-01 01:00:01", "A", 1)])
    got = [(str(r["timestamp"])[11:], r["failure_event"], r["y"]) for r in
           targets.future_failure_range(df, name="y").orderBy("timestamp", "failure_event").collect()]
    assert got == [("00:00:00", 0, 0), ("00:00:00", 1, 0), ("00:30:00", 0, None), ("01:00:01", 1, None)]


def test_failing_rows_are_dropped_only_after_the_target_is_known(spark):
    df = small(spark, [("2024-01-01 00:00:00", "A", 0), ("2024-01-01 00:05:00", "A", 1), ("2024-01-01 00:10:00", "A", 0)])
    known = targets.future_failure_rows(df).filter("failure_next_30m is not null and failure_event = 0")
    assert [r["failure_next_30m"] for r in known.collect()] == [1]
    early = targets.future_failure_rows(df.filter("failure_event = 0")).filter("failure_next_30m is not null")
    assert [r["failure_next_30m"] for r in early.collect()] == [0]


def test_pos_weight_without_positives(spark):
    df = spark.createDataFrame([(0,), (0,)], "failure_next_30m int")
    assert targets.pos_weight(df).first()["scale_pos_weight"] == 2.0

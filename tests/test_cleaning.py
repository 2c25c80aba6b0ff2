"""Cleaning contracts on small literal frames."""

import math

from pyspark.sql import Row, functions as F

from netpulse import functions as fn
from netpulse.operators import cleaning, quality
from netpulse.sources.telemetry import RAW_SCHEMA

GOOD = dict(
    timestamp="2024-01-01 06:00:00", cell_id="CELL_0001", site_id="SITE_0001", region=" HOUSTON",
    signal_strength_dbm=-80.0, sinr_db=10.0, latency_ms=50.0, packet_loss_pct=0.5, throughput_mbps=100.0,
    connected_users=10, traffic_load_pct=50.0, cpu_utilization_pct=40.0, alarm_count=1, failure_event=0,
)


def raw(spark, *changes):
    rows = [Row(**{**GOOD, **change}) for change in changes]
    return spark.createDataFrame([tuple(r[f] for f in RAW_SCHEMA.fieldNames()) for r in rows], RAW_SCHEMA)


def values(df, name):
    return [row[name] for row in df.select(name).collect()]


def test_unparseable_timestamp_is_dropped_not_an_error(spark):
    df = raw(spark, {}, {"timestamp": "garbage"}, {"timestamp": None})
    assert cleaning.valid_rows(df).count() == 1
    assert quality.quality_funnel(df).first()["invalid_timestamps"] == 2


def test_missing_kpi_is_neither_invalid_nor_kept(spark):
    df = raw(spark, {}, {"latency_ms": None}, {"latency_ms": None, "throughput_mbps": -1.0}, {"latency_ms": 501.0})
    funnel = quality.quality_funnel(df).first()
    assert (funnel["invalid_kpis"], funnel["null_kpi"], funnel["final_rows"]) == (2, 1, 1)


def test_funnel_adds_up(spark, sf_dir):
    from netpulse.catalog import inputs

    f = quality.quality_funnel(inputs.raw(spark, sf_dir)).first()
    both = f["invalid_cell_ids"] + f["invalid_site_ids"]
    rest = f["raw_rows"] - f["duplicates_removed"] - f["invalid_timestamps"] - f["invalid_kpis"] - f["null_kpi"] - f["final_rows"]
    assert 0 <= both - rest <= min(f["invalid_cell_ids"], f["invalid_site_ids"])


def test_ids_with_both_faults_count_twice(spark):
    df = raw(spark, {"cell_id": "CELL_1", "site_id": None}, {"cell_id": None}, {"site_id": "SITE_00001"})
    f = quality.quality_funnel(df).first()
    assert (f["invalid_cell_ids"], f["invalid_site_ids"], f["final_rows"]) == (2, 2, 0)


def test_regions(spark):
    names = [" houston ", "HOUSTON", "ft worth", " Fort Worth", "dallas", "Dallas ", None]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, region string")
    got = [r[1] for r in df.select("i", fn.standardize_region()).orderBy("i").collect()]
    assert got == ["Houston", "Houston", "Fort Worth", "Fort Worth", "dallas", "Dallas", None]


def test_nan_is_above_every_limit_and_filled_like_a_gap(spark):
    nan = float("nan")
    df = raw(spark, {}, {"latency_ms": nan}, {"throughput_mbps": nan, "sinr_db": nan}, {"throughput_mbps": 300.0})
    valid = cleaning.valid_rows(df)
    assert valid.count() == 3
    filled = cleaning.impute_median(valid)
    assert sorted(values(filled, "throughput_mbps")) == [100.0, 100.0, 300.0]
    assert sorted(values(filled, "sinr_db")) == [10.0, 10.0, 10.0]


def test_median_is_an_observed_value_and_empty_columns_stay_missing(spark):
    df = raw(spark, *[{"sinr_db": v, "signal_strength_dbm": None, "connected_users": i}
                      for i, v in enumerate([1.0, 2.0, 3.0, 4.0, None])])
    assert cleaning.medians(df, ["sinr_db", "signal_strength_dbm"]).first() == Row(sinr_db=2.0, signal_strength_dbm=None)
    filled = cleaning.impute_median(df)
    assert sorted(values(filled, "sinr_db")) == [1.0, 2.0, 2.0, 3.0, 4.0]
    assert set(values(filled, "signal_strength_dbm")) == {None}


def test_approximate_median_keeps_its_rank_bound(spark):
    df = spark.range(5000).select((F.col("id") % 997).cast("double").alias("sinr_db"))
    exact = cleaning.medians(df, ["sinr_db"]).first()[0]
    near = cleaning.medians(df, ["sinr_db"], accuracy=1000).first()[0]
    assert abs(exact - near) <= 2


def test_cleaning_is_idempotent(spark):
    df = raw(spark, {}, {}, {"sinr_db": None, "latency_ms": 60.0}, {"region": "Ft Worth", "latency_ms": 70.0})
    once = cleaning.clean(df)
    columns = df.columns
    again = cleaning.clean(once.select(*columns))
    assert sorted(map(str, once.select(*columns).collect())) == sorted(map(str, again.select(*columns).collect()))


def test_extra_columns_pass_silver_and_stop_at_gold(spark):
    df = raw(spark, {}).withColumn("vendor", F.lit("x"))
    silver = cleaning.clean(df)
    assert "vendor" in silver.columns
    gold = cleaning.build_gold(silver)
    assert "vendor" not in gold.columns and len(gold.columns) == 24


def test_missing_region_fails_only_the_gate(spark):
    silver = cleaning.clean(raw(spark, {"region": None}, {"latency_ms": 51.0}))
    assert silver.count() == 2
    gate = quality.quality_gate(silver, 2).first()
    assert (gate["total_missing"], gate["status"]) == (1, "REVIEW")
    assert quality.quality_gate(silver.filter("region is not null"), 1).first()["status"] == "PASS"


def test_copies_created_by_standardising_are_reported(spark):
    silver = cleaning.clean(raw(spark, {"region": "houston"}, {"region": "HOUSTON"}))
    gate = quality.quality_gate(silver, 2).first()
    assert (gate["remaining_duplicates"], gate["status"]) == (1, "REVIEW")


def test_dedup_by_key_keeps_the_best_and_survives_a_hot_key(spark):
    rows = [("a", i, float(i % 7), i % 2) for i in range(3000)] + [("b", 1, None, 0), ("b", 2, 1.0, 1)]
    df = spark.createDataFrame(rows, "k string, i int, score double, flag int").drop("i")
    got = {r["k"]: (r["score"], r["flag"]) for r in cleaning.dedup_by_key(df, ["k"], ["score", "flag"]).collect()}
    assert got == {"a": (6.0, 1), "b": (1.0, 1)}


def test_complete_rows_drop_null_and_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, math.nan)], "a int, b double")
    assert values(cleaning.complete_rows(df, ["a", "b"]), "a") == [1]


def test_profiles_of_an_empty_frame(spark):
    df = raw(spark, {}).limit(0)
    assert quality.failure_rate(df).first()["failure_rate_pct"] is None
    assert quality.duplicate_profile(df).first() == Row(total_rows=0, distinct_rows=0, exact_duplicates=0)
    assert quality.quality_funnel(df).first()["final_rows"] == 0


def test_schema_profile_and_guard(spark):
    df = raw(spark, {})
    assert quality.schema_profile(df).count() == 14
    assert cleaning.existing(df, ["sinr_db", "nothing"]) == ["sinr_db"]
    assert quality.kpi_summary(df.drop("sinr_db")).count() == 8

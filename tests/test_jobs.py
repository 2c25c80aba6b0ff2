"""Sources, sinks, tracking and the end-to-end jobs."""

import glob
import gzip
import os

import pytest
from pyspark.sql import functions as F

from netpulse.catalog import inputs
from netpulse.operators import cleaning, quality, serving
from netpulse.plans import medallion
from netpulse import session
from netpulse.session import sized_settings, staging_root
from netpulse.sources import layers, runs
from netpulse.sources.telemetry import read_telemetry_csv


HEADER = "timestamp,cell_id,site_id,region,signal_strength_dbm,sinr_db,latency_ms,packet_loss_pct,throughput_mbps,connected_users,traffic_load_pct,cpu_utilization_pct,alarm_count,failure_event"


def test_csv_round_trip_and_permissive_fields(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(HEADER + "\n2024-01-01 00:00:00,CELL_0001,SITE_0001,Dallas,-80,10,abc,0.1,5,3,50,40,1,0\n")
    row = read_telemetry_csv(spark, str(path)).first()
    assert row["latency_ms"] is None and row["sinr_db"] == 10.0 and row["timestamp"] == "2024-01-01 00:00:00"
    inferred = dict(read_telemetry_csv(spark, str(path), None).dtypes)
    assert inferred["timestamp"] == "timestamp" and inferred["connected_users"] == "int"


def test_csv_columns_go_by_name(spark, tmp_path):
    """Reordered, further and missing columns, blanks, 120.0 in whole numbers, a packed file: the same silver."""
    names = HEADER.split(",")
    rows = [
        dict(zip(names, [f"2024-01-01 00:{i:02d}:00", "CELL_0001", "SITE_0001", "Dallas", "", "10", f"{i}.5", "0.1", "5", str(120 + i), "50", "40", "1", "0"]))
        for i in range(9)
    ]
    plain, mixed = tmp_path / "plain", tmp_path / "mixed"
    plain.mkdir(), mixed.mkdir()

    def text(names, rows):
        return "\n".join([",".join(names), *[",".join(r.get(n, "x") for n in names) for r in rows]]) + "\n"

    (plain / "a.csv").write_text(text(names, [{**r, "signal_strength_dbm": "-80"} if i < 3 else r for i, r in enumerate(rows)]))
    turned = [*reversed(names), "vendor"]
    (mixed / "a.csv").write_text("\ufeff" + text([f" {n}" for n in names], [{f" {n}": v for n, v in {**r, "signal_strength_dbm": "-80"}.items()} for r in rows[:3]]))
    with gzip.open(mixed / "b.csv.gz", "wt") as out:
        out.write(text(turned, [{**r, "connected_users": r["connected_users"] + ".0", "vendor": "v"} for r in rows[3:6]]))
    (mixed / "c.csv").write_text(text([n for n in names if n != "signal_strength_dbm"], rows[6:]))
    (mixed / "_done").write_text("no,header\n")
    (mixed / "empty.csv").write_text("")
    one, other = (read_telemetry_csv(spark, str(p)) for p in (plain, mixed))
    assert other.columns == [*one.columns, "vendor"] and other.dtypes[:-1] == one.dtypes
    silver = lambda df: sorted(map(str, cleaning.clean(df).drop("vendor").collect()))
    assert silver(one) == silver(other) and len(silver(one)) == 9
    assert sorted(str(r.vendor) for r in other.select("vendor").collect()) == ["None"] * 6 + ["v"] * 3


def test_csv_corrupt_lines_are_kept(spark, tmp_path):
    line = "2024-01-01 00:00:00,CELL_0001,SITE_0001,Dallas,-80,10,1,0.1,5,3.5,50,40,1,0"
    (tmp_path / "raw.csv").write_text(f"{HEADER}\n{line}\n{line},9\n2024-01-01 00:01:00,CELL_0001\n")
    rows = read_telemetry_csv(spark, str(tmp_path / "*.csv"), corrupt="bad").orderBy("timestamp", F.col("bad").asc_nulls_first()).collect()
    assert [r["bad"] for r in rows] == [None, f"{line},9", "2024-01-01 00:01:00,CELL_0001"]
    assert rows[0]["connected_users"] is None and rows[2]["latency_ms"] is None
    (tmp_path / "twice.csv").write_text("a,b,a\n1,2,3\n")
    with pytest.raises(ValueError, match="repeats"):
        read_telemetry_csv(spark, str(tmp_path / "twice.csv"))
    with pytest.raises(ValueError, match="no CSV file"):
        read_telemetry_csv(spark, str(tmp_path / "none*.csv"))


def test_schemas_are_enforced_on_the_first_write(spark):
    good = spark.createDataFrame([(1.0, 2.0, 3.0, "NORMAL")], "p double, lo double, hi double, r string").select(
        F.col("r").alias("capacity_risk"), F.current_timestamp().alias("forecast_timestamp"),
        F.col("p").alias("predicted_traffic_load_pct"), F.col("lo").alias("forecast_lower_pct"), F.col("hi").alias("forecast_upper_pct"),
    )
    assert layers.write_layer(good, "layer_f", replace_schema=False, schema=layers.FORECAST_SCHEMA) == 1
    assert spark.table("layer_f").columns == layers.FORECAST_SCHEMA.fieldNames()  # by name, whatever the order
    for wrong, said in [
        (good.withColumn("forecast_lower_pct", F.lit(1)), "not double"), (good.drop("capacity_risk"), "must hold the columns"),
        (good.withColumn("more", F.lit(1)), "must hold the columns"),
    ]:
        with pytest.raises(ValueError, match=said):
            layers.write_layer(wrong, "layer_g", schema=layers.FORECAST_SCHEMA)
    missing = good.withColumn("forecast_timestamp", F.when(F.rand() < 0, F.current_timestamp()))
    with pytest.raises(Exception, match="forecast_timestamp must not be NULL"):
        layers.write_layer(missing, "layer_g", schema=layers.FORECAST_SCHEMA)
    export = good.select("forecast_timestamp", "predicted_traffic_load_pct", F.col("forecast_lower_pct").alias("forecast_lower_bound"), F.lit(1).alias("forecast_upper_bound"))
    with pytest.raises(ValueError, match="forecast_upper_bound is int"):
        layers.conform(export, layers.EXPORT_SCHEMA)


def test_layers_replace_and_keep_their_schema(spark):
    df = spark.range(10)
    layers.write_layer(df, "layer_a")
    assert layers.verify_saved(spark, "layer_a", 10) == 10
    layers.write_layer(df.withColumn("x", F.lit(1)), "layer_a")
    assert layers.read_layer(spark, "layer_a").columns == ["id", "x"]
    with pytest.raises(ValueError, match="keeps its schema"):
        layers.write_layer(df, "layer_a", replace_schema=False)
    layers.write_layer(df.limit(3).withColumn("x", F.lit(1)), "layer_a", replace_schema=False)
    with pytest.raises(ValueError, match="expected 4"):
        layers.verify_saved(spark, "layer_a", 4)


def test_partitioned_layer(spark):
    df = spark.range(1000).withColumn("day", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")))
    layers.write_layer(df, "layer_p", partition_by=["day"])
    assert spark.table("layer_p").filter("day = 'hot'").count() == 666


def test_export_is_one_file(spark, tmp_path):
    layers.export_csv(spark.range(20_000).repartition(5), str(tmp_path / "out"))
    files = glob.glob(str(tmp_path / "out" / "*.csv"))
    assert len(files) == 1 and len(open(files[0]).read().split()) == 20_001


def test_writes_count_their_rows(spark):
    assert layers.write_layer(spark.range(1000).repartition(7), "layer_n", partition_by=None) == 1000
    assert layers.write_layer(spark.range(0), "layer_n") == 0
    assert layers.write_layer(spark.range(50).withColumn("day", F.col("id") % 3), "layer_n", partition_by=["day"]) == 50


def test_runs(spark):
    with pytest.raises(ValueError, match="not found"):
        runs.latest_run(spark, "x", "runs_a")
    runs.log_run(spark, "x", {"depth": 5}, {"auc": 0.5}, table="runs_a")
    second = runs.log_run(spark, "x", {"depth": 6}, {"auc": 0.6}, {"model": "/m"}, table="runs_a")
    runs.log_run(spark, "y", {}, {}, table="runs_a")
    run = runs.latest_run(spark, "x", "runs_a")
    assert (run["run_id"], run["params"]["depth"], run["metrics"]["auc"], run["artifacts"]["model"]) == (second, "6", 0.6, "/m")
    with pytest.raises(ValueError, match="no run named"):
        runs.latest_run(spark, "z", "runs_a")


def test_staging_uses_the_configured_folder(spark):
    assert staging_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_sizing_follows_the_data():
    small, huge = sized_settings(1 << 30, 8), sized_settings(100 << 40, 8000)
    assert small["spark.sql.shuffle.partitions"] == "16" and huge["spark.sql.shuffle.partitions"] == "524288"


def test_short_lived_stages_are_deleted(spark):
    before = len(session._staged)
    with session.short_lived_stages(spark):
        kept = session.stage(spark.range(3))
        assert kept.count() == 3
        path = session._staged[-1]
    assert len(session._staged) == before and not os.path.exists(path)


def test_require():
    quality.require(True, "fine")
    with pytest.raises(ValueError, match="broken"):
        quality.require(False, "broken")


def test_whole_chain(spark, sf_dir, tmp_path):
    names = medallion.Names()
    staged = len(session._staged)
    gate = medallion.build_silver(inputs.raw(spark, sf_dir), names, partition_by=["event_date"]).first()
    assert gate["status"] == "PASS" and gate["saved_rows"] == gate["final_rows"]
    funnel = quality.quality_funnel(inputs.raw(spark, sf_dir)).first().asDict()
    assert {name: gate[name] for name in funnel} == funnel
    gold = medallion.build_gold(spark, names)
    assert gold.count() == gate["final_rows"]
    scored = medallion.detect_anomalies(spark, names, trees=20)
    assert scored.count() == gate["final_rows"] and len(scored.columns) == 16
    medallion.train_tracked_model(spark, str(tmp_path / "model"), names, trees=3)
    run = runs.latest_run(spark, medallion.TRACKED_RUN, names.runs)
    assert run["metrics"]["training_rows"] == int((run["metrics"]["training_rows"] + run["metrics"]["testing_rows"]) * 0.8)
    risks, alerts = medallion.score_risk(spark, names)
    assert risks == gate["final_rows"] and 0 <= alerts <= risks
    view = serving.create_command_center(spark, names.risk, names.view)
    assert spark.table(names.view).count() == risks and len(view.columns) == 30
    expected = serving.command_center_view(spark.table(names.risk))
    assert sorted(map(str, view.collect())) == sorted(map(str, expected.collect()))
    assert [f.dataType for f in view.schema] == [f.dataType for f in expected.schema]
    kept = spark.catalog.getTable(names.view)  # the view belongs to the catalog, not to the session
    assert (kept.tableType, kept.isTemporary) == ("VIEW", False)
    summary = medallion.publish_forecast(spark, str(tmp_path / "forecast"), names).first()
    assert summary["high_critical_hours"] == summary["high_hours"] + summary["critical_hours"]
    assert len(glob.glob(str(tmp_path / "forecast" / "*.csv"))) == 1
    assert len(session._staged) == staged  # the jobs above leave nothing behind
    reports = medallion.compare_failure_models(gold, trees=3, sample=100)
    assert {name: frame.count() > 0 for name, frame in reports.items() if name != "risk_drivers"} == {
        name: True for name in reports if name != "risk_drivers"
    }


def test_explanations_cover_all_test_rows(spark, sf_dir, monkeypatch):
    seen, real = [], medallion.explain.tree_shap
    monkeypatch.setattr(medallion.explain, "tree_shap", lambda model, rows: seen.append(rows.count()) or real(model, rows))
    monkeypatch.setattr(medallion.anomaly, "sample_cap", lambda rows, most: rows.limit(10))
    medallion.compare_failure_models(inputs.gold(spark, sf_dir), trees=1)
    assert seen == [medallion.targets.test_part(inputs.rows_split(spark, sf_dir)).count()] and seen[0] > 10


def test_jobs_refuse_writes_that_lose_rows(spark, sf_dir, tmp_path, monkeypatch):
    """A row vanishes from the table right after its write: each of the six saved tables is refused."""
    names = medallion.Names(**{f: f"lossy_{f}" for f in ("silver", "gold", "anomalies", "risk", "alerts", "forecast", "runs", "view")})
    real, losing = layers.write_layer, []

    def write(df, name, **given):
        written = real(df, name, **given)
        if name in losing:
            rest = session.stage(spark.table(name).limit(written - 1))
            rest.write.mode("overwrite").saveAsTable(name)
        return written

    monkeypatch.setattr(layers, "write_layer", write)
    jobs = [
        (names.silver, lambda: medallion.build_silver(inputs.raw(spark, sf_dir), names)),
        (names.gold, lambda: medallion.build_gold(spark, names)),
        (names.anomalies, lambda: medallion.detect_anomalies(spark, names, trees=5)),
        (names.risk, lambda: medallion.score_risk(spark, names)),
        (names.alerts, lambda: medallion.score_risk(spark, names)),
        (names.forecast, lambda: medallion.publish_forecast(spark, str(tmp_path / "f"), names)),
    ]
    for table, job in jobs:
        if table == names.risk:
            medallion.train_tracked_model(spark, str(tmp_path / "model"), names, trees=1)
        losing[:] = [table]
        with pytest.raises(ValueError, match=f"{table} holds"):
            job()
        losing.clear()
        job()

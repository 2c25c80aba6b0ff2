"""Fitted models, isolation forest and explanations."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from netpulse import fixed
from netpulse.operators import anomaly, explain, metrics, models
from netpulse.session import stage, staging_path
from netpulse.sources import runs

FEATURES = fixed.ROWS_MODEL_FEATURES


@pytest.fixture(scope="module")
def train(spark):
    """Latency decides, load matters a little, the rest is noise."""
    rng = random.Random(11)
    rows = []
    for i in range(1200):
        x = {name: rng.gauss(0, 1) for name in FEATURES}
        logit = 2.5 * x["latency_ms"] + 0.8 * x["traffic_load_pct"] - 1.5
        rows.append((i, *[x[n] for n in FEATURES], int(rng.random() < 1 / (1 + math.exp(-logit)))))
    schema = "timestamp long, " + ", ".join(f"{n} double" for n in FEATURES) + ", failure_next_30m int"
    return stage(spark.createDataFrame(rows, schema).withColumn("cell_id", F.lit("A")).repartition(3))


@pytest.fixture(scope="module")
def boosted(train):
    return models.fit_boosted(train, trees=6, depth=3)


def test_balanced_weights_add_up(train):
    row = models.class_weights(train).agg(F.sum("class_weight"), F.count("*")).first()
    assert row[0] == pytest.approx(row[1])


def test_scaler(train):
    scaled = models.apply_scaler(train, models.fit_scaler(train, FEATURES))
    row = scaled.agg(F.avg("sinr_db"), F.stddev_pop("sinr_db")).first()
    assert row[0] == pytest.approx(0, abs=1e-9) and row[1] == pytest.approx(1)


def test_logistic_minimises_the_stated_objective(train):
    """Gradient of the weighted, unit-penalty loss is zero at the fitted point."""
    model = models.fit_logistic(train)
    fitted = model.stages[-1]
    pdf = models.apply_scaler(models.class_weights(train), models.fit_scaler(train, FEATURES)).toPandas()
    x, y, w = pdf[FEATURES].to_numpy(), pdf["failure_next_30m"].to_numpy(), pdf["class_weight"].to_numpy()
    beta = fitted.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ beta + fitted.intercept)))
    gradient = x.T @ (w * (p - y)) + beta
    assert np.abs(gradient).max() < 1e-2 * len(y) ** 0.5
    auc = metrics.roc_auc(models.score(model, train), "failure_next_30m").first()[0]
    assert auc > 0.85


def test_boosted_model_learns_and_survives_saving(spark, train, boosted):
    scored = models.score(boosted, train)
    assert metrics.roc_auc(scored, "failure_next_30m").first()[0] > 0.85
    assert models.feature_importance(boosted).first()["feature"] == "latency_ms"
    again = models.score(runs.load_model(runs.save_model(boosted, staging_path(spark, "model"))), train)
    total = lambda df: df.agg(F.sum("failure_probability")).first()[0]
    assert total(again) == pytest.approx(total(scored))
    edge = scored.filter((F.col("failure_probability") >= 0.5) != (F.col("prediction") == 1))
    assert edge.count() == 0


def test_attributions_add_up_to_the_log_odds(train, boosted):
    scored = models.score(boosted, train)
    shap = explain.tree_shap(boosted, scored)
    total = sum((F.col(explain.PREFIX + n) for n in FEATURES), F.col(explain.BASE))
    p = F.col("failure_probability")
    worst = shap.select(F.max(F.abs(total - F.log(p / (1 - p))))).first()[0]
    assert worst < 1e-6
    ranking = [r["feature"] for r in explain.shap_importance(shap).collect()]
    assert ranking[:2] == ["latency_ms", "traffic_load_pct"]


def test_attributions_equal_the_definition(spark, train, boosted):
    """One row against Shapley's formula on the cover-weighted value function."""
    from itertools import combinations

    nodes = boosted.nodes()
    row = train.orderBy("timestamp").first()
    x = [row[n] for n in FEATURES]
    trees = [{n.node: n for n in tree.itertuples()} for _, tree in nodes.groupby("tree")]

    def value(known):
        total = boosted.base
        for by_id in trees:

            def walk(n):
                if n.left < 0:
                    return n.value
                left, right = by_id[n.left], by_id[n.right]
                if n.feature in known:
                    return walk(left if x[n.feature] <= n.threshold else right)
                return (left.cover * walk(left) + right.cover * walk(right)) / n.cover

            total += walk(by_id[0])
        return total

    used = sorted(set(int(f) for f in nodes[nodes["left"] >= 0]["feature"]))
    shap = explain.tree_shap(boosted, train.filter(F.col("timestamp") == row["timestamp"])).first()
    for k in used:
        others = [f for f in used if f != k]
        d = len(used)
        phi = sum(
            math.factorial(size) * math.factorial(d - size - 1) / math.factorial(d) * (value({*s, k}) - value(set(s)))
            for size in range(d) for s in combinations(others, size)
        )
        assert shap[explain.PREFIX + FEATURES[k]] == pytest.approx(phi, abs=1e-9)


def test_local_explanation_and_drivers(train, boosted):
    shap = explain.tree_shap(boosted, models.score(boosted, train))
    local = explain.explain_top(shap, None)
    impacts = [r["abs_impact"] for r in local.collect()]
    assert len(impacts) == 10 and impacts == sorted(impacts, reverse=True)
    drivers = explain.risk_drivers(local).collect()
    assert 0 < len(drivers) <= 5 and all(r["shap_impact"] > 0 for r in drivers)
    assert explain.risk_drivers(local.withColumn("shap_impact", F.lit(-1.0))).count() == 0


@pytest.fixture(scope="module")
def planted(spark):
    """Five far outliers; a third of the rows are copies of one observation."""
    rng = random.Random(3)
    rows = [tuple([0.0] * 9) if i % 3 == 0 else tuple(rng.gauss(0, 1) for _ in range(9)) for i in range(1500)]
    rows += [tuple([40.0 + j] * 9) for j in range(5)]
    schema = ", ".join(f"{n} double" for n in fixed.ANOMALY_FEATURES)
    return stage(spark.createDataFrame(rows, schema).repartition(4))


def test_planted_outliers_rank_first(planted):
    forest = stage(anomaly.fit_isolation_forest(planted, trees=40))
    scored = stage(anomaly.score_isolation_forest(forest, planted))
    assert scored.count() == 1505
    top = scored.orderBy(F.desc("raw_score")).limit(5).collect()
    assert all(r["sinr_db"] >= 40 for r in top)
    bounds = scored.agg(F.min("raw_score"), F.max("raw_score")).first()
    assert 0 < bounds[0] < bounds[1] <= 1
    flagged = anomaly.flag_anomalies(anomaly.minmax_score(scored))
    share = flagged.filter("is_anomaly = 1").count() / 1505
    assert 0.005 <= share <= 0.01 + 1 / 1505
    assert flagged.agg(F.min("anomaly_score"), F.max("anomaly_score")).first()[:] == (0.0, 100.0)


def test_forest_is_bounded_and_reproducible(planted):
    grow = lambda: anomaly.fit_isolation_forest(planted, trees=25, sample=64)
    first, second = (sorted(map(str, grow().collect())) for _ in range(2))
    assert first == second
    per_tree = grow().groupBy("tree").agg(F.count(F.when(F.col("feature") < 0, 1)).alias("leaves")).collect()
    assert len(per_tree) == 25 and all(r["leaves"] <= 64 for r in per_tree)


@pytest.mark.parametrize("rows", [5, 300, 1505])
def test_same_forest_and_sample_for_any_partitioning(planted, rows):
    """A third of the rows are copies; a frame smaller than a tree's sample gives all its rows."""
    held = stage(planted.orderBy(*fixed.ANOMALY_FEATURES).limit(rows))
    forests, samples = set(), set()
    for parts in (1, 4, 7):
        df = held.repartition(parts)
        forests.add(tuple(sorted(map(str, anomaly.fit_isolation_forest(df, trees=12).collect()))))
        samples.add(tuple(sorted(map(str, anomaly.sample_cap(df, 200).collect()))))
    assert len(forests) == len(samples) == 1
    assert len(samples.pop()) == min(rows, 200) and f"sample={min(rows, 256)}," in forests.pop()[0]


def test_often_repeated_rows_are_dealt_out(spark, monkeypatch):
    from netpulse.operators import sampling

    df = spark.createDataFrame([(1.0,)] * 700 + [(float(i),) for i in range(2, 302)], "v double").repartition(3)
    whole = sorted(r.v for r in anomaly.sample_cap(df, 400).collect())
    monkeypatch.setattr(sampling, "COPIES", 50)
    assert sorted(r.v for r in anomaly.sample_cap(df, 400).collect()) == whole
    assert 250 < whole.count(1.0) < 310  # 280 expected


def test_constant_scores(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "raw_score double")
    assert [r["anomaly_score"] for r in anomaly.minmax_score(df).collect()] == [0.0, 0.0]
    assert anomaly.flag_anomalies(df).filter("is_anomaly = 1").count() == 0


def test_sample_cap(spark):
    df = stage(spark.range(20_000).withColumn("v", F.lit(1)))
    sample = anomaly.sample_cap(df, 500)
    ids = [r["id"] for r in sample.collect()]
    assert len(ids) == len(set(ids)) == 500
    assert sorted(ids) == sorted(r["id"] for r in anomaly.sample_cap(df, 500).collect())
    assert 8000 < sum(ids) / 500 < 12_000
    assert anomaly.sample_cap(df, 50_000).count() == 20_000
    assert anomaly.sample_cap(df.select("v"), 500).count() == 500  # copies draw on their own


def test_average_path():
    assert list(anomaly.average_path([0, 1, 2])) == [0, 0, 1]
    assert float(anomaly.average_path(256)) == pytest.approx(10.2448, abs=1e-3)


@pytest.mark.parametrize("splits", [1, 3, 8])
def test_attributions_do_not_depend_on_the_groups_of_leaves(boosted, monkeypatch, splits):
    """Groups of one leaf up to whole trees give the same; looked up per group, not per leaf."""
    points = np.random.default_rng(5).normal(size=(len(FEATURES), 200))
    nodes = boosted.nodes()
    monkeypatch.setattr(explain, "GROUP_SPLITS", splits)
    base, trees = explain._tree_tables(nodes, len(FEATURES))
    found = explain._attributed(points, trees)
    assert found.sum(axis=1) + base + boosted.base == pytest.approx(boosted.log_odds(points.T))
    monkeypatch.setattr(explain, "GROUP_SPLITS", 0)
    plain_base, plain = explain._tree_tables(nodes, len(FEATURES))
    assert base == pytest.approx(plain_base) and found == pytest.approx(explain._attributed(points, plain))
    leaves, groups = (nodes["left"] < 0).sum(), sum(len(g) for _, _, g in trees)
    assert sum(len(g) for _, _, g in plain) == leaves and (splits < 8 or groups == len(boosted.trees))

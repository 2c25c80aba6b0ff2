"""Published confusion matrix, ties and degenerate cases."""

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from netpulse.operators import metrics

# actual, predicted score, rows: the published logistic-regression test result.
PUBLISHED = [(0, 0.1, 97118), (0, 0.9, 1242), (1, 0.1, 27), (1, 0.9, 1113)]


@pytest.fixture(scope="module")
def published(spark):
    return spark.createDataFrame(PUBLISHED, "label int, failure_probability double, rows long")


def test_published_metrics(published):
    row = metrics.binary_metrics(published, weight=F.col("rows")).first()
    assert [round(row[c], 4) for c in ("precision", "recall", "f1_score", "accuracy")] == [0.4726, 0.9763, 0.6369, 0.9872]
    matrix = metrics.confusion_matrix(published, weight=F.col("rows")).orderBy("actual").collect()
    assert [tuple(r) for r in matrix] == [(0, 97118, 1242), (1, 27, 1113)]
    report = {r["class"]: r for r in metrics.classification_report(published, weight=F.col("rows")).collect()}
    assert report["1"]["precision"] == 0.4726 and report["1"]["support"] == 1140
    assert report["accuracy"]["f1_score"] == 0.9872 and report["macro avg"]["support"] == 99500


def test_threshold_is_left_closed(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.4999999)], "label int, failure_probability double")
    assert metrics.binary_metrics(df).first()["accuracy"] == 1.0


def test_no_positive_calls_give_zero_not_an_error(spark):
    df = spark.createDataFrame([(1, 0.1), (0, 0.2)], "label int, failure_probability double")
    row = metrics.binary_metrics(df).first()
    assert (row["precision"], row["recall"], row["f1_score"]) == (0.0, 0.0, 0.0)


def test_ranking_with_ties_by_hand(spark):
    # descending: 0.9 (1), 0.5 (1, 0, 0), 0.1 (0, 1)
    df = spark.createDataFrame(
        [(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.5), (0, 0.1), (1, 0.1)], "label int, failure_probability double"
    )
    row = metrics.ranking_metrics(df).first()
    wins = 3 + (2 * 0.5 + 1) + 0.5  # per positive: lower negatives plus half the tied ones
    assert row["roc_auc"] == pytest.approx(wins / 9)
    assert row["average_precision"] == pytest.approx((1 / 1 + 2 / 4 + 3 / 6) / 3)


def test_auc_equals_the_exact_evaluator_on_skewed_scores(spark):
    df = spark.createDataFrame(
        [(0.25 if i % 3 == 0 else (i * 7919 % 1000) / 1000, int(i * 104729 % 11 < 2)) for i in range(4000)],
        "failure_probability double, label int",
    )
    exact = BinaryClassificationEvaluator(rawPredictionCol="failure_probability", numBins=0).evaluate(df)
    assert metrics.roc_auc(df).first()[0] == pytest.approx(exact, abs=1e-12)


def test_one_class_has_no_ranking(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "label int, failure_probability double")
    assert metrics.ranking_metrics(df).first()["roc_auc"] is None


def test_compare_models_lists_each_model(spark):
    good = spark.createDataFrame([(1, 0.9), (0, 0.1)], "label int, failure_probability double")
    bad = spark.createDataFrame([(1, 0.1), (0, 0.9)], "label int, failure_probability double")
    rows = {r["model"]: r for r in metrics.compare_models({"good": good, "bad": bad}).collect()}
    assert rows["good"]["roc_auc"] == 1.0 and rows["bad"]["roc_auc"] == 0.0

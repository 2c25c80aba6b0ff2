"""Binary classification metrics as aggregations over (label, score) columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from netpulse import fixed
from netpulse.operators.ordering import with_running_sums

LABEL, SCORE = "label", "failure_probability"


def predicted(score: str = SCORE, threshold: float = fixed.DECISION_THRESHOLD) -> Column:
    return F.when(F.col(score) >= threshold, 1).otherwise(0)


def _cells(scored: DataFrame, label: str, score: str, weight: Column | None) -> DataFrame:
    """tn, fp, fn, tp in one row.  ``weight`` counts a row several times."""
    positive, called = F.col(label) == 1, predicted(score) == 1
    one = F.lit(1).cast("bigint") if weight is None else weight.cast("bigint")
    count = lambda condition: F.coalesce(F.sum(F.when(condition, one)), F.lit(0)).cast("bigint")
    return scored.agg(
        count(~positive & ~called).alias("tn"), count(~positive & called).alias("fp"),
        count(positive & ~called).alias("fn"), count(positive & called).alias("tp"),
    )


def _ratio(part: Column, whole: Column) -> Column:
    """Zero for an empty denominator."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return _ratio(2 * tp, 2 * tp + fp + fn)


def binary_metrics(
    scored: DataFrame, label: str = LABEL, score: str = SCORE, weight: Column | None = None
) -> DataFrame:
    tn, fp, fn, tp = (F.col(name) for name in ("tn", "fp", "fn", "tp"))
    return _cells(scored, label, score, weight).select(
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _f1(tp, fp, fn).alias("f1_score"),
        _ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
    )


def confusion_matrix(
    scored: DataFrame, label: str = LABEL, score: str = SCORE, weight: Column | None = None
) -> DataFrame:
    """One row per actual class, one column per predicted class, zero-filled."""
    rows = F.array(
        F.struct(F.lit(0).alias("actual"), F.col("tn").alias("predicted_0"), F.col("fp").alias("predicted_1")),
        F.struct(F.lit(1).alias("actual"), F.col("fn").alias("predicted_0"), F.col("tp").alias("predicted_1")),
    )
    return _cells(scored, label, score, weight).select(F.inline(rows))


def classification_report(
    scored: DataFrame, label: str = LABEL, score: str = SCORE, weight: Column | None = None, digits: int = 4
) -> DataFrame:
    """Per-class and averaged precision, recall, F1 and support."""
    tn, fp, fn, tp = (F.col(name) for name in ("tn", "fp", "fn", "tp"))
    zero = [_ratio(tn, tn + fn), _ratio(tn, tn + fp), _f1(tn, fn, fp), tn + fp]
    one = [_ratio(tp, tp + fp), _ratio(tp, tp + fn), _f1(tp, fp, fn), tp + fn]
    everything = tn + fp + fn + tp
    accuracy = _ratio(tp + tn, everything)
    macro = [(a + b) / 2 for a, b in zip(zero[:3], one[:3])]
    weighted = [_ratio(a * zero[3] + b * one[3], everything) for a, b in zip(zero[:3], one[:3])]

    def line(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            F.round(precision, digits).alias("precision"), F.round(recall, digits).alias("recall"),
            F.round(f1, digits).alias("f1_score"), support.alias("support"),
        )

    none = F.lit(None).cast("double")
    return _cells(scored, label, score, weight).select(F.inline(F.array(
        line("0", *zero), line("1", *one),
        line("accuracy", none, none, accuracy, everything),
        line("macro avg", *macro, everything), line("weighted avg", *weighted, everything),
    )))


def _by_score(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score, with running totals from the highest down."""
    counts = scored.groupBy(F.col(score).alias("score")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("bigint").alias("pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast("bigint").alias("neg"),
    )
    return with_running_sums(counts, {"tp": "pos", "fp": "neg"}, F.desc("score"))


def ranking_metrics(scored: DataFrame, label: str = LABEL, score: str = SCORE) -> DataFrame:
    """ROC-AUC (tied scores count half) and average precision (step sum), NULL without both classes."""
    pos, neg, tp, fp = (F.col(name).cast("double") for name in ("pos", "neg", "tp", "fp"))
    sums = _by_score(scored, label, score).agg(
        F.sum(neg * (tp - pos / 2)).alias("wins"), F.sum(pos * tp / (tp + fp)).alias("steps"),
        F.sum(pos).alias("positives"), F.sum(neg).alias("negatives"),
    )
    return sums.select(
        F.try_divide("wins", F.col("positives") * F.col("negatives")).alias("roc_auc"),
        F.try_divide("steps", "positives").alias("average_precision"),
    )


def roc_auc(scored: DataFrame, label: str = LABEL, score: str = SCORE) -> DataFrame:
    return ranking_metrics(scored, label, score).select("roc_auc")


def average_precision(scored: DataFrame, label: str = LABEL, score: str = SCORE) -> DataFrame:
    return ranking_metrics(scored, label, score).select("average_precision")


def all_metrics(scored: DataFrame, label: str = LABEL, score: str = SCORE) -> DataFrame:
    """Threshold and ranking metrics in one row."""
    ranked = ranking_metrics(scored, label, score).select(F.struct("roc_auc", "average_precision").alias("r")).scalar()
    return binary_metrics(scored, label, score).select(
        "*", ranked.getField("roc_auc").alias("roc_auc"), ranked.getField("average_precision").alias("pr_auc"),
    )


def compare_models(scored: dict[str, DataFrame], label: str = LABEL, score: str = SCORE) -> DataFrame:
    """Precision, recall, F1, ROC-AUC and PR-AUC: one row per model."""
    rows = [
        all_metrics(frame, label, score).drop("accuracy").select(F.lit(name).alias("model"), "*")
        for name, frame in scored.items()
    ]
    return reduce(DataFrame.unionByName, rows)

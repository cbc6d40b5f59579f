from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator

from tidemark.operators import evaluation


def scored(spark, labels, scores):
    rows = [(int(y), float(s)) for y, s in zip(labels, scores)]
    return spark.createDataFrame(rows, "churned int, churn_probability double")


def brute_auc(labels, scores):
    pos = [s for y, s in zip(labels, scores) if y == 1]
    neg = [s for y, s in zip(labels, scores) if y == 0]
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(11)
    labels = rng.integers(0, 2, 400)
    scores = np.round(np.clip(rng.normal(0.4 + 0.2 * labels, 0.2), 0, 1), 2)
    return labels, scores


@pytest.mark.parametrize("decimals", [None, 5])
def test_metrics(spark, sample, decimals):
    labels, scores = sample
    row = evaluation.binary_metrics(scored(spark, labels, scores), decimals=decimals).first()
    guess = scores >= 0.5
    tp, fp, fn = (guess & (labels == 1)).sum(), (guess & (labels == 0)).sum(), (~guess & (labels == 1)).sum()
    assert row.roc_auc == round(brute_auc(labels, scores), 4)
    assert row.precision == round(tp / (tp + fp), 4)
    assert row.recall == round(tp / (tp + fn), 4)
    assert row.f1 == round(2 * tp / (2 * tp + fp + fn), 4)


def test_auc_agrees_with_the_library_evaluator(spark, sample):
    df = scored(spark, *sample).selectExpr("double(churned) AS label", "churn_probability AS rawPrediction")
    library = BinaryClassificationEvaluator(numBins=0).evaluate(df)
    assert evaluation.binary_metrics(scored(spark, *sample)).first().roc_auc == round(library, 4)


def test_one_class_has_no_auc(spark):
    row = evaluation.binary_metrics(scored(spark, [1, 1], [0.2, 0.9])).first()
    assert tuple(row) == (None, 1.0, 0.5, 0.6667)
    row = evaluation.binary_metrics(scored(spark, [0, 0], [0.2, 0.3])).first()
    assert tuple(row) == (None, 0.0, 0.0, 0.0)


@pytest.mark.parametrize("decimals", [None, 5])
@pytest.mark.parametrize("drop", [True, False])
def test_roc_points(spark, sample, decimals, drop):
    labels, scores = sample
    got = evaluation.roc_points(scored(spark, labels, scores), decimals=decimals, drop_intermediate=drop)
    points = sorted(map(tuple, got.collect()), reverse=True)
    levels = sorted(set(scores), reverse=True)
    pos, neg = (labels == 1).sum(), (labels == 0).sum()
    steps = [((scores == s) & (labels == 0)).sum() for s in levels], [((scores == s) & (labels == 1)).sum() for s in levels]
    want = [(float("inf"), 0.0, 0.0)]
    fp = tp = 0
    for i, s in enumerate(levels):
        fp, tp = fp + steps[0][i], tp + steps[1][i]
        inner = 0 < i < len(levels) - 1
        if drop and inner and steps[0][i] == steps[0][i + 1] and steps[1][i] == steps[1][i + 1]:
            continue
        want.append((s, fp / neg, tp / pos))
    assert points == want
    area = np.trapezoid([p[2] for p in points], [p[1] for p in points])
    assert area == pytest.approx(brute_auc(labels, scores))


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (6.0, 4.0)], "y double, p double")
    row = evaluation.regression_metrics(df, "y", "p").first()
    assert (row.mae, row.r2) == (1.0, pytest.approx(1 - 5 / 14))


def test_best_model_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b", 0.9), ("a", 0.9), ("c", 0.1), ("d", None)], "model string, roc_auc double")
    assert evaluation.best_model(df).first().model == "a"


@pytest.mark.parametrize("decimals", [None, 5])
@pytest.mark.parametrize("row", [(1, None), (0, float("nan")), (None, 0.5), (2, 0.5)])
@pytest.mark.parametrize("measure", [evaluation.binary_metrics, evaluation.roc_points])
def test_missing_scores_and_labels_stop(spark, decimals, row, measure):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), row], "churned int, churn_probability double")
    with pytest.raises(Exception, match="cannot rank"):
        measure(df, decimals=decimals).collect()


def test_scores_outside_the_bound_stop_or_are_ranked(spark):
    df = spark.createDataFrame([(1, 1.5), (0, -2.0), (1, 0.3)], "churned int, churn_probability double")
    with pytest.raises(Exception, match="cannot rank"):
        evaluation.binary_metrics(df, decimals=5).collect()
    assert evaluation.binary_metrics(df).first().roc_auc == 1.0


def test_error_counts_rows_with_a_prediction_only(spark):
    df = spark.createDataFrame([(1.0, 1.0), (3.0, 2.0), (100.0, None)], "y double, p double")
    assert evaluation.regression_metrics(df, "y", "p").first() == (0.5, 0.5)

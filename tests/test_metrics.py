import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator

from punctual.operators import metrics


def _frame(spark, n, digits, seed=1):
    rng = np.random.default_rng(seed)
    score = rng.random(n).round(digits)
    label = (rng.random(n) < score).astype(float)
    return spark.createDataFrame(
        pd.DataFrame({"score": score, "is_delayed": label, "prediction": (score > 0.7).astype(float)})
    )


@pytest.mark.parametrize("digits", [1, 2, 12])
@pytest.mark.parametrize("ranges", [2, 7, 1000])
def test_auc_equals_evaluator_for_any_cut(spark, digits, ranges):
    rows = _frame(spark, 4000, digits)
    exact = BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="is_delayed", numBins=0
    ).evaluate(rows)
    assert metrics.area_under_roc(rows, ranges=ranges).first().auc == pytest.approx(exact, abs=1e-12)


def test_auc_of_one_class_is_unknown(spark):
    rows = _frame(spark, 100, 2).where("is_delayed = 1")
    assert metrics.area_under_roc(rows).first().auc is None


def test_auc_with_most_rows_on_one_score(spark):
    rows = _frame(spark, 3000, 3)
    hot = rows.unionAll(rows.selectExpr("0.4D AS score", "is_delayed", "prediction"))
    exact = BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="is_delayed", numBins=0
    ).evaluate(hot)
    assert metrics.area_under_roc(hot).first().auc == pytest.approx(exact, abs=1e-12)


def test_class_metrics_equal_evaluator(spark):
    rows = _frame(spark, 2000, 3)
    found = metrics.classification_metrics(metrics.confusion(rows)).first()
    names = {
        "accuracy": "accuracy",
        "weighted_precision": "weightedPrecision",
        "weighted_recall": "weightedRecall",
        "weighted_f1": "f1",
    }
    for column, name in names.items():
        evaluator = MulticlassClassificationEvaluator(
            labelCol="is_delayed", predictionCol="prediction", metricName=name
        )
        assert found[column] == pytest.approx(evaluator.evaluate(rows), abs=1e-12)


def test_class_never_predicted_scores_zero(spark):
    rows = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (0.0, 0.0)], "is_delayed double, prediction double")
    by_class = {r["class"]: r for r in metrics.class_scores(metrics.confusion(rows)).collect()}
    assert (by_class[1.0].precision, by_class[1.0].recall, by_class[1.0].f1) == (0.0, 0.0, 0.0)
    assert metrics.recall_of(metrics.confusion(rows)).first().recall == 0.0


def test_missing_labels_are_left_out(spark):
    rows = spark.createDataFrame([(1.0, 1.0), (None, 1.0), (0.0, None)], "is_delayed double, prediction double")
    assert [tuple(r) for r in metrics.confusion(rows).collect()] == [(1.0, 1.0, 1)]


def test_auc_leaves_out_missing_scores_and_is_lazy(spark):
    rows = _frame(spark, 500, 2)
    holes = spark.createDataFrame([(float("nan"), 1.0), (None, 0.0)], "score double, is_delayed double")
    more = rows.select("score", "is_delayed").unionAll(holes)
    found = metrics.area_under_roc(more)
    assert found.first().auc == metrics.area_under_roc(rows).first().auc
    assert "LogicalRDD" in found._jdf.queryExecution().logical().toString()


def test_auc_of_one_level_and_of_no_rows(spark):
    rows = spark.createDataFrame([(0.5, 1.0), (0.5, 0.0)], "score double, is_delayed double")
    assert metrics.area_under_roc(rows).first().auc == 0.5
    assert metrics.area_under_roc(rows.limit(0)).first().auc is None

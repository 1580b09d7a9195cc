import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from lexiflow.operators.metrics import (confusion_matrix, evaluate, per_class_metrics)

PAIRS = [(0, 0)] * 5 + [(1, 0)] * 3 + [(0, 1)] * 1 + [(1, 1)] * 4 + [(2, 1)] * 2 + [(2, 2)] * 1 + [(0, 2)] * 4


@pytest.fixture()
def preds(spark):
    return spark.createDataFrame([(float(p), float(l)) for p, l in PAIRS], "prediction double, label double")


def test_weighted_right_and_swapped(preds):
    right = evaluate(preds)
    assert right["precision"] == pytest.approx(0.483333, abs=1e-6)
    assert right["recall"] == pytest.approx(0.5)
    assert right["f1Score"] == pytest.approx(0.484722, abs=1e-6)
    assert right["accuracy"] == pytest.approx(0.5)
    sw = evaluate(preds, orientation="swapped")
    assert sw["precision"] == pytest.approx(0.5425, abs=1e-6)
    assert sw["recall"] == pytest.approx(0.5)
    assert sw["f1Score"] == pytest.approx(0.515278, abs=1e-6)


def test_confusion_matrix_orientation(preds):
    m = [list(r)[1:] for r in confusion_matrix(preds, [0, 1, 2]).collect()]
    assert m == [[5, 3, 0], [1, 4, 2], [4, 0, 1]]
    s = [list(r)[1:] for r in confusion_matrix(preds, [0, 1, 2], orientation="swapped").collect()]
    assert s == [[5, 1, 4], [3, 4, 0], [0, 2, 1]]


def test_per_class(preds):
    per = {r["class"]: r for r in per_class_metrics(preds).collect()}
    assert per[0.0]["precision"] == pytest.approx(0.5) and per[0.0]["recall"] == pytest.approx(0.625)
    assert per[1.0]["precision"] == pytest.approx(4 / 7) and per[1.0]["recall"] == pytest.approx(4 / 7)
    assert per[2.0]["precision"] == pytest.approx(1 / 3) and per[2.0]["recall"] == pytest.approx(0.2)


def test_matches_spark_evaluator(preds):
    ours = evaluate(preds)
    for metric, key in [("weightedPrecision", "precision"), ("weightedRecall", "recall"),
                        ("f1", "f1Score"), ("accuracy", "accuracy")]:
        ev = MulticlassClassificationEvaluator(metricName=metric)
        assert ev.evaluate(preds) == pytest.approx(ours[key], abs=1e-12)


def test_weighted_recall_equals_accuracy(spark):
    from lexiflow.plans.catalog import q_weighted_metrics
    from tests.conftest import SF001
    row = q_weighted_metrics(spark, SF001).first()
    assert row["recall"] == pytest.approx(row["accuracy"])

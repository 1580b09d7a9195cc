import math

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lexiflow.operators.metrics import evaluate
from lexiflow.operators.models import fit_timed, make_classifier, materialize, predict


def test_naive_bayes_closed_form(spark):
    rows = [(0, 0.5, Vectors.dense([2.0, 0.0, 1.0])), (0, 0.5, Vectors.dense([1.0, 1.0, 0.0])),
            (1, 2.0, Vectors.dense([0.0, 3.0, 1.0]))]
    df = spark.createDataFrame(rows, ["label", "weight", "f"])
    m = make_classifier("nb", "f").fit(df)
    s, L, K = 1.0, 2, 3
    W = {0: 1.0, 1: 2.0}
    pi = [math.log(W[c] + s) - math.log(3.0 + s * L) for c in (0, 1)]
    sums = {0: [0.5 * 2 + 0.5 * 1, 0.5 * 0 + 0.5 * 1, 0.5 * 1], 1: [0.0, 6.0, 2.0]}
    theta = [[math.log(sums[c][j] + s) - math.log(sum(sums[c]) + s * K) for j in range(K)] for c in (0, 1)]
    assert m.pi.toArray().tolist() == pytest.approx(pi, abs=1e-12)
    assert m.theta.toArray().tolist()[0] == pytest.approx(theta[0], abs=1e-12)
    assert m.theta.toArray().tolist()[1] == pytest.approx(theta[1], abs=1e-12)


def test_mlp_layers_from_data(spark):
    rows = [(float(i % 3), Vectors.dense([float(i % 3 == 0), float(i % 3 == 1), float(i % 3 == 2)]))
            for i in range(30)]
    df = spark.createDataFrame(rows, ["label", "f"])
    est = make_classifier("mlp", "f", weight_col=None, n_features=3, n_classes=3)
    assert est.getLayers() == [3, 30, 3]
    model, secs = fit_timed(est, materialize(df))
    assert secs > 0
    assert predict(model, df, ["label"]).count() == 30


def test_quality_floor_flagship(spark):
    """G3 features + weighted NB on sf0.001 documents: language is easy to tell apart."""
    from lexiflow.plans.catalog import state
    from lexiflow.plans.splits import is_split
    from tests.conftest import SF001
    st = state(spark, SF001)
    (g3,) = st.models("G3")
    feats = g3.transform(st.frame)
    for clf in ("nb", "lr", "svm"):
        model = make_classifier(clf, "featuresIDF", parallelism=4).fit(feats.filter(is_split("train")))
        m = evaluate(predict(model, feats.filter(~is_split("train")), ["label"]))
        assert m["f1Score"] > 0.6, (clf, m)
    assert feats.filter(F.col("weight").isNull()).count() == 0


def test_partitions_are_the_caller_s_choice(spark):
    from lexiflow.operators.models import materialize, release
    df = spark.range(100).repartition(6)
    for wanted, got in ((None, 6), (2, 2), (50, 6)):
        held = materialize(df, partitions=wanted)
        assert held.rdd.getNumPartitions() == got and held.count() == 100
        release(held)

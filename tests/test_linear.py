import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC, OneVsRest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lexiflow.operators.linear import (Problem, feature_scales, fit_svms, hinge, linear_rows, predict_linear)
from lexiflow.operators.models import materialize
from lexiflow.plans.tuning import assign_folds, cross_validate, param_grid, search_svms


@pytest.fixture(scope="module")
def noisy(spark):
    """Three overlapping classes, 12 features (one constant, one empty), sparse and dense rows, uneven weights."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        c = int(rng.integers(0, 3))
        x = rng.normal(0, 1, 12) * np.arange(1, 13) * (rng.random(12) < 0.6)
        x[c] += 1.5
        x[10], x[11] = 2.0, 0.0
        vector = Vectors.dense(x) if i % 2 else Vectors.sparse(12, [(j, v) for j, v in enumerate(x) if v])
        rows.append((i, c if rng.random() < 0.85 else int(rng.integers(0, 3)), vector, float(0.5 + rng.random())))
    return assign_folds(spark.createDataFrame(rows, ["doc_id", "label", "f", "weight"]), 3).repartition(4).cache()


def objective(rows, cls, reg, coef, scale):
    """Plain numpy over collected rows."""
    x = np.array([r.f.toArray() for r in rows])
    y = np.array([1.0 if r.label == cls else -1.0 for r in rows])
    w = np.array([r.weight for r in rows])
    loss = w * np.maximum(0, 1 - y * (x @ coef[:-1] + coef[-1]))
    scaled = np.divide(coef[:-1], scale, out=np.zeros(len(scale)), where=scale > 0)
    return loss.sum() / w.sum() + reg / 2 * (scaled @ scaled)


def test_scales_are_spark_s(noisy):
    from pyspark.ml.stat import Summarizer
    rows = linear_rows(noisy, "f", fold_col="fold")
    scales, centres, weights = feature_scales(rows, 12, [0, None])
    for fold, part in ((0, noisy.filter("fold <> 0")), (None, noisy)):
        both = Summarizer.metrics("std", "mean").summary(F.col("f"), F.col("weight"))
        std, mean, total = part.agg(both["std"], both["mean"], F.sum("weight")).first()
        expect = np.array([1 / s if s > 1e-9 else 0 for s in std])
        assert np.allclose(scales[fold], expect) and np.isclose(weights[fold], total)
        assert np.allclose(centres[fold], mean.toArray() * expect)


def test_gradient_is_the_slope_of_the_loss(noisy):
    rows = materialize(linear_rows(noisy, "f", fold_col="fold"))
    rng = np.random.default_rng(1)
    problems = [Problem(0, 0.1, None), Problem(2, 0.1, 1)]
    coef = rng.normal(0, 0.1, (2, 13))
    loss, grad = hinge(rows, problems, coef)
    for j in (0, 5, 12):
        step = np.zeros(13)
        step[j] = 1e-6
        up, down = hinge(rows, problems, coef + step)[0], hinge(rows, problems, coef - step)[0]
        assert np.allclose((up - down) / 2e-6, grad[:, j], rtol=1e-3, atol=1e-3)


def test_fits_equal_spark_s_classifier(noisy):
    rows = materialize(linear_rows(noisy, "f", fold_col="fold"))
    problems = [Problem(c, reg, 2) for c in range(3) for reg in (0.1, 0.001)]
    ours = fit_svms(rows, problems, 12, 50, (5, 50))
    part = noisy.filter("fold <> 2")
    scale = feature_scales(rows, 12, [2])[0][2]
    held = part.collect()
    for p in problems:
        one = part.withColumn("y", (F.col("label") == p.cls).cast("double"))
        for iterations in (5, 50):
            model = LinearSVC(featuresCol="f", labelCol="y", weightCol="weight", maxIter=iterations, regParam=p.reg).fit(one)
            theirs = np.append(model.coefficients.toArray(), model.intercept)
            a, b = (objective(held, p.cls, p.reg, c, scale) for c in (ours[p].kept[iterations], theirs))
            assert abs(a - b) < (1e-6 if iterations == 5 else 1e-4) * abs(b), (p, iterations, a, b)
        assert ours[p].history == sorted(ours[p].history, reverse=True)


def test_search_equals_spark_s_cross_validator(noisy):
    found = search_svms(noisy, "f", 12, 3, (10, 30), (0.1, 0.01))
    est = OneVsRest(classifier=LinearSVC(featuresCol="f", labelCol="label", weightCol="weight"), featuresCol="f",
                    labelCol="label", weightCol="weight")
    grid = param_grid(est.getClassifier(), (10, 30), (0.1, 0.01))
    theirs = cross_validate(est, grid, noisy, parallelism=4)
    assert np.allclose([r["avg_f1"] for r in found.scores], theirs.avgMetrics, atol=1e-3)
    assert found.n_scored == 600 and len(found.fold_scores) == 12
    best = found.best_scores({"all": noisy})["all"]
    assert abs(best - cross_best(theirs, noisy)) < 1e-3


def cross_best(model, df):
    from lexiflow.operators.metrics import evaluate
    return evaluate(model.bestModel.transform(df).select("label", "prediction"))["f1Score"]


def test_search_on_the_feature_table(spark):
    """One fold and two settings against Spark's own search."""
    from lexiflow.plans.catalog import state
    from lexiflow.plans.splits import is_split
    from lexiflow.operators.models import make_classifier
    from tests.conftest import SF001
    st = state(spark, SF001)
    (g3,) = st.models("G3")
    train = assign_folds(g3.transform(st.frame).filter(is_split("train")), 3)
    est = make_classifier("svm", "featuresIDF", parallelism=4)
    theirs = cross_validate(est, param_grid(est.getClassifier(), (10,), (0.1, 0.01)), train, parallelism=2)
    ours = search_svms(train, "featuresIDF", 1000, st.n_classes, (10,), (0.1, 0.01))
    assert np.allclose([r["avg_f1"] for r in ours.scores], theirs.avgMetrics, atol=1e-3)


def test_prediction_keeps_columns_and_takes_the_highest_score(noisy):
    coef = np.random.default_rng(0).normal(size=(3, 13))
    got = predict_linear(noisy, coef, "f", ["doc_id", "label"]).collect()
    x = {r.doc_id: r.f.toArray() for r in noisy.collect()}
    assert len(got) == 600 and all(r.prediction == np.argmax(coef[:, :-1] @ x[r.doc_id] + coef[:, -1]) for r in got)


def test_null_rows_are_an_error(spark, noisy):
    bad = noisy.limit(1).withColumn("label", F.lit(None).cast("int"))
    with pytest.raises(Exception, match="null label"):
        linear_rows(bad, "f").collect()

from pyspark.ml.classification import LinearSVC
from pyspark.sql import functions as F

from lexiflow.plans.tuning import assign_folds, grid_frame, param_grid


def test_grid_is_cartesian(spark):
    grid = param_grid(LinearSVC())
    assert len(grid) == 9
    rows = grid_frame(spark, grid).collect()
    assert {(r["maxIter"], r["regParam"]) for r in rows} == {(i, r) for i in (10, 50, 100) for r in (0.1, 0.01, 0.001)}
    assert {r["weightCol"] for r in rows} == {"weight"}


def test_every_row_in_one_fold(spark):
    df = assign_folds(spark.range(100).withColumnRenamed("id", "doc_id"), 3)
    counts = {r["fold"]: r["count"] for r in df.groupBy("fold").count().collect()}
    assert sum(counts.values()) == 100 and set(counts) == {0, 1, 2}
    assert df.filter(F.col("fold").isNull()).count() == 0


def test_small_cross_validation(spark):
    from lexiflow.operators.models import make_classifier
    from lexiflow.plans.catalog import state
    from lexiflow.plans.splits import is_split
    from lexiflow.plans.tuning import best_model_scores, cross_validate, cv_scores
    from tests.conftest import SF001
    st = state(spark, SF001)
    (g3,) = st.models("G3")
    feats = g3.transform(st.frame)
    train = assign_folds(feats.filter(is_split("train")), 3)
    est = make_classifier("lr", "featuresIDF")
    grid = param_grid(est, max_iter=(5,), reg_param=(0.1, 0.01))
    cvm = cross_validate(est, grid, train, "fold", parallelism=2)
    scores = cv_scores(spark, cvm, grid).collect()
    assert len(scores) == 2 and all(0 <= r["avg_f1"] <= 1 for r in scores)
    best = best_model_scores(cvm, {"val": feats.filter(is_split("val"))})
    assert 0 <= best["val"] <= 1

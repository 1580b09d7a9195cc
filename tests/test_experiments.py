import pytest

from lexiflow.plans.experiments import (best_run, results_by_group, results_column_max, results_series,
                                        time_box_by_group, union_results)
from lexiflow.sources.results import read_results_csv, results_frame, write_results_csv

GOLDEN = [
    ("countVectorizer+iDF", "svm", 17.888, 0.86, 0.82, 0.828, "df1"),
    ("countVectorizer+iDF", "lr", 1.548, 0.862, 0.804, 0.817, "df2"),
    ("countVectorizer+iDF", "nb", 1.64, 0.806, 0.806, 0.805, "df3"),
    ("countVectorizer+iDF+chisquare", "svm", 11.132, 0.858, 0.82, 0.827, "df4"),
    ("countVectorizer+iDF+chisquare", "lr", 1.023, 0.861, 0.802, 0.814, "df5"),
    ("countVectorizer+iDF+chisquare", "nb", 0.473, 0.836, 0.831, 0.83, "df6"),
    ("unCleanData+countVectorizer+iDF", "svm", 7.98, 0.873, 0.845, 0.85, "df7"),
    ("unCleanData+countVectorizer+iDF", "lr", 1.103, 0.869, 0.818, 0.829, "df8"),
    ("unCleanData+countVectorizer+iDF", "nb", 0.422, 0.83, 0.831, 0.83, "df9"),
    ("ngram+hashingtf+iDF", "svm", 10.965, 0.685, 0.435, 0.524, "df10"),
    ("ngram+hashingtf+iDF", "lr", 1.053, 0.689, 0.436, 0.527, "df11"),
    ("ngram+hashingtf+iDF", "nb", 0.416, 0.416, 0.42, 0.417, "df12"),
]


@pytest.fixture()
def golden(spark):
    return results_frame(spark, GOLDEN)


def test_column_max(golden):
    r = results_column_max(golden).first()
    assert (r["trainingTime"], r["precision"], r["recall"], r["f1Score"]) == (17.888, 0.873, 0.845, 0.85)


def test_box_stats(golden):
    by_model = {r["modelName"]: r for r in time_box_by_group(golden, "modelName").collect()}
    assert [by_model["svm"][k] for k in ("min", "q1", "median", "q3", "max")] == \
        pytest.approx([7.98, 10.21875, 11.0485, 12.821, 17.888])
    assert [by_model["nb"][k] for k in ("min", "q1", "median", "q3", "max")] == \
        pytest.approx([0.416, 0.4205, 0.4475, 0.76475, 1.64])
    by_fs = {r["dataModel"]: r for r in time_box_by_group(golden, "dataModel").collect()}
    assert [by_fs["countVectorizer+iDF"][k] for k in ("min", "q1", "median", "q3", "max")] == \
        pytest.approx([1.548, 1.594, 1.64, 9.764, 17.888])


def test_best_and_groups(golden):
    assert best_run(golden).first()["dataFrameNo"] == "df7"
    by_model = {r["modelName"]: r["max_f1Score"] for r in results_by_group(golden, "modelName").collect()}
    assert by_model == {"svm": 0.85, "lr": 0.829, "nb": 0.83}
    by_fs = {r["dataModel"]: r["max_f1Score"] for r in results_by_group(golden, "dataModel").collect()}
    assert by_fs["ngram+hashingtf+iDF"] == 0.527


def test_series_in_run_order(golden):
    runs = [r["dataFrameNo"] for r in results_series(golden).collect()]
    assert runs == [f"df{i}" for i in range(1, 13)]


def test_union_and_csv_roundtrip(spark, golden, tmp_path):
    both = union_results([golden, golden])
    assert both.count() == 24
    path = str(tmp_path / "results")
    write_results_csv(golden, path)
    back = read_results_csv(spark, path)
    assert sorted(tuple(r) for r in back.collect()) == sorted(GOLDEN)


def test_run_ids_belong_to_pairs_not_positions(spark):
    from lexiflow.plans.catalog import state
    from lexiflow.plans.experiments import run_experiments
    from tests.conftest import SF001
    st = state(spark, SF001)
    (g3,) = st.models("G3")
    rows = run_experiments(spark, st.frame, {"G3": g3}, st.n_classes, ("nb", "svm"), parallelism=2).collect()
    assert {(r["modelName"], r["dataFrameNo"]) for r in rows} == {("nb", "df9"), ("svm", "df7")}
    assert all(r["trainingTime"] > 0 and 0 <= r["f1Score"] <= 1 for r in rows)


def test_small_grid_scores_equal_own_metrics(spark):
    from lexiflow.operators.models import make_classifier
    from lexiflow.plans.catalog import _own_f1, state
    from lexiflow.plans.splits import is_split
    from lexiflow.plans.tuning import assign_folds, best_model_scores, cross_validate, param_grid
    from tests.conftest import SF001
    st = state(spark, SF001)
    (g3,) = st.models("G3")
    feats = g3.transform(st.frame)
    est = make_classifier("svm", "featuresIDF", "label", "weight", parallelism=4)
    grid = param_grid(est.getClassifier(), max_iter=(3,), reg_param=(0.1, 0.01))
    cvm = cross_validate(est, grid, assign_folds(feats.filter(is_split("train")), 3), "fold", parallelism=2)
    val = feats.filter(is_split("val"))
    n, f1 = _own_f1(cvm.bestModel, val)
    assert n == val.count() and abs(best_model_scores(cvm, {"val": val})["val"] - f1) < 1e-9

"""Parameter grid, k-fold cross-validation with explicit folds, best-model scores.

``search_svms`` is the grid search to use for linear SVMs: it fits every setting, fold and class together.
``cross_validate`` takes any Spark ML estimator and fits one model after another.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import Estimator
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.linear import Problem, fit_svms, fold_confusion, linear_rows, packed, predict_linear
from ..operators.metrics import evaluate, weighted_f1_by
from ..operators.models import materialize, release


def assign_folds(df: DataFrame, k: int = 3, id_col: str = "doc_id", fold_col: str = "fold") -> DataFrame:
    """Fold = pmod(id, k): reproducible, every row in exactly one fold."""
    return df.withColumn(fold_col, F.pmod(F.col(id_col), F.lit(k)).cast("int"))


def param_grid(classifier, max_iter=(10, 50, 100), reg_param=(0.1, 0.01, 0.001),
               weight_col: str | None = "weight") -> list:
    """Cartesian grid over ``maxIter`` x ``regParam`` (x ``weightCol``)."""
    b = ParamGridBuilder().addGrid(classifier.maxIter, list(max_iter)) \
                          .addGrid(classifier.regParam, list(reg_param))
    if weight_col:
        b = b.addGrid(classifier.weightCol, [weight_col])
    return b.build()


def grid_frame(spark: SparkSession, grid: list) -> DataFrame:
    """The grid as rows (one per setting, ordered as built)."""
    rows = []
    for i, pm in enumerate(grid):
        d = {p.name: v for p, v in pm.items()}
        rows.append((i, int(d.get("maxIter")), float(d.get("regParam")), d.get("weightCol")))
    return spark.createDataFrame(rows, "setting int, maxIter int, regParam double, weightCol string")


def f1_evaluator(label_col: str = "label", prediction_col: str = "prediction") -> MulticlassClassificationEvaluator:
    """Weighted F1 in the right orientation."""
    return MulticlassClassificationEvaluator(labelCol=label_col, predictionCol=prediction_col, metricName="f1")


def cross_validate(estimator: Estimator, grid: list, train: DataFrame, fold_col: str = "fold",
                   parallelism: int = 1, label_col: str = "label") -> CrossValidatorModel:
    """k-fold CV on explicit folds; mean F1 per setting; best setting refit on all rows."""
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=f1_evaluator(label_col),
                        foldCol=fold_col, parallelism=parallelism)
    return cv.fit(train)


def cv_scores(spark: SparkSession, cv_model: CrossValidatorModel, grid: list) -> DataFrame:
    """(setting, maxIter, regParam, weightCol, avg_f1) per grid setting."""
    base = grid_frame(spark, grid)
    metrics = spark.createDataFrame([(i, float(m)) for i, m in enumerate(cv_model.avgMetrics)],
                                    "setting int, avg_f1 double")
    return base.join(metrics, "setting")


def best_model_scores(cv_model: CrossValidatorModel, splits: dict[str, DataFrame],
                      label_col: str = "label") -> dict[str, float]:
    """Weighted F1 of the best model on each named split."""
    ev = f1_evaluator(label_col)
    return {name: float(ev.evaluate(cv_model.bestModel.transform(df))) for name, df in splits.items()}


@dataclass(frozen=True)
class SvmSearch:
    """A finished grid search.  ``scores`` has a dict a setting, ordered as a grid over maxIter, then regParam;
    ``best`` is the position of the first with the highest mean F1; ``coef`` is the model of that setting on
    all rows, a row a class, intercept last."""
    scores: list[dict]
    best: int
    coef: np.ndarray
    fold_scores: list[dict]
    n_scored: int
    features_col: str

    def predict(self, df: DataFrame, keep: list[str]) -> DataFrame:
        return predict_linear(df, self.coef, self.features_col, keep)

    def frame(self, spark: SparkSession) -> DataFrame:
        """(setting, maxIter, regParam, weightCol, avg_f1)."""
        return spark.createDataFrame([(r["setting"], r["maxIter"], r["regParam"], r["weightCol"], r["avg_f1"])
                                      for r in self.scores],
                                     "setting int, maxIter int, regParam double, weightCol string, avg_f1 double")

    def save(self, spark: SparkSession, path: str, feature_set: str, mode: str = "errorifexists") -> None:
        """The best model as a table (feature_set, features_col, cls, coef, intercept), a row a class."""
        rows = [(feature_set, self.features_col, c, [float(x) for x in r[:-1]], float(r[-1])) for c, r in enumerate(self.coef)]
        spark.createDataFrame(rows, "feature_set string, features_col string, cls int, coef array<double>, "
                                    "intercept double").coalesce(1).write.mode(mode).parquet(path)

    def best_scores(self, splits: dict[str, DataFrame], label_col: str = "label") -> dict[str, float]:
        """Weighted F1 of the best model on each named split."""
        return {name: float(evaluate(self.predict(df, [label_col]), label_col)["f1Score"]) for name, df in splits.items()}


def load_svm(spark: SparkSession, path: str) -> tuple[str, str, np.ndarray]:
    """(feature set, features column, coefficients with the intercept last) of a saved model."""
    rows = sorted(spark.read.parquet(path).collect(), key=lambda r: r.cls)  # one row a class
    if [r.cls for r in rows] != list(range(len(rows))) or not rows:
        raise ValueError(f"{path} isn't a saved model: classes {[r.cls for r in rows]}")
    return rows[0].feature_set, rows[0].features_col, np.array([[*r.coef, r.intercept] for r in rows])


def search_svms(train: DataFrame, features_col: str, width: int, n_classes: int, max_iter=(10, 50, 100),
                reg_param=(0.1, 0.01, 0.001), fold_col: str = "fold", label_col: str = "label",
                weight_col: str | None = "weight", tol: float = 1e-6) -> SvmSearch:
    """Cross-validated grid search of the weighted one-vs-rest SVM on explicit folds.

    All (regParam, fold, class) problems and the final models are fitted together; the longest run holds the shorter
    ones.  Each row is then scored once by each setting, in one pass.
    """
    each = linear_rows(train, features_col, label_col, weight_col, fold_col)
    folds = sorted(r[0] for r in each.select("fold").distinct().collect())
    rows = materialize(packed(each))
    problems = [Problem(c, float(reg), f) for reg in reg_param for f in [*folds, None] for c in range(n_classes)]
    found = fit_svms(rows, problems, width, max(max_iter), tuple(max_iter), tol)
    settings = [(i, float(reg)) for i in max_iter for reg in reg_param]

    def model(i: int, reg: float, fold: int | None) -> np.ndarray:
        return np.stack([found[Problem(c, reg, fold)].kept[i] for c in range(n_classes)])

    cells = materialize(fold_confusion(rows, [{f: model(i, reg, f) for f in folds} for i, reg in settings], n_classes))
    by_fold = [r.asDict() for r in weighted_f1_by(cells, ["setting", "fold"]).collect()]
    means = [float(np.mean([r["f1"] for r in sorted(by_fold, key=lambda r: r["fold"]) if r["setting"] == k]))
             for k in range(len(settings))]
    best = int(np.argmax(means))
    n_scored = cells.filter("setting = 0").agg(F.sum("n")).first()[0]
    release(cells)
    release(rows)
    scores = [{"setting": k, "maxIter": i, "regParam": reg, "weightCol": weight_col, "avg_f1": means[k]}
              for k, (i, reg) in enumerate(settings)]
    return SvmSearch(scores, best, model(*settings[best], None), by_fold, int(n_scored or 0), features_col)

"""Classifiers: weighted one-vs-rest linear SVM, logistic regression, Naive Bayes, MLP.

Thin constructors over Spark ML estimators (their solvers aggregate gradients
across executors), a timed fit on a materialised input, and scoring.
"""

from __future__ import annotations

import time

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (LinearSVC, LogisticRegression, MultilayerPerceptronClassifier,
                                       NaiveBayes, OneVsRest)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

CLASSIFIERS = ("svm", "lr", "nb", "mlp")

# The reference's classifier settings.
DEFAULTS = {
    "svm": {"maxIter": 10, "regParam": 0.1},
    "lr": {"maxIter": 10, "regParam": 0.1},
    "nb": {"smoothing": 1.0, "modelType": "multinomial"},
    "mlp": {"maxIter": 10, "blockSize": 128, "seed": 1234, "hidden": 30},
}


def make_classifier(name: str, features_col: str, label_col: str = "label",
                    weight_col: str | None = "weight", n_features: int | None = None,
                    n_classes: int | None = None, parallelism: int = 1, **params) -> Estimator:
    """Build one of ``svm``, ``lr``, ``nb``, ``mlp`` with the reference's defaults.

    The MLP's layer sizes come from the data (input width, number of classes);
    the reference hard-coded two outputs for six classes, which cannot fit.
    """
    p = dict(DEFAULTS[name])
    p.update(params)
    common = {"featuresCol": features_col, "labelCol": label_col}
    if name == "svm":
        svc = LinearSVC(maxIter=p["maxIter"], regParam=p["regParam"], **common)
        if weight_col:
            svc.setWeightCol(weight_col)
        ovr = OneVsRest(classifier=svc, parallelism=parallelism, **common)
        if weight_col:
            ovr.setWeightCol(weight_col)
        return ovr
    if name == "lr":
        lr = LogisticRegression(maxIter=p["maxIter"], regParam=p["regParam"], **common)
        if weight_col:
            lr.setWeightCol(weight_col)
        return lr
    if name == "nb":
        nb = NaiveBayes(smoothing=p["smoothing"], modelType=p["modelType"], **common)
        if weight_col:
            nb.setWeightCol(weight_col)
        return nb
    if name == "mlp":
        if not n_features or not n_classes:
            raise ValueError("mlp needs n_features and n_classes")
        return MultilayerPerceptronClassifier(layers=[n_features, p["hidden"], n_classes],
                                              maxIter=p["maxIter"], blockSize=p["blockSize"],
                                              seed=p["seed"], **common)
    raise ValueError(f"unknown classifier {name!r}; one of {CLASSIFIERS}")


def materialize(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK,
                cut_lineage: bool = True, partitions: int | None = None) -> DataFrame:
    """Persist and fill the cache now, so a timed fit measures the fit alone.

    ``cut_lineage`` first writes the frame to ``spark.checkpoint.dir``
    (``checkpoint()``, a reliable shared folder on a cluster): a lost
    executor's blocks are re-read instead of recomputed through the feature
    pipeline, and every solver iteration ships a short lineage instead of
    the whole feature plan.  Partitions stay as they are unless the caller says
    how many tasks an iteration shall have: then the written rows are read in
    at most ``partitions``.
    """
    if cut_lineage:
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    if partitions:
        df = df.coalesce(partitions)
    cached = df.persist(level)
    cached.count()
    return cached


def release(df: DataFrame) -> None:
    """Drop the cache of a frame returned by ``materialize``."""
    df.unpersist(blocking=False)


def fit_timed(estimator: Estimator, train: DataFrame) -> tuple[Model, float]:
    """Fit and return (model, wall seconds of the fit only)."""
    start = time.perf_counter()
    model = estimator.fit(train)
    return model, time.perf_counter() - start


def predict(model: Model, df: DataFrame, keep: list[str]) -> DataFrame:
    """Score rows; keep ``keep`` columns plus ``prediction`` (double)."""
    return model.transform(df).select(*keep, F.col("prediction").cast("double").alias("prediction"))

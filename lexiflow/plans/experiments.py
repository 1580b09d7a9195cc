"""The feature-set x classifier matrix and its reports.

The run loop lives on the driver (it is a list of fits), but every fit,
score and metric is a Spark job; each run adds one small row to the result
table, which is built once at the end.
"""

from __future__ import annotations

import time

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.metrics import evaluate
from ..operators.models import fit_timed, make_classifier, materialize, predict, release
from ..operators.quantiles import five_numbers
from ..sources.results import results_frame
from .pipelines import FEATURE_SET_NAMES, FEATURES_COL, num_features_of
from .splits import TRAIN, VAL, is_split

# The reference's order of classifiers within a feature set.
RUN_CLASSIFIERS = ("svm", "lr", "nb")
RESULT_COLS = ["dataModel", "modelName", "trainingTime", "precision", "recall", "f1Score", "dataFrameNo"]


def run_experiments(spark: SparkSession, frame: DataFrame, feature_models: dict[str, PipelineModel],
                    n_classes: int, classifiers=("svm", "lr", "nb"), eval_split: str = VAL,
                    orientation: str = "right", split_col: str = "split", parallelism: int = 1,
                    digits: int = 3, log: list | None = None, train_partitions: int | None = None) -> DataFrame:
    """Fit every (feature set, classifier) pair on train, score ``eval_split``.

    ``orientation='swapped'`` reproduces the reference's published numbers.
    Times are wall seconds of ``fit`` on an already cached training frame; the
    cost of filling the cache is recorded apart in ``log``.  ``train_partitions``:
    how many tasks a solver's iteration shall have at most (a choice of the
    caller, who knows rows and executors; partitions stay as they are without).
    """
    tables = {fs: (model.transform(frame), num_features_of(model, fs)) for fs, model in feature_models.items()}
    return run_on_feature_tables(spark, tables, n_classes, classifiers, eval_split, orientation,
                                 split_col, parallelism, digits, log, train_partitions)


def run_on_feature_tables(spark: SparkSession, tables: dict[str, tuple[DataFrame, int]], n_classes: int,
                          classifiers=("svm", "lr", "nb"), eval_split: str = VAL,
                          orientation: str = "right", split_col: str = "split", parallelism: int = 1,
                          digits: int = 3, log: list | None = None,
                          train_partitions: int | None = None) -> DataFrame:
    """The run loop over already featurized tables: {set: (frame with split/label/weight/features, width)}."""
    rows = []
    for fs, (featurized, n_features) in tables.items():
        feat = FEATURES_COL[fs]
        t0 = time.perf_counter()
        scored = featurized.select(split_col, "label", "weight", feat)
        train = materialize(scored.filter(is_split(TRAIN, split_col)), partitions=train_partitions)
        # Held-out rows are only scored (once per classifier): a cache is enough.
        held = materialize(scored.filter(is_split(eval_split, split_col)), cut_lineage=False)
        if log is not None:
            log.append({"feature_set": fs, "cache_seconds": time.perf_counter() - t0})
        for clf in classifiers:
            est = make_classifier(clf, feat, "label", None if clf == "mlp" else "weight",
                                  n_features=n_features, n_classes=n_classes, parallelism=parallelism)
            fitted, secs = fit_timed(est, train)
            m = evaluate(predict(fitted, held, ["label"]), "label", "prediction", orientation)
            rows.append((FEATURE_SET_NAMES[fs], clf, round(secs, digits), round(m["precision"], digits),
                         round(m["recall"], digits), round(m["f1Score"], digits), run_id(fs, clf)))
            if log is not None:
                log.append({"feature_set": fs, "classifier": clf, "fit_seconds": secs, **m})
        release(train)
        release(held)
    return results_frame(spark, rows)


def run_id(feature_set: str, classifier: str) -> str:
    """The reference's run name of a (feature set, classifier) pair, whichever pairs are run."""
    return f"df{3 * list(FEATURE_SET_NAMES).index(feature_set) + RUN_CLASSIFIERS.index(classifier) + 1}" \
        if classifier in RUN_CLASSIFIERS else f"{feature_set}-{classifier}"


def run_order(df: DataFrame, run_col: str = "dataFrameNo") -> DataFrame:
    """Add ``run`` = the number in ``df<N>`` so runs sort 1, 2, ..., 10 (not as text)."""
    return df.withColumn("run", F.regexp_extract(F.col(run_col), r"(\d+)$", 1).cast("int"))


def union_results(frames: list[DataFrame]) -> DataFrame:
    """Concatenate result tables by column name, duplicates kept."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def results_column_max(df: DataFrame) -> DataFrame:
    """Maximum of every column, strings included."""
    return df.agg(*[F.max(c).alias(c) for c in df.columns])


def time_box_by_group(df: DataFrame, group_col: str, value_col: str = "trainingTime") -> DataFrame:
    """Five-number summary per group, linear-interpolated quartiles (A7); no task holds a group."""
    return five_numbers(df, group_col, value_col)


def results_series(df: DataFrame, run_col: str = "dataFrameNo") -> DataFrame:
    """Metrics and time in run order."""
    shown = [c for c in ("f1Score", "recall", "precision", "trainingTime") if c in df.columns]
    return run_order(df, run_col).select("run", run_col, *shown).orderBy("run")


def best_run(df: DataFrame, metric: str = "f1Score", run_col: str = "dataFrameNo") -> DataFrame:
    """The run with the highest ``metric``; ties go to the earlier run (R2)."""
    return run_order(df, run_col).orderBy(F.col(metric).desc(), F.col("run").asc()).limit(1).drop("run")


def results_by_group(df: DataFrame, group_col: str, metric: str = "f1Score") -> DataFrame:
    """Best and mean ``metric`` per feature set or classifier."""
    return df.groupBy(group_col).agg(F.max(metric).alias(f"max_{metric}"),
                                     F.avg(metric).alias(f"avg_{metric}"),
                                     F.count(F.lit(1)).alias("n_runs"))

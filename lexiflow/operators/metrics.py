"""Classification metrics as DataFrames.

Everything is derived from one aggregation, ``groupBy(label, prediction)``,
whose result has at most k*k rows for k classes; the rest is arithmetic on that
tiny table.  Nothing is collected, nothing crosses into an RDD.

``orientation='right'`` treats ``label_col`` as the truth.  ``'swapped'``
reproduces the reference's result table, which fed the pairs in the wrong
order: precision and recall swap per class, weighted recall still equals
accuracy, and the confusion matrix is transposed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORIENTATIONS = ("right", "swapped")


def _pair(label_col: str, prediction_col: str, orientation: str) -> tuple[str, str]:
    if orientation not in ORIENTATIONS:
        raise ValueError(f"orientation must be one of {ORIENTATIONS}")
    return (label_col, prediction_col) if orientation == "right" else (prediction_col, label_col)


def confusion_long(df: DataFrame, label_col: str = "label", prediction_col: str = "prediction",
                   weight_col: str | None = None, orientation: str = "right") -> DataFrame:
    """(label, prediction, n): one row per non-empty cell, rows = actual class."""
    actual, predicted = _pair(label_col, prediction_col, orientation)
    n = F.sum(F.col(weight_col).cast("double")) if weight_col else F.count(F.lit(1))
    return df.groupBy(F.col(actual).cast("double").alias("label"),
                      F.col(predicted).cast("double").alias("prediction")).agg(n.alias("n"))


def confusion_matrix(df: DataFrame, class_ids: list[float], label_col: str = "label",
                     prediction_col: str = "prediction", orientation: str = "right") -> DataFrame:
    """Wide matrix: one row per actual class, one column per predicted id (ascending), zeros filled."""
    ids = sorted(float(i) for i in class_ids)
    conf = confusion_long(df, label_col, prediction_col, None, orientation)
    wide = conf.groupBy("label").pivot("prediction", ids).agg(F.sum("n")).na.fill(0)
    return wide.orderBy("label")


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def f_measure(p: Column, r: Column, beta: float = 1.0) -> Column:
    b2 = float(beta) * float(beta)
    return _safe_div((1.0 + b2) * p * r, b2 * p + r)


def per_class_metrics(df: DataFrame, label_col: str = "label", prediction_col: str = "prediction",
                      weight_col: str | None = None, orientation: str = "right",
                      beta: float = 1.0) -> DataFrame:
    """(class, actual_n, predicted_n, tp, precision, recall, f_measure) per class id.

    Classes are those seen as label or as prediction.  A zero denominator gives 0.
    """
    conf = confusion_long(df, label_col, prediction_col, weight_col, orientation)
    # Each cell contributes to its actual class and to its predicted class.
    both = conf.select(F.explode(F.array(
        F.struct(F.col("label").alias("class"), F.col("n").cast("double").alias("act"),
                 F.lit(0.0).alias("pred"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
                  .cast("double").alias("tp")),
        F.struct(F.col("prediction").alias("class"), F.lit(0.0).alias("act"),
                 F.col("n").cast("double").alias("pred"), F.lit(0.0).alias("tp")),
    )).alias("c")).select("c.*")
    per = both.groupBy("class").agg(F.sum("act").alias("actual_n"),
                                    F.sum("pred").alias("predicted_n"),
                                    F.sum("tp").alias("tp"))
    p = _safe_div(F.col("tp"), F.col("predicted_n"))
    r = _safe_div(F.col("tp"), F.col("actual_n"))
    return per.select("class", "actual_n", "predicted_n", "tp",
                      p.alias("precision"), r.alias("recall"),
                      f_measure(p, r, beta).alias("f_measure"))


def metrics_by_orientation(df: DataFrame, label_col: str = "label", prediction_col: str = "prediction") -> DataFrame:
    """``weighted_metrics`` for both orientations (column ``orientation``), from one scan of the pairs."""
    cells = confusion_long(df, label_col, prediction_col)
    both = cells.select(F.explode(F.array(
        F.struct(F.lit("right").alias("orientation"), "label", "prediction", "n"),
        F.struct(F.lit("swapped").alias("orientation"), F.col("prediction").alias("label"),
                 F.col("label").alias("prediction"), "n"))).alias("c")).select("c.*")
    each = both.select("orientation", F.explode(F.array(
        F.struct(F.col("label").alias("class"), F.col("n").cast("double").alias("act"), F.lit(0.0).alias("pred"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).cast("double").alias("tp")),
        F.struct(F.col("prediction").alias("class"), F.lit(0.0).alias("act"), F.col("n").cast("double").alias("pred"),
                 F.lit(0.0).alias("tp")))).alias("c")).select("orientation", "c.*")
    per = each.groupBy("orientation", "class").agg(F.sum("act").alias("a"), F.sum("pred").alias("p"), F.sum("tp").alias("tp"))
    p, r = _safe_div(F.col("tp"), F.col("p")), _safe_div(F.col("tp"), F.col("a"))
    total = F.sum("a")
    return per.groupBy("orientation").agg(
        _safe_div(F.sum(F.col("a") * p), total).alias("precision"),
        _safe_div(F.sum(F.col("a") * r), total).alias("recall"),
        _safe_div(F.sum(F.col("a") * f_measure(p, r)), total).alias("f1Score"),
        _safe_div(F.sum("tp"), total).alias("accuracy"))


def weighted_metrics(df: DataFrame, label_col: str = "label", prediction_col: str = "prediction",
                     weight_col: str | None = None, orientation: str = "right",
                     beta: float = 1.0) -> DataFrame:
    """One row: weighted precision, recall, F-measure(beta) and accuracy.

    Weighted = sum over actual classes of (actual share) x per-class value, the
    definition of Spark's multiclass metrics; weighted recall equals accuracy.
    """
    per = per_class_metrics(df, label_col, prediction_col, weight_col, orientation, beta)
    total = F.sum("actual_n")
    return per.agg(
        _safe_div(F.sum(F.col("actual_n") * F.col("precision")), total).alias("precision"),
        _safe_div(F.sum(F.col("actual_n") * F.col("recall")), total).alias("recall"),
        _safe_div(F.sum(F.col("actual_n") * F.col("f_measure")), total).alias("f1Score"),
        _safe_div(F.sum("tp"), total).alias("accuracy"),
    )


def weighted_f1_by(cells: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, f1): weighted F1 of each group of confusion cells (keys, label, prediction, n)."""
    both = cells.select(*keys, F.explode(F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("a"), F.lit(0).cast("long").alias("p"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).cast("long").alias("tp")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("a"), F.col("n").alias("p"),
                 F.lit(0).cast("long").alias("tp")))).alias("c")).select(*keys, "c.*")
    per = both.groupBy(*keys, "class").agg(*[F.sum(c).cast("double").alias(c) for c in ("a", "p", "tp")])
    f1 = f_measure(_safe_div(F.col("tp"), F.col("p")), _safe_div(F.col("tp"), F.col("a")))
    return per.groupBy(*keys).agg(_safe_div(F.sum(F.col("a") * f1), F.sum("a")).alias("f1"))


def accuracy(df: DataFrame, label_col: str = "label", prediction_col: str = "prediction") -> DataFrame:
    """One row: share of rows whose prediction equals the label."""
    hit = F.when(F.col(label_col).cast("double") == F.col(prediction_col).cast("double"), 1.0).otherwise(0.0)
    return df.agg(F.avg(hit).alias("accuracy"))


def evaluate(df: DataFrame, label_col: str = "label", prediction_col: str = "prediction",
             orientation: str = "right", beta: float = 1.0) -> dict:
    """Weighted metrics as a Python dict (one tiny row collected)."""
    row = weighted_metrics(df, label_col, prediction_col, None, orientation, beta).first()
    return row.asDict()

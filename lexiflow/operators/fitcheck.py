"""Objective and gradient of a linear classifier at given coefficients, as aggregations over long features.

An independent look at a fit: nothing of the solver is used.  ``rows`` has an id, a label, a weight and a sparse or dense
vector; features are exploded to (id, feature, value), joined with the coefficients (a row a feature, so bounded by
the vocabulary), summed to one score a class and row, and the residuals go back to the features.

The objective is Spark's: mean weighted loss plus regParam / 2 times the squared coefficients of features
scaled to unit standard deviation; intercepts are free.  ``hinge`` has one problem a class (one-vs-rest),
``log`` is one multinomial problem whose gradient has a part for each class.

Ids must be unique; rows without non-zero features count with their intercepts; null labels or weights are
left out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .features import vector_to_long

LOSSES = ("hinge", "log")


def fit_report(rows: DataFrame, features_col: str, coef: np.ndarray, intercept: np.ndarray, reg: float, loss: str,
               id_col: str = "doc_id", label_col: str = "label", weight_col: str = "weight") -> DataFrame:
    """(cls, objective, gradient): for each class the objective and the norm of its gradient in scaled features,
    intercept included.  ``coef`` has a row a class."""
    if loss not in LOSSES:
        raise ValueError(f"loss must be one of {LOSSES}")
    spark = rows.sparkSession
    classes = range(len(coef))
    named = rows.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"),
                        F.col(weight_col).cast("double").alias("weight"), F.col(features_col).alias("features")).filter(
        "label IS NOT NULL AND weight IS NOT NULL")
    entries = vector_to_long(named, "features", ["id", "weight"], "feature", "value")
    table = spark.createDataFrame([(j, [float(x) for x in coef[:, j]]) for j in range(coef.shape[1])],
                                  "feature int, c array<double>")
    sums = entries.join(table, "feature").groupBy("id").agg(
        *[F.sum(F.col("value") * F.get("c", F.lit(k))).alias(f"s{k}") for k in classes])
    scored = named.select("id", "label", "weight").join(sums, "id", "left")
    z = [F.coalesce(f"s{k}", F.lit(0.0)) + F.lit(float(intercept[k])) for k in classes]
    scored = scored.select("id", "label", "weight", *[c.alias(f"z{k}") for k, c in zip(classes, z)])
    losses, residuals = _hinge(classes) if loss == "hinge" else _log(classes)
    scored = scored.select("id", "weight", *[x.alias(f"l{k}") for k, x in zip(classes, losses)],
                           *[x.alias(f"r{k}") for k, x in zip(classes, residuals)])
    total = F.sum("weight")
    means = scored.agg(total.alias("total"), F.sum(F.col("weight") ** 2).alias("total2"),
                       *[(F.sum(F.col("weight") * F.col(f"l{k}")) / total).alias(f"loss{k}") for k in classes],
                       *[(F.sum(F.col("weight") * F.col(f"r{k}")) / total).alias(f"b{k}") for k in classes])
    weighted = F.col("weight") * F.col("value")
    pulls = entries.join(scored.drop("weight"), "id").groupBy("feature").agg(
        F.sum(weighted).alias("x1"), F.sum(weighted * F.col("value")).alias("x2"),
        *[F.sum(weighted * F.col(f"r{k}")).alias(f"g{k}") for k in classes])
    per = pulls.join(table, "feature").join(F.broadcast(means))  # one row of means
    spread = (F.col("x2") - F.col("x1") ** 2 / F.col("total")) / (F.col("total") - F.col("total2") / F.col("total"))
    per = per.withColumn("sd", F.sqrt(F.greatest(spread, F.lit(0.0)))).filter("sd > 0")
    per = per.withColumn("mean", F.col("x1") / F.col("total"))

    def scaled(k: int) -> Column:
        slope = (F.col(f"g{k}") / F.col("total") - F.col("mean") * F.col(f"b{k}")) / F.col("sd")
        return slope + reg * F.get("c", F.lit(k)) * F.col("sd")

    squares = per.agg(*[F.sum((F.get("c", F.lit(k)) * F.col("sd")) ** 2).alias(f"p{k}") for k in classes],
                      *[F.sum(scaled(k) ** 2).alias(f"n{k}") for k in classes])
    both = squares.join(F.broadcast(means))
    penalties = [F.coalesce(f"p{k}", F.lit(0.0)) * (reg / 2) for k in classes]
    penalty = penalties if loss == "hinge" else [sum(penalties, F.lit(0.0))] * len(penalties)
    out = F.array(*[F.struct(F.lit(k).alias("cls"), (F.col(f"loss{k}") + penalty[k]).alias("objective"),
                             F.sqrt(F.coalesce(f"n{k}", F.lit(0.0)) + F.col(f"b{k}") ** 2).alias("gradient"))
                    for k in classes])
    return both.select(F.explode(out).alias("o")).select("o.*")


def _hinge(classes) -> tuple[list[Column], list[Column]]:
    sign = [F.when(F.col("label") == k, 1.0).otherwise(-1.0) for k in classes]
    short = [1 - s * F.col(f"z{k}") for k, s in zip(classes, sign)]
    return [F.greatest(x, F.lit(0.0)) for x in short], [F.when(x > 0, -s).otherwise(0.0) for x, s in zip(short, sign)]


def _log(classes) -> tuple[list[Column], list[Column]]:
    top = F.greatest(*[F.col(f"z{k}") for k in classes])
    size = sum((F.exp(F.col(f"z{k}") - top) for k in classes), F.lit(0.0))
    own = F.get(F.array(*[F.col(f"z{k}") for k in classes]), F.col("label"))
    loss = F.log(size) + top - own
    return [loss] * len(classes), [F.exp(F.col(f"z{k}") - top) / size - F.when(F.col("label") == k, 1.0).otherwise(0.0)
                                   for k in classes]


def log_loss(scores: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "label") -> DataFrame:
    """(n, loss): mean multinomial log loss of (id, scores) rows, one score a class, over the labelled ids."""
    both = labels.select(id_col, F.col(label_col).cast("int").alias("label")).join(scores, id_col)
    top = F.array_max("scores")
    size = F.aggregate("scores", F.lit(0.0), lambda s, z: s + F.exp(z - top))
    return both.agg(F.count(F.lit(1)).alias("n"), F.avg(F.log(size) + top - F.get("scores", F.col("label"))).alias("loss"))

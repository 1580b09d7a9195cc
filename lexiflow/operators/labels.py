"""Label operators: index, names, class weights, distinct labels.

The label index is fitted once, on training rows, and applied to every split
(the reference fitted one per split, so ids could disagree between splits).
"""

from __future__ import annotations

from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

def fit_label_index(df: DataFrame, input_col: str, output_col: str = "label",
                    handle_invalid: str = "error") -> StringIndexerModel:
    """Ids by descending frequency, ties by label ascending (``frequencyDesc``).

    ``handle_invalid``: ``error`` (unseen or null labels fail), ``skip`` (drop
    those rows) or ``keep`` (they get id ``len(labels)``).
    """
    return StringIndexer(inputCol=input_col, outputCol=output_col,
                         stringOrderType="frequencyDesc",
                         handleInvalid=handle_invalid).fit(df)


def index_labels(model: StringIndexerModel, df: DataFrame) -> DataFrame:
    """Apply a fitted index and cast the id to int."""
    out = model.getOutputCol()
    return model.transform(df).withColumn(out, F.col(out).cast("int"))


def label_table(spark: SparkSession, model: StringIndexerModel,
                id_col: str = "label", name_col: str = "name") -> DataFrame:
    """(id, name) pairs of a fitted index, taken from the model (not hard-coded)."""
    rows = [(i, name) for i, name in enumerate(model.labels)]
    return spark.createDataFrame(rows, f"{id_col} int, {name_col} string")


def label_names(df: DataFrame, model: StringIndexerModel, id_col: str,
                name_col: str) -> DataFrame:
    """Add the display name of an id column (``IndexToString`` with the model's labels)."""
    tmp = f"__{id_col}_d"
    conv = IndexToString(inputCol=tmp, outputCol=name_col, labels=list(model.labels))
    return conv.transform(df.withColumn(tmp, F.col(id_col).cast("double"))).drop(tmp)


def class_weights(df: DataFrame, label_col: str = "label", scheme: str = "share",
                  weight_col: str = "weight") -> DataFrame:
    """Weight per class from one aggregation over the training rows.

    ``share``   = n_c / N (what the reference computes; favours frequent classes);
    ``inverse`` = N / (k * n_c) (balances the classes).
    """
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    if scheme not in ("share", "inverse"):
        raise ValueError("scheme must be 'share' or 'inverse'")
    total, k = counts.agg(F.sum("n"), F.count(F.lit(1))).first()  # two numbers
    w = F.col("n") / F.lit(total) if scheme == "share" else F.lit(total) / (F.lit(k) * F.col("n"))
    return counts.select(label_col, "n", w.cast("double").alias(weight_col))


def apply_class_weight(df: DataFrame, weights: DataFrame | dict, label_col: str = "label",
                       weight_col: str = "weight", default="last") -> DataFrame:
    """Add ``weight_col`` by a join with a class-weight table (label, weight), of any number of classes.

    The table is broadcast, as the label index is that it is counted by: a join by label would deal all rows,
    texts included, out by class, so into as many tasks as there are classes.

    ``default='last'`` reproduces the reference: every other value, null
    included, takes the weight of the highest class id.  A number or None sets
    the fallback explicitly.
    """
    if isinstance(weights, dict):
        if not weights:
            raise ValueError("empty weight table")
        weights = df.sparkSession.createDataFrame([(k, float(v)) for k, v in sorted(weights.items())],
                                                  f"{label_col} int, {weight_col} double")
    table = weights.select(F.col(label_col).alias("_class"), F.col(weight_col).alias("_weight"))
    fallback = default
    if default == "last":
        fallback = table.agg(F.max_by("_weight", "_class")).first()[0]  # one number
    out = df.drop(weight_col).join(F.broadcast(table), F.col(label_col) == F.col("_class"), "left")
    return out.withColumn(weight_col, F.coalesce("_weight", F.lit(fallback).cast("double"))).drop("_class", "_weight")


def distinct_labels(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct values across the given id columns, sorted (e.g. label and prediction); one scan."""
    values = F.array(*[F.col(c).cast("double") for c in cols])
    return df.select(F.explode(values).alias("id")).distinct().orderBy("id")

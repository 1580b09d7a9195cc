import pytest
from pyspark.sql import functions as F

from lexiflow.operators.labels import (apply_class_weight, class_weights, distinct_labels, fit_label_index,
                                       index_labels, label_names, label_table)


def test_label_index_order_and_invalid(spark):
    df = spark.createDataFrame([("x",), ("y",), ("b",), ("b",), ("a",), (None,)], "e string")
    ok = df.filter(F.col("e").isNotNull())
    m = fit_label_index(ok, "e")
    assert list(m.labels) == ["b", "a", "x", "y"]
    with pytest.raises(Exception):
        index_labels(m, df).collect()
    skip = fit_label_index(ok, "e", handle_invalid="skip")
    assert index_labels(skip, df).count() == 5
    keep = fit_label_index(ok, "e", handle_invalid="keep")
    ids = sorted(r["label"] for r in index_labels(keep, df).collect())
    assert ids == [0, 0, 1, 2, 3, 4]
    names = label_table(spark, m, "label", "name").collect()
    assert [tuple(r) for r in names] == [(0, "b"), (1, "a"), (2, "x"), (3, "y")]
    back = label_names(index_labels(m, ok), m, "label", "name").select("e", "name").collect()
    assert all(r["e"] == r["name"] for r in back)


def test_split_specific_index_disagrees(spark):
    # Trap D1: fitting on each split gives ids that depend on that split's frequencies.
    train = spark.createDataFrame([("en",)] * 3 + [("fr",)] * 2 + [("de",)], "e string")
    val = spark.createDataFrame([("en",)] * 3 + [("de",)] * 2 + [("fr",)], "e string")
    assert list(fit_label_index(train, "e").labels) != list(fit_label_index(val, "e").labels)
    shared = fit_label_index(train, "e")
    assert index_labels(shared, val).filter("e = 'fr'").first()["label"] == 1


def test_class_weights_share_and_inverse(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 3 + [(2,)], "label int")
    share = {r["label"]: r["weight"] for r in class_weights(df, "label", "share").collect()}
    assert share == pytest.approx({0: 0.6, 1: 0.3, 2: 0.1})
    inv = {r["label"]: r["weight"] for r in class_weights(df, "label", "inverse").collect()}
    assert inv == pytest.approx({0: 10 / 18, 1: 10 / 9, 2: 10 / 3})


def test_apply_weight_otherwise_takes_last_class(spark):
    df = spark.createDataFrame([(0,), (1,), (7,), (None,)], "label int")
    out = [r["weight"] for r in apply_class_weight(df, {0: 0.5, 1: 0.3, 2: 0.2}).collect()]
    assert out == [0.5, 0.3, 0.2, 0.2]
    out2 = [r["weight"] for r in apply_class_weight(df, {0: 0.5, 1: 0.3, 2: 0.2}, default=None).collect()]
    assert out2 == [0.5, 0.3, None, None]


def test_distinct_labels_sorted(spark):
    df = spark.createDataFrame([(2.0, 0.0), (1.0, 1.0), (0.0, 3.0)], "label double, prediction double")
    assert [r["id"] for r in distinct_labels(df, ["label", "prediction"]).collect()] == [0.0, 1.0, 2.0, 3.0]

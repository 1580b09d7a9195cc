"""Traps of SURVEY 2.12 not covered elsewhere."""

from pyspark.sql import functions as F

from lexiflow.functions.text import clean_text
from lexiflow.operators.metrics import confusion_matrix
from lexiflow.operators.models import materialize, release
from lexiflow.plans.pipelines import g1_pipeline, vocabulary_of


def test_d6_empty_token_enters_vocabulary(spark):
    df = spark.createDataFrame([("I am so happy at home",), ("it is a joy to be here",)], "text string")
    cleaned = df.withColumn("text_c", clean_text("text"))
    assert "" in vocabulary_of(g1_pipeline().fit(cleaned))
    assert "" not in vocabulary_of(g1_pipeline(drop_empty=True).fit(cleaned))


def test_d8_matrix_ids_sorted(spark):
    df = spark.createDataFrame([(2.0, 0.0), (0.0, 2.0), (1.0, 1.0)], "label double, prediction double")
    wide = confusion_matrix(df, [2, 0, 1])
    assert wide.columns == ["label", "0.0", "1.0", "2.0"]
    assert [r["label"] for r in wide.collect()] == [0.0, 1.0, 2.0]


def test_d10_materialize_fills_cache(spark):
    df = spark.range(1000).repartition(4).withColumn("x", F.col("id") * 2)
    out = materialize(df)
    assert out.storageLevel.useMemory and out.is_cached
    assert out.rdd.getNumPartitions() == 4
    assert out.count() == 1000
    release(out)
    assert not out.is_cached

"""The minimum end-to-end slice (``entry``): documents -> per-class metrics."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.metrics import per_class_metrics
from ..operators.models import make_classifier, predict
from ..sources.tables import read_table
from .pipelines import fit_feature_sets
from .prepare import documents_as_labeled, prepare
from .splits import TRAIN, VAL, assign_split, is_split


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = assign_split(documents_as_labeled(read_table(spark, os.path.join(sf_dir, "documents.parquet"))))
    prep = prepare(docs)
    (g3,) = fit_feature_sets(prep.frame, ("G3",)).values()
    feats = g3.transform(prep.frame).select("doc_id", "split", "label", "weight", "featuresIDF")
    nb = make_classifier("nb", "featuresIDF").fit(feats.filter(is_split(TRAIN)))
    scored = predict(nb, feats.filter(is_split(VAL)), ["label"])
    per = per_class_metrics(scored)
    names = spark.createDataFrame(list(enumerate(prep.labels)), "class_id int, name string")
    return (per.join(F.broadcast(names), per["class"] == names["class_id"].cast("double"), "left")
               .drop("class_id").orderBy("class"))

"""Score a stream of texts with fitted models (Structured Streaming).

All fitted stages used here (label-free cleaning, lemmas, tokenizer, count
vectors, IDF, hashing, classifiers) concern single rows: no state store, no
watermark.  Each micro-batch is cleaned, lemmatized with the table that the
models were fitted with, scored and written to a folder of its own, named by
the batch's number and overwritten if the batch is repeated; with the query's
checkpoint in the shared folder a restarted query gives each row once.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.text import clean_text
from ..operators.lemma import lemmatize
from ..session import work_path


def scoring_frame(rows: DataFrame, feature_model: Model, classifier: Model, keep: list[str],
                  text_col: str = "text", clean_col: str = "text_c", lemmas: DataFrame | None = None) -> DataFrame:
    """Rows -> ``keep`` columns + ``prediction``; ``lemmas`` as given to ``prepare``."""
    prepared = rows.withColumn(clean_col, clean_text(text_col))
    if lemmas is not None:
        prepared = lemmatize(prepared, lemmas, clean_col)
    scored = classifier.transform(feature_model.transform(prepared))
    return scored.select(*keep, F.col("prediction").cast("double").alias("prediction"))


def start_scoring(spark: SparkSession, source_path: str, schema: StructType, feature_model: Model,
                  classifier: Model, keep: list[str], sink_path: str | None = None,
                  before: Callable[[DataFrame], DataFrame] | None = None,
                  available_now: bool = True, text_col: str = "text",
                  lemmas: DataFrame | None = None) -> tuple[StreamingQuery, str]:
    """Start a query reading Parquet files at ``source_path``; returns (query, sink path).

    ``source_path`` is a folder or a glob (a single file is read through a glob
    on its own name, as the file source lists folders).  ``before`` is applied
    to the raw stream (e.g. derive and filter a split).
    """
    if source_path.endswith(".parquet") and not source_path.endswith("]"):
        source_path = source_path[:-1] + "[" + source_path[-1] + "]"
    stream = spark.readStream.schema(schema).parquet(source_path)
    if before is not None:
        stream = before(stream)
    sink_path = sink_path or work_path(spark, "stream-scores")

    def score(batch: DataFrame, number: int) -> None:
        out = scoring_frame(batch, feature_model, classifier, keep, text_col, lemmas=lemmas)
        out.write.mode("overwrite").parquet(os.path.join(sink_path, "data", f"batch={number}"))

    writer = stream.writeStream.foreachBatch(score).option("checkpointLocation",
                                                           os.path.join(sink_path, "_checkpoint"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start(), sink_path


def read_scores(spark: SparkSession, sink_path: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sink_path, "data")).drop("batch")

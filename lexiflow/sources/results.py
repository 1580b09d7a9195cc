"""The experiment result table.

One row per (feature set, classifier) run.  The table is bounded by the size of
the experiment grid, never by the data, so writing it as a single CSV file is
fine.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import remove_path

RESULTS_SCHEMA = T.StructType([
    T.StructField("dataModel", T.StringType(), False),
    T.StructField("modelName", T.StringType(), False),
    T.StructField("trainingTime", T.DoubleType(), True),
    T.StructField("precision", T.DoubleType(), True),
    T.StructField("recall", T.DoubleType(), True),
    T.StructField("f1Score", T.DoubleType(), True),
    T.StructField("dataFrameNo", T.StringType(), False),
])


def results_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Build the result table from rows in ``RESULTS_SCHEMA`` order, in one go."""
    return spark.createDataFrame(rows, RESULTS_SCHEMA)


def write_results_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write the result table as one CSV file named ``path``, with a header.

    The table is written to a folder beside it, and its only part is renamed to ``path``: readers see no file or
    a whole one.  ``mode``: ``errorifexists`` or ``overwrite``.
    """
    if mode not in ("errorifexists", "error", "overwrite"):
        raise ValueError("mode must be errorifexists or overwrite")
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(target) and mode != "overwrite":
        raise FileExistsError(path)
    folder = f"{path}.part-{uuid.uuid4().hex}"
    try:
        df.coalesce(1).write.option("header", True).csv(folder)
        (part,) = [f.getPath() for f in fs.listStatus(hadoop.Path(folder)) if f.getPath().getName().endswith(".csv")]
        if mode == "overwrite":
            fs.delete(target, True)
        if not fs.rename(part, target):
            raise FileExistsError(path)
    finally:
        remove_path(spark, folder)


def read_results_csv(spark: SparkSession, path: str, schema: T.StructType | str = RESULTS_SCHEMA) -> DataFrame:
    """Read a result table written by ``write_results_csv`` (S5), types declared."""
    return spark.read.schema(schema).option("header", True).csv(path)

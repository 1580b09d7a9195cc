"""Reading input tables.

Text stages (regex cleaning, tokenizing) cost CPU per byte, and a Parquet
file with a single row group is one task however many cores there are.
``partitions`` deals such an input out round-robin (Spark sorts before that,
so a retried task gets the same rows).  It is the caller's choice: nothing is
shuffled unless asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.repartition(partitions) if partitions else df

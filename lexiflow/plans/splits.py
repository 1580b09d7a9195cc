"""Train / test / validation assignment inside one DataFrame.

The reference read three files; here one table carries a ``split`` column so
every stage is planned once over all rows and a split is a filter (a partition
filter once written with ``partitionBy('split')``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN, TEST, VAL = "train", "test", "val"


def split_expr(id_col: str = "doc_id", buckets: int = 10, test_bucket: int = 8,
               val_bucket: int = 9) -> Column:
    """Deterministic split from an integer id: bucket = pmod(id, buckets).

    Default: buckets 0-7 train, 8 test, 9 val (80/10/10).  Every row lands in
    exactly one split.
    """
    b = F.pmod(F.col(id_col), F.lit(buckets))
    return (F.when(b == test_bucket, F.lit(TEST))
             .when(b == val_bucket, F.lit(VAL))
             .otherwise(F.lit(TRAIN)))


def assign_split(df: DataFrame, id_col: str = "doc_id", split_col: str = "split", **kw) -> DataFrame:
    return df.withColumn(split_col, split_expr(id_col, **kw))


def is_split(name: str, split_col: str = "split") -> Column:
    return F.col(split_col) == F.lit(name)

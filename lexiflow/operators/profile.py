"""Profiling operators: split sizes, class counts, filters, null drop, preview."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_sizes(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Rows per split and the column count of the frame (the reference's shape)."""
    n_cols = len([c for c in df.columns if c != split_col])
    return (df.groupBy(split_col)
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumn("n_cols", F.lit(n_cols).cast("bigint")))


def class_counts(df: DataFrame, label_col: str, by: list[str] | None = None) -> DataFrame:
    """Rows per class (optionally per extra keys); partial + final hash aggregate."""
    keys = list(by or []) + [label_col]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def filter_class(df: DataFrame, label_col: str, value) -> DataFrame:
    """Rows of one class."""
    return df.filter(F.col(label_col) == F.lit(value))


def drop_null_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows holding a null in any of ``subset`` (all columns by default)."""
    return df.na.drop(how="any", subset=subset)


def preview(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """First ``n`` rows in a defined order (top-k: per-partition top-n, then merge)."""
    return df.orderBy(*order_by).limit(n)

"""Digests of a table that don't depend on the order of its rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def table_digest(df: DataFrame, by: list[str]) -> DataFrame:
    """(by..., n_rows, total, flips): rows of each group, the sum of their 64-bit hashes and the exclusive or of hashes
    under another seed.  Columns count by name order, so their order doesn't matter; equal rows count each."""
    one, two = _hashes(df)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(one).alias("total"), F.bit_xor(two).alias("flips"))


def _hashes(df: DataFrame):
    columns = sorted(df.columns)
    return F.xxhash64(*columns).cast("decimal(38,0)"), F.xxhash64(F.lit(1), *columns)


def digested(df: DataFrame, by: str, values: Sequence[str]) -> tuple[DataFrame, Callable[[], dict]]:
    """``df``, and a function that tells {value of ``by``: (n_rows, total, flips)}, as ``table_digest`` has them, of the
    rows that the next action on that frame (a write) reads: rows aren't made a second time for their digest.  Rows
    whose ``by`` is none of ``values`` aren't counted."""
    df = _beside(df)
    one, two = _hashes(df)
    seen = Observation()
    sums = []
    for k, value in enumerate(values):
        own = F.col(by) == F.lit(value)
        sums += [F.count(F.when(own, 1)).alias(f"n{k}"), F.sum(F.when(own, F.col("_one"))).alias(f"t{k}"),
                 F.bit_xor(F.when(own, F.col("_two"))).alias(f"f{k}")]
    observed = df.withColumns({"_one": one, "_two": two}).observe(seen, *sums).drop("_one", "_two")

    def found() -> dict:
        got = seen.get
        return {v: (got[f"n{k}"], got[f"t{k}"], got[f"f{k}"]) for k, v in enumerate(values) if got[f"n{k}"]}

    return observed, found


def _beside(df: DataFrame) -> DataFrame:
    """The same rows in a copy of their session.  A session that has observed once can't be sent to tasks any more, and plans
    that hold theirs (parallel SVM fits) fail from then on."""
    spark = df.sparkSession
    copy = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    plan = df._jdf.queryExecution().logical()
    return DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(copy._jsparkSession, plan), copy)

"""Exact quantiles per group when a group is too large for one task.

``percentile`` keeps all different values of a group in one task.  Here equal values are counted first (so a
value that fills a third of a group is one row), the (group, value) pairs are dealt out in ranges of
(group, value), which cut through large groups, and a value's rank is the count of its group's rows in
earlier ranges plus those before it in its own range.  No task holds more than a range.

Quantiles are interpolated linearly between neighbouring ranks, as ``percentile`` does.  Null values don't
count; a group of nulls only has null quantiles; the null group is a group; NaN ranks above all numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def quantiles_by_group(df: DataFrame, group_col: str, value_col: str, probabilities: dict[str, float],
                       ranges: int | None = None) -> DataFrame:
    """(group_col, a double column for each name in ``probabilities``).

    ``ranges``: how many ranges to deal out to; the session's ``spark.sql.shuffle.partitions`` by default.
    """
    for name, p in probabilities.items():
        if not 0 <= p <= 1:
            raise ValueError(f"{name}: {p} is no probability")
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(F.col(group_col).alias("g"), F.col(value_col).cast("double").alias("v")).agg(
        F.count(F.lit(1)).alias("n"))
    dealt = counts.filter("v IS NOT NULL").repartitionByRange(ranges, "g", "v").withColumn(
        "part", F.spark_partition_id()).checkpoint(eager=True)
    # At most one row for each range and each group boundary.
    parts = dealt.groupBy("g", "part").agg(F.sum("n").alias("here"))
    in_group = Window.partitionBy("g")
    parts = parts.select("g", "part", (F.sum("here").over(in_group.orderBy("part")) - F.col("here")).alias("before"),
                         F.sum("here").over(in_group).alias("total"))
    ranked = dealt.join(parts.select(F.col("g").alias("pg"), F.col("part").alias("pp"), "before", "total"),
                        F.col("g").eqNullSafe(F.col("pg")) & (F.col("part") == F.col("pp")))
    end = F.col("before") + F.sum("n").over(Window.partitionBy("g", "part").orderBy("v"))
    ranked = ranked.select("g", "v", "total", (end - F.col("n")).alias("start"), end.alias("end"))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("start") <= rank) & (rank < F.col("end")), F.col("v")))

    aggs = []
    for name, p in probabilities.items():
        place = F.lit(float(p)) * (F.col("total") - 1)
        low = F.floor(place)
        aggs += [at(low).alias(f"{name}_low"), at(F.ceil(place)).alias(f"{name}_high"),
                 F.max(place - low).alias(f"{name}_share")]
    found = ranked.groupBy("g").agg(*aggs)

    def between(name: str) -> Column:
        low, high, share = (F.col(f"{name}_{part}") for part in ("low", "high", "share"))
        return F.when((share == 0) | (low == high), low).otherwise((1 - share) * low + share * high).alias(name)

    groups = df.select(F.col(group_col).alias("all_g")).distinct()
    return groups.join(found, F.col("all_g").eqNullSafe(F.col("g")), "left").select(
        F.col("all_g").alias(group_col), *[between(name) for name in probabilities])


FIVE_NUMBERS = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}


def five_numbers(df: DataFrame, group_col: str, value_col: str, ranges: int | None = None) -> DataFrame:
    """Minimum, quartiles and maximum per group."""
    return quantiles_by_group(df, group_col, value_col, FIVE_NUMBERS, ranges)



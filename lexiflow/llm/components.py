"""Connected components of a link table by alternating large-star and small-star steps.

Links (a, b) with a > b are rewired until every node points at the smallest node of its component: a large
star sends the larger neighbours of a node to its smallest neighbour, a small star the smaller ones.  Each
step is one aggregation and one join; no neighbourhood is gathered and nothing reaches the driver but two
numbers a step, which tell whether anything changed.  Least neighbours are written before the join: it
then has an exchange on both sides, so that Spark can split the many links of a hub over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _rewire(links: DataFrame, large: bool) -> DataFrame:
    if large:  # (a, b) -> (a, smallest of b and its neighbours)
        least = links.select(F.col("b").alias("u"), F.col("b").alias("v")).unionByName(
            links.select(F.col("a").alias("u"), F.col("b").alias("v"))).groupBy("u").agg(F.min("v").alias("m"))
        least = materialise(least, "least")
        return links.join(least, links["b"] == least["u"]).select("a", F.col("m").alias("b")).distinct()
    least = materialise(links.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u"), "least")
    moved = links.join(least, links["a"] == least["u"])  # (a, b) -> (b, smallest of a), (a, smallest of a)
    return moved.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                          F.struct("a", F.col("m").alias("b")))).alias("l")).select(
        "l.*").filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link; ``links`` has longs a and b in any order."""
    current = materialise(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(
        "a <> b").distinct(), "links")
    state = None
    while True:
        for large in (True, False):
            current = materialise(_rewire(current, large), "links")
        n, total = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
        if (n, total) == state or n == 0:
            break
        state = (n, total)
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())

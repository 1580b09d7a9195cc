import random

import pytest
from pyspark.sql import functions as F

from lexiflow.operators.quantiles import FIVE_NUMBERS, five_numbers, quantiles_by_group


def percentiles(df, probabilities):
    return {r["g"]: tuple(r)[1:] for r in df.groupBy("g").agg(
        *[F.percentile("v", p).alias(n) for n, p in probabilities.items()]).collect()}


def frame(spark, rows, parts=5):
    return spark.createDataFrame(rows, "g string, v double").repartition(parts)


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_equals_percentile(spark, ranges):
    r = random.Random(ranges)
    rows = [(r.choice(["a", "b", None, ""]), r.choice([None, 0.0, -0.0, 1e300, r.gauss(0, 1), float(r.randrange(5))]))
            for _ in range(700)] + [("one", 3.5), ("two", 1.0), ("two", 2.0), ("nulls", None), ("nulls", None)]
    df = frame(spark, rows)
    probabilities = FIVE_NUMBERS | {"p1": 0.01, "p99": 0.99, "third": 1 / 3}
    got = {x["g"]: tuple(x)[1:] for x in quantiles_by_group(df, "g", "v", probabilities, ranges).collect()}
    expect = percentiles(df, probabilities)
    assert set(got) == set(expect)
    for g in expect:
        assert got[g] == pytest.approx(expect[g], rel=1e-12, abs=1e-12) if expect[g][0] is not None else got[g] == expect[g]


def test_hot_group_is_cut_and_a_hot_value_is_one_row(spark):
    rows = [("hot", float(i)) for i in range(4000)] + [("hot", 7.0)] * 3000 + [("cold", 1.0)]
    df = frame(spark, rows)
    found = five_numbers(df, "g", "v", 8)
    assert {r["g"]: tuple(r)[1:] for r in found.collect()} == percentiles(df, FIVE_NUMBERS)
    ranges = df.groupBy("g", "v").count().repartitionByRange(8, "g", "v").withColumn("p", F.spark_partition_id())
    sizes = [r["count"] for r in ranges.groupBy("p").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 4000 / 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan.lower()


def test_empty_and_wrong(spark):
    assert five_numbers(frame(spark, [], 1), "g", "v").count() == 0
    with pytest.raises(ValueError, match="no probability"):
        quantiles_by_group(frame(spark, [], 1), "g", "v", {"x": 1.5})

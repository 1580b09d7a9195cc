"""Property tests: DataFrame metrics and tokenizer against plain-Python definitions."""

import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lexiflow.operators.features import tokenizer
from lexiflow.operators.metrics import evaluate

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def brute_force(pairs, beta=1.0):
    n = len(pairs)
    act = Counter(label for _, label in pairs)
    pred = Counter(p for p, _ in pairs)
    tp = Counter(label for p, label in pairs if p == label)
    out = {"precision": 0.0, "recall": 0.0, "f1Score": 0.0}
    for c, a in act.items():
        p = tp[c] / pred[c] if pred[c] else 0.0
        r = tp[c] / a
        f = (1 + beta ** 2) * p * r / (beta ** 2 * p + r) if (p + r) else 0.0
        out["precision"] += a / n * p
        out["recall"] += a / n * r
        out["f1Score"] += a / n * f
    out["accuracy"] = sum(tp.values()) / n
    return out


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=40))
def test_weighted_metrics_property(spark, pairs):
    df = spark.createDataFrame([(float(p), float(l)) for p, l in pairs], "prediction double, label double")
    got = evaluate(df)
    exp = brute_force(pairs)
    for k in exp:
        assert got[k] == pytest.approx(exp[k], abs=1e-12)
    swapped = evaluate(df, orientation="swapped")
    assert swapped["recall"] == pytest.approx(exp["accuracy"], abs=1e-12)


def java_split_lower(s):
    parts = re.split(r"[ \t\n\x0b\f\r]", s.lower())
    while parts and parts[-1] == "" and len(parts) > 1:
        parts.pop()
    if parts == [""] and s != "":
        return []
    return parts


@SETTINGS
@given(st.lists(st.text(alphabet="ab C\t\n", max_size=12), min_size=1, max_size=8))
def test_tokenizer_property(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["w"] for r in tokenizer("t", "w").transform(df).collect()]
    assert got == [java_split_lower(t) for t in texts]

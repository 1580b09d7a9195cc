"""Memberships by plain Python, rates between bounds, and what the pipeline's mixing stage may cost."""

import math
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as P
from lexiflow.llm import mixing as M
from lexiflow.llm.common import table
from tests.llm.helpers import odd_docs
from tests.llm.test_advice_r02 import members_of

DOMAINS = ["calm", "loud"]


def features_of(text):
    """(tokens, 5-letter beginnings and shapes) of a text."""
    text = text or ""
    words = [w for w in re.split(r"[^\w]+|_", text.lower()) if w]
    n = max(len(text), 1)
    shapes = (f"=d{math.floor(len(set(words)) / max(len(words), 1) * 10)}",
              f"=u{math.floor(min(len(re.findall('[A-Z]', text)) / n * 20, 9))}",
              f"=s{math.floor(min(len(re.findall('[#*$%&|<>!]', text)) / n * 20, 9))}",
              f"=n{math.floor(min(math.log2(len(words) + 1) / 2, 9))}")
    return len(words), [w[:5] for w in dict.fromkeys(words)] + list(shapes)


def weights_of(rows):
    """{feature: weights} and log priors from (domain number, features)."""
    counts = [sum(d == i for d, _ in rows) for i in range(len(DOMAINS))]
    total = sum(counts)
    own = [Counter(f for d, fs in rows if d == i for f in set(fs)) for i in range(len(DOMAINS))]
    table = {}
    for f in set().union(*own):
        share = (sum(c[f] for c in own) + 0.5) / (total + 1)
        sure = max(math.log((c[f] + 0.5) / (n + 1) / share) - 3 * math.sqrt(1 / (c[f] + 0.5)) if c[f] >= M.LEAST_DOCS else -1
                   for c, n in zip(own, counts))
        if sure > 0:
            table[f] = [math.log((c[f] + 5 * share) / (n + 5)) - math.log(share) for c, n in zip(own, counts)]
    return table, [math.log((n + 1) / (total + len(counts))) for n in counts]


def evidence(fs, table):
    hits = [table[f] for f in fs if f in table]
    return len(hits), [sum(h[i] for h in hits) for i in range(len(DOMAINS))]


def posterior(found, s, t, g, doubt, base, shares):
    z = np.array(s) / (t * (found + 1) ** g) + base
    e = np.exp(z - z.max())
    return (1 - doubt) * e / e.sum() + doubt * np.array(shares)


def test_memberships_equal_plain_python(spark):
    r = np.random.default_rng(8)
    markers = [f"{chr(97 + i)}{chr(98 + i)}mark" for i in range(12)]
    odds = np.linspace(0.02, 0.5, 12)
    texts, domain = [], []
    for i in range(400):
        d = int(r.random() < 0.3)
        own = [m for m, o in zip(markers, odds if d else odds[::-1]) if r.random() < o]
        texts.append(" ".join([f"w{j}xyz" for j in r.integers(0, 26, 12)] + own))
        domain.append(d)
    texts += ["", None, "ABMARK! ***"]
    docs = spark.createDataFrame([(i, t, "x", 0.5) for i, t in enumerate(texts)], "doc_id long, text string, domain string, p double")
    labelled = spark.createDataFrame([(i, DOMAINS[d]) for i, d in enumerate(domain)], "doc_id long, domain string")
    half = {x.id: x.h for x in spark.range(400).selectExpr("id", "CAST(pmod(xxhash64(id, 7), 2) AS INT) h").collect()}
    rows = [(d, features_of(texts[i])[1]) for i, d in enumerate(domain)]
    table_, priors = weights_of(rows)
    shares = np.exp(priors) / np.exp(priors).sum()
    seen = []
    for h in (0, 1):
        other, _ = weights_of([x for i, x in enumerate(rows) if half[i] == h])
        seen += [(d, *evidence(fs, other)) for i, (d, fs) in enumerate(rows) if half[i] == 1 - h]
    sizes, best = np.array([sum(d == i for d in domain) for i in range(2)]), None
    for t in M.TEMPERATURES:
        for g in M.POWERS:
            base = list(priors)
            for _ in range(M.ROUNDS):
                got = sum(posterior(n, s, t, g, 0.0, base, shares) for _, n, s in seen)
                base = list(base + np.log((sizes + 0.5) / (got + 0.5)))
            for doubt in M.DOUBTS:
                loss = np.mean([-math.log(posterior(n, s, t, g, doubt, base, shares)[d]) for d, n, s in seen])
                best = min(best or (9, 0, 0, 0, 0), (round(loss, 9), t, g, doubt, base))
    got = {x.doc_id: x for x in M.memberships(docs, labelled, DOMAINS).collect()}
    assert len(got) == len(texts) and len(table_) > 3
    for i, text in enumerate(texts):
        n, fs = features_of(text)
        assert got[i].tokens == n
        assert np.allclose(got[i].p, posterior(*evidence(fs, table_), *best[1:], shares), atol=2e-4), (i, text)
    assert len({tuple(x.p) for x in got.values()}) > 17


@pytest.mark.parametrize("limits", [(), ("b",)])
def test_rates_between_bounds_equal_a_plain_solver(spark, limits):
    r = np.random.default_rng(6)
    p, t = r.dirichlet([0.06, 0.03], 500), r.integers(1, 500, 500)
    found, told = M.fit_rates(members_of(spark, p, t), {"a": 0.95, "b": 0.05}, "down", 0.0, limits)
    w, goal = t / t.sum(), np.array([told["goal"]["a"], told["goal"]["b"]])
    metric = np.linalg.inv((p * w[:, None]).T @ p)
    got = np.array([x.rate for x in found.orderBy("doc_id").collect()])
    assert got.min() >= 0 and got.max() <= 1
    if limits:  # the limit holds
        assert told["reached"]["b"] <= 0.05 * 1.001 * sum(told["reached"].values()) and not told["over_limit"]
        return
    rate, ahead, turn = np.ones(500), np.ones(500), 1.0
    for _ in range(20000):
        new = np.clip(ahead - (p @ (metric @ ((ahead * w) @ p - goal)) + M.RIDGE * (ahead - 1)) / (1 + M.RIDGE), 0, 1)
        if (ahead - new) @ (new - rate) > 0:
            turn = 1.0
        again = (1 + (1 + 4 * turn * turn) ** 0.5) / 2
        rate, ahead, turn = new, new + (turn - 1) / again * (new - rate), again
    assert np.abs(got - rate).max() < 0.01
    # no rate can improve along its slope
    slope = p @ (metric @ ((got * w) @ p - goal)) + M.RIDGE * (got - 1)
    assert np.sqrt((w * (np.clip(got - slope, 0, 1) - got) ** 2).sum()) < 2e-3


def test_limit_that_cannot_be_met_is_reported(spark, caplog):
    found, told = M.fit_rates(members_of(spark, np.tile([0.8, 0.2], (50, 1)), np.full(50, 9)), {"a": 0.97, "b": 0.03},
                              "down", 0.0, ("b",))
    assert told["over_limit"] == ["b"] and "over their limits" in caplog.text and found.count() == 50


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_mixing_stage_spares_clean_documents(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    for _, stage in P.STAGES[:3]:
        docs = P.materialise(stage(spark, docs, sf), "test-stage")
    told = {}
    marks = labels.filter("toxic IS NOT NULL").selectExpr("doc_id", "IF(toxic = 1, 'toxic', 'clean') AS domain")
    out = M.mix(docs, marks, P.TARGETS, total="down", limits=("toxic",), told=told)
    out = [r.doc_id for r in out.select("doc_id").collect()]
    before = {r.doc_id: r.n for r in docs.selectExpr("doc_id", "size(split(text, ' ')) AS n").collect()}
    assert len(out) == len(set(out)) and set(out) <= set(before)
    mark = {r.doc_id: r.toxic for r in labels.collect()}
    clean = [i for i in before if mark.get(i) == 0]
    assert sum(i not in set(out) for i in clean) <= 0.01 * len(clean)
    kept = [i for i in out if i in mark]
    assert sum(before[i] for i in kept if mark[i] == 1) <= 0.03 * sum(before[i] for i in kept)
    if sf.endswith("0.1"):
        assert not told["over_limit"] and told["reached"]["toxic"] <= 0.0301 * sum(told["reached"].values())
        assert len(out) > 0.88 * len(before)


def test_clashing_columns(spark):
    names = ("domain", "label", "p", "rate", "tokens", "_times", "_id", "key", "row", "_l", "_text")
    docs = odd_docs(spark).drop("key", "row")
    for n in names:
        docs = docs.withColumn(n, M.F.lit("x"))
    labels = spark.createDataFrame([(7, 1, 1, "z"), (13, 0, 0, "z"), (15, 1, 0, "z")], "doc_id long, quality int, toxic int, text string")
    assert M.report(docs, labels).count() == docs.count()
    out = M.mix(docs, M.label_domains(labels), {"good": 1.0, "poor": 1.0}, least=1.0)
    assert out.columns == docs.columns and out.filter("domain <> 'x'").count() == 0
    with pytest.raises(ValueError, match="can't be named"):
        M.memberships(docs, M.label_domains(labels), ["good"], id_col="row")

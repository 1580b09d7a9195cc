import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from lexiflow.llm import mixing as M
from lexiflow.llm import quality_gbdt
from tests.llm.helpers import odd_docs, odd_texts, words
from tests.llm.test_near_and_repeats import brute_links

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels")]


def test_rates_reach_the_targets(tables):
    docs, labels = tables
    rows = M.report(docs, labels).toPandas()
    assert len(rows) == docs.count() and (rows.rate >= 0).all()
    p = rows[[f"p_{d}" for d in M.TARGETS]].to_numpy()
    assert np.allclose(p.sum(1), 1, atol=1e-4)
    t = rows.n_tokens.to_numpy()
    for weights in (rows.rate, rows.copies):  # expected tokens, and those of the copies drawn
        share = (p * (t * weights).to_numpy()[:, None]).sum(0) / t.sum()
        assert np.allclose(share, list(M.TARGETS.values()), atol=0.03)


def test_rates_equal_a_plain_solver(spark):
    r = np.random.default_rng(6)
    p, t = r.dirichlet([0.3, 0.3], 400), r.integers(1, 500, 400)
    members = spark.createDataFrame([(i, int(a), b.tolist()) for i, (a, b) in enumerate(zip(t, p))],
                                    "doc_id long, tokens long, p array<double>")
    found, told = M.fit_rates(members, {"a": 0.8, "b": 0.2})
    m = (p * t[:, None]).T @ p / t.sum()
    metric, rate, goal = np.linalg.inv(m), np.ones(400), np.array([0.8, 0.2])
    for _ in range(4000):
        slope = metric @ ((rate * t) @ p / t.sum() - goal)
        rate = np.maximum(0, rate - 0.3 * (p @ slope + M.RIDGE * (rate - 1)))
    got = np.array([r.rate for r in found.orderBy("doc_id").collect()])
    assert abs(told["reached"]["a"] - ((rate * t) @ p / t.sum())[0]) < 0.02 and np.abs(got - rate).max() < 0.15


def test_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(7, 1, 1), (7, 0, 0), (13, 0, 0), (None, 1, 1), (9, None, None), (15, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    for l_ in (labels, labels.limit(0)):
        assert M.report(docs, l_).count() == len(odd_texts())
    assert M.report(docs.limit(0), labels).count() == 0
    out = M.mix(docs, M.label_domains(labels), {"good": 1.0, "poor": 1.0}, least=1.0)
    assert out.columns == docs.columns and out.count() >= docs.select("doc_id", "text").distinct().count()


def by_id(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_stages_equal_brute_force(spark, tables):
    """Each stage against plain Python on its own input; the two trained ones against what they must respect."""
    docs, labels = tables
    outs = [docs]
    for _, stage in P.STAGES:
        outs.append(P.materialise(stage(spark, outs[-1], SF), "test-stage"))
    assert [n for n, _ in P.STAGES] == ["quality classifier", "exact dedup", "MinHash near-dedup", "mixing", "BPE"]
    assert all(o.columns == docs.columns for o in outs[:-1])

    trees = quality_gbdt.train(docs, labels)
    texts = by_id(docs)
    score = dict(zip(texts, trees.score(quality_gbdt.features([t or "" for t in texts.values()]))))
    assert by_id(outs[1]) == {i: t for i, t in texts.items() if score[i] >= quality_gbdt.THRESHOLD}

    first = {}
    for i, t in sorted(by_id(outs[1]).items()):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), (i, t))
    assert by_id(outs[2]) == dict(first.values())

    rows = sorted(by_id(outs[2]).items())
    kept = {i for (i, _), (_, _, c) in zip(rows, brute_links(rows, 5)) if i == c}
    assert by_id(outs[3]) == {i: t for i, t in rows if i in kept}

    before, after = by_id(outs[3]), by_id(outs[4])
    assert set(after) <= set(before) and all(before[i] == t for i, t in after.items())
    toxic = {r.doc_id for r in labels.filter("toxic = 1").collect()}
    drawn = [r.doc_id for r in outs[4].select("doc_id").collect()]
    share = lambda ids: sum(len(words(before[i])) for i in ids if i in toxic) / sum(
        len(words(before[i])) for i in ids)
    assert share(drawn) < 0.7 * share(before)

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    whole.no_truncation()
    whole.no_padding()
    got = outs[5].collect()
    assert sorted(r.doc_id for r in got) == sorted(drawn)
    for r in got:
        ids = whole.encode(before[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids, r.decoded) == (len(ids), ids, whole.decode(ids, skip_special_tokens=False))


def test_stages_on_odd_and_empty_tables(spark):
    docs = odd_docs(spark)
    for rows in (docs, docs.limit(0)):
        for _, stage in P.STAGES[1:]:
            rows = P.materialise(stage(spark, rows, SF), "odd-stage")
        assert rows.columns == ["doc_id", "source", "n_tokens", "ids", "decoded"]

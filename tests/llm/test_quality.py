import numpy as np
import pytest

from lexiflow.llm import quality_gbdt as Q
from lexiflow.llm import quality_rules as R
from lexiflow.llm import toxicity as T
from lexiflow.llm.stats import COUNTS, measure
from tests.llm.helpers import odd_docs, odd_texts, words

SF = "/root/testdata/sf0.01"


def naive_counts(text):
    w, text = [x.decode() for x in words(text)], text or ""
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    inside = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside))


@pytest.mark.parametrize("text", [t for _, t in odd_texts() if len(t or "") < 5000] + ["a b\na b\n\n a b\n#|", "x x x x"])
def test_counts(text):
    assert measure(text or "")[:5] == naive_counts(text)


def test_trees_equal_recursion():
    r = np.random.default_rng(1)
    x = np.round(r.normal(size=(500, 4)), 1)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    model = Q.fit(x, y, trees=20, depth=3)

    def one(row):
        total = model.base
        for f, c, leaf in zip(model.feature, model.cut, model.leaf):
            at = 0
            while at < len(f):
                at = 2 * at + (2 if row[f[at]] > c[at] else 1)
            total += leaf[at - len(f)]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(model.score(x), [one(v) for v in x])
    assert ((model.score(x) > 0.5) == (y > 0.5)).mean() > 0.95
    assert Q.fit(x[:0], y[:0]).score(x).tolist() == [0.5] * 500


def auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return (np.sum(pos[:, None] > neg) + 0.5 * np.sum(pos[:, None] == neg)) / (len(pos) * len(neg))


@pytest.mark.parametrize("module, label, least", [(Q, "quality", 0.97), (T, "toxic", 0.8)])
def test_held_out_accuracy(spark, module, label, least):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    found = module.report(docs, labels)
    assert found.count() == docs.count()
    rows = found.filter("held_out").join(labels, "doc_id").toPandas()
    assert auc(rows[label].to_numpy(), rows["score"].to_numpy()) >= least


@pytest.mark.parametrize("module", [Q, T])
def test_odd_rows(spark, module):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(7, 1, 1), (7, 0, 0), (13, 0, 1), (None, 1, 1), (9, None, None), (15, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    for l_ in (labels, labels.limit(0)):
        rows = module.report(docs, l_).collect()
        assert len(rows) == len(odd_texts()) and all(0 <= r.score <= 1 for r in rows)
        assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    assert module.report(docs.limit(0), labels).count() == 0


def test_keep_good_keeps_columns(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    marks = kept.join(labels, "doc_id", "right").groupBy("quality").agg({"text": "count", "doc_id": "count"}).toPandas()
    share = dict(zip(marks["quality"], marks["count(text)"] / marks["count(doc_id)"]))
    assert share[1] > 0.98 and share[0] < 0.1


def test_non_negative_risk_learns_from_positive_and_unlabelled():
    r = np.random.default_rng(2)
    toxic = lambda: sorted({0} | set(r.choice(np.arange(2, 40), 6)))
    clean = lambda: sorted({1} | set(r.choice(np.arange(2, 40), 6)))
    positive = [toxic() for _ in range(200)]
    unlabelled = [toxic() if i % 5 == 0 else clean() for i in range(1000)]
    w, b = T.fit_nnpu(positive, unlabelled, 40, 0.2)
    score = lambda row: 1 / (1 + np.exp(-(w[row].sum() + b)))
    assert np.mean([score(x) > 0.5 for x in positive]) > 0.95
    assert np.mean([score(clean()) < 0.5 for _ in range(200)]) > 0.95


def test_rules_on_odd_rows(spark):
    docs = odd_docs(spark)
    rows = R.report(docs).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows), key=key)
    want = sorted(((i, *(measure(t or "")[:5])) for i, t in odd_texts()), key=key)
    assert got == want
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed)  # too few rows for any group
    assert R.report(docs.limit(0)).count() == 0


def test_mcd_equals_numpy(spark, monkeypatch):
    r = np.random.default_rng(3)
    x = np.vstack([r.normal(size=(900, R.SIZE)) @ np.diag(np.linspace(0.5, 2, R.SIZE)), r.normal(6, 1, (100, R.SIZE))])
    rows = spark.createDataFrame([(["g"], v.tolist()) for v in x], "keys array<string>, x array<double>")
    found = R.estimates_of(rows).first()
    bins = np.floor(x * 64)
    quartile = lambda f: (np.sort(bins, 0)[int(np.ceil(f * len(x))) - 1] + 0.5) / 64
    center, cov = quartile(0.5), np.diag(((quartile(0.75) - quartile(0.25)) / 1.349) ** 2)
    for _ in range(R.STEPS):
        z = np.linalg.solve(np.linalg.cholesky(cov + np.diag(R.FLOOR ** 2)), (x - center).T)
        at = np.floor(np.log2((z ** 2).sum(0) + 1e-6) * R.FINENESS)
        near = at <= np.sort(at)[int(np.ceil(R.KEPT_SHARE * len(x))) - 1]
        center, cov = x[near].mean(0), R.CONSISTENCY * np.cov(x[near].T, bias=True)
    assert found.n == 1000 and np.allclose(found.center, center, atol=1e-6)
    assert np.allclose(found.whiten, R.whitening(cov), atol=1e-6)
    z = np.linalg.solve(np.linalg.cholesky(cov + np.diag(R.FLOOR ** 2)), (x - center).T)
    assert ((z ** 2).sum(0)[900:] > R.CUTOFF).mean() > 0.9 and ((z ** 2).sum(0)[:900] > R.CUTOFF).mean() < 0.01


def test_rules_part_junk_from_prose(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = R.report(docs).join(labels, "doc_id").filter("NOT base_failed").toPandas()
    assert rows[rows.quality == 1].kept.mean() > 0.99 and rows[rows.quality == 0].kept.mean() < 0.05

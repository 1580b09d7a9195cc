"""Cases of the third review: clashing columns, counts over all documents, the risk's slope, tokenizer files."""

import json
import math

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from lexiflow.llm import bpe
from lexiflow.llm import quality_gbdt as Q
from lexiflow.llm import toxicity as T
from tests.llm.helpers import odd_docs, odd_texts, prose

SF = "/root/testdata/sf0.01"
CLASH = ("label", "_label", "_id", "p", "t", "f", "domain", "bucket", "pos", "all", "id", "score", "_text", "toxic", "quality")


def clashing(docs):
    for name in CLASH:
        docs = docs.withColumn(name, F.lit("x"))
    return docs


@pytest.mark.parametrize("module, label", [(Q, "quality"), (T, "toxic")])
def test_clashing_columns(spark, module, label):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.filter("doc_id < 300")
    plain = {r.doc_id: r.score for r in module.report(docs, labels).collect()}
    more = labels.withColumn("text", F.lit(1)).withColumn("p", F.lit(1)).withColumn("label", F.lit("z"))
    assert {r.doc_id: r.score for r in module.report(clashing(docs), more).collect()} == plain


def test_stages_on_odd_and_clashing_tables(spark):
    """All five stages on odd rows with clashing columns; the first four keep the columns."""
    docs = clashing(odd_docs(spark))
    for rows in (docs, docs.limit(0)):
        before = rows
        for name, stage in P.STAGES:
            rows = P.materialise(stage(spark, rows, SF), "odd-stage")
            if name != "BPE":
                assert rows.columns == docs.columns
                assert rows.exceptAll(before).count() == 0
        assert rows.columns == ["doc_id", "source", "n_tokens", "ids", "decoded"]


def test_first_stage_on_odd_rows_equals_scores(spark):
    docs = odd_docs(spark)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    trees = Q.train(docs, labels)
    score = trees.score(Q.features([t or "" for _, t in odd_texts()]))
    got = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in P.keep_good(spark, docs, SF).collect())
    assert got == sorted((i is None, i or 0, t or "") for (i, t), s in zip(odd_texts(), score) if s >= Q.THRESHOLD)


def sets_of(rows):
    return [(*T._rows(r), len(r)) for r in rows]


def plain_risk(positive, unlabelled, w, b, prior):
    f = lambda row: sum(w[j] for j in row) + b
    loss = lambda z: math.log1p(math.exp(-abs(z))) + max(-z, 0)
    mean = lambda rows, sign: sum(loss(sign * f(r)) for r in rows) / len(rows)
    bracket = mean(unlabelled, -1) - prior * mean(positive, -1)
    return prior * mean(positive, 1) + max(0.0, bracket), bracket


@pytest.mark.parametrize("shift", [-2.0, 0.5])
def test_risk_and_slope_equal_loops_and_differences(shift):
    r = np.random.default_rng(4)
    positive = [sorted(r.choice(12, r.integers(0, 6), replace=False).tolist()) for _ in range(30)]
    unlabelled = [sorted(r.choice(12, r.integers(0, 6), replace=False).tolist()) for _ in range(80)]
    if shift < 0:
        positive, unlabelled = [x + [12] for x in positive], unlabelled  # confirmed rows score high: the bracket is negative
    w, b, prior = np.append(r.normal(0, 0.3, 12), 9.0 if shift < 0 else 0.0), shift, 0.4
    sets = sets_of([positive, unlabelled])
    risk, slope, below = T.risk_and_slope(sets, w, b, prior)
    expect, bracket = plain_risk(positive, unlabelled, w, b, prior)
    assert risk == pytest.approx(expect) and below.any() == (bracket < 0)
    for j in range(14):
        step = np.zeros(14)
        step[j] = 1e-6
        up, down = (plain_risk(positive, unlabelled, w + s * step[:13], b + s * step[13], prior) for s in (1, -1))
        assert slope[j] == pytest.approx((up[0] - down[0]) / 2e-6, abs=1e-6)
        if bracket < 0:
            assert below[j] == pytest.approx((up[1] - down[1]) / 2e-6, abs=1e-6)


def test_fit_stops_when_the_risk_has_settled(caplog):
    r = np.random.default_rng(2)
    rows = lambda first, n: [sorted({first} | set(r.choice(np.arange(2, 40), 6).tolist())) for _ in range(n)]
    positive, unlabelled = rows(0, 200), rows(0, 200) + rows(1, 800)
    w, b = T.fit_nnpu(positive, unlabelled, 40, 0.2)
    again, base = T.fit_nnpu(positive, unlabelled, 40, 0.2, settled=0, steps=3_000)
    assert caplog.text.count("still moves") <= 1
    caplog.clear()
    w, b = T.fit_nnpu(positive, unlabelled, 40, 0.2)
    sets = sets_of([positive, unlabelled])
    assert "still moves" not in caplog.text
    assert abs(T.risk_and_slope(sets, w, b, 0.2)[0] - T.risk_and_slope(sets, again, base, 0.2)[0]) < 0.01
    T.fit_nnpu(positive, unlabelled, 40, 0.2, steps=5)
    assert "still moves" in caplog.text


def test_features_are_counted_over_all_documents(spark):
    """A word that is common outside the sampled unlabelled rows is no marker; the counts equal loops."""
    texts = [prose(i, 30) + " sharedmark" + (" badmark" if i % 2 else "") for i in range(30)]
    texts += [prose(100 + i, 30) + (" sharedmark" if i % 3 == 0 else "") for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    some = T._occurrences(docs.select(F.lit(1).cast("long").alias("all"), F.col("text").alias("t")), ["all"])
    got = {r.bucket: r["all"] for r in some.collect()}
    expect = {}
    for text in texts:
        for code in T.WordFeatures().of(text):
            expect[code] = expect.get(code, 0) + 1
    assert got == expect
    code = lambda word: (T.xxhash.xxh3_64_intdigest(word) >> (64 - T.HASH_BITS)) * T.LEVELS
    confirmed = docs.filter("doc_id < 30").select("doc_id")
    model = T.train(docs, confirmed, 0.1, max_unlabelled=10)
    assert code(b"=badmark") in model.buckets and code(b"=sharedmark") in model.buckets  # 30 of 30 against 163 of 430
    model = T.train(docs.withColumn("text", F.concat("text", F.lit(" sharedmark"))), confirmed, 0.1, max_unlabelled=10)
    assert code(b"=badmark") in model.buckets and code(b"=sharedmark") not in model.buckets


def write_variant(tmp_path, **changes):
    spec = json.load(open(public_tokenizers.path("word_bpe_49k.json")))
    for key, value in changes.items():
        if key in spec["model"] or key in bpe.UNSUPPORTED:
            spec["model"][key] = value
        else:
            spec[key] = value
    path = str(tmp_path / "variant.json")
    json.dump(spec, open(path, "w"))
    return path


def test_cased_file_and_file_without_normaliser(tmp_path):
    text = "Hello World AND lower, MiXed é İ"
    path = write_variant(tmp_path, normalizer=None)
    ids = bpe.Encoder(path).encode_batch([text.encode()]).to_pylist()[0]
    assert ids == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    path = write_variant(tmp_path, normalizer={"type": "NFC"})
    assert bpe.Encoder(path).encode_batch([text.encode()]).to_pylist()[0] == Tokenizer.from_file(path).encode(
        text, add_special_tokens=False).ids


@pytest.mark.parametrize("key, value", [("byte_fallback", True), ("ignore_merges", True), ("continuing_subword_prefix", "##"),
                                        ("pre_tokenizer", None)])
def test_unsupported_files_are_refused(tmp_path, key, value):
    with pytest.raises(Exception, match="not supported|subword|prefix|Error"):
        bpe.Encoder(write_variant(tmp_path, **{key: value}))

import pytest
from pyspark.ml.feature import IDF
from pyspark.sql import functions as F

from lexiflow.operators.features import (TermVocabulary, chi2_statistics, hashing_tf, vector_to_long,
                                         vocabulary_list)


@pytest.fixture()
def corpus(spark):
    return spark.createDataFrame([(0, ["b", "a", "c", "a"]), (1, ["d", "b", "e"]), (2, ["c"])],
                                 "doc_id long, toks array<string>")


def test_vocabulary_ties_by_term(corpus):
    assert vocabulary_list(corpus, "toks", 1000) == ["a", "b", "c", "d", "e"]
    assert vocabulary_list(corpus, "toks", 2) == ["a", "b"]


def test_vocabulary_independent_of_partitioning(spark, corpus):
    base = vocabulary_list(corpus, "toks")
    for n in (1, 2, 3, 7):
        assert vocabulary_list(corpus.repartition(n), "toks") == base


def test_idf_values(corpus):
    cv = TermVocabulary(inputCol="toks", outputCol="tf", vocabSize=1000).fit(corpus)
    tf = cv.transform(corpus)
    model = IDF(inputCol="tf", outputCol="x", minDocFreq=0).fit(tf)
    got = dict(zip(cv.vocabulary, model.idf.toArray()))
    assert got == pytest.approx({"a": 0.693147, "b": 0.287682, "c": 0.287682, "d": 0.693147, "e": 0.693147},
                                abs=1e-6)
    long = vector_to_long(tf, "tf", ["doc_id"]).collect()
    assert sorted((r["doc_id"], r["feature"], r["value"]) for r in long)[:2] == [(0, 0, 2.0), (0, 1, 1.0)]


def test_hash_buckets(spark):
    df = spark.createDataFrame([(["abcd"],), (["abc"],), (["i feel"],), (["ab cd ef"],)], "g array<string>")
    out = hashing_tf("g", "v", 1000).transform(df).collect()
    assert [int(r["v"].indices[0]) for r in out] == [100, 976, 974, 719]


def test_hashed_total_equals_bigram_count(spark):
    from lexiflow.plans.catalog import q_hashed_bigram_totals
    from tests.conftest import SF001
    df = q_hashed_bigram_totals(spark, SF001)
    assert df.filter(F.col("n_bigrams") < 0).count() == 0
    assert df.count() == 200


def test_chi2_single_category(spark):
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(0.0, Vectors.dense([1.0, 0.0])), (1.0, Vectors.dense([1.0, 2.0])),
                                (1.0, Vectors.dense([1.0, 2.0]))], ["label", "f"])
    rows = {r["feature"]: r for r in chi2_statistics(df, "f", "label", 2).collect()}
    assert rows[0]["dof"] == 0 and rows[0]["statistic"] == 0.0 and rows[0]["log_p"] == 0.0
    assert rows[1]["dof"] == 1 and rows[1]["statistic"] == pytest.approx(3.0)


def test_chi2_equals_spark_and_has_no_cap(spark):
    import math
    import random

    from pyspark.ml.linalg import Vectors
    from pyspark.ml.stat import ChiSquareTest
    r = random.Random(3)
    rows = [(float(i % 3), Vectors.sparse(4, {0: float(r.randrange(3)), 1: float(i % 3 == 1), 3: float(r.randrange(9) + 1)}))
            for i in range(300)]
    df = spark.createDataFrame(rows, ["label", "f"])
    want = {x["featureIndex"]: x for x in ChiSquareTest.test(df, "f", "label", flatten=True).collect()}
    got = {x["feature"]: x for x in chi2_statistics(df, "f", "label", 4).collect()}
    assert set(got) == {0, 1, 2, 3}
    for j, x in got.items():
        assert x["dof"] == want[j]["degreesOfFreedom"]
        assert x["statistic"] == pytest.approx(want[j]["statistic"], abs=1e-8)
        if want[j]["pValue"] > 1e-250:
            assert x["log_p"] == pytest.approx(math.log(want[j]["pValue"]), rel=1e-6, abs=1e-9)
    many = spark.range(10_050).rdd.map(lambda i: (float(i[0] % 2), Vectors.dense([float(i[0])]))).toDF(["label", "f"])
    x = chi2_statistics(many, "f", "label").first()
    assert x["dof"] == 10_049 and x["statistic"] == pytest.approx(10_050)


def test_log_tail_beyond_underflow():
    from lexiflow.operators.features import log_chi2_tail
    assert log_chi2_tail(2.0, 2) == pytest.approx(-1.0)
    assert log_chi2_tail(5000.0, 2) == pytest.approx(-2500.0)
    assert log_chi2_tail(3.841458820694124, 1) == pytest.approx(-2.995732273553991)
    assert log_chi2_tail(10.0, 40) == pytest.approx(0.0, abs=1e-6) and log_chi2_tail(0.0, 3) == 0.0


def test_sparse_and_dense_entries(spark):
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(1, Vectors.dense([0.0, 2.0, 0.0])), (2, Vectors.sparse(1 << 18, {7: 1.5, 9: 0.0})),
                                (3, Vectors.sparse(5, {}))], ["k", "v"])
    assert sorted(map(tuple, vector_to_long(df, "v", ["k"]).collect())) == [(1, 1, 2.0), (2, 7, 1.5)]


def test_chi2_rank_by_statistic(spark):
    from pyspark.ml.linalg import Vectors

    from lexiflow.operators.features import chi2_selector
    rows = [(0.0, Vectors.dense([1.0, 0.0, 5.0])), (0.0, Vectors.dense([1.0, 0.0, 5.0])),
            (1.0, Vectors.dense([2.0, 1.0, 5.0])), (1.0, Vectors.dense([2.0, 0.0, 5.0]))]
    df = spark.createDataFrame(rows, ["label", "f"])
    model = chi2_selector("f", "sel", "label", 1, rank_by="statistic").fit(df)
    assert model.getIndices() == [0]
    out = model.transform(df).first()["sel"]
    assert out.size == 1
    by_p = chi2_selector("f", "sel", "label", 2).fit(df)
    assert by_p.getIndices() == [0, 1]

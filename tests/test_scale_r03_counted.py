"""Texts are cut into Arrow columns: a word is looked up once a slice, and a set alone is counted by one function."""

import random

import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel

from lexiflow.functions.stopwords import ENGLISH_STOP_WORDS
from lexiflow.operators import counted as N
from lexiflow.operators import features as X
from lexiflow.operators import lemma as L
from lexiflow.plans import pipelines as P

R = random.Random(7)
WORDS = ["", "The", "a", "fox", "Füchse", "ΑΣ", "日本", "x😀y", "dog's", "|", "İi", "ran"]
TEXTS = ["", " ", "\t\n  ", "a", "the", " the fox ", "x\x0by\fz\rq\n", "one  two   three", "ab" * 700 + " c", "no break here",
         *("".join(R.choice(WORDS) + R.choice([" ", "  ", "\n", "\t"]) for _ in range(R.randrange(60))) for _ in range(90))]


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(i, t, t[::-1], ("train", "test", "val")[max(0, i % 10 - 7)], i % 2, "en", 0.5) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, text_c string, split string, label int, emotion string, "
                                       "weight double").repartition(3)


@pytest.mark.parametrize("name", ["G1", "G3", "G4"])
@pytest.mark.parametrize("part", [1, 4 << 20])
def test_a_set_alone_has_the_vectors_of_its_stages(frame, monkeypatch, name, part):
    monkeypatch.setattr(L, "PART_BYTES", part)
    models, counted = P.fit_and_count(frame, (name,), vocab_size=9, num_hash=50)
    single = {"G1": P.g1_pipeline(9), "G3": P.g3_pipeline(9), "G4": P.g4_pipeline(50)}[name].fit(frame.filter("split = 'train'"))
    assert "UDF(" not in counted.frame._jdf.queryExecution().logical().toString()
    if name != "G4":
        assert P.vocabulary_of(models[name]) == P.vocabulary_of(single)
    for col in ("rawFeatures", "featuresIDF"):
        rows = [{r.doc_id: r[col] for r in f.select("doc_id", col).collect()} for f in (
            counted.finish(name, models[name]), models[name].transform(frame), single.transform(frame))]
        assert rows[0] == rows[1]
        assert all(rows[0][i].squared_distance(rows[2][i]) < 1e-18 for i in rows[0])


def test_hashes_are_those_of_hashing_tf(frame):
    stages = PipelineModel(stages=[X.tokenizer("text", "w"), X.stop_words_remover("w", "f"), X.ngrams("f", "g", 2),
                                   X.hashing_tf("g", "v", 1 << 18)])
    both = stages.transform(frame).select("v", N.hashed_bigram_counts("text", 1 << 18, ENGLISH_STOP_WORDS).alias("own")).collect()
    assert all(r.v == r.own for r in both) and sum(r.v.numNonzeros() for r in both) > 500


def test_stages_are_not_run_for_a_set_alone(frame, monkeypatch):
    calls = []
    side = P._side_by_side
    monkeypatch.setattr(P, "_side_by_side", lambda *a, **k: calls.append(a) or side(*a, **k))
    P.fit_and_count(frame, ("G3",), vocab_size=4)
    P.fit_and_count(frame, ("G4",), num_hash=8)
    assert not calls


@pytest.mark.parametrize("names", [("G3",), ("G4",), ("G3", "G4")])
def test_null_texts_fail_alone_as_side_by_side(spark, frame, names):
    rows = frame.limit(2).unionByName(spark.createDataFrame([(1, None, None, "train", 0, "en", 0.5)], frame.schema))
    with pytest.raises(Exception, match="null"):
        P.fit_and_count(rows, names, vocab_size=4, num_hash=8)


def test_words_are_looked_up_once_a_slice():
    class Counting(dict):
        asked = 0

        def get(self, *a):
            Counting.asked += 1
            return dict.get(self, *a)

    texts = pa.array(["dogs ran  dogs", None, "", "dogs cats"] * 50)
    held = Counting(dogs="dog")
    assert L._replaced(texts, held, {"cats": ""}).to_pylist() == ["dog ran  dog", None, "", "dog "] * 50
    assert Counting.asked == 4
    assert [sorted(x) for x in L._unknown(texts.slice(1, 3), {"ran": "ran"}).to_pylist()] == [[], [], ["cats", "dogs"]]

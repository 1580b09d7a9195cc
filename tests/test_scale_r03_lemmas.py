"""The shared state: texts are cleaned once, and a lemma table is made of a corpus' different words."""

from pyspark.sql import functions as F

from lexiflow.operators import lemma as N
from lexiflow.plans import catalog as C
from lexiflow.plans import prepare as P

TEXTS = ["dogs  ran <b>dogs</b> stopped", "", None, "  walking\tdogs cities", "Cities é cities", "walking"]


def test_state_cleans_texts_once(spark, tmp_path, monkeypatch):
    docs = [(i, t or "", "en" if i % 3 else "fr", "web", len(t or "")) for i, t in enumerate(TEXTS * 5)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet")
    calls = []
    for module in (C, P):
        clean = module.clean_text
        monkeypatch.setattr(module, "clean_text", lambda c, clean=clean: calls.append(c) or clean(c))
    st = C._State(spark, str(tmp_path))
    assert len(calls) == 1
    assert {r.form: r.lemma for r in st.lemmas.collect()} == {
        "dogs": "dog", "stopped": "stopp", "cities": "city", "Cities": "City", "walking": "walk", "walkingdogs": "walkingdog"}
    alone = P.prepare(st.docs, lemmas=st.lemmas)
    assert sorted(st.frame.collect()) == sorted(alone.frame.collect())


def test_lemmas_of_the_written_frame(spark):
    docs = spark.createDataFrame([*enumerate(TEXTS)], "i long, t string")
    seen = []
    got = N.lemmatize(docs, lambda frame, col: seen.append((frame, col)) or N.rule_table(frame, col), "t", "l")
    table = N.lemmatize(docs, N.rule_table(docs, "t"), "t", "l")
    assert sorted(map(str, got.collect())) == sorted(map(str, table.collect()))
    assert got.filter("i = 2").first().l is None and got.filter("i = 1").first().l == ""
    ((frame, col),) = seen
    assert col == "t" and frame.count() == len(TEXTS)


def test_distinct_forms_send_each_word_of_a_batch_once(spark):
    docs = spark.createDataFrame([*enumerate(TEXTS * 3)], "i long, t string").repartition(3)
    found = N.distinct_forms(docs, "t")
    assert sorted(r.form for r in found.collect()) == sorted({w for t in TEXTS if t for w in t.split(" ") if w})
    assert "Generate" not in N.rule_table(docs, "t")._jdf.queryExecution().optimizedPlan().toString()
    assert N.distinct_forms(docs.filter(F.lit(False)), "t").count() == 0
    assert N.distinct_forms(docs.filter("t IS NULL"), "t").count() == 0

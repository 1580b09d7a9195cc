"""The steps that the queries on feature sets share: each runs once a row, in as many tasks as the input has."""

import re

from pyspark.sql import functions as F

from lexiflow.functions.text import NON_LETTER_PATTERN, keep_letters
from lexiflow.plans import catalog


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_letters_by_a_class_without_negated_union(spark):
    assert "[^a-zA-Z ]" not in NON_LETTER_PATTERN
    texts = ["", "a b\tc\nd", "Äpfel sind grün", "x😀y", "".join(map(chr, range(1, 0x250))), "\x00A^Z[`{", "日本 go", " kKİ"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", keep_letters("text").alias("t")).collect()
    assert {r.i: r.t for r in rows} == {i: re.sub("[^a-zA-Z ]", "", t) for i, t in enumerate(texts)}


def test_long_forms_make_their_arrays_once(spark, tmp_path):
    spark.createDataFrame([(1, "the red fox <b>jumps</b> over", "en"), (2, "", "en"), (4, "word", "en")],
                          "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    found = catalog.q_ngrams(spark, str(tmp_path))
    assert plan_of(found).count("regexp_replace") == 3
    assert [tuple(r) for r in found.orderBy("doc_id", "pos").collect()] == [(1, 0, "red fox"), (1, 1, "fox jumps")]



def test_class_weights_leave_rows_where_they_lie(spark):
    from lexiflow.operators.labels import apply_class_weight
    rows = spark.range(40).select("id", (F.col("id") % 2).cast("int").alias("label")).repartition(5)
    weights = spark.createDataFrame([(0, 0.25), (1, 0.75)], "label int, weight double").checkpoint()
    found = apply_class_weight(rows.checkpoint(), weights)
    assert "Exchange hashpartitioning" not in plan_of(found)
    assert {(r.label, r.weight) for r in found.collect()} == {(0, 0.25), (1, 0.75)}


def test_lemmas_of_frequent_forms_join_nothing(spark, monkeypatch):
    """Frequent forms are known to the tasks; rare ones still meet the table, and lemmas aren't looked up again."""
    from lexiflow.operators import lemma
    rows = [(i, f"runs  runs go rare{i} dogs") for i in range(64)]
    docs = spark.createDataFrame(rows, "i int, t string").repartition(1)
    table = {"runs": "dogs", "dogs": "rare1"} | {f"rare{i}": f"dogs{i % 2 or ''}" for i in range(0, 64, 3)}
    lemmas = spark.createDataFrame(list(table.items()), "form string, lemma string")
    sizes = []
    dealt = lemma._dealt
    monkeypatch.setattr(lemma, "_dealt", lambda pairs: sizes.append(pairs.count()) or dealt(pairs))
    for held in (200_000, 2, 0):
        monkeypatch.setattr(lemma, "HELD_FORMS", held)
        got = {r.i: r.t for r in lemma.lemmatize(docs, lemmas, "t").collect()}
        assert got == {i: " ".join(table.get(w, w) for w in t.split(" ")) for i, t in rows}
    assert sizes == [0, 8, 16]  # different forms of the 4 rows counted that aren't held


def test_wanted_toxicity_features_are_found_by_bucket():
    """One lookup a bucket, none a (bucket, level) code, and the same features as before."""
    from lexiflow.llm.toxicity import LEVELS, WordFeatures

    class Counting(dict):
        asked = 0

        def __contains__(self, key):
            Counting.asked += 1
            return dict.__contains__(self, key)

    text = "Boarding boards board, boarded! A be bee é ... (x) badly"
    every = WordFeatures().of(text)
    wanted = Counting({c: i for i, c in enumerate(sorted(every)[::2])} | {7 * LEVELS + 1: 99})
    features = WordFeatures(wanted)
    Counting.asked = 0
    assert sorted(features.of(text)) == sorted(dict.__getitem__(wanted, c) for c in every if dict.__contains__(wanted, c))
    assert Counting.asked == 0

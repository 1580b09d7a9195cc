"""Four sets side by side are counted as columns, and texts are cleaned as columns, with the rows of Spark's stages."""

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import SparkSession

from lexiflow.operators import cleaning
from lexiflow.operators import counted as N
from lexiflow.operators import lemma as L
from lexiflow.plans import catalog as C
from lexiflow.plans import pipelines as P
from lexiflow.plans import prepare as R

RANDOM = random.Random(11)
WORDS = ["", "The", "a", "fox", "Füchse", "ΑΣ", "日本", "x😀y", "dog's", "|", "İi", "ran"]
TEXTS = ["", " ", "\t\n  ", "the", " the fox ", "x\x0by\fz\rq\n", "one  two   three",
         *("".join(RANDOM.choice(WORDS) + RANDOM.choice([" ", "  ", "\n"]) for _ in range(RANDOM.randrange(50))) for _ in range(60))]


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(i, t, t[::-1], ("train", "test", "val")[max(0, i % 10 - 7)], i % 2, "en", 0.5) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, text_c string, split string, label int, emotion string, "
                                       "weight double").repartition(3)


@pytest.mark.parametrize("part,held", [(1, 3), (4 << 20, 2_000_000)])
def test_sets_by_columns_are_those_of_the_stages(frame, monkeypatch, part, held):
    monkeypatch.setattr(L, "PART_BYTES", part)
    monkeypatch.setattr(N, "HELD_WORDS", held)
    wanted = {"vocab_size": 9, "num_hash": 50, "chi2_top": 4}
    stages, by_stages = P.fit_and_count(frame, **wanted)
    models, counted = P.fit_and_count(frame, by_columns=True, **wanted)
    assert [f.name for f in counted.frame.schema] == [f.name for f in by_stages.frame.schema]
    for name in models:
        for col in ("rawFeatures", P.FEATURES_COL[name]):
            rows = [sorted((r.doc_id, str(r[col])) for r in c.finish(name, m[name]).select("doc_id", col).collect())
                    for m, c in ((models, counted), (stages, by_stages))]
            assert rows[0] == rows[1] and len(rows[0]) == len(TEXTS)


def test_sets_by_columns_of_no_rows(frame):
    models, counted = P.fit_and_count(frame.filter("false"), ("G4",), num_hash=4, by_columns=True)
    assert counted.finish("G4", models["G4"]).count() == 0


def test_null_texts_fail_by_columns(spark, frame):
    rows = frame.limit(2).unionByName(spark.createDataFrame([(1, None, None, "val", 0, "en", 0.5)], frame.schema))
    with pytest.raises(Exception, match="null"):
        P.fit_and_count(rows, vocab_size=4, num_hash=8, by_columns=True)


def test_queries_count_sets_by_columns(spark, tmp_path, monkeypatch):
    docs = [(i, t, "en" if i % 3 else "fr", "web", len(t)) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet")
    calls = []
    monkeypatch.setattr(P, "_side_by_side", lambda *a, **k: calls.append(a))
    assert len(C._State(spark, str(tmp_path)).models("G1", "G2", "G3", "G4")) == 4 and not calls


def test_cleaning_by_columns_is_that_of_the_expressions(spark):
    from lexiflow.functions.text import clean_text
    signs = ["<", ">", "a", "bc", "def", " ", "\n", "é", "日", "😀", "_", "1", "İ", "\x00", "&"]
    texts = [*TEXTS, None, *("".join(RANDOM.choice(signs) for _ in range(RANDOM.randrange(40))) for _ in range(400))]
    docs = spark.createDataFrame([(i, t, "en", "train") for i, t in enumerate(texts)], "i int, text string, emotion string, split string")
    prepared = R.prepare(docs).frame
    assert "regexp_replace" not in prepared._jdf.queryExecution().optimizedPlan().toString()
    expect = {r.i: r.c for r in docs.select("i", clean_text("text").alias("c")).collect()}
    assert {r.i: r.text_c for r in prepared.select("i", "text_c").collect()} == expect
    assert expect[len(TEXTS)] is None and all(re.fullmatch("[a-zA-Z ]*", c) for c in expect.values() if c)


def test_bytes_that_are_no_text_go_with_the_rest():
    broken = pa.array([b"ab\xffcd <\xfe> \xe2(efg"]).view(pa.string())
    assert cleaning.cleaned(broken).to_pylist() == ["abcd  efg"]


def test_blocks_take_two_bytes_a_number_and_lose_nothing(spark):
    import numpy as np
    from lexiflow.operators import linear as V
    rng = np.random.default_rng(4)
    for spots in (np.array([0, 3, 65538]), np.array([0, 70_000]), np.array([5, 2]), np.array([], int), np.array([65_536])):
        assert V._long_spots(pa.py_buffer(V._short_spots(spots.astype(np.int32)))).tolist() == spots.tolist()
    for values in (rng.integers(0, 9, 500) * 0.7, rng.random(500), np.array([0.0, -0.0, np.nan, np.inf] * 9), np.array([]),
                   np.arange(200_000) / 3):
        data = V._short_values(values)
        assert V._long_values(pa.py_buffer(data)).tobytes() == values.tobytes() and len(data) <= 8 + values.nbytes
    rows = [(i % 2, 1.0, i % 3, [*range(i % 7, 400, 3)], [float(j % 5 + 1) for j in range(i % 7, 400, 3)]) for i in range(900)]
    df = spark.createDataFrame(rows, "label int, weight double, fold int, idx array<int>, val array<double>").select(
        "idx", "val", "label", "weight", "fold").coalesce(1)
    (block,) = V.packed(df).collect()
    cells = sum(len(r[3]) for r in rows)
    assert len(block.spots) < 2 * cells + 100 and len(block.vals) < 2 * cells + 100


def test_several_lengths_of_a_line_are_tried_in_one_pass(monkeypatch):
    """The same searches, step by step, in fewer passes over the rows."""
    import numpy as np
    from lexiflow.operators import linear as V
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 8)) * 10.0 ** rng.integers(-1, 2, 8)
    y = rng.integers(0, 3, 300)
    x[np.arange(300), y] += 1.0
    passes = []

    def hinge(rows, problems, coef):
        passes.append(len(problems))
        sign = np.where(y[:, None] == [p.cls for p in problems], 1.0, -1.0)
        short = 1 - sign * (x @ coef[:, :-1].T + coef[:, -1])
        pull = -sign * (short > 0)
        return np.maximum(short, 0).sum(0), np.hstack([pull.T @ x, pull.sum(0)[:, None]])

    monkeypatch.setattr(V, "hinge", hinge)
    monkeypatch.setattr(V, "feature_scales", lambda rows, width, folds: (
        {None: 1 / x.std(0)}, {None: x.mean(0) / x.std(0)}, {None: 300.0}))
    problems = [V.Problem(c, reg) for reg in (0.1, 0.001) for c in range(3)]
    found, counts = [], []
    for room in (0, 1.25, 3):
        passes.clear()
        monkeypatch.setattr(V, "ROOM", room)
        found.append(V.fit_svms(None, problems, 8, 60, (10, 60)))
        counts.append((len(passes), max(passes)))
    for other in found[1:]:
        for p in problems:
            assert np.allclose(found[0][p].history, other[p].history, rtol=1e-9)
            assert np.allclose(found[0][p].kept[60], other[p].kept[60], rtol=1e-6)
    assert counts[2][0] < counts[1][0] < counts[0][0] and counts[1][1] <= 1.25 * len(problems)


@pytest.mark.parametrize("part", [1, 4 << 20])
def test_every_column_of_a_set_is_that_of_its_stages(frame, monkeypatch, part):
    monkeypatch.setattr(L, "PART_BYTES", part)
    models = P.fit_feature_sets(frame, vocab_size=9, num_hash=50, chi2_top=4)
    for model in models.values():
        stages, columns = model.transform(frame), P.transform_by_columns(model, frame)
        assert columns.columns == stages.columns and columns.dtypes == stages.dtypes
        assert sorted(map(str, columns.collect())) == sorted(map(str, stages.collect()))
        assert columns._jdf.queryExecution().optimizedPlan().toString().count("UDF(") < stages._jdf.queryExecution(
            ).optimizedPlan().toString().count("UDF(")
    dropping = P.g1_pipeline(5, drop_empty=True).fit(frame)
    assert P.transform_by_columns(dropping, frame).collect() == dropping.transform(frame).collect()


def test_digests_are_of_sets_by_columns(spark, tmp_path, monkeypatch):
    from lexiflow.plans import checks as K
    docs = [(i, t, "en" if i % 3 else "fr", "web", len(t)) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet")
    written = []
    write = K.write_feature_set
    monkeypatch.setattr(K, "write_feature_set", lambda df, path: written.append(df) or write(df, path))
    rows = K.q_feature_digests(spark, str(tmp_path)).collect()
    assert all(r.same for r in rows) and sum(r.n_rows for r in rows) == 4 * len(TEXTS)
    st = C.state(spark, str(tmp_path))
    for name, df in zip(("G1", "G2", "G3", "G4"), written):
        assert df.columns == st.models(name)[0].transform(st.frame).columns
        assert "MapInArrow" in df._jdf.queryExecution().optimizedPlan().toString()


def test_digests_leave_the_session_fit_for_tasks(spark, frame, tmp_path):
    from lexiflow.operators.digests import digested
    spark.conf.set("lexiflow.test", "kept")
    seen, found = digested(frame, "split", ("train",))
    assert seen.sparkSession.conf.get("lexiflow.test") == "kept"
    seen.write.parquet(f"{tmp_path}/t")
    assert found()["train"][0] == frame.filter("split = 'train'").count()
    assert len(spark._jvm.org.apache.spark.util.Utils.serialize(spark._jsparkSession)) > 0
    assert SparkSession.getActiveSession()._jsparkSession.equals(spark._jsparkSession)

"""What the queries on feature sets and the grid search share: terms are cut once, blocks are made once, rows digested as written."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lexiflow.operators import linear as L
from lexiflow.operators.digests import digested, table_digest
from lexiflow.plans import pipelines as P


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(i, t, t.replace("  ", " "), ("train", "test", "val")[max(0, i % 10 - 7)], i % 2, "en", 0.5) for i, t in enumerate(
        ["red fox the fox", "", "the  red  dog ran", "blue", "Blue dog RAN the"] * 8)]
    return spark.createDataFrame(rows, "doc_id long, text string, text_c string, split string, label int, emotion string, weight double")


def test_counted_terms_make_the_features_of_the_pipelines(frame, monkeypatch):
    plans = []
    side = P._side_by_side
    monkeypatch.setattr(P, "_side_by_side", lambda *a, **k: plans.append(side(*a, **k)) or plans[-1])
    models, counted = P.fit_and_count(frame, vocab_size=4, num_hash=8, chi2_top=2)
    alone = {"G1": P.g1_pipeline(4), "G3": P.g3_pipeline(4), "G4": P.g4_pipeline(8)}
    rows = lambda df, col: [(r.doc_id, r[col]) for r in df.select("doc_id", col).orderBy("doc_id").collect()]
    for name, model in models.items():
        col = P.FEATURES_COL[name]
        assert rows(counted.finish(name, model), col) == rows(model.transform(frame), col)
        if name in alone:
            assert rows(counted.finish(name, model), col) == rows(alone[name].fit(frame.filter("split = 'train'")).transform(frame), col)
    assert len(plans) == 2  # terms are cut for the vocabularies and for the counts, and not again
    assert plans[1]._jdf.queryExecution().optimizedPlan().toString().count("UDF(") == 7  # G1 and G4 share two of nine


def test_no_training_rows_have_no_frequencies(spark, frame):
    (model,) = P.fit_feature_sets(frame.filter("split <> 'train'"), ("G4",), num_hash=8).values()
    assert P.idf_model_of(model).idf.toArray().tolist() == [0.0] * 8


def test_entries_leave_out_stored_zeros(spark):
    from lexiflow.operators.features import sparse_entries, vector_to_long
    df = spark.createDataFrame([(1, Vectors.dense(0.0, 2.0)), (2, Vectors.sparse(3, [0, 2], [0.0, 3.0])), (3, Vectors.sparse(3, [], []))],
                               ["doc_id", "v"])
    long = vector_to_long(df, "v", ["doc_id"])
    assert [tuple(r) for r in long.orderBy("doc_id").collect()] == [(1, 1, 2.0), (2, 2, 3.0)]
    assert [r[0] for r in df.orderBy("doc_id").select(F.size(sparse_entries("v"))).collect()] == [1, 1, 0]
    assert "lambdafunction" not in long._jdf.queryExecution().optimizedPlan().toString()


def test_packed_blocks_give_the_same_totals(spark, monkeypatch):
    rng = np.random.default_rng(5)
    data = [(i % 3, float(rng.random()), i % 2, Vectors.sparse(6, {int(j): float(rng.random()) for j in rng.permutation(6)[:i % 4]}))
            for i in range(90)]
    df = spark.createDataFrame(data, ["label", "weight", "fold", "f"]).repartition(3)
    rows = L.linear_rows(df, "f", fold_col="fold")
    monkeypatch.setattr(L, "BLOCK_CELLS", 64)  # tasks see it, too: several blocks a task
    blocks = L.packed(rows).cache()
    assert blocks.columns == ["label", "weight", "fold", "used", "spots", "vals"] and L.packed(blocks) is blocks
    problems = [L.Problem(0, 0.1), L.Problem(2, 0.1, 1)]
    coef = rng.normal(size=(2, 7))
    loss, grad = L.hinge(blocks, problems, coef)
    for k, p in enumerate(problems):
        mine = [(lab, w, x.toArray()) for lab, w, f, x in data if f != p.fold]
        short = np.array([max(0, 1 - (1 if lab == p.cls else -1) * (x @ coef[k, :-1] + coef[k, -1])) for lab, _, x in mine])
        assert np.isclose(loss[k], sum(w * s for (_, w, _), s in zip(mine, short)))
        pull = sum(-w * (1 if lab == p.cls else -1) * np.append(x, 1) for (lab, w, x), s in zip(mine, short) if s > 0)
        assert np.allclose(grad[k], pull)
    assert sum(r.n for r in L.fold_confusion(blocks, [{0: coef, 1: coef}], 2).collect()) == 90


def test_rows_are_digested_as_they_are_written(frame, tmp_path):
    seen, found = digested(frame.unionAll(frame.limit(3)), "split", ("train", "test", "none"))
    seen.write.parquet(f"{tmp_path}/t")
    expect = {r[0]: tuple(r)[1:] for r in table_digest(frame.sparkSession.read.parquet(f"{tmp_path}/t"), ["split"]).collect()}
    assert found() == {s: expect[s] for s in ("train", "test")} and seen.columns == frame.columns

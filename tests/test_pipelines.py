from pyspark.sql import functions as F

from lexiflow.plans.catalog import labeled_docs
from lexiflow.plans.pipelines import fit_feature_sets, write_feature_sets
from lexiflow.plans.prepare import prepare
from lexiflow.session import work_path
from lexiflow.sources.parquet import read_feature_set
from tests.conftest import SF001


def test_checkpointed_prepare_equals_cached(spark):
    docs = labeled_docs(spark, SF001)
    a = prepare(docs, persist=True)
    b = prepare(docs, persist="checkpoint")
    assert a.cached is not None and a.cached.is_cached and b.cached is None
    cols = ["doc_id", "label", "weight", "text_c"]
    assert sorted(a.frame.select(cols).collect()) == sorted(b.frame.select(cols).collect())
    assert a.labels == b.labels and sorted(a.weights.collect()) == sorted(b.weights.collect())
    a.release()


def test_write_all_feature_sets(spark):
    prep = prepare(labeled_docs(spark, SF001), persist=True)
    models = fit_feature_sets(prep.frame, ("G1", "G2", "G3", "G4"))
    assert models["G2"].stages[:4] == models["G1"].stages  # shared fitted prefix
    paths = write_feature_sets(prep.frame, models, work_path(spark, "feature-sets"))
    assert set(paths) == {"G1", "G2", "G3", "G4"}
    val = read_feature_set(spark, paths["G2"], "val")
    assert val.count() == prep.frame.filter(F.col("split") == "val").count()
    assert "features" in val.columns and val.first()["features"].size == 300
    assert {"text", "text_c", "words", "filtered", "rawFeatures", "featuresIDF"} <= set(val.columns)
    assert "ngrams" in read_feature_set(spark, paths["G4"]).columns
    prep.release()


def test_fits_independent_of_partitioning(spark):
    from lexiflow.plans.pipelines import idf_model_of, vocabulary_of
    docs = labeled_docs(spark, SF001)
    results = []
    for n in (1, 5):
        prep = prepare(docs.repartition(n))
        models = fit_feature_sets(prep.frame, ("G1", "G2", "G3"))
        results.append((prep.labels, sorted(prep.weights.collect()), vocabulary_of(models["G1"]), vocabulary_of(models["G3"]),
                        [round(x, 12) for x in idf_model_of(models["G1"]).idf.toArray()],
                        list(models["G2"].stages[-1].getIndices())))
    assert results[0] == results[1]


def test_joint_fit_equals_single_pipelines(spark):
    from lexiflow.plans.pipelines import g1_pipeline, g3_pipeline, g4_pipeline, idf_model_of, vocabulary_of
    prep = prepare(labeled_docs(spark, SF001), persist="checkpoint")
    train = prep.frame.filter(F.col("split") == "train")
    joint = fit_feature_sets(prep.frame, ("G1", "G3", "G4"))
    for name, make in (("G1", g1_pipeline), ("G3", g3_pipeline), ("G4", g4_pipeline)):
        single = make().fit(train)
        if name != "G4":
            assert vocabulary_of(joint[name]) == vocabulary_of(single)
        a, b = (idf_model_of(m).idf.toArray() for m in (joint[name], single))
        assert len(a) == len(b) and max(abs(a - b)) < 1e-12
        rows = [m.transform(prep.frame).select("doc_id", "featuresIDF").orderBy("doc_id").head(20) for m in (joint[name], single)]
        for x, y in zip(*rows):
            assert x.doc_id == y.doc_id and x.featuresIDF.squared_distance(y.featuresIDF) < 1e-18

"""The three-step workflow on labelled text files made from sf0.001 documents."""

import os
import shutil

import pyarrow.parquet as pq
import pytest

from lexiflow.plans.jobs import prepare_job, select_job, tune_job
from lexiflow.sources.results import read_results_csv
from tests.conftest import SF001


def _write_split_files(tmp_path):
    docs = pq.read_table(os.path.join(SF001, "documents.parquet")).to_pylist()
    files = {name: open(tmp_path / f"{name}.txt", "w") for name in ("train", "test", "val")}
    for d in docs:
        name = {8: "test", 9: "val"}.get(d["doc_id"] % 10, "train")
        for line in d["text"].split("\n"):
            files[name].write(f"{line};{d['lang']}\n")
    for f in files.values():
        f.close()
    return [str(tmp_path / f"{n}.txt") for n in ("train", "test", "val")]


def test_prepare_select_tune(spark, tmp_path):
    train, test, val = _write_split_files(tmp_path)
    out = str(tmp_path / "out")
    paths = prepare_job(spark, train, test, val, out)
    assert set(paths) == {"G1", "G2", "G3", "G4"}
    assert os.path.exists(os.path.join(out, "models", "G3"))
    with pytest.raises(Exception):  # neither tables nor models are overwritten unless asked for
        prepare_job(spark, train, test, val, out)
    csv = str(tmp_path / "modelselection")
    res = select_job(spark, os.path.join(out, "features"), csv, classifiers=("nb", "lr"))
    assert res.count() == 8
    back = read_results_csv(spark, csv).collect()
    assert sorted(r["dataFrameNo"] for r in back) == sorted(f"df{i}" for i in (2, 3, 5, 6, 8, 9, 11, 12))
    assert all(0.0 <= r["f1Score"] <= 1.0 for r in back)
    tuned = tune_job(spark, os.path.join(out, "features"), "G3", folds=3, max_iter=(5,), reg_param=(0.1, 0.01))
    shutil.rmtree(os.path.join(out, "features", "G2"))
    with pytest.raises(Exception):
        select_job(spark, os.path.join(out, "features"), classifiers=("nb",))
    assert select_job(spark, os.path.join(out, "features"), classifiers=("nb",),
                      feature_sets=("G3",)).first()["dataFrameNo"] == "df9"
    assert len(tuned["cv"]) == 2 and set(tuned["best"]) == {"val", "test"}


def test_saved_lemma_table_scores_new_texts_alike(spark, tmp_path):
    from lexiflow.operators.lemma import rule_table
    from lexiflow.functions.text import clean_text
    train, test, val = _write_split_files(tmp_path)
    lines = spark.read.text(train).select(clean_text("value").alias("text_c"))
    lemmas = str(tmp_path / "lemmas")
    rule_table(lines, "text_c").write.parquet(lemmas)
    out = str(tmp_path / "out")
    prepare_job(spark, train, test, val, out, lemma_path=lemmas)
    saved = spark.read.parquet(os.path.join(out, "models", "lemmas"))
    assert sorted(map(tuple, saved.collect())) == sorted(map(tuple, spark.read.parquet(lemmas).collect()))


def test_ids_do_not_depend_on_file_splits(spark, tmp_path):
    from lexiflow.plans.jobs import read_splits
    train, test, val = _write_split_files(tmp_path)
    ids = []
    for size in ("134217728", "4096"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        ids.append(sorted(r[0] for r in read_splits(spark, train, test, val).select("doc_id").collect()))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert ids[0] == ids[1]


def test_tune_saves_a_model_that_scores_new_texts(spark, tmp_path, capsys):
    import json

    from lexiflow.__main__ import main
    from lexiflow.operators.lemma import rule_table
    from lexiflow.functions.text import clean_text
    from pyspark.sql import functions as F
    train, test, val = _write_split_files(tmp_path)
    lines = spark.read.text(train).select(clean_text(F.split("value", ";")[0]).alias("text_c"))
    lemmas, out, model = (str(tmp_path / n) for n in ("lemmas", "out", "model"))
    rule_table(lines, "text_c").write.parquet(lemmas)
    prepare_job(spark, train, test, val, out, lemma_path=lemmas)
    tuned = tune_job(spark, os.path.join(out, "features"), "G1", 3, (5,), (0.1,), model_path=model)
    new = tmp_path / "new.txt"
    rows = [line.rstrip("\n").split(";") for line in open(val)]
    new.write_text("\n".join(r[0] for r in rows) + "\n")
    main(["score", "--prepared", out, "--model", model, "--texts", str(new), "--out", str(tmp_path / "scored")])
    counts = json.loads(capsys.readouterr().out)
    scored = spark.read.parquet(str(tmp_path / "scored"))
    assert sum(counts.values()) == scored.count() == len(rows)
    label = {r.text: r.label for r in scored.collect()}
    # the F1 of the scored file is the one that tune found on val
    pairs = spark.createDataFrame([(b, label[a]) for a, b in rows], "label string, prediction string")
    ids = {name: float(i) for i, name in enumerate(sorted({r[1] for r in rows} | set(label.values())))}
    from lexiflow.operators.metrics import evaluate
    pairs = spark.createDataFrame([(ids[r.label], ids[r.prediction]) for r in pairs.collect()], "label double, prediction double")
    assert abs(evaluate(pairs)["f1Score"] - tuned["best"]["val"]) < 1e-9
    with pytest.raises(Exception):
        main(["score", "--prepared", out, "--model", model, "--texts", str(new), "--out", str(tmp_path / "scored")])


def test_empty_feature_table_says_so(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, label int, split string, weight double, featuresIDF array<double>").write.parquet(
        str(tmp_path / "G3"))
    with pytest.raises(ValueError, match="no rows"):
        tune_job(spark, str(tmp_path), "G3")

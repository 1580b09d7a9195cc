"""Registered queries that check sources, sinks and fits against SQL: files read and written, digests, hashed
buckets, and the objective and gradient of fitted models."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.digests import digested, table_digest
from ..operators.features import vector_to_long
from ..operators.fitcheck import fit_report, log_loss
from ..operators.models import make_classifier, materialize, release
from ..session import remove_path, work_path
from ..sources.parquet import read_feature_set, write_feature_set
from ..sources.results import read_results_csv, write_results_csv
from ..sources.text import read_labeled_files
from . import catalog as C
from .pipelines import num_features_of, transform_by_columns
from .splits import TEST, TRAIN, VAL, is_split


def _rows(spark, rows, schema: str) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def _labeled_files(spark, sf_dir):
    """The documents' lines as text files, ``line;lang`` but for lines that begin with A to D, which lose their
    label; read back with a side table.  A file's folder says which tenth of the documents it has."""
    docs = C.text_table(spark, sf_dir, "documents")
    lines = docs.select(F.pmod("doc_id", F.lit(10)).alias("tenth"), F.explode(F.split("text", "\n", -1)).alias("line"), "lang")
    value = F.when(F.col("line").rlike("^[A-D]"), F.regexp_replace("line", ";", ",")).otherwise(
        F.concat("line", F.lit(";"), "lang"))
    path = work_path(spark, "labeled-lines")
    lines.select("tenth", value.alias("value")).write.partitionBy("tenth").text(path)
    records, malformed = read_labeled_files(spark, path)
    tenth = F.regexp_extract("file", r"tenth=(\d+)", 1).cast("int").alias("tenth")
    found = (records.groupBy(tenth, "text", "emotion").agg(F.count(F.lit(1)).alias("n")),
             malformed.groupBy(tenth, "line").agg(F.count(F.lit(1)).alias("n")))
    return path, found


def _from_files(spark, sf_dir, which: int) -> DataFrame:
    path, found = _labeled_files(spark, sf_dir)
    kept = found[which].checkpoint(eager=True)
    remove_path(spark, path)
    return kept


def q_labeled_files(spark, sf_dir):
    """Lines read from files, with the folder they came from."""
    return _from_files(spark, sf_dir, 0)


def q_malformed_lines(spark, sf_dir):
    """The side table of lines without a label."""
    return _from_files(spark, sf_dir, 1)


def q_feature_digests(spark, sf_dir):
    """All four feature sets written and read back; digests by split before and after."""
    st = C.state(spark, sf_dir)
    names = ("G1", "G2", "G3", "G4")
    rows = []
    for name, model in zip(names, st.models(*names)):
        feats, written = digested(transform_by_columns(model, st.frame), "split", (TRAIN, TEST, VAL))
        path = work_path(spark, f"digests-{name}")
        write_feature_set(feats, path)
        back = table_digest(read_feature_set(spark, path), ["split"]).select("split", "n_rows", "total", "flips")
        before, after = written(), {r[0]: tuple(r)[1:] for r in back.collect()}  # one row a split
        rows += [(name, s, before.get(s, (None,))[0], before.get(s) == after.get(s)) for s in sorted({*before, *after})]
        remove_path(spark, path)
    return _rows(spark, rows, "feature_set string, split string, n_rows bigint, same boolean")


def q_results_csv(spark, sf_dir):
    """A result table written as one CSV file and read back with declared types."""
    table = C.q_nb_results(spark, sf_dir)
    path = work_path(spark, "results") + ".csv"
    write_results_csv(table, path)
    rows = read_results_csv(spark, path, table.schema).collect()  # one row a run
    remove_path(spark, path)
    return _rows(spark, rows, table.schema.simpleString()[len("struct<"):-1].replace(":", " ").replace(",", ", "))


def q_hashed_bigrams(spark, sf_dir):
    """(doc_id, bucket, n): the hashed bigram counts of every document."""
    return vector_to_long(C.state(spark, sf_dir).features("G4"), "rawFeatures", ["doc_id"], "bucket", "value").select(
        "doc_id", "bucket", F.col("value").cast("bigint").alias("n"))


def _fit_checked(spark, sf_dir, clf: str) -> DataFrame:
    st = C.state(spark, sf_dir)
    train = materialize(st.features("G3").filter(is_split(TRAIN)).select("doc_id", "label", "weight", "featuresIDF"))
    if clf == "svm":
        model, _ = C._fit_predict(spark, sf_dir, "svm")
        coef = np.stack([m.coefficients.toArray() for m in model.models])
        shift = np.array([m.intercept for m in model.models])
        paths = [list(m.summary().objectiveHistory) for m in model.models]
        bound = None
    else:
        model = make_classifier("lr", "featuresIDF", maxIter=200, tol=1e-9).fit(train)
        coef, shift = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
        paths = [list(model.summary.objectiveHistory)] * len(coef)
        bound = 1e-3
    found = {r.cls: r for r in fit_report(train, "featuresIDF", coef, shift, 0.1, "hinge" if clf == "svm" else "log").collect()}
    sizes = train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()
    release(train)
    rows = []
    for label, n in sorted(tuple(r) for r in sizes):
        path, one = paths[label], found[label]
        rows.append((label, n, abs(one.objective - path[-1]) <= 1e-8 * path[-1],
                     path[-1] < path[0] and (bound is None or one.gradient <= bound)))
    return spark.createDataFrame(rows, "label int, n bigint, objective_ok boolean, descent_ok boolean")


def q_svm_fit_checked(spark, sf_dir):
    """The objective at the returned coefficients, from long features, is the solver's last and below its first."""
    return _fit_checked(spark, sf_dir, "svm")


def q_logreg_fit_checked(spark, sf_dir):
    """As C1, and the gradient of a converged fit vanishes."""
    return _fit_checked(spark, sf_dir, "lr")


def q_mlp_fit_checked(spark, sf_dir):
    """C4: the perceptron's loss on the training rows, by a forward pass of its weights, fell from its start."""
    st = C.state(spark, sf_dir)
    (g3,) = st.models("G3")
    train = materialize(st.features("G3").filter(is_split(TRAIN)).select("doc_id", "label", "featuresIDF"))
    entries = vector_to_long(train, "featuresIDF", ["doc_id"], "feature", "value")
    last, _ = C._fit_predict(spark, sf_dir, "mlp")
    start = make_classifier("mlp", "featuresIDF", "label", None, n_features=num_features_of(g3, "G3"),
                            n_classes=st.n_classes, maxIter=0).fit(train)
    losses = [log_loss(C._scores(m, "mlp", entries), train).first() for m in (start, last)]
    n = train.count()
    release(train)
    return spark.createDataFrame([(n, bool(losses[1].loss < losses[0].loss and losses[0].n == losses[1].n))],
                                 "n bigint, ok boolean")


QUERIES = {
    "labeled_files": q_labeled_files,
    "malformed_lines": q_malformed_lines,
    "feature_digests": q_feature_digests,
    "results_csv": q_results_csv,
    "hashed_bigrams": q_hashed_bigrams,
    "svm_fit_checked": q_svm_fit_checked,
    "logreg_fit_checked": q_logreg_fit_checked,
    "mlp_fit_checked": q_mlp_fit_checked,
}

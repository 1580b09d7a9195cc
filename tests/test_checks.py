import os

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lexiflow.operators.digests import table_digest
from lexiflow.operators.fitcheck import fit_report, log_loss
from lexiflow.sources.results import read_results_csv, results_frame, write_results_csv
from lexiflow.sources.text import read_labeled_files


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    data = []
    for i in range(400):
        c = int(rng.integers(0, 3))
        x = rng.normal(0, 2, 6) * (rng.random(6) < 0.7)
        x[c] += 1
        data.append((i, c, float(0.5 + rng.random()), Vectors.sparse(6, [(j, float(v)) for j, v in enumerate(x) if v])))
    data += [(1000, 1, 1.0, Vectors.sparse(6, []))]
    return spark.createDataFrame(data, ["doc_id", "label", "weight", "f"]).cache()


def test_objective_and_gradient_of_a_converged_fit(spark, rows):
    model = LogisticRegression(featuresCol="f", weightCol="weight", regParam=0.1, maxIter=300, tol=1e-11).fit(rows)
    coef, shift = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    last = model.summary.objectiveHistory[-1]
    found = fit_report(rows, "f", coef, shift, 0.1, "log").collect()
    assert [r.cls for r in found] == [0, 1, 2]
    assert all(abs(r.objective - last) < 1e-10 and r.gradient < 1e-4 for r in found)


def test_a_coefficient_changed_by_a_hundredth_shows(spark, rows):
    model = LogisticRegression(featuresCol="f", weightCol="weight", regParam=0.1, maxIter=300, tol=1e-11).fit(rows)
    coef, shift = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    last = model.summary.objectiveHistory[-1]
    big = np.unravel_index(np.abs(coef).argmax(), coef.shape)
    coef[big] *= 1.01
    found = {r.cls: r for r in fit_report(rows, "f", coef, shift, 0.1, "log").collect()}
    assert abs(found[0].objective - last) > 1e-8 * last and found[big[0]].gradient > 1e-4


def test_hinge_equals_numpy(spark, rows):
    rng = np.random.default_rng(0)
    coef, shift = rng.normal(size=(3, 6)), rng.normal(size=3)
    held = rows.collect()
    x, w = np.array([r.f.toArray() for r in held]), np.array([r.weight for r in held])
    total = w.sum()
    mean = w @ x / total
    sd = np.sqrt((w @ x ** 2 - total * mean ** 2) / (total - (w ** 2).sum() / total))
    for r in fit_report(rows, "f", coef, shift, 0.3, "hinge").collect():
        y = np.array([1.0 if h.label == r.cls else -1.0 for h in held])
        short = 1 - y * (x @ coef[r.cls] + shift[r.cls])
        pull = np.where(short > 0, -y * w, 0) / total
        slope = (pull @ x - mean * pull.sum()) / sd + 0.3 * coef[r.cls] * sd
        assert r.objective == pytest.approx((w * np.maximum(short, 0)).sum() / total + 0.15 * ((coef[r.cls] * sd) ** 2).sum())
        assert r.gradient == pytest.approx(np.sqrt((slope ** 2).sum() + pull.sum() ** 2))
    with pytest.raises(ValueError, match="loss"):
        fit_report(rows, "f", coef, shift, 0.3, "square")


def test_log_loss(spark):
    scores = spark.createDataFrame([(1, [0.0, 1000.0]), (2, [0.5, 0.5])], "doc_id int, scores array<double>")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id int, label int")
    n, loss = log_loss(scores, labels).first()
    assert n == 2 and loss == pytest.approx(np.log(2) / 2)


def test_digest_ignores_order_and_sees_changes(spark):
    df = spark.createDataFrame([("a", 1, [1.0]), ("a", 2, None), ("b", 1, []), ("a", 1, [1.0])], "s string, n int, v array<double>")
    one = sorted(map(tuple, table_digest(df, ["s"]).collect()))
    assert one == sorted(map(tuple, table_digest(df.select("v", "n", "s").orderBy(F.desc("n")), ["s"]).collect()))
    assert one != sorted(map(tuple, table_digest(df.dropDuplicates(), ["s"]).collect()))
    assert one[1] != sorted(map(tuple, table_digest(df.withColumn("n", F.col("n") + (F.col("s") == "b").cast("int")), ["s"]).collect()))[1]


def test_files_with_malformed_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("good, text;joy\nno label\n\nx;sad;more\n")
    (tmp_path / "b.txt").write_text(";empty text\n;\n")
    records, bad = read_labeled_files(spark, str(tmp_path))
    name = F.element_at(F.split("file", "/"), -1)
    assert sorted(map(tuple, records.select(name, "text", "emotion").collect())) == [
        ("a.txt", "good, text", "joy"), ("a.txt", "x", "sad"), ("b.txt", "", ""), ("b.txt", "", "empty text")]
    assert sorted(map(tuple, bad.select(name, "line").collect())) == [("a.txt", ""), ("a.txt", "no label")]


def test_results_are_one_file(spark, tmp_path):
    table = results_frame(spark, [("m", "svm", 1.5, 0.1, 0.2, None, "df1"), ('a "q", x', "nb", 2.0, 0.1, 0.2, 0.3, "df2")])
    path = str(tmp_path / "modelselection.csv")
    write_results_csv(table, path)
    assert os.path.isfile(path) and [f for f in os.listdir(tmp_path) if not f.startswith(".")] == ["modelselection.csv"]
    assert open(path).readline().strip() == ",".join(table.columns)
    assert sorted(map(str, read_results_csv(spark, path).collect())) == sorted(map(str, table.collect()))
    with pytest.raises(FileExistsError):
        write_results_csv(table, path)
    write_results_csv(table.limit(1), path, "overwrite")
    assert read_results_csv(spark, path).count() == 1
    with pytest.raises(ValueError, match="mode"):
        write_results_csv(table, path, "append")

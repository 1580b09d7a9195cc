"""The reference's three-step workflow as parameterised Spark jobs.

``prepare``: labelled text files (train / test / val) -> label index, cleaning,
optional lemmas, class weights -> four feature sets written as Parquet tables
partitioned by split, plus the fitted models.
``select``: feature tables -> every (feature set, classifier) run -> result
table as CSV.
``tune``: one feature table -> k-fold cross-validated grid search of the
one-vs-rest SVM -> mean F1 per setting and the best model's F1 on val / test.
``score``: new text files -> predicted labels, with the saved models.

Paths are arguments (the reference hard-coded them); the session is the
caller's.
"""

from __future__ import annotations

import os

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_text
from ..operators.labels import label_names
from ..operators.lemma import lemma_pairs, lemmatize
from ..operators.linear import predict_linear
from ..session import path_exists
from ..sources.parquet import read_feature_set
from ..sources.results import write_results_csv
from ..sources.text import read_labeled_text
from . import tuning as T
from .experiments import run_on_feature_tables
from .pipelines import FEATURE_SET_NAMES, FEATURES_COL, fit_feature_sets, write_feature_sets
from .prepare import prepare
from .splits import TEST, TRAIN, VAL, is_split
from .tuning import load_svm


def read_splits(spark: SparkSession, train_path: str, test_path: str, val_path: str, sep: str = ";",
                malformed: str = "fail") -> DataFrame:
    """The three labelled files as one frame (doc_id, text, emotion, split).

    ``doc_id`` is a hash of split, label and text, so it doesn't depend on how
    files are cut into tasks (equal lines share one, and a fold).
    """
    parts = [read_labeled_text(spark, path, sep, malformed=malformed).withColumn("split", F.lit(name))
             for name, path in ((TRAIN, train_path), (TEST, test_path), (VAL, val_path))]
    docs = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return docs.withColumn("doc_id", F.xxhash64("split", "emotion", "text"))


def prepare_job(spark: SparkSession, train_path: str, test_path: str, val_path: str, out_dir: str,
                sep: str = ";", malformed: str = "fail", lemma_path: str | None = None,
                weight_scheme: str = "share", vocab_size: int = 1000, num_hash: int = 1000,
                chi2_top: int = 300, chi2_rank: str = "pvalue", mode: str = "errorifexists") -> dict[str, str]:
    """Step 1.  Returns {feature set: table path}; models go under ``out_dir/models``."""
    docs = read_splits(spark, train_path, test_path, val_path, sep, malformed)
    lemmas = spark.read.parquet(lemma_path) if lemma_path else None
    prep = prepare(docs, lemmas=lemmas, weight_scheme=weight_scheme, persist="checkpoint")
    models = fit_feature_sets(prep.frame, vocab_size=vocab_size, num_hash=num_hash, chi2_top=chi2_top,
                              chi2_rank=chi2_rank)
    paths = write_feature_sets(prep.frame, models, os.path.join(out_dir, "features"), mode)
    saved = {**models, "label_index": prep.indexer}
    for name, model in saved.items():
        writer = model.write()
        (writer.overwrite() if mode == "overwrite" else writer).save(os.path.join(out_dir, "models", name))
    if lemmas is not None:  # scoring new texts needs the same table
        lemma_pairs(lemmas).write.mode(mode).parquet(os.path.join(out_dir, "models", "lemmas"))
    return paths


def _feature_tables(spark: SparkSession, features_dir: str, names=("G1", "G2", "G3", "G4")):
    """The named feature tables under ``features_dir`` (any Hadoop path); a missing one is an error."""
    tables = {}
    for name in names:
        df = read_feature_set(spark, os.path.join(features_dir, name))
        tables[name] = (df, vector_width(df, FEATURES_COL[name]))
    return tables


def vector_width(df: DataFrame, features_col: str) -> int:
    """Length of a feature column's vectors; a table without rows is an error that says so."""
    first = df.select(features_col).first()
    if first is None:
        raise ValueError(f"the feature table has no rows, so the width of {features_col} isn't known")
    return first[0].size


def _n_classes(df: DataFrame) -> int:
    """One more than the highest class id of the training rows."""
    top = df.filter(is_split(TRAIN)).agg(F.max("label")).first()[0]
    if top is None:
        raise ValueError("the feature table has no training rows")
    return int(top) + 1


def select_job(spark: SparkSession, features_dir: str, out_csv: str | None = None,
               classifiers=("svm", "lr", "nb"), feature_sets=("G1", "G2", "G3", "G4"), orientation: str = "right", eval_split: str = VAL,
               parallelism: int = 4, mode: str = "errorifexists", train_partitions: int | None = None) -> DataFrame:
    """Step 2.  Returns the result table (and writes it as CSV when ``out_csv`` is given)."""
    tables = _feature_tables(spark, features_dir, feature_sets)
    any_table = next(iter(tables.values()))[0]
    results = run_on_feature_tables(spark, tables, _n_classes(any_table), classifiers, eval_split, orientation,
                                    parallelism=parallelism, train_partitions=train_partitions)
    if out_csv:
        write_results_csv(results, out_csv, mode)
    return results


def tune_job(spark: SparkSession, features_dir: str, feature_set: str = "G3", folds: int = 3,
             max_iter=(10, 50, 100), reg_param=(0.1, 0.01, 0.001), model_path: str | None = None,
             mode: str = "errorifexists") -> dict:
    """Step 3.  Cross-validated grid search of the weighted one-vs-rest SVM; the best model is saved at
    ``model_path`` if given."""
    df = read_feature_set(spark, os.path.join(features_dir, feature_set))
    feat = FEATURES_COL[feature_set]
    train = T.assign_folds(df.filter(is_split(TRAIN)), folds, "doc_id", "fold")
    found = T.search_svms(train, feat, vector_width(df, feat), _n_classes(df), max_iter, reg_param)
    if model_path:
        found.save(spark, model_path, feature_set, mode)
    best = found.best_scores({VAL: df.filter(is_split(VAL)), TEST: df.filter(is_split(TEST))})
    return {"feature_set": FEATURE_SET_NAMES[feature_set], "cv": found.scores, "best": best}


def score_job(spark: SparkSession, prepared_dir: str, model_path: str, text_path: str | list[str], out: str | None = None,
              mode: str = "errorifexists") -> DataFrame:
    """Score new text files, one text a line: (file, text, prediction, label).

    Uses what ``prepare`` saved under ``prepared_dir`` (label index, feature model, lemma table if there was one)
    and what ``tune`` saved at ``model_path``.  Written as Parquet when ``out`` is given.
    """
    feature_set, features_col, coef = load_svm(spark, model_path)
    folder = os.path.join(prepared_dir, "models")
    index = StringIndexerModel.load(os.path.join(folder, "label_index"))
    features = PipelineModel.load(os.path.join(folder, feature_set))
    texts = spark.read.text(text_path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
    texts = texts.withColumn("text_c", clean_text("text"))
    if path_exists(spark, os.path.join(folder, "lemmas")):
        texts = lemmatize(texts, spark.read.parquet(os.path.join(folder, "lemmas")), "text_c")
    scored = label_names(predict_linear(features.transform(texts), coef, features_col, ["file", "text"]), index,
                         "prediction", "label")
    if out:
        scored.write.mode(mode).parquet(out)
        return spark.read.parquet(out)
    return scored

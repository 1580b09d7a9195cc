"""Feature operators: tokens, stop words, n-grams, vocabulary, TF, IDF, hashing, chi-square.

Token-level stages are Spark's own transformers (JVM-side, no shuffle).  The
vocabulary is our own estimator: Spark's ``CountVectorizer`` breaks ties in
the corpus count by partition order, so the same rows can give different
vocabularies; here ties go to the smaller term, under any partitioning.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.feature import (IDF, CountVectorizerModel, HashingTF, NGram, RegexTokenizer,
                                StopWordsRemover, Tokenizer, VectorSlicer)
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasLabelCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stopwords import ENGLISH_STOP_WORDS
from ..session import ensure_checkpoint_dir


def tokenizer(input_col: str, output_col: str, drop_empty: bool = False):
    """Lower-case and split on single whitespace characters.

    Like Java's ``split``, empty tokens inside the text are kept and trailing
    ones dropped (cleaned text with double spaces yields ``''`` tokens).
    ``drop_empty=True`` splits on runs of whitespace instead.
    """
    if drop_empty:
        return RegexTokenizer(inputCol=input_col, outputCol=output_col, pattern=r"\s+",
                              minTokenLength=1, toLowercase=True)
    return Tokenizer(inputCol=input_col, outputCol=output_col)


def stop_words_remover(input_col: str, output_col: str, words: list[str] | None = None,
                       case_sensitive: bool = False) -> StopWordsRemover:
    """Remove stop words (default: Spark's English list, case-insensitive)."""
    return StopWordsRemover(inputCol=input_col, outputCol=output_col,
                            stopWords=list(words or ENGLISH_STOP_WORDS),
                            caseSensitive=case_sensitive)


def ngrams(input_col: str, output_col: str, n: int = 2) -> NGram:
    """Adjacent tokens joined by a space; fewer than ``n`` tokens gives ``[]``."""
    return NGram(n=n, inputCol=input_col, outputCol=output_col)


def hashing_tf(input_col: str, output_col: str, num_features: int = 1000) -> HashingTF:
    """Term counts hashed into ``num_features`` buckets (MurmurHash3 of the UTF-8 term)."""
    return HashingTF(inputCol=input_col, outputCol=output_col, numFeatures=num_features)


def idf(input_col: str, output_col: str, min_doc_freq: int = 0) -> IDF:
    """IDF fitted on the rows it sees: ``ln((N + 1) / (df + 1))``."""
    return IDF(inputCol=input_col, outputCol=output_col, minDocFreq=min_doc_freq)


def vocabulary(df: DataFrame, tokens_col: str, size: int = 1000, term_col: str = "term") -> DataFrame:
    """Top ``size`` terms by corpus count, ties by term ascending: (term, count).

    Planned as explode -> partial/final hash aggregate -> TakeOrderedAndProject,
    so only ``size`` rows per task reach the final merge.
    """
    # explode_outer: plain explode makes the optimizer add a ``size(tokens) > 0``
    # filter, which evaluates the whole clean/tokenize chain a second time.
    counts = (df.select(F.explode_outer(F.col(tokens_col)).alias(term_col))
                .filter(F.col(term_col).isNotNull())
                .groupBy(term_col).agg(F.count(F.lit(1)).alias("count")))
    top = counts.orderBy(F.col("count").desc(), F.col(term_col).asc()).limit(size)
    return top


def vocabulary_list(df: DataFrame, tokens_col: str, size: int = 1000) -> list[str]:
    """The vocabulary as a list in index order (at most ``size`` terms reach the driver)."""
    rows = vocabulary(df, tokens_col, size).collect()
    rows.sort(key=lambda r: (-r["count"], r["term"]))
    return [r["term"] for r in rows]


class TermVocabulary(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Estimator: deterministic vocabulary -> ``CountVectorizerModel``.

    A drop-in for ``CountVectorizer(vocabSize=...)`` whose ties in the corpus
    count go to the smaller term, so the fitted vocabulary does not depend on
    partitioning.  Unknown terms are ignored at transform time.
    """

    vocabSize = Param(Params._dummy(), "vocabSize", "max size of the vocabulary",
                      typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, vocabSize=1000):
        super().__init__()
        self._setDefault(vocabSize=1000)
        self._set(**self._input_kwargs)

    def getVocabSize(self) -> int:
        return self.getOrDefault(self.vocabSize)

    def _fit(self, dataset: DataFrame) -> CountVectorizerModel:
        vocab = vocabulary_list(dataset, self.getInputCol(), self.getVocabSize())
        return CountVectorizerModel.from_vocabulary(vocab, inputCol=self.getInputCol(),
                                                    outputCol=self.getOutputCol())


def stored_entries(vector_col: str) -> Column:
    """array<struct<index, value>> of a vector's stored entries, dense or sparse, zeros among them, without densifying."""
    raw = F.unwrap_udt(F.col(vector_col))
    indices = F.when(raw["type"] == 0, raw["indices"]).otherwise(
        F.sequence(F.lit(0), F.size(raw["values"]) - 1))
    return F.arrays_zip(indices.alias("index"), raw["values"].alias("value"))


def sparse_entries(vector_col: str) -> Column:
    """array<struct<index, value>> of a vector's entries that aren't zero, dense or sparse, without densifying."""
    return F.filter(stored_entries(vector_col), lambda e: e["value"] != 0.0)


def vector_to_long(df: DataFrame, vector_col: str, keys: list[str],
                   index_col: str = "feature", value_col: str = "value") -> DataFrame:
    """Sparse vector column -> long rows (keys..., index, value) for non-zero entries; any width."""
    # explode_outer as in ``vocabulary``: the stages that make the vector run once; zeros go when rows are there
    return df.select(*keys, F.explode_outer(stored_entries(vector_col)).alias("_e")).filter("_e.value <> 0").select(
        *keys, F.col("_e.index").alias(index_col), F.col("_e.value").alias(value_col))


def idf_table(spark, idf_model, vocab: list[str] | None = None,
              index_col: str = "feature", term_col: str = "term") -> DataFrame:
    """(index, [term,] idf) of a fitted IDF model; as wide as the vocabulary."""
    weights = idf_model.idf.toArray().tolist()
    if vocab is None:
        rows = [(i, float(w)) for i, w in enumerate(weights)]
        return spark.createDataFrame(rows, f"{index_col} int, idf double")
    rows = [(i, vocab[i], float(w)) for i, w in enumerate(weights)]
    return spark.createDataFrame(rows, f"{index_col} int, {term_col} string, idf double")


def chi2_statistics(df: DataFrame, features_col: str, label_col: str = "label",
                    n_features: int | None = None) -> DataFrame:
    """(feature, n_values, dof, statistic, log_p): Pearson's test of each feature against the label.

    Every distinct value of a feature, zero included, is one category, of any
    number of values.  Contingency cells are counted from the vectors' stored
    entries; the cell of zero is the label's total less the other cells.
    Aggregations are partial before each shuffle, and a feature that is common
    is spread over its values and labels.  ``log_p`` doesn't underflow.
    Features that are always zero are listed if ``n_features`` is given.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    labels = df.groupBy(F.col(label_col).cast("double").alias("label")).agg(
        F.count(F.lit(1)).alias("label_n")).checkpoint(eager=True)  # one row a class
    total, k = labels.agg(F.sum("label_n"), F.count(F.lit(1))).first()
    total = total or 0
    cells = df.select(F.col(label_col).cast("double").alias("label"),
                      F.explode_outer(stored_entries(features_col)).alias("e")).filter("e.value <> 0").groupBy(
        F.col("e.index").alias("feature"), F.col("e.value").alias("value"), "label").agg(
        F.count(F.lit(1)).alias("n")).checkpoint(eager=True)
    seen = cells.select("feature").distinct() if n_features is None else spark.range(n_features).select(
        F.col("id").cast("int").alias("feature"))
    filled = cells.groupBy("feature", "label").agg(F.sum("n").alias("filled"))
    # Each feature meets each class: features come from a bounded vocabulary, and classes are few.
    classes = labels.agg(F.collect_list(F.struct("label", "label_n"))).first()[0]
    every = F.array(*[F.struct(F.lit(c["label"]).alias("label"), F.lit(c["label_n"]).alias("label_n"))
                      for c in classes]) if classes else F.array().cast("array<struct<label:double,label_n:bigint>>")
    zero = seen.select("feature", F.explode(every).alias("c")).select("feature", "c.*").join(filled, ["feature", "label"], "left").select(
        "feature", F.lit(0.0).alias("value"), "label", (F.col("label_n") - F.coalesce("filled", F.lit(0))).alias("n"))
    full = cells.select("feature", "value", "label", "n").unionByName(zero).filter("n > 0")
    rows = full.join(labels, "label").groupBy("feature", "value").agg(
        F.sum("n").alias("row_n"), F.sum(F.col("n") * F.col("n") / F.col("label_n")).alias("part"))
    stats = rows.groupBy("feature").agg(F.count(F.lit(1)).alias("n_values"),
                                        F.sum(F.col("part") / F.col("row_n")).alias("share"))
    dof = (F.col("n_values") - 1) * F.lit(max(int(k) - 1, 0))
    stats = stats.select("feature", "n_values", dof.cast("long").alias("dof"),
                         F.when(dof == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.lit(total) * F.col("share") - total))
                         .alias("statistic"))

    @F.pandas_udf("double")
    def log_p(statistic: pd.Series, dof: pd.Series) -> pd.Series:
        return pd.Series([log_chi2_tail(s, d) for s, d in zip(statistic, dof)], dtype=float)

    return stats.withColumn("log_p", log_p("statistic", "dof"))


def log_chi2_tail(statistic: float, dof: int) -> float:
    """log P(X >= statistic) of a chi-square variable, far beyond where the probability underflows."""
    if dof <= 0 or statistic <= 0:
        return 0.0
    a, z = dof / 2, statistic / 2
    if z < a + 1:  # lower tail by its series
        term = total = 1 / a
        n = a
        while term > total * 1e-17:
            n += 1
            term *= z / n
            total += term
        lower = math.exp(a * math.log(z) - z - math.lgamma(a) + math.log(total))
        return math.log1p(-min(lower, 1 - 1e-16))
    # upper tail by its continued fraction, from the back
    fraction = 0.0
    for i in range(400, 0, -1):
        fraction = i * (a - i) / (z - a + 2 * i + 1 + fraction)
    return a * math.log(z) - z - math.lgamma(a) - math.log(z - a + 1 + fraction)


def chi2_ranking(rank_by: str) -> list[Column]:
    """Order of the features, best first; ties by index."""
    if rank_by == "pvalue":
        return [F.round("log_p", 9).asc(), F.col("feature").asc()]
    if rank_by == "statistic":
        score = F.when(F.col("dof") > 0, F.col("statistic") / F.col("dof")).otherwise(0.0)
        return [F.round(score, 9).desc(), F.col("feature").asc()]
    raise ValueError("rank_by must be 'pvalue' or 'statistic'")


def chi2_selector(features_col: str, output_col: str, label_col: str = "label",
                  num_top: int = 300, rank_by: str = "pvalue") -> "Chi2Selector":
    """Keep ``num_top`` features by a chi-square test against the label.

    ``rank_by='pvalue'`` (the reference's rule): smallest p-value, compared by
    its logarithm, so that probabilities too small for a double still differ.
    ``'statistic'`` ranks by statistic per degree of freedom.  Ties by index.
    """
    chi2_ranking(rank_by)
    return Chi2Selector(inputCol=features_col, outputCol=output_col, labelCol=label_col,
                        numTopFeatures=num_top, rankBy=rank_by)


class Chi2Selector(Estimator, HasInputCol, HasOutputCol, HasLabelCol,
                   DefaultParamsReadable, DefaultParamsWritable):
    """Estimator: top features by ``chi2_statistics`` -> ``VectorSlicer``.

    One row per feature is ranked, and only ``numTopFeatures`` indices reach
    the driver.  Selected indices are kept in ascending order, like Spark's
    selectors.
    """

    numTopFeatures = Param(Params._dummy(), "numTopFeatures", "number of features to keep",
                           typeConverter=TypeConverters.toInt)
    rankBy = Param(Params._dummy(), "rankBy", "pvalue or statistic", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, labelCol="label", numTopFeatures=300, rankBy="pvalue"):
        super().__init__()
        self._setDefault(numTopFeatures=300, labelCol="label", rankBy="pvalue")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> VectorSlicer:
        first = dataset.select(self.getInputCol()).first()
        width = first[0].size if first else 0
        stats = chi2_statistics(dataset, self.getInputCol(), self.getLabelCol(), width)
        top = stats.orderBy(*chi2_ranking(self.getOrDefault(self.rankBy))).limit(
            self.getOrDefault(self.numTopFeatures)).select("feature").collect()
        return VectorSlicer(inputCol=self.getInputCol(), outputCol=self.getOutputCol(),
                            indices=sorted(int(r["feature"]) for r in top))

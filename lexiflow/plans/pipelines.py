"""The four feature sets, as Spark ML pipelines fitted on training rows.

G1 and G2 share one fitted prefix (G2 = G1 + chi-square selection); the
reference refitted the whole prefix for G2.  ``fit_feature_sets`` fits all four
together in three passes; the ``g*_pipeline`` functions are the same sets as
ordinary Spark ML pipelines, one at a time.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (IDF, CountVectorizerModel, ElementwiseProduct, HashingTF, NGram, StopWordsRemover, Tokenizer,
                                VectorAssembler)
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stopwords import ENGLISH_STOP_WORDS
from ..operators.counted import (Terms, counted_side_by_side, document_frequencies, term_totals,
                                 with_term_columns)
from ..operators.features import (TermVocabulary, chi2_selector, hashing_tf, idf, ngrams, stop_words_remover,
                                  tokenizer)
from ..session import ensure_checkpoint_dir
from .splits import TRAIN, is_split

# The feature-set names used in the result table.
FEATURE_SET_NAMES = {
    "G1": "countVectorizer+iDF",
    "G2": "countVectorizer+iDF+chisquare",
    "G3": "unCleanData+countVectorizer+iDF",
    "G4": "ngram+hashingtf+iDF",
}

# Feature column each set's classifiers read.
FEATURES_COL = {"G1": "featuresIDF", "G2": "features", "G3": "featuresIDF", "G4": "featuresIDF"}


def g1_pipeline(vocab_size=1000, drop_empty=False, clean_col="text_c") -> Pipeline:
    return Pipeline(stages=[
        tokenizer(clean_col, "words", drop_empty),
        stop_words_remover("words", "filtered"),
        TermVocabulary(inputCol="filtered", outputCol="rawFeatures", vocabSize=vocab_size),
        idf("rawFeatures", "featuresIDF"),
    ])


def g3_pipeline(vocab_size=1000, drop_empty=False, text_col="text") -> Pipeline:
    return Pipeline(stages=[
        tokenizer(text_col, "words", drop_empty),
        TermVocabulary(inputCol="words", outputCol="rawFeatures", vocabSize=vocab_size),
        idf("rawFeatures", "featuresIDF"),
    ])


def g4_pipeline(num_features=1000, n=2, drop_empty=False, clean_col="text_c") -> Pipeline:
    return Pipeline(stages=[
        tokenizer(clean_col, "words", drop_empty),
        stop_words_remover("words", "filtered"),
        ngrams("filtered", "ngrams", n),
        hashing_tf("ngrams", "rawFeatures", num_features),
        idf("rawFeatures", "featuresIDF"),
    ])


def _token_stages(name: str, drop_empty: bool, text_col: str, clean_col: str) -> tuple[list, str]:
    """The stages of a set up to its terms, and the column of these."""
    if name == "G3":
        return [tokenizer(text_col, "words", drop_empty)], "words"
    stages = [tokenizer(clean_col, "words", drop_empty), stop_words_remover("words", "filtered")]
    if name == "G4":
        return stages + [ngrams("filtered", "ngrams", 2)], "ngrams"
    return stages, "filtered"


def _terms(name: str, text_col: str, clean_col: str, **by) -> Terms:
    """The text and the stop words of a set that is counted without Spark's stages."""
    return Terms(text_col, **by) if name == "G3" else Terms(clean_col, tuple(ENGLISH_STOP_WORDS), **by)


def _side_by_side(rows: DataFrame, stages: dict[str, list], columns: dict[str, str], out: str,
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """One frame with the ``keep`` columns and a column of each set's stages as ``<out>_<set>``; a single scan of ``rows``.
    Stages that a set shares with the one before it run once."""
    done, applied, made = rows, [], []
    for name, own in stages.items():
        if own[0] not in applied:
            done, applied = done.select(*rows.columns, *made), []
        for stage in own:
            if stage not in applied:
                done = stage.transform(done)
                applied.append(stage)
        done = done.withColumnRenamed(columns[name], f"{out}_{name}")
        made.append(f"{out}_{name}")
    return done.select(*keep, *made)


@dataclass(frozen=True)
class Counted:
    """Written rows with the term counts of feature sets, for ``finish``."""
    frame: DataFrame
    columns: dict[str, str]

    def finish(self, name: str, model: PipelineModel) -> DataFrame:
        """The rows with the set's ``rawFeatures``, and what its stages make of these; ``model`` is the fitted set."""
        others = [c for n, c in self.columns.items() if c != self.columns[name]]
        done = self.frame.drop(*others).withColumnRenamed(self.columns[name], "rawFeatures")
        first = 1 + [s.getOutputCol() for s in model.stages].index("rawFeatures")
        return PipelineModel(stages=model.stages[first:]).transform(done)


def transform_by_columns(model: PipelineModel, frame: DataFrame) -> DataFrame:
    """What ``model.transform(frame)`` gives for a fitted set of this module, every column of its stages among it; terms and
    counts are made by one function over Arrow columns.  A set that drops empty tokens is left to its stages."""
    made, first = {}, 0
    kinds = {Tokenizer: "tokens", StopWordsRemover: "kept", NGram: "bigrams", CountVectorizerModel: "counts", HashingTF: "counts"}
    for stage in model.stages:
        if type(stage) not in kinds or "counts" in made.values():
            break
        made[stage.getOutputCol()] = kinds[type(stage)]
        first += 1
    if list(made.values()) not in (["tokens", "counts"], ["tokens", "kept", "counts"], ["tokens", "kept", "bigrams", "counts"]):
        return model.transform(frame)
    stop_words = tuple(model.stages[1].getStopWords()) if "kept" in made.values() else ()
    counting = model.stages[first - 1]
    by = {"width": counting.getNumFeatures()} if isinstance(counting, HashingTF) else {"vocabulary": tuple(counting.vocabulary)}
    done = with_term_columns(frame, Terms(model.stages[0].getInputCol(), stop_words, **by), made)
    return PipelineModel(stages=model.stages[first:]).transform(done)


def fit_feature_sets(frame: DataFrame, names=("G1", "G2", "G3", "G4"), split_col="split",
                     vocab_size=1000, num_hash=1000, chi2_top=300,
                     drop_empty=False, chi2_rank: str = "pvalue", text_col: str = "text",
                     clean_col: str = "text_c") -> dict[str, PipelineModel]:
    """Fit the requested feature sets on the training rows of ``frame``, in three passes over them at most.

    1. The vocabularies of G1 and G3: terms are counted by (set, term).
    2. The document frequencies of G1, G3 and G4, of their vectors side by side.
    3. The chi-square cells of G2, which extends G1.

    Fitted sets are the same as those of ``g1_pipeline`` ... ``g4_pipeline``.
    """
    return _fit_sets(frame, names, split_col, vocab_size, num_hash, chi2_top, drop_empty, chi2_rank, text_col, clean_col)[0]


def fit_and_count(frame: DataFrame, names=("G1", "G2", "G3", "G4"), keep=("doc_id", "split", "emotion", "label", "weight"),
                  split_col="split", vocab_size=1000, num_hash=1000, chi2_top=300, drop_empty=False,
                  chi2_rank: str = "pvalue", text_col: str = "text",
                  clean_col: str = "text_c", by_columns: bool = False) -> tuple[dict[str, PipelineModel], Counted]:
    """As ``fit_feature_sets``, for those who need the vectors of all rows next: texts are cut into terms twice, once for
    the vocabularies and once for the term counts, which are written to ``spark.checkpoint.dir`` with the ``keep`` columns
    (split and label among them).  Document frequencies, chi-square cells and features are made from these.  Sets side by
    side share Spark's stages; one alone, or all of them ``by_columns``, are counted by one function
    (``operators/counted.py``), with the same result."""
    return _fit_sets(frame, names, split_col, vocab_size, num_hash, chi2_top, drop_empty, chi2_rank, text_col, clean_col,
                     tuple(keep), by_columns)


def _fit_sets(frame, names, split_col, vocab_size, num_hash, chi2_top, drop_empty, chi2_rank, text_col, clean_col,
              keep: tuple[str, ...] | None = None, by_columns: bool = False) -> tuple[dict[str, PipelineModel], Counted | None]:
    train = frame.filter(is_split(TRAIN, split_col))
    ensure_checkpoint_dir(frame.sparkSession)
    sets = [n for n in ("G1", "G4", "G3") if n in names or (n == "G1" and "G2" in names)]
    tokens = {n: _token_stages(n, drop_empty, text_col, clean_col) for n in sets}
    if "G1" in sets and "G4" in sets:
        tokens["G4"] = (tokens["G1"][0] + tokens["G4"][0][2:], tokens["G4"][1])
    stages: dict[str, list] = {n: list(tokens[n][0]) for n in sets}

    by_columns = keep is not None and (by_columns or len(sets) == 1) and not drop_empty
    counted = [n for n in sets if n != "G4"]
    if counted and by_columns:
        counts = term_totals(train, {n: _terms(n, text_col, clean_col) for n in counted}).checkpoint(eager=True)
    elif counted:
        side = _side_by_side(train, {n: tokens[n][0] for n in counted}, {n: tokens[n][1] for n in counted}, "t")
        each = F.explode_outer(F.array(*[F.struct(F.lit(n).alias("set"), F.col(f"t_{n}").alias("terms")) for n in counted]))
        counts = side.select(each.alias("x")).select("x.set", F.explode_outer("x.terms").alias("term")).filter(
            "term IS NOT NULL").groupBy("set", "term").agg(F.count(F.lit(1)).alias("n")).checkpoint(eager=True)
    for n in counted:
        top = counts.filter(F.col("set") == n).orderBy(F.col("n").desc(), "term").limit(vocab_size).collect()
        words = [r["term"] for r in sorted(top, key=lambda r: (-r["n"], r["term"]))]
        stages[n].append(CountVectorizerModel.from_vocabulary(words, inputCol=tokens[n][1], outputCol="rawFeatures"))
    if "G4" in sets:
        stages["G4"].append(hashing_tf("ngrams", "rawFeatures", num_hash))

    width = {n: num_hash if n == "G4" else len(stages[n][-1].vocabulary) for n in sets}
    raw = dict.fromkeys(sets, "rawFeatures")
    written = None
    if keep is None:
        side = _side_by_side(train, stages, raw, "v")
    else:
        if by_columns:
            by = {n: {"width": num_hash} if n == "G4" else {"vocabulary": tuple(stages[n][-1].vocabulary)} for n in sets}
            written = counted_side_by_side(frame, keep, {n: _terms(n, text_col, clean_col, **by[n]) for n in sets}).checkpoint(eager=True)
        else:
            written = _side_by_side(frame, stages, raw, "v", keep).checkpoint(eager=True)
        side = written.filter(is_split(TRAIN, split_col))
    if by_columns:
        n_rows, frequency = document_frequencies(side, {f"v_{n}": width[n] for n in sets})
    else:
        n_rows, frequency = _document_frequencies(side, [f"v_{n}" for n in sets])
    models = {}
    for n in sets:
        of_set, frequency = frequency[:width[n]] or [0] * width[n], frequency[width[n]:]
        weights = [math.log((n_rows + 1.0) / (d + 1.0)) for d in of_set]
        stages[n].append(ElementwiseProduct(inputCol="rawFeatures", outputCol="featuresIDF",
                                            scalingVec=Vectors.dense(weights)))
        models[n] = PipelineModel(stages=stages[n])
    found = None
    if written is not None:
        found = Counted(written, {n: f"v_{n}" for n in sets} | ({"G2": "v_G1"} if "G2" in names else {}))
    if "G2" in names:
        selector = chi2_selector("featuresIDF", "features", "label", chi2_top, chi2_rank)
        vectors = models["G1"].transform(train) if found is None else found.finish("G1", models["G1"]).filter(
            is_split(TRAIN, split_col))
        models["G2"] = PipelineModel(stages=stages["G1"] + [selector.fit(vectors)])
    return {n: models[n] for n in names}, found


def _document_frequencies(rows: DataFrame, columns: list[str]) -> tuple[int, list[int]]:
    """The number of rows, and in how many of them each entry of the vectors, one column's after another's, isn't zero."""
    both = VectorAssembler(inputCols=columns, outputCol="v").transform(rows).select("v")
    if both.isEmpty():
        return 0, []
    fitted = IDF(inputCol="v", outputCol="idf").fit(both)  # one array of frequencies a task, added up in a tree
    return fitted.numDocs, [int(d) for d in fitted.docFreq]


def write_feature_sets(frame: DataFrame, models: dict[str, PipelineModel], base_path: str,
                       mode: str = "errorifexists", keep=("doc_id", "split", "emotion", "label", "weight"),
                       split_col: str = "split", text_columns: bool = True) -> dict[str, str]:
    """Transform all rows with each fitted set and write one table per set,
    partitioned by split (the reference wrote twelve folders: 4 sets x 3 splits).

    Like the reference's, a table keeps the texts and every intermediate
    column (words, filtered, ngrams, rawFeatures, featuresIDF, features);
    ``text_columns=False`` writes ids and vectors only.  Returns {set name: path}."""
    from ..sources.parquet import write_feature_set
    paths = {}
    for name, model in models.items():
        out = model.transform(frame)
        cols = [c for c in keep if c in frame.columns]
        if text_columns:
            cols += [c for c in out.columns if c not in cols and c not in ("rawFeatures", FEATURES_COL[name])]
        out = out.select(*cols, "rawFeatures", FEATURES_COL[name])
        path = f"{base_path.rstrip('/')}/{name}"
        write_feature_set(out, path, mode, split_col)
        paths[name] = path
    return paths


def vocabulary_of(model: PipelineModel) -> list[str]:
    """Vocabulary of a count-vector feature set."""
    for st in model.stages:
        if hasattr(st, "vocabulary"):
            return list(st.vocabulary)
    raise ValueError("feature set has no vocabulary (hashed)")


class IdfWeights(NamedTuple):
    """The fitted weights of an IDF stage."""

    idf: DenseVector


def idf_model_of(model: PipelineModel) -> IdfWeights:
    for st in model.stages:
        if isinstance(st, ElementwiseProduct):
            return IdfWeights(st.getScalingVec())
        if hasattr(st, "idf") and hasattr(st, "docFreq"):
            return IdfWeights(st.idf)
    raise ValueError("feature set has no IDF stage")


def num_features_of(model: PipelineModel, name: str) -> int:
    last = model.stages[-1]
    if hasattr(last, "getIndices"):
        return len(last.getIndices())
    return len(idf_model_of(model).idf)

"""Preparation: label index, cleaning, optional lemmas, class weights.

One plan over all splits.  The label index and the class weights are fitted on
training rows only and applied to every split.  The weight column is added to
all rows; only fits use it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.cleaning import clean_text
from ..operators.labels import apply_class_weight, class_weights, fit_label_index, index_labels
from ..operators.lemma import lemmatize
from ..session import ensure_checkpoint_dir, workers_import
from .splits import TRAIN, is_split


@dataclass
class Prepared:
    frame: DataFrame
    indexer: StringIndexerModel
    weights: DataFrame  # (label, n, weight), one row a class
    cached: DataFrame | None = None

    @property
    def labels(self) -> list[str]:
        return list(self.indexer.labels)

    def release(self) -> None:
        """Drop the cache kept by ``prepare(persist=True)``."""
        if self.cached is not None:
            self.cached.unpersist(blocking=False)


def prepare(docs: DataFrame, text_col: str = "text", label_name_col: str = "emotion",
            split_col: str = "split", lemmas: DataFrame | Callable[[DataFrame, str], DataFrame] | None = None,
            weight_scheme: str = "share", handle_invalid: str = "error", clean_col: str = "text_c",
            persist: bool | str = False) -> Prepared:
    """Add ``label`` (int), ``text_c`` (cleaned, lemmatized) and ``weight``.

    Class weights are counted on (split, label) alone, from the source.
    ``lemmas``: a table, or a function that makes one of the cleaned frame, as ``lemmatize`` takes it.
    ``persist`` keeps the finished frame for the several passes that fitting
    feature sets makes over it:
    ``"checkpoint"``: written once to ``spark.checkpoint.dir`` (a reliable
    shared folder on a cluster) and read from there, so an executor loss
    costs no recomputation of the cleaning;
    ``True`` / ``"cache"``: MEMORY_AND_DISK, for corpora that fit there.
    """
    train = docs.filter(is_split(TRAIN, split_col))
    indexer = fit_label_index(train, label_name_col, "label", handle_invalid)
    ensure_checkpoint_dir(docs.sparkSession)
    counted = index_labels(indexer, train.select(label_name_col))
    weights = class_weights(counted, "label", weight_scheme).checkpoint(eager=True)  # one row a class
    frame = apply_class_weight(index_labels(indexer, docs), weights, "label", "weight")
    workers_import(docs.sparkSession)
    frame = frame.withColumn(clean_col, clean_text(text_col))
    if lemmas is not None:
        frame = lemmatize(frame, lemmas, clean_col)
    cached = None
    if persist == "checkpoint":
        frame = frame.checkpoint(eager=True)
    elif persist:
        frame = cached = frame.persist(StorageLevel.MEMORY_AND_DISK)
    return Prepared(frame=frame, indexer=indexer, weights=weights, cached=cached)


def documents_as_labeled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         label_col: str = "lang") -> DataFrame:
    """The test tables' stand-in for labelled tweets: (doc_id, text, emotion)."""
    return docs.select(F.col(id_col), F.col(text_col).alias("text"), F.col(label_col).alias("emotion"))

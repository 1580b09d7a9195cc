"""Quality classifier: histogram gradient-boosted trees over document statistics.

Each statistic is cut into at most 64 bins; trees of a fixed depth are grown level by level from the
histograms of gradients and Hessians of the logistic loss.  The finished trees are complete binary trees
in flat arrays (split feature, threshold, leaf value), so scoring a batch is ``depth`` vectorised steps a
tree.

The trees are fitted on a bounded sample of the labelled rows: the ``max_rows`` (20,000 unless said
otherwise) with the smallest hashes of their ids.  Every document is scored, in the task that holds it;
no text is shuffled.

Defined results: null and empty texts are scored by their zero statistics; a label row with a null
label or id is ignored, of several for one id the smallest label counts; without labelled rows every
score is 0.5; ids may repeat (each row is scored); texts of any length are measured whole, one at a time; of splits
that gain alike, the first in order of statistic and bin is taken; an empty table gives an empty table; further columns
of the documents are ignored by ``score`` and kept by ``keep_good``, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import clean_text, fold, map_texts
from .stats import COUNTS, measure

#: A document counts as good from this score on.
THRESHOLD = 0.3


def features(texts: list[str]) -> np.ndarray:
    """Statistics of texts as a float matrix: sizes as logarithms, the rest as shares."""
    c = dict(zip(COUNTS, np.array([measure(t) for t in texts], float).reshape(-1, len(COUNTS)).T))
    words, chars, lines = (np.maximum(c[k], 1) for k in ("n_words", "word_chars", "n_lines"))
    return np.column_stack([
        np.log1p(c["n_words"]), np.log1p(c["n_lines"]), c["word_chars"] / words, c["n_words"] / lines,
        c["n_symbols"] / chars, c["n_symbols"] / words, c["n_dup_lines"] / lines, c["n_repeat_words"] / words,
        c["n_distinct"] / words, c["n_distinct"] / np.sqrt(words), c["n_adjacent"] / words, c["n_top"] / words,
        c["n_upper"] / chars, c["n_caps_words"] / words, c["n_digits"] / chars, c["n_marks"] / chars,
        c["n_exclaim"] / words, c["n_periods"] / words, c["n_pipes"] / words, c["n_short"] / words])


@dataclass
class Trees:
    """Complete trees of one depth: inner nodes ``feature``/``cut`` (trees x nodes) and ``leaf`` values."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total, row = np.full(len(x), self.base), np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            at = np.zeros(len(x), np.int64)
            while len(at) and at[0] < inner:  # all rows are on the same level
                at = 2 * at + 1 + (x[row, feature[at]] > cut[at])
            total += leaf[at - inner]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15,
        ridge: float = 2.0, least: float = 5.0) -> Trees:
    """Boost ``trees`` trees of ``depth`` on rows ``x`` with labels ``y`` in {0, 1}."""
    n, p = x.shape
    inner = 2 ** depth - 1
    if n == 0:
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), 0.0)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(p)]
    binned = np.column_stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)])
    flat = binned + np.arange(p) * bins
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    total = np.full(n, base)
    features_, cuts, leaves = [], [], []
    for _ in range(trees):
        prob = 1 / (1 + np.exp(-total))
        g, h = prob - y, np.maximum(prob * (1 - prob), 1e-6)
        at = np.zeros(n, np.int64)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, nodes = 2 ** level - 1, 2 ** level
            key = ((at - first)[:, None] * (p * bins) + flat).ravel()
            size = nodes * p * bins
            sums = [np.bincount(key, np.repeat(v, p), size).reshape(nodes, p, bins) for v in (g, h)]
            left = [s.cumsum(2)[:, :, :-1] for s in sums]
            whole = [s.sum(2, keepdims=True) for s in sums]
            right = [w - s for w, s in zip(whole, left)]
            gain = sum(a * a / (b + ridge) for a, b in ((left[0], left[1]), (right[0], right[1]))) \
                - whole[0] ** 2 / (whole[1] + ridge)
            gain[(left[1] < least / 4) | (right[1] < least / 4)] = -1
            for k in range(nodes):
                best = int(gain[k].argmax())
                j, b = divmod(best, bins - 1)
                if gain[k, j, b] > 1e-9 and b < len(edges[j]):
                    feature[first + k], cut[first + k] = j, edges[j][b]
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > cut[at])
        at -= inner
        value = -rate * np.bincount(at, g, inner + 1) / (np.bincount(at, h, inner + 1) + ridge)
        total += value[at]
        features_.append(feature)
        cuts.append(cut)
        leaves.append(value)
    return Trees(np.array(features_), np.array(cuts), np.array(leaves), base)


def sample(labels: DataFrame, label_col: str, max_rows: int, id_col: str = "doc_id") -> DataFrame:
    """(_id, _label) of at most ``max_rows`` labelled ids: those with the smallest hashes."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias("_label"))
    one = known.filter(F.col("_id").isNotNull() & F.col("_label").isNotNull()).groupBy("_id").agg(
        F.min("_label").alias("_label"))
    return one.orderBy(F.xxhash64("_id"), "_id").limit(max_rows)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", max_rows: int = 20_000, **options) -> Trees:
    """Fit on the sampled labelled documents.  At most ``max_rows`` ids are broadcast, and as many rows of
    20 numbers come back (of ids that repeat, one row)."""
    chosen = F.broadcast(sample(labels, label_col, max_rows, id_col))
    plain = docs.select(F.col(id_col).alias("_id"), clean_text(text_col).alias("t"))
    rows = plain.join(chosen, "_id").select("_id", "_label", "t")

    def make():
        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            x = features(part.column(2).to_pylist())
            return pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.FixedSizeListArray.from_arrays(
                x.ravel(), x.shape[1]).cast(pa.list_(pa.float64()))], ["id", "label", "x"])
        return work

    kind = docs.schema[id_col].dataType.simpleString()
    got = map_texts(rows, ["_id", "_label"], "t", f"id {kind}, label double, x array<double>", make).groupBy(
        "id").agg(F.min(F.struct("label", "x")).alias("r")).select("id", "r.*").toArrow().sort_by("id")
    if not got.num_rows:
        return fit(np.zeros((0, 1)), np.zeros(0), **options)
    x = np.array(got["x"].to_pylist(), float)
    return fit(x, got["label"].to_numpy().astype(float), **options)


def score(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score) of every row."""
    def make():
        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(trees.score(features(part.column(1).to_pylist())))], ["id", "score"])
        return work

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs, [id_col], text_col, f"id {kind}, score double", make).withColumnRenamed("id", id_col)


def score_column(text, trees: Trees):
    """The score as a column, for use beside all other columns of a row."""
    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        out, step = [], 256
        for i in range(0, len(texts), step):
            out.append(trees.score(features(texts.slice(i, step).to_pylist())))
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return scored(text)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The documents that score at least ``threshold``, with all their columns."""
    trees = train(docs, labels, **options)
    return docs.filter(score_column(clean_text("text"), trees) >= threshold)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; rows of fold 0 of 5 teach nothing."""
    held_out = fold("doc_id", 5) == 0
    trees = train(docs, labels.filter(~held_out))
    return score(docs, trees).select("doc_id", held_out.alias("held_out"), "score",
                                     (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

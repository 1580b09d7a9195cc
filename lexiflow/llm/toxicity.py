"""Toxicity: non-negative positive-unlabelled learning over word and word-stem features.

Only confirmed toxic documents are known to be what they are; everything else is unlabelled and holds
toxic documents too, in the share of the class prior.  With prior q, loss l and linear score f, the risk is

    q * mean_P l(f) + max(0, mean_U l(-f) - q * mean_P l(-f))

The bracket estimates the loss on true negatives; when a batch drives it below zero, the step goes the
other way on that part, which keeps a flexible model from fitting the unlabelled toxic documents as
negatives.  The model is trained in numpy by gradient steps with
momentum over full batches, until the risk has settled.

Features are hashed words and word beginnings of 4 to 8 bytes, at three levels: at least one, two or three
different words of a text have it.  Candidates occur in ``least`` of the confirmed training texts and there more often
than in the unlabelled training rows.  Spark then counts in how many of *all* documents that may teach each candidate
occurs; those that are surely more frequent in the confirmed
ones (log ratio less three standard errors above zero) are kept, the
``max_features`` surest at most.  Equal confirmed texts count once here, so that the words of a few copies
aren't taken for markers, and a language with few confirmed documents keeps its own.

Bounds, all parameters: the training rows are the ``max_positive`` confirmed and ``max_unlabelled``
other documents with the smallest id hashes; ``max_candidates`` candidates (the surest by the training rows), ``max_features``
features.  Every document is counted and scored, where
it lies; no text is shuffled but the confirmed ones of the training rows.

Defined results: null and empty texts get the score of no features; label rows with a null id or label
are ignored, of several for one id the largest counts; rows of documents that repeat an id teach and are scored each; without
confirmed documents every score is the prior; texts of any length are read whole, one at a time; features as sure as each
other are taken by bucket number; an empty table gives an empty table; further columns aren't read, whatever their names.
"""

from __future__ import annotations

import logging
from collections import Counter
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import clean_text, fold, map_texts, materialise

LOG = logging.getLogger(__name__)
THRESHOLD = 0.3
#: Feature hashes fall into 2 ** HASH_BITS buckets.
HASH_BITS = 26
#: Lengths in bytes of the word beginnings, and how many levels of a count are told apart.
STEMS, LEVELS = (4, 5, 6, 8), 3
EDGE = b".,;:!?'\"()[]{}-_/\\#*$%&|<>@+=~^`"


class WordFeatures(dict):
    """word (bytes) -> buckets of the word and its beginnings; kept for reuse, emptied at ``limit`` words.

    The features of a text are (bucket, level) codes: level k if at least k different words have the
    bucket.  With ``wanted`` (code -> column) only those, as columns.
    """

    def __init__(self, wanted: dict[int, int] | None = None, limit: int = 200_000):
        super().__init__()
        self.wanted, self.limit = wanted, limit
        # bucket -> the columns of 0, 1, ... LEVELS different words
        self.bases = {} if wanted is None else {b: [[wanted[c] for c in range(b * LEVELS, b * LEVELS + n) if c in wanted]
                                                    for n in range(LEVELS + 1)] for b in {code // LEVELS for code in wanted}}

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= self.limit:
            self.clear()
        low = word.lower().strip(EDGE)
        out: tuple[int, ...] = ()
        if low:
            n, bases, shift, digest = len(low), self.bases, 64 - HASH_BITS, xxhash.xxh3_64_intdigest
            found = [digest(b"=" + low) >> shift] + [digest(low[:k]) >> shift for k in STEMS if n >= k]
            out = tuple(found if self.wanted is None else [b for b in found if b in bases])
        self[word] = out
        return out

    def of(self, text: str) -> list[int]:
        found = Counter(chain.from_iterable(map(self.__getitem__, set(text.encode("utf-8").split()))))
        if self.wanted is None:
            return [b * LEVELS + k for b, n in found.items() for k in range(min(n, LEVELS))]
        bases = self.bases
        return [c for b, n in found.items() for c in bases[b][n if n < LEVELS else LEVELS]]


@dataclass
class Linear:
    buckets: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    base: float = 0.0

    def scorer(self):
        features = WordFeatures({int(b): i for i, b in enumerate(self.buckets)})

        def score(texts: list[str]) -> np.ndarray:
            total = np.array([self.weights[f].sum() if (f := features.of(t)) else 0.0 for t in texts], float)
            return 1 / (1 + np.exp(-np.clip(total + self.base, -50, 50)))

        return score


def _rows(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in lists], np.int64)
    return np.repeat(np.arange(len(lists)), sizes), np.array([i for x in lists for i in x], np.int64)


def risk_and_slope(sets: list[tuple], w: np.ndarray, b: float, prior: float) -> tuple[float, np.ndarray, np.ndarray]:
    """The non-negative risk of a linear model on (row, column, rows) sets of confirmed and unlabelled rows, its slope, and
    the slope of its bracket (intercept last).  Where the bracket is below zero, the risk's slope is that of the first part alone."""
    def slope(rows, pull):
        at, col, n = rows
        return np.append(np.bincount(col, pull[at], len(w)), pull.sum()) / max(n, 1)

    scores = [np.bincount(at, w[col], n) + b for at, col, n in sets]
    up = [1 / (1 + np.exp(-np.clip(s, -50, 50))) for s in scores]  # slope of a negative's loss
    as_negative = [np.logaddexp(0, s).mean() for s in scores]
    bracket = as_negative[1] - prior * as_negative[0]
    g_bracket = slope(sets[1], up[1]) - prior * slope(sets[0], up[0])
    g_first = prior * slope(sets[0], up[0] - 1)
    risk = prior * np.logaddexp(0, -scores[0]).mean() + max(0.0, bracket)
    return float(risk), (g_first + g_bracket if bracket >= 0 else g_first), (g_bracket if bracket < 0 else 0 * g_bracket)


def fit_nnpu(positive: list[list[int]], unlabelled: list[list[int]], columns: int, prior: float,
             steps: int = 5_000, rate: float = 1.0, decay: float = 2e-4, settled: float = 2e-4,
             window: int = 100) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise the non-negative risk; rows are lists of active columns.

    Stops when the mean risk (with the decay) of ``window`` steps differs from that of the ``window`` steps before by no more than
    ``settled`` of its start (single steps go up and down where the bracket is about zero); ``steps`` is an emergency stop, which
    is logged."""
    sets = [(*_rows(rows), len(rows)) for rows in (positive, unlabelled)]
    w, b = np.zeros(columns), float(np.log(prior / (1 - prior)))
    pace = np.zeros(columns + 1)
    path: list[float] = []
    for _ in range(steps):
        risk, g, below = risk_and_slope(sets, w, b, prior)
        path.append(risk + decay / 2 * float(w @ w))
        if len(path) % window == 0 and len(path) >= 2 * window and abs(
                sum(path[-window:]) - sum(path[-2 * window:-window])) <= window * settled * path[0]:
            break
        if below.any():
            g = -below  # the bracket is below zero: back on that part
        g[:-1] += decay * w
        pace = 0.9 * pace - rate * g
        w, b = w + pace[:-1], b + float(pace[-1])
    else:
        LOG.warning("toxicity: the risk still moves after %d steps: %s", steps, path[-1])
    return w, b


def _occurrences(rows: DataFrame, flags: list[str], wanted: np.ndarray | None = None) -> DataFrame:
    """(bucket, a count for each flag column): in how many rows (flags..., t) with a flag set a feature occurs.  Each task sums
    its own slices first; with ``wanted`` only those features."""
    def make():
        places = None if wanted is None else {int(b): i for i, b in enumerate(wanted)}
        features = WordFeatures(places)

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            found = [np.fromiter(f, np.int64, len(f)) for f in map(features.of, part.column(len(flags)).to_pylist())]
            flat = np.concatenate([*found, np.zeros(0, np.int64)])
            if wanted is None:
                unique, where = np.unique(flat, return_inverse=True)
            else:  # few and small numbers: counted without a sort
                unique = np.flatnonzero(np.bincount(flat, minlength=len(wanted)))
                where = np.searchsorted(unique, flat)
            counts = [pa.array(np.bincount(where.reshape(-1), np.repeat(np.array(part.column(k).to_pylist(), float), [
                len(f) for f in found]), len(unique)).astype(np.int64)) for k in range(len(flags))]
            keys = unique if wanted is None else wanted[unique]
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), *counts], ["bucket", *flags])
        return work

    schema = ", ".join(["bucket long", *[f"{f} long" for f in flags]])
    return map_texts(rows, flags, "t", schema, make).groupBy("bucket").agg(*[F.sum(f).alias(f) for f in flags])


def _surely(pos: str, n_pos: float, other: str, n_other: float):
    """Log ratio of two document frequencies, and the same less three standard errors."""
    a, u = (F.col(pos) + 0.5) / F.lit(n_pos + 1.0), (F.col(other) + 0.5) / F.lit(n_other + 1.0)
    return F.log(a / u), F.log(a / u) - 3 * F.sqrt(1 / (F.col(pos) + 0.5) + 1 / (F.col(other) + 0.5))


def train(docs: DataFrame, confirmed: DataFrame, prior: float, id_col: str = "doc_id", text_col: str = "text",
          max_positive: int = 5_000, max_unlabelled: int = 15_000, max_features: int = 3_000,
          least: int = 3, max_candidates: int = 12_000) -> Linear:
    """Fit on ``confirmed`` (ids) as positives and ``docs`` as unlabelled."""
    plain = docs.select(F.col(id_col).alias("_id"), clean_text(text_col).alias("t"))
    first = lambda df, n: df.filter(F.col("_id").isNotNull()).select("_id").distinct().orderBy(
        F.xxhash64("_id"), "_id").limit(n)
    positive = first(confirmed.select(F.col(id_col).alias("_id")), max_positive).withColumn("p", F.lit(1))
    other = first(plain, max_unlabelled).withColumn("p", F.lit(0))
    chosen = F.broadcast(positive.unionByName(other))  # max_positive + max_unlabelled ids at most
    # a confirmed document that is also among the unlabelled ones counts as both, as the risk asks
    rows = materialise(plain.join(chosen, "_id").select("_id", F.col("p").cast("long").alias("p"), "t"), "toxicity-rows")
    sizes = {r["p"]: r["n"] for r in chosen.groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_unl = sizes.get(1, 0), sizes.get(0, 0)
    intercept = float(np.log(prior / (1 - prior)))
    if not n_pos or not n_unl:
        return Linear(base=intercept)
    once = rows.filter("p = 1").dropDuplicates(["t"])  # max_positive ids' texts at most
    n_once = once.count()
    flagged = once.unionByName(rows.filter("p = 0")).select(F.col("p").alias("pos"), (1 - F.col("p")).alias("unl"), "t")
    ratio, sure = _surely("pos", n_once, "unl", n_unl)
    candidates = materialise(_occurrences(flagged, ["pos", "unl"]).filter((F.col("pos") >= least) & (ratio > 0)).orderBy(
        sure.desc(), "bucket").limit(max_candidates).select("bucket", "pos"), "toxicity-candidates")
    known = np.sort(candidates.select("bucket").toArrow()["bucket"].to_numpy())  # max_candidates numbers at most
    every = _occurrences(plain.select(F.lit(1).cast("long").alias("all"), "t"), ["all"], known)
    n_all = plain.count()
    _, sure = _surely("pos", n_once, "all", n_all)
    best = candidates.join(F.broadcast(every), "bucket").filter(sure > 0).orderBy(
        sure.desc(), "bucket").limit(max_features).select("bucket").toArrow()["bucket"].to_numpy()
    wanted = {int(b): i for i, b in enumerate(best)}

    def make():
        features = WordFeatures(wanted)

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            lists = [sorted(features.of(t)) for t in part.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([part.column(0), pa.array(lists, pa.list_(pa.int32()))], ["p", "f"])
        return work

    got = map_texts(rows, ["p"], "t", "p long, f array<int>", make).toArrow().to_pydict()
    order = sorted(range(len(got["p"])), key=lambda i: (got["p"][i], got["f"][i]))  # the same sums in any layout
    lists = {k: [got["f"][i] for i in order if got["p"][i] == k] for k in (0, 1)}
    weights, base = fit_nnpu(lists[1], lists[0], len(best), prior)
    return Linear(best, weights, base)


def score(docs: DataFrame, model: Linear, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score) of every row."""
    def make():
        scorer = model.scorer()

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([part.column(0), pa.array(scorer(part.column(1).to_pylist()))],
                                              ["id", "score"])
        return work

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs, [id_col], text_col, f"id {kind}, score double", make).withColumnRenamed("id", id_col)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; rows of fold 2 of 4 teach nothing."""
    held_out = fold("doc_id", 4) == 2
    known = labels.filter(~held_out & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy(
        "doc_id").agg(F.max("toxic").alias("toxic"))
    share = known.agg(F.avg("toxic")).first()[0]
    prior = min(max(float(share or 0.0), 0.001), 0.9)
    model = train(docs.filter(~held_out), known.filter("toxic = 1"), prior)
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score",
                                     (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

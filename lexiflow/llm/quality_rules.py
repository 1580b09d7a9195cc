"""Quality rules: base rules, then robust multivariate outliers.

Each text becomes a vector of transformed statistics.  For every (language, source), language, and for all
documents together, the minimum covariance determinant estimate of centre and scatter is computed, and a
document is rejected if its squared Mahalanobis distance exceeds ``CUTOFF``.  The finest of its three groups
with at least ``LEAST_GROUP`` rows judges it.  The estimates see all documents that pass the base rules.

MCD looks for the half of a group whose covariance matrix has the least determinant.  It starts from medians
and interquartile ranges, and from the shortest halves of the statistics, which up to 45% of junk don't draw
away, and repeats concentration steps: distances under the current estimate, then mean and covariance of the
nearest half, which never raises the determinant.  The steps end when the estimate stops moving; where the
starts disagree, the second one's result is taken.  Then mean and covariance of the rows within
``NEAR`` are taken, ``REWEIGHTS`` times.  An estimate that rejects more than half of its own group describes
a tight minority: the steps start again from the rejected rows, and if that doesn't help, the next coarser
group judges.  Every step is one aggregation: rows are binned by the logarithm of their distance (1/32 of a
power of two), each (group, bin) sums its moments, and the nearest bins up to half of the rows make the next
estimate.  So no group is ever gathered, however many rows it holds, and results don't depend on how rows
are dealt out.  ``FLOOR`` is added to the standard deviations, since many statistics are zero in most texts.

Defined results: a null or empty text has zero counts and fails the base rules; null language or source
is a group of its own; groups that are too small are judged by the next coarser one and, with fewer than
``LEAST_GROUP`` rows in all, nothing more is rejected; equal rows get equal results; an empty table gives
an empty table; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts, materialise
from .stats import COUNTS, measure

#: Transformed statistics: name, expression over the counts, standard deviation added (the floor).
STATISTICS = (
    ("size", "ln(1 + n_words)", 0.2),
    ("word_length", "ln(1 + word_chars / n_words)", 0.05),
    ("symbols", "ln(1 + 50 * n_symbols / word_chars)", 0.15),
    ("upper", "ln(1 + 20 * n_upper / word_chars)", 0.15),
    ("marks", "ln(1 + 20 * n_marks / word_chars)", 0.15),
    ("digits", "ln(1 + 20 * n_digits / word_chars)", 0.25),
    ("repeats", "ln(1 + 5 * n_repeat_words / n_words)", 0.25),
    ("same_lines", "ln(1 + 5 * n_dup_lines / n_lines)", 0.25),
)
FLOOR = np.array([s[2] for s in STATISTICS])
SIZE = len(STATISTICS)
#: Rows a group needs, share of rows that an estimate keeps, steps at most, bins of a power of two.
LEAST_GROUP, KEPT_SHARE, STEPS, FINENESS = 200, 0.5, 60, 32
#: Squared distances beyond this are outliers; under a normal distribution one in about 10**8 rows is.
CUTOFF = 60.0
#: Covariances of the inner half of 8 normal variables are too small by this factor.
CONSISTENCY = 1.628
#: Rows within this squared distance (97.5% of normal ones) count in the reweighted estimate; factor of its
#: covariances, and how often it is made.
NEAR, NEAR_CONSISTENCY, REWEIGHTS = 17.54, 1.041, 4
#: An estimate has settled if its centre moves by less than this share of the floors and the logarithm of its
#: determinant by less than the second number; up to the third, two starts have found the same.
MOVED, MOVED_LOG, SAME_LOG = 0.01, 0.001, 0.5


def measured(docs: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """``keys`` and the counts of ``stats.COUNTS`` for every row."""
    def make():
        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            counts = np.array([measure(t) for t in part.column(len(keys)).to_pylist()], np.int64)
            return pa.RecordBatch.from_arrays(
                [*part.columns[:len(keys)], *map(pa.array, counts.reshape(-1, len(COUNTS)).T)], [*keys, *COUNTS])
        return work

    types = dict(docs.dtypes)
    schema = ", ".join([f"`{k}` {types[k]}" for k in keys] + [f"{c} long" for c in COUNTS])
    return map_texts(docs, keys, text_col, schema, make)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def group_keys(lang: str, source: str) -> Column:
    """Keys of a row's groups, finest first."""
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))
    return F.array(F.concat_ws("\x1f", F.lit("0"), name(lang), name(source)),
                   F.concat_ws("\x1f", F.lit("1"), name(lang)), F.lit("2"))


def distance() -> Column:
    """Squared distance of ``x`` under ``center`` and ``whiten`` (a lower triangle, row by row)."""
    total, at = F.lit(0.0), 0
    for i in range(SIZE):
        part = F.lit(0.0)
        for j in range(i + 1):
            part = part + F.get("whiten", F.lit(at)) * (F.get("x", F.lit(j)) - F.get("center", F.lit(j)))
            at += 1
        total = total + part * part
    return total


def whitening(cov: np.ndarray) -> np.ndarray:
    return np.linalg.inv(np.linalg.cholesky(cov + np.diag(FLOOR ** 2)))[np.tril_indices(SIZE)]


ESTIMATE = "key string, start int, n long, center array<double>, whiten array<double>"
PAIRS = [(i, j) for i in range(SIZE) for j in range(i + 1)]


def log_determinant(whiten: str = "whiten") -> Column:
    return sum((F.log(F.get(whiten, F.lit(i * (i + 3) // 2))) for i in range(SIZE)), F.lit(0.0)) * -2


def start(rows: DataFrame) -> DataFrame:
    """(key, start, n, center, whiten) from values binned by 1/64: start 0 from medians and interquartile
    ranges, start 1 from shortest halves."""
    cells = rows.select("key", F.posexplode("x").alias("j", "v")).groupBy(
        "key", "j", F.floor(F.col("v") * 64).alias("bin")).agg(F.count(F.lit(1)).alias("n"))

    def starts(pdf: pd.DataFrame) -> pd.DataFrame:
        center, spread = np.zeros((2, SIZE)), np.zeros((2, SIZE))
        for j, part in pdf.sort_values("bin").groupby("j"):
            below, bins = part["n"].cumsum().to_numpy(), part["bin"].to_numpy()
            q = [(bins[np.searchsorted(below, f * below[-1])] + 0.5) / 64 for f in (0.25, 0.5, 0.75)]
            center[0, j], spread[0, j] = q[1], (q[2] - q[0]) / 1.349
            to = np.searchsorted(below, below - part["n"].to_numpy() + below[-1] / 2)
            inside = to < len(bins)  # from these bins on there is a half of the rows
            width = bins[to[inside]] - bins[inside]
            at = int(width.argmin())
            center[1, j], spread[1, j] = (bins[at] + bins[to[at]] + 1) / 128, width[at] / 64 / 1.349
        return pd.DataFrame({"key": [pdf["key"].iloc[0]] * 2, "start": [0, 1], "n": [int(pdf["n"].sum()) // SIZE] * 2,
                             "center": list(center), "whiten": [whitening(np.diag(x ** 2)) for x in spread]})

    return cells.groupBy("key").applyInPandas(starts, ESTIMATE)


def moments(rows: DataFrame, estimates: DataFrame, bin_: Column, share: float | None, factor: float) -> DataFrame:
    """Estimates from the rows of the lowest bins: those that hold ``share`` of a group, or bin 0."""
    x = [F.get("x", F.lit(i)) for i in range(SIZE)]
    sums = rows.join(estimates, "key").withColumn("bin", bin_).groupBy("key", "start", "bin").agg(
        F.count(F.lit(1)).alias("m"), F.array(*[F.sum(v) for v in x]).alias("s"),
        F.array(*[F.sum(x[i] * x[j]) for i, j in PAIRS]).alias("ss"))

    def estimate(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bin")
        below = pdf["m"].cumsum().to_numpy()
        pdf = pdf.iloc[:1 if share is None else int(np.searchsorted(below, share * below[-1])) + 1]
        m = pdf["m"].sum()
        center = np.vstack(pdf["s"]).sum(0) / m
        cov = np.zeros((SIZE, SIZE))
        for value, (i, j) in zip(np.vstack(pdf["ss"]).sum(0) / m, PAIRS):
            cov[i, j] = cov[j, i] = value - center[i] * center[j]
        lowest = np.linalg.eigvalsh(cov)[0]
        cov = factor * (cov + max(0.0, -lowest) * np.eye(SIZE))
        return pd.DataFrame({"key": pdf["key"].iloc[:1], "start": pdf["start"].iloc[:1], "n": [int(below[-1])],
                             "center": [center], "whiten": [whitening(cov)]})

    return sums.groupBy("key", "start").applyInPandas(estimate, ESTIMATE)


def concentrate(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """One concentration step for all groups."""
    bin_ = F.floor(F.log2(distance() + F.lit(1e-6)) * FINENESS).cast("int")
    return moments(rows, estimates, bin_, KEPT_SHARE, CONSISTENCY)


def settle(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Concentration steps until no estimate moves; one of each group's starts."""
    moved = F.abs(log_determinant() - log_determinant("_w")) >= MOVED_LOG
    for i, floor in enumerate(FLOOR):
        moved = moved | (F.abs(F.get("center", F.lit(i)) - F.get("_c", F.lit(i))) >= float(MOVED * floor))
    settled = []
    for step in range(STEPS):
        before = found.select("key", "start", F.col("center").alias("_c"), F.col("whiten").alias("_w"))
        new = materialise(concentrate(rows, found).join(before, ["key", "start"]).withColumn("moved", moved).drop(
            "_c", "_w"), f"mcd-{step}")
        settled.append(new.filter("NOT moved" if step + 1 < STEPS else "true").drop("moved"))
        found = new.filter("moved").drop("moved")
        if found.isEmpty():
            break
    every = settled[0]
    for more in settled[1:]:
        every = every.unionByName(more)
    one = F.struct("start", "n", "center", "whiten")
    both = every.groupBy("key").agg(F.min_by(one, "start").alias("_0"), F.max_by(one, "start").alias("_1"))
    same = F.abs(log_determinant("_0.whiten") - log_determinant("_1.whiten")) < SAME_LOG
    return materialise(both.select("key", F.when(same, F.col("_0")).otherwise(F.col("_1")).alias("_e")).select(
        "key", "_e.*"), "mcd-best")


def by_groups(rows: DataFrame) -> DataFrame:
    return materialise(rows.select(F.explode("keys").alias("key"), "x"), "mcd-rows")


def estimates_of(rows: DataFrame) -> DataFrame:
    """(key, start, n, center, whiten) of all groups of rows (keys, x), not reweighted; one row a group."""
    by_key = by_groups(rows)
    return settle(by_key, materialise(start(by_key), "mcd-start"))


def reweighted(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Estimates from the rows near the given ones, and ``most``: whether they reject no more than half."""
    for _ in range(REWEIGHTS):
        found = materialise(moments(rows, found, (distance() > NEAR).cast("int"), None, NEAR_CONSISTENCY), "mcd-near")
    rejected = rows.join(found, "key").groupBy("key").agg(F.avg((distance() > CUTOFF).cast("int")).alias("_r"))
    return materialise(found.join(rejected, "key").withColumn("most", F.col("_r") <= 0.5).drop("_r"), "mcd-final")


def trusted(rows: DataFrame) -> DataFrame:
    """(key, start, n, center, whiten) of the groups of rows (keys, x) with an estimate that holds for most of
    their rows."""
    by_key = by_groups(rows)
    found = reweighted(by_key, settle(by_key, materialise(start(by_key), "mcd-start")))
    good, rest = found.filter("most").drop("most"), found.filter("NOT most").drop("most")
    if rest.isEmpty():
        return good
    others = materialise(moments(by_key, rest, (distance() <= CUTOFF).cast("int"), None, 1.0), "mcd-others")
    again = reweighted(by_key, settle(by_key, others))
    return good.unionByName(again.filter("most").drop("most"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source") -> DataFrame:
    """id, counts, base_failed, distance (null if not judged), kept."""
    keys = [id_col, *dict.fromkeys(c for c in (lang_col, source_col) if c != id_col)]
    stats = measured(docs, keys, text_col).withColumn("base_failed", base_failed())
    vector = F.array(*[F.expr(e).cast("double") for _, e, _ in STATISTICS])
    stats = materialise(stats.withColumn("keys", group_keys(lang_col, source_col)).withColumn(
        "x", F.when(~F.col("base_failed"), vector)), "document-statistics")
    found = trusted(stats.filter("NOT base_failed").select("keys", "x"))
    usable = found.filter(F.col("n") >= LEAST_GROUP).select(
        "key", F.struct("center", "whiten").alias("estimate"))
    for level in range(3):  # three joins on keys of one row each; Spark broadcasts what is small enough
        stats = stats.withColumn("key", F.get("keys", F.lit(level))).join(
            usable.withColumnRenamed("estimate", f"_{level}"), "key", "left").drop("key")
    stats = stats.withColumn("_e", F.coalesce("_0", "_1", "_2")).withColumns(
        {"center": F.col("_e.center"), "whiten": F.col("_e.whiten")})
    stats = stats.withColumn("distance", F.when(~F.col("base_failed"), distance()))
    return stats.select(id_col, *COUNTS, "base_failed", "distance", (
        ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= CUTOFF)).alias("kept"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance."""
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                              "base_failed", "kept", "distance")

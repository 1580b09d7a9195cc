"""Many one-vs-rest linear SVMs fitted together, one pass over the rows for all of them.

A grid search fits (regularisation x fold x class) hinge-loss problems on the same rows.  Here they are columns of one
coefficient matrix: a pass multiplies blocks of rows with all columns, and what goes back to the driver is
one loss and one gradient a problem, whatever the number of rows.  Each problem keeps its own search
(orthant-wise limited-memory BFGS with a backtracking strong-Wolfe line search, as Spark's ``LinearSVC``
runs it), so that one that needs a shorter step doesn't hold up the others.  The model after 10 iterations
is the 50-iteration model's path at 10, so a grid over ``maxIter`` costs its longest run.

The objective is that of ``LinearSVC``: mean weighted hinge loss plus regParam / 2 times the squared
coefficients of features centred and scaled to unit standard deviation (of the rows fitted on); the
intercept is free.  Rows stay as they are, sparse ones too: centre and scale go into the coefficients.

Rows with a null label, weight or feature vector are an error, as in Spark's classifiers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Most cells of a dense block inside a task (8 bytes each).
BLOCK_CELLS = 1 << 20
MEMORY = 10            # pairs of steps and gradient changes kept
ARMIJO, WOLFE = 1e-4, 0.9
GROW, SHRINK, FIRST_SHRINK = 2.1, 0.5, 0.1
MOST_TRIALS = 20
AHEAD = 4              # shorter steps that may be tried at once
ROOM = 1.25            # columns of a pass, for each problem
LATE = 12              # iterations behind that make up for one step further ahead


def sparse_parts(features_col: str) -> list[Column]:
    """``idx`` and ``val`` of a vector column, dense or sparse."""
    v = F.unwrap_udt(F.col(features_col))
    every = F.when(F.size(v["values"]) > 0, F.sequence(F.lit(0), F.size(v["values"]) - 1)).otherwise(
        F.array().cast("array<int>"))
    return [F.coalesce(v["indices"], every).alias("idx"), v["values"].alias("val")]


def linear_rows(df: DataFrame, features_col: str, label_col: str = "label", weight_col: str | None = "weight",
                fold_col: str | None = None) -> DataFrame:
    """(idx, val, label, weight, fold) for the functions below."""
    weight = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    fold = F.col(fold_col).cast("int") if fold_col else F.lit(0)
    label = F.col(label_col).cast("int")
    checked = F.when(F.isnull(label) | F.isnull(weight) | F.isnull(features_col), F.raise_error(
        F.lit("null label, weight or features"))).otherwise(label)
    return df.select(*sparse_parts(features_col), checked.alias("label"), weight.alias("weight"), fold.alias("fold"))


def blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, feature numbers, dense rows over them) that cover a batch of (idx, val, ...)."""
    for start, stop, used, spots, values in _sparse_blocks(batch):
        yield start, stop, used, _dense(stop - start, used, spots, values)


def _sparse_blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, feature numbers, places of the values in dense rows over them, values) of each block."""
    idx, val = (batch.column(k).flatten().to_numpy(zero_copy_only=False) for k in (0, 1))
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column(0)).to_numpy(zero_copy_only=False))])
    start = 0
    while start < batch.num_rows:
        stop = min(start + 1024, batch.num_rows)
        while True:
            cells = slice(ends[start], ends[stop])
            used, spot = np.unique(idx[cells], return_inverse=True)
            if stop - start == 1 or (stop - start) * len(used) <= BLOCK_CELLS:
                break
            stop = start + (stop - start) // 2
        row = np.repeat(np.arange(stop - start), np.diff(ends[start:stop + 1]))
        yield start, stop, used, row * len(used) + spot, val[cells]
        start = stop


def _dense(n_rows: int, used: np.ndarray, spots: np.ndarray, values: np.ndarray) -> np.ndarray:
    dense = np.zeros(n_rows * len(used))
    dense[spots] = values
    return dense.reshape(n_rows, len(used))


PACKED = "label binary, weight binary, fold binary, used binary, spots binary, vals binary"
_TYPES = {"label": np.int32, "weight": np.float64, "fold": np.int32, "used": np.int32, "spots": np.int32, "vals": np.float64}


def _short_spots(spots: np.ndarray) -> bytes:
    """Ascending places as the gaps between them if these fit 16 bits, else as they are; the first number says which."""
    gaps = np.diff(spots, prepend=0)
    if len(gaps) and gaps.min() >= 0 and gaps.max() < 1 << 16:
        return np.int64(1).tobytes() + gaps.astype(np.uint16).tobytes()
    return np.int64(0).tobytes() + spots.astype(np.int32).tobytes()


def _long_spots(data: pa.Buffer) -> np.ndarray:
    if np.frombuffer(data, np.int64, 1)[0]:
        return np.cumsum(np.frombuffer(data, np.uint16, offset=8), dtype=np.int64)
    return np.frombuffer(data, np.int32, offset=8)


def _short_values(values: np.ndarray) -> bytes:
    """The different values (to the bit), their number first, and of each value its place among them, if that takes 16 bits
    and less room; else 0 and the values."""
    table, place = np.unique(values.view(np.int64), return_inverse=True)
    if len(table) <= 1 << 16 and 4 * len(table) < 3 * len(values):
        return np.int64(len(table)).tobytes() + table.tobytes() + place.astype(np.uint16).tobytes()
    return np.int64(0).tobytes() + values.tobytes()


def _long_values(data: pa.Buffer) -> np.ndarray:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    if not n:
        return np.frombuffer(data, np.float64, offset=8)
    return np.frombuffer(data, np.float64, n, 8).take(np.frombuffer(data, np.uint16, offset=8 + 8 * n))


def packed(rows: DataFrame) -> DataFrame:
    """``linear_rows`` as blocks of up to 1,024 rows, a block's numbers in one binary value a column; cache it before a
    fit: a pass then only copies blocks, where rows would be sorted into blocks again.  What a pass copies most of, places
    and values, takes 2 bytes each where that loses nothing.  Packed rows stay as they are."""
    if rows.columns == list(_TYPES):
        return rows

    def pack(batches):
        for batch in batches:
            every = _numbers(batch, "label", "weight", "fold")
            for start, stop, *parts in _sparse_blocks(batch):
                *block, spots, values = [np.ascontiguousarray(v, t) for v, t in zip(
                    [*(c[start:stop] for c in every), *parts], _TYPES.values())]
                block = [*(v.tobytes() for v in block), _short_spots(spots), _short_values(values)]
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in block], list(_TYPES))

    return rows.mapInArrow(pack, PACKED)


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(labels, weights, folds, feature numbers, dense rows over them) of each block."""
    for k in range(batch.num_rows):
        *numbers, spots, values = (batch.column(n)[k].as_buffer() for n in _TYPES)
        label, weight, fold, used = (np.frombuffer(b, t) for b, t in zip(numbers, _TYPES.values()))
        yield label, weight, fold, used, _dense(len(label), used, _long_spots(spots), _long_values(values))


def _numbers(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False) for n in names]


def totals(rows: DataFrame, n_keys: int, width: int, add: Callable[[pa.RecordBatch, np.ndarray], None]) -> np.ndarray:
    """Sum over all rows of what ``add`` adds to an (n_keys, width) matrix, batch by batch.

    A task sends one array a key; one group a key adds up its arrays, in the order of the partitions.
    """
    def partial(batches):
        from pyspark import TaskContext
        sums = np.zeros((n_keys, width))
        seen = False
        for batch in batches:
            seen = True
            add(batch, sums)
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(n_keys, dtype=np.int32)), pa.array([TaskContext.get().partitionId()] * n_keys, pa.int32()),
                 pa.array(list(sums), pa.list_(pa.float64()))], ["key", "part", "sums"])

    def whole(table: pa.Table) -> pa.Table:
        total = np.zeros(width)
        for one in table.sort_by("part").column("sums"):
            total += one.values.to_numpy()
        return pa.table({"key": table.column("key")[:1], "sums": pa.array([total], pa.list_(pa.float64()))})

    found = rows.mapInArrow(partial, "key int, part int, sums array<double>").groupBy("key").applyInArrow(
        whole, "key int, sums array<double>").toArrow()
    out = np.zeros((n_keys, width))
    for key, sums in zip(found.column("key").to_pylist(), found.column("sums")):
        out[key] = sums.values.to_numpy()
    return out


@dataclass(frozen=True)
class Problem:
    """Class ``cls`` against the rest, on the rows outside ``fold`` (None: on all)."""
    cls: int
    reg: float
    fold: int | None = None


@dataclass
class Search:
    """One problem's path: where to evaluate next, and what to make of the answer."""
    x: np.ndarray
    max_iter: int
    tol: float
    keep: tuple[int, ...] = ()
    f: float = np.nan
    g: np.ndarray | None = None
    iteration: int = 0
    done: bool = False
    history: list[float] = field(default_factory=list)
    kept: dict[int, np.ndarray] = field(default_factory=dict)
    pairs: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    failed: bool = False
    alpha: float = 0.0
    line: int = 0          # lines searched so far

    def trial(self, alpha: float | None = None) -> np.ndarray:
        if self.g is None:
            return self.x
        moved = self.x + (self.alpha if alpha is None else alpha) * self.direction
        return np.where(np.sign(moved) == self.orthant, moved, 0.0)

    def ahead(self) -> list[float]:
        """Lengths on this line that may be asked for after the next answer, likely ones first."""
        if self.g is None:
            return []
        step = SHRINK if self.iteration else FIRST_SHRINK
        shorter = [self.alpha * step]
        while len(shorter) < AHEAD:
            shorter.append(shorter[-1] * step)
        return [shorter[0], self.alpha * GROW, *shorter[1:], shorter[0] * GROW]

    def tell_all(self, answers: dict[float, tuple[float, np.ndarray]]) -> None:
        """Tell the answers, by length, as long as this line's search asks for one that is there."""
        line = self.line
        while not self.done and self.line == line and self.alpha in answers:
            self.tell(*answers[self.alpha])

    def tell(self, f: float, g: np.ndarray) -> None:
        if self.g is None:
            self.f, self.g = f, g
            self.history.append(f)
            return self._begin()
        slope = g @ self.direction
        if f > self.f + ARMIJO * self.alpha * self.slope:
            step = SHRINK if self.iteration else FIRST_SHRINK
        elif slope < WOLFE * self.slope:
            step = GROW
        elif slope > -WOLFE * self.slope:
            step = SHRINK if self.iteration else FIRST_SHRINK
        else:
            return self._accept(f, g)
        self.alpha *= step
        self.trials += 1
        if self.trials >= MOST_TRIALS:  # once from the plain gradient, then give up
            if self.failed or not self.pairs:
                return self._end()
            self.failed, self.pairs = True, []
            self._begin()

    def _accept(self, f: float, g: np.ndarray) -> None:
        x = self.trial()
        self.pairs = [*self.pairs, (x - self.x, g - self.g)][-MEMORY:]
        self.x, self.f, self.g = x, f, g
        self.iteration += 1
        self.history.append(f)
        if self.iteration in self.keep:
            self.kept[self.iteration] = x.copy()
        recent = self.history[-20:]
        if (self.iteration >= self.max_iter or abs(f - max(recent)) <= self.tol * abs(self.history[0])
                or np.linalg.norm(g) <= max(self.tol * abs(f), 1e-8)):
            return self._end()
        self._begin()

    def _begin(self) -> None:
        self.line += 1
        down = -self._preconditioned(self.g)
        self.direction = np.where(down * self.g < 0, down, 0.0)
        self.slope = self.direction @ self.g
        if not self.slope < 0:
            return self._end()
        self.orthant = np.where(self.x != 0, np.sign(self.x), -np.sign(self.g))
        # Spark's search judges its first length by the value at 0, so that it always shrinks that one
        self.alpha = SHRINK if self.iteration else FIRST_SHRINK * 0.5 / np.linalg.norm(self.g)
        self.trials = 1

    def _preconditioned(self, g: np.ndarray) -> np.ndarray:
        q, parts = g.copy(), []
        for s, y in reversed(self.pairs):
            a = (s @ q) / (s @ y)
            parts.append(a)
            q -= a * y
        if self.pairs:
            s, y = self.pairs[-1]
            q *= (s @ y) / (y @ y)
        for (s, y), a in zip(self.pairs, reversed(parts)):
            q += s * (a - (y @ q) / (s @ y))
        return q if np.all(np.isfinite(q)) else g

    def _end(self) -> None:
        self.done = True
        for k in self.keep:
            self.kept.setdefault(k, self.x.copy())


def feature_scales(rows: DataFrame, width: int, folds: list[int | None]) -> tuple[dict, dict, dict]:
    """By fold left out: 1 / standard deviation of each feature (0 for constants), mean / standard deviation, and
    the weight of the rows."""
    values = sorted(f for f in folds if f is not None)
    places = np.array([*values, 1 << 40])

    def add(batch: pa.RecordBatch, sums: np.ndarray) -> None:
        for _, w, fold, used, dense in _unpacked(batch):
            place = np.searchsorted(places, fold)
            place = np.where(places[place] == fold, place, len(values))
            for k in np.unique(place):
                mine = place == k
                sums[k, used] += w[mine] @ dense[mine]
                sums[k, width + used] += w[mine] @ dense[mine] ** 2
                sums[k, -2:] += w[mine].sum(), (w[mine] ** 2).sum()

    sums = totals(packed(rows), len(values) + 1, 2 * width + 2, add)
    scales, centres, weights = {}, {}, {}
    for fold in folds:
        t = sums.sum(0) - (0 if fold is None else sums[values.index(fold)])
        total = t[-2]
        spread = (t[width:2 * width] - t[:width] ** 2 / total) / (total - t[-1] / total)
        flat = spread <= 1e-12 * np.maximum(t[width:2 * width] / total, 1e-300)  # rounding of a constant
        scales[fold] = np.where(flat, 0.0, 1 / np.sqrt(np.where(flat, 1.0, spread)))
        centres[fold] = t[:width] / total * scales[fold]
        weights[fold] = total
    return scales, centres, weights


def hinge(rows: DataFrame, problems: list[Problem], coef: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted hinge loss and its gradient (intercept last) of each problem, in one pass.  ``coef`` has a
    row a problem, intercept last."""
    width = coef.shape[1] - 1
    cls = np.array([p.cls for p in problems])
    out = np.array([-1 if p.fold is None else p.fold for p in problems])
    whole = np.array([p.fold is None for p in problems])

    def add(batch: pa.RecordBatch, sums: np.ndarray) -> None:
        for label, weight, fold, used, dense in _unpacked(batch):
            sign = np.where(label[:, None] == cls, 1.0, -1.0)
            share = weight[:, None] * (whole | (fold[:, None] != out))
            short = 1 - sign * (dense @ coef[:, used].T + coef[:, -1])
            share *= short > 0
            sums[:, 0] += np.einsum("ij,ij->j", share, short)
            pull = -sign * share
            sums[:, 1 + used] += pull.T @ dense
            sums[:, -1] += pull.sum(0)

    sums = totals(packed(rows), len(problems), width + 2, add)
    return sums[:, 0], sums[:, 1:]


def fit_svms(rows: DataFrame, problems: list[Problem], width: int, max_iter: int = 10, keep: tuple[int, ...] = (),
             tol: float = 1e-6) -> dict[Problem, Search]:
    """Fit all ``problems`` on cached ``packed`` (or ``linear_rows``, slower); ``kept[i]`` of a result has the coefficients after ``i``
    iterations (or at the end, if that came first) for the features as they are, intercept last."""
    keep = tuple(sorted({*keep, max_iter}))
    scales, centres, weights = feature_scales(rows, width, list(dict.fromkeys(p.fold for p in problems)))
    searches = {p: Search(np.zeros(width + 1), max_iter, tol, keep) for p in problems}

    def plain(x: np.ndarray, fold: int | None) -> np.ndarray:
        """Coefficients for the features as they are."""
        return np.append(x[:-1] * scales[fold], x[-1] - x[:-1] @ centres[fold])

    while live := [p for p in problems if not searches[p].done]:
        asked = _asked(searches, live, int(ROOM * len(problems)))
        at = [searches[p].trial(alpha) for p, alpha in asked]
        loss, grad = hinge(rows, [p for p, _ in asked], np.stack([plain(x, p.fold) for x, (p, _) in zip(at, asked)]))
        answers: dict[Problem, dict] = {p: {} for p in live}
        for k, (p, alpha) in enumerate(asked):
            flat = np.append(at[k][:-1], 0.0)
            slope = np.append(grad[k, :-1] * scales[p.fold] - grad[k, -1] * centres[p.fold], grad[k, -1])
            answers[p][alpha] = (loss[k] / weights[p.fold] + p.reg / 2 * (flat @ flat), slope / weights[p.fold] + p.reg * flat)
        for p in live:
            searches[p].tell_all(answers[p])
    for p, search in searches.items():
        search.kept = {k: plain(x, p.fold) for k, x in search.kept.items()}
    return searches


def _asked(searches: dict[Problem, Search], live: list[Problem], columns: int) -> list[tuple[Problem, float]]:
    """(problem, step length) of a pass: what each search asks for, and as far as there are ``columns``, what those that are
    behind may ask for next.  A search that needs several lengths of one line gets them in one pass over the rows."""
    asked = [(p, searches[p].alpha) for p in live]
    ahead = [(searches[p].iteration + LATE * k, n, k, p) for n, p in enumerate(live) for k in range(len(searches[p].ahead()))]
    for _, _, k, p in sorted(ahead, key=lambda x: x[:3])[:max(columns - len(asked), 0)]:
        asked.append((p, searches[p].ahead()[k]))
    return asked


def predict_linear(df: DataFrame, coef: np.ndarray, features_col: str, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``prediction``, the class (row of ``coef``, intercept last) with the highest score."""
    held = df.select(*keep)
    schema = StructType(held.schema.fields).add("prediction", "double")
    names = schema.names

    def run(batches):
        for batch in batches:
            found = np.zeros(batch.num_rows)
            for start, stop, used, dense in blocks(batch):
                found[start:stop] = np.argmax(dense @ coef[:, used].T + coef[:, -1], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(found)], names)

    return df.select(*sparse_parts(features_col), *keep).mapInArrow(run, schema)


def fold_confusion(rows: DataFrame, models: list[dict[int, np.ndarray]], n_classes: int) -> DataFrame:
    """(setting, fold, label, prediction, n): each row scored by the models that left its fold out;
    ``models[setting][fold]`` has a row a class."""
    def run(batches):
        cells: dict[tuple, int] = {}
        for batch in batches:
            for label, _, fold, used, dense in _unpacked(batch):
                for f in np.unique(fold):
                    mine = fold == f
                    for setting, by_fold in enumerate(models):
                        coef = by_fold[int(f)]
                        found = np.argmax(dense[mine] @ coef[:, used].T + coef[:, -1], axis=1)
                        pairs, n = np.unique(np.stack([label[mine], found]), axis=1, return_counts=True)
                        for (actual, guess), count in zip(pairs.T, n):
                            key = (setting, int(f), int(actual), int(guess))
                            cells[key] = cells.get(key, 0) + int(count)
        if cells:
            columns = list(zip(*cells))
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in columns), pa.array(cells.values(), pa.int64())],
                                             ["setting", "fold", "label", "prediction", "n"])

    return packed(rows).mapInArrow(run, "setting int, fold int, label int, prediction int, n long").groupBy(
        "setting", "fold", "label", "prediction").agg(F.sum("n").alias("n"))

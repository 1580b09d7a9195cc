"""Removal of word sequences that repeat across documents, by prefix-partitioned suffix subtrees.

A suffix starts at every word of a document.  Two suffixes that share their first ``WINDOW`` (50) words meet
in a node of the corpus's suffix tree at depth 50 or more; the leaves below such a node are the places of a
repeat.  The tree is never built whole: suffixes are partitioned by a prefix, each partition holds a subtree
that fits into memory, and subtrees are cut at depth 50, since what lies deeper follows from the
neighbouring suffixes.

Prefixes have variable length.  A suffix's prefix ends with the ``GRAM``-word sequence of least hash among
its first 50 words, so it has 10 to 50 words; equal windows have equal prefixes, and neighbouring suffixes
mostly end theirs at the same place, which is why a partition is named by that sequence.  Where so many
documents share a sequence that the partition is too large, the prefix is taken to depth 50 (the suffix's
fingerprint decides on one of several parts).  Prefixes that occur in one document only are dropped before
any suffix is moved.  A partition keeps, sorted, the fingerprints of its suffixes at depth 50 with the
least and the largest document below; nodes with two documents at least are repeats.

Each task merges its own leaves of a partition before the shuffle, so a passage that fills a third of
all documents arrives as one entry a task, not one a document.  Documents that are copies of one another
as a whole are decided by their digests and take no part in the trees.

A word is removed if it is covered by a 50-word window that also starts in a document with a smaller id.

Defined results: null and empty texts have no words; texts of under 50 words lose nothing; a null id is
larger than all others; windows that repeat only inside one document, or in documents of the same id,
stay; repeated rows get equal results; an empty table gives an empty table; texts enter whole.
Words are compared by 64-bit hashes, windows inside a partition by 64-bit fingerprints.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Bitmap, WordHashes, clean_text, map_texts, materialise, mix

WINDOW, GRAM = 50, 10
#: A partition is divided if more documents share its prefix than this or 1/65536 of all prefixes' documents;
#: so at most 65536 prefixes are, which bounds the table of parts.
LARGE, MOST_LARGE = 1_000, 65_536
LAST_ID = (1 << 63) - 1
SPANS = "array<struct<start:bigint,end:bigint>>"
BASE = 0x9E3779B97F4A7C15


class Windows:
    """Prefix hashes and fingerprints of the windows of word hash arrays."""

    def __init__(self):
        self.powers = self.inverse = np.zeros(0, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            steps = np.full(max(n, 2 * len(self.powers)), BASE, np.uint64)
            back = np.full(len(steps), pow(BASE, -1, 1 << 64), np.uint64)
            steps[0] = back[0] = 1
            with np.errstate(over="ignore"):
                self.powers, self.inverse = np.cumprod(steps), np.cumprod(back)

    def of(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(prefix, fingerprint) of each window, as signed integers; empty for fewer than WINDOW words."""
        n = len(h) - WINDOW + 1
        if n < 1:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._grow(len(h))
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * self.powers[:len(h)])])
            gram = mix((sums[GRAM:] - sums[:-GRAM]) * self.inverse[:len(h) - GRAM + 1], 31)
            mark = mix((sums[WINDOW:] - sums[:-WINDOW]) * self.inverse[:n], 32)
        span = WINDOW - GRAM + 1
        least = np.empty(n, np.uint64)
        for at in range(0, n, 4096):
            end = min(n, at + 4096)
            least[at:end] = np.lib.stride_tricks.sliding_window_view(gram[at:end + span - 1], span).min(1)
        return least.view(np.int64), mark.view(np.int64)


def split_words(text: str) -> list[bytes]:
    return text.encode("utf-8").split()


def identity(joined: bytes) -> tuple[int, int]:
    """Two signed 64-bit numbers that identify a word sequence."""
    raw = xxhash.xxh3_128_digest(joined)
    return int.from_bytes(raw[:8], "big", signed=True), int.from_bytes(raw[8:], "big", signed=True)


def _id(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(_id(id_col).alias("id"), clean_text(text_col).alias("t"))


def _survey(texts: DataFrame) -> DataFrame:
    """id, d1, d2, n_words, sha, prefixes (distinct) of every row."""
    def make():
        hashes, windows = WordHashes(), Windows()

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            names, n, sha, prefixes = [], [], [], []
            for text in part.column(1).to_pylist():
                words = split_words(text)
                joined = b" ".join(words)
                names.append(identity(joined))
                n.append(len(words))
                sha.append(hashlib.sha256(joined).hexdigest())
                prefixes.append(np.unique(windows.of(hashes.of(words))[0]))
            ends = np.cumsum([0, *map(len, prefixes)])
            flat = np.concatenate([np.zeros(0, np.int64), *prefixes])
            return pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([a for a, _ in names], pa.int64()), pa.array([b for _, b in names], pa.int64()),
                 pa.array(n, pa.int64()), pa.array(sha, pa.string()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                ["id", "d1", "d2", "n_words", "sha", "prefixes"])
        return work

    return map_texts(texts, ["id"], "t", "id long, d1 long, d2 long, n_words long, sha string, prefixes array<long>",
                     make)


def _suffixes(texts: DataFrame, first: Bitmap, shared: Bitmap, parts: dict[int, int]) -> DataFrame:
    """id, d1, d2, prefix, part, marks: the distinct fingerprints of a first document's suffixes, by prefix."""
    spark = texts.sparkSession
    prefixes, sizes = (np.array(x, np.int64) for x in (sorted(parts), [parts[k] for k in sorted(parts)]))
    sent = spark.sparkContext.broadcast((first, shared, prefixes, sizes))

    def make():
        hashes, windows = WordHashes(), Windows()
        first_, shared_, large, count = sent.value

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            ids, d1, d2, keys, pieces, marks = [], [], [], [], [], []
            for id_, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                words = split_words(text)
                if len(words) < WINDOW:
                    continue
                name = identity(b" ".join(words))
                if not first_.has(np.array([name[0]]), np.array([id_]))[0]:
                    continue
                prefix, mark = windows.of(hashes.of(words))
                kept = shared_.has(prefix)
                prefix, mark = prefix[kept], mark[kept]
                piece = np.zeros(len(prefix), np.int64)
                if len(large) and len(prefix):
                    at = np.minimum(np.searchsorted(large, prefix), len(large) - 1)
                    piece = np.where(large[at] == prefix, (mark >> 20) % count[at], 0)
                if not len(prefix):
                    continue
                order = np.lexsort((mark, piece, prefix))
                rows = np.column_stack([prefix, piece, mark])[order]
                rows = rows[np.append(True, (rows[1:] != rows[:-1]).any(1))]
                starts = np.flatnonzero(np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(1)))
                ids += [id_] * len(starts)
                d1 += [name[0]] * len(starts)
                d2 += [name[1]] * len(starts)
                keys.append(rows[starts, 0])
                pieces.append(rows[starts, 1])
                marks += np.split(rows[:, 2], starts[1:])
            none = np.zeros(0, np.int64)
            return pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.int64()) for x in (ids, d1, d2)), pa.array(np.concatenate([none, *keys])),
                 pa.array(np.concatenate([none, *pieces])), pa.ListArray.from_arrays(
                     pa.array(np.cumsum([0, *map(len, marks)]), pa.int32()), pa.array(np.concatenate([none, *marks])))],
                ["id", "d1", "d2", "prefix", "part", "marks"])
        return work

    return map_texts(texts, ["id"], "t", "id long, d1 long, d2 long, prefix long, part long, marks array<long>", make)


def _subtrees(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Leaves (prefix, part, mark, least, most) merged: one entry a node at depth 50, in tree order."""
    prefix, part, mark, least, most = columns
    if not len(prefix):
        return columns
    order = np.lexsort((mark, part, prefix))
    prefix, part, mark, least, most = (x[order] for x in columns)
    starts = np.flatnonzero(np.append(True, (prefix[1:] != prefix[:-1]) | (part[1:] != part[:-1])
                                      | (mark[1:] != mark[:-1])))
    return [prefix[starts], part[starts], mark[starts], np.minimum.reduceat(least, starts),
            np.maximum.reduceat(most, starts)]


def _packed(columns: list[np.ndarray]) -> pa.RecordBatch:
    """One row a (prefix, part), its nodes as lists."""
    prefix, part, mark, least, most = columns
    starts = np.flatnonzero(np.append(True, (prefix[1:] != prefix[:-1]) | (part[1:] != part[:-1]))) \
        if len(prefix) else np.zeros(0, np.int64)
    ends = pa.array(np.append(starts, len(prefix)), pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(prefix[starts]), pa.array(part[starts]),
         *(pa.ListArray.from_arrays(ends, pa.array(x)) for x in (mark, least, most))],
        ["prefix", "part", "marks", "least", "most"])


TREES = "prefix long, part long, marks array<long>, least array<long>, most array<long>"


def _leaves(batches):
    """Merge each task's own leaves."""
    for batch in batches:
        lengths = np.diff(batch.column(3).offsets.to_numpy())
        prefix, part, ids = (np.repeat(batch.column(i).to_numpy(), lengths) for i in range(3))
        yield _packed(_subtrees([prefix, part, batch.column(3).flatten().to_numpy(), ids, ids]))


def _repeats(batches):
    """Subtrees from sorted (prefix, part) rows; only nodes with two documents are kept.  The last subtree of
    a batch waits for the next batch, which may hold more of it."""
    held = [np.zeros(0, np.int64)] * 5

    def repeated(columns):
        several = columns[3] < columns[4]
        return _packed([x[several] for x in columns])

    for batch in batches:
        lengths = np.diff(batch.column(2).offsets.to_numpy())
        columns = [np.repeat(batch.column(i).to_numpy(), lengths) for i in range(2)]
        columns += [batch.column(i).flatten().to_numpy() for i in range(2, 5)]
        nodes = _subtrees([np.concatenate(x) for x in zip(held, columns)])
        if not len(nodes[0]):
            continue
        open_ = (nodes[0] == nodes[0][-1]) & (nodes[1] == nodes[1][-1])
        held = [x[open_] for x in nodes]
        yield repeated([x[~open_] for x in nodes])
    yield repeated(held)


def _removable(batches):
    """(id, d1, d2, marks): the windows of a document that start in one with a smaller id."""
    for batch in batches:
        out = []
        for id_, own, nodes, least in zip(*(batch.column(i) for i in (0, 3, 4, 5))):
            own, nodes, least = (x.values.to_numpy() for x in (own, nodes, least))
            at = np.minimum(np.searchsorted(nodes, own), len(nodes) - 1)
            out.append(own[(nodes[at] == own) & (least[at] < id_.as_py())])
        ends = pa.array(np.cumsum([0, *map(len, out)]), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int64), *out])))],
            ["id", "d1", "d2", "marks"])


def covered(words: list[bytes], marks: np.ndarray, hashes: WordHashes, windows: Windows) -> np.ndarray:
    """Which words lie in a window whose fingerprint is in the sorted ``marks``."""
    mark = windows.of(hashes.of(words))[1]
    out = np.zeros(len(words) + 1, np.int64)
    if len(marks) and len(mark):
        at = np.minimum(np.searchsorted(marks, mark), len(marks) - 1)
        hit = np.flatnonzero(marks[at] == mark)
        np.add.at(out, hit, 1)
        np.add.at(out, hit + WINDOW, -1)
    return np.cumsum(out)[:-1] > 0


class Repeats:
    """The repeats of a corpus: ``rows`` (id, d1, d2, n_words, sha, first: least id of the same words) and
    ``marks`` (id, d1, d2, marks: sorted fingerprints of a first document's removable windows)."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
        self.texts = _texts(docs, id_col, text_col)
        survey = materialise(_survey(self.texts), "survey")
        firsts = materialise(survey.groupBy("d1", "d2").agg(
            F.min("id").alias("first"), F.any_value("prefixes").alias("prefixes")), "survey-firsts")
        self.rows = survey.drop("prefixes").join(firsts.drop("prefixes"), ["d1", "d2"])
        shared = materialise(
            firsts.select(F.col("first").alias("id"), F.explode("prefixes").alias("prefix")).groupBy("prefix").agg(
                F.min("id").alias("least"), F.max("id").alias("most"), F.count(F.lit(1)).alias("n"))
            .filter("least < most").select("prefix", "n"), "shared-prefixes")
        total = shared.agg(F.sum("n")).first()[0] or 0
        limit = max(LARGE, total // MOST_LARGE)
        parts = {r["prefix"]: -(-r["n"] // limit) * 2 for r in shared.filter(F.col("n") > limit).toLocalIterator()}
        suffixes = materialise(_suffixes(self.texts, Bitmap.of(firsts, "d1", "first"), Bitmap.of(shared, "prefix"),
                                         parts), "suffixes")
        leaves = suffixes.select("prefix", "part", "id", "marks").mapInArrow(_leaves, TREES)
        nodes = leaves.repartition("prefix", "part").sortWithinPartitions("prefix", "part").mapInArrow(
            _repeats, TREES).select("prefix", "part", F.col("marks").alias("nodes"), "least")
        found = suffixes.join(nodes, ["prefix", "part"]).select("id", "d1", "d2", "marks", "nodes", "least").mapInArrow(
            _removable, "id long, d1 long, d2 long, marks array<long>").filter(F.size("marks") > 0)
        self.marks = materialise(found.groupBy("id", "d1", "d2").agg(
            F.array_sort(F.flatten(F.collect_list("marks"))).alias("marks")), "removable")

    def stripped(self) -> DataFrame:
        """id, d1, d2, n_removed, spans, text of the documents with removable windows, one row each: the
        maximal repeats that go (start, end in words) and the kept words."""
        wanted = self.texts.sparkSession.sparkContext.broadcast(Bitmap.of(self.marks, "d1", "id"))

        def pick():
            def work(part: pa.RecordBatch) -> pa.RecordBatch:
                joined = [b" ".join(split_words(t)) for t in part.column(1).to_pylist()]
                names = np.array([identity(j) for j in joined], np.int64).reshape(-1, 2)
                here = wanted.value.has(names[:, 0], part.column(0).to_numpy()).nonzero()[0]
                return pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(here)), pa.array(names[here, 0]), pa.array(names[here, 1]),
                     pa.array([joined[i].decode("utf-8") for i in here], pa.string())], ["id", "d1", "d2", "t"])
            return work

        picked = map_texts(self.texts, ["id"], "t", "id long, d1 long, d2 long, t string", pick)
        picked = picked.join(self.marks, ["id", "d1", "d2"]).dropDuplicates(["id", "d1", "d2"])

        def strip():
            hashes, windows = WordHashes(), Windows()

            def work(part: pa.RecordBatch) -> pa.RecordBatch:
                removed, spans, kept = [], [], []
                for text, marks in zip(part.column(4).to_pylist(), part.column(3)):
                    words = split_words(text)
                    gone = covered(words, marks.values.to_numpy(), hashes, windows)
                    removed.append(int(gone.sum()))
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]]))).tolist()
                    spans.append([{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2])])
                    kept.append(b" ".join(w for w, g in zip(words, gone) if not g).decode("utf-8"))
                return pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(removed, pa.int64()), pa.array(spans, pa.list_(pa.struct(
                        [("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.string())],
                    ["id", "d1", "d2", "n_removed", "spans", "text"])
            return work

        return map_texts(picked, ["id", "d1", "d2", "marks"], "t",
                         f"id long, d1 long, d2 long, n_removed long, spans {SPANS}, text string", strip)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_words, n_removed, spans (start, end of the removed runs, in words) and text_col (kept words
    joined by one space) of every row."""
    found = Repeats(docs, id_col, text_col)

    def name():
        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            joined = [b" ".join(split_words(t)) for t in part.column(1).to_pylist()]
            names = np.array([identity(j) for j in joined], np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(names[:, 0]), pa.array(names[:, 1]),
                 pa.array([j.decode("utf-8") for j in joined], pa.string()),
                 pa.array([len(split_words(t)) for t in part.column(1).to_pylist()], pa.int64())],
                ["id", "d1", "d2", "t", "n_words"])
        return work

    rows = map_texts(found.texts, ["id"], "t", "id long, d1 long, d2 long, t string, n_words long", name)
    firsts = found.rows.groupBy("d1", "d2").agg(F.min("first").alias("first"))
    rows = rows.join(firsts, ["d1", "d2"]).join(found.stripped().withColumnRenamed("text", "kept"),
                                                ["id", "d1", "d2"], "left")
    copy = (F.col("first") < F.col("id")) & (F.col("n_words") >= WINDOW)
    return rows.select(
        F.when(F.col("id") != LAST_ID, F.col("id")).alias(id_col), "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")))).otherwise(
            F.coalesce("spans", F.array().cast(SPANS))).alias("spans"),
        F.when(copy, F.lit("")).otherwise(F.coalesce("kept", "t")).alias(text_col))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document; only texts that lose words are read again."""
    found = Repeats(docs)
    stripped = found.stripped().select("id", "d1", "d2", "n_removed", F.sha2("text", 256).alias("kept"))
    rows = found.rows.join(stripped, ["id", "d1", "d2"], "left")
    copy = (F.col("first") < F.col("id")) & (F.col("n_words") >= WINDOW)
    return rows.select(
        F.when(F.col("id") != LAST_ID, F.col("id")).alias("doc_id"), "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"))


REPORT_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM d)),
firsts AS (SELECT h, min(doc_id) AS m FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS pos
  FROM windows JOIN firsts USING (h) WHERE m < doc_id),
words AS (SELECT doc_id, unnest(generate_series(1, len(w))) AS pos, unnest(w) AS word FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS t, count(*) AS k
  FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(k, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

r"""Divergence between the sources of a language, priced by sparse merges.

Terms are runs of letters A-Z and of characters outside ASCII, with only A-Z lower-cased.  A language keeps
the V terms in at least ``least_docs`` of its documents.  A group (a language's source) and the language itself
price a kept term with count c at p = 1 + floor(10^9 (c + 5) / (N + 5 V)); two sources differ by the sum
of |p - q| over all kept terms.

1. ``term_counts``: one scan; tasks add up terms before anything is shuffled, so that a term that fills a
   third of the corpus costs one row a task and group.
2. ``vocabulary``: kept terms get ids 0, 1, ... in blocks of about 50,000, by the term's hash, so that no task numbers a
   whole language.
3. ``sparse_arrays``: per group and block, the ids it has and their counts, sorted by id.
4. ``pair_values``: pair tasks.  The blocks of two groups meet in one task by a co-grouped map; the shorter
   array gallops through the longer one.  Ids in both are priced by both counts; ids on one side by the
   other's floor price (that of count 0), in both directions; all others in the block by both floors.  Tasks
   take small tiles of sources against tiles, so that an array is copied once a tile rather than once a
   pair.  Values of blocks are added up by pair.

What a task holds is two tiles of one block.  The result has a row for each ordered pair of a language's
sources, as its contract demands.

Arithmetic is exact: in numpy, 10^9 (c + 5) is divided in three steps of 1000, whose remainders stay below
2^63 for all N + 5 V < 9 * 10^15; in SQL, as decimals.

Defined results: null texts, languages and sources are empty texts; rows count one document each, also with
null or repeated ids; a group without terms has N = 0; a language without kept terms has V = 0 and value 0
for each pair; a source alone in its language has no pairs; ties rank by item in UTF-8 order; long
texts are read in pieces; further columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import clean_text, materialise, slices, workers_import

#: Every byte that is no part of a term becomes a space, capitals become small letters.
TO_TERMS = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
SCALE, SMOOTHING = 1_000_000_000, 5
#: Most (group, term) sums a task holds before it hands them on.
HELD = 300_000
PIECE = 1 << 20


def _pieces(text: bytes):
    """Terms of ``text``, a list for each piece of about 1 MB; no term is cut."""
    start = 0
    while start < len(text):
        end = text.find(b" ", start + PIECE)
        end = len(text) if end < 0 else end
        yield text[start:end].split()
        start = end


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that have the term."""
    def rows(held: dict[tuple, tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, seen) in held.items():
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(lang, len(n)), pa.repeat(source, len(n)), pa.array(list(n), pa.binary()).cast(pa.string()),
                     pa.array(list(n.values()), pa.int64()), pa.array([seen[t] for t in n], pa.int64())],
                    ["lang", "source", "term", "n", "docs"])
        held.clear()

    def run(batches):
        held: dict[tuple, tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for part in slices(batch, 2):
                for lang, source, text in zip(*(c.to_pylist() for c in part.columns)):
                    n, seen = held.setdefault((lang, source), (Counter(), Counter()))
                    size -= len(n)
                    here: set[bytes] = set()
                    for terms in _pieces(text.encode().translate(TO_TERMS)):
                        n.update(terms)
                        here.update(terms)
                    seen.update(here)
                    size += len(n)
                    if size > HELD:
                        yield from rows(held)
                        size = 0
        yield from rows(held)

    workers_import(docs.sparkSession)
    named = docs.select(*[clean_text(c).alias(c) for c in ("lang", "source", "text")])
    found = named.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def vocabulary(counts: DataFrame, least_docs: int = 30, block_terms: int = 50_000) -> DataFrame:
    """(lang, term, lang_n, block, id): the kept terms of each language with ids within their blocks.  All
    languages have as many blocks as the whole vocabulary needs, so no block is larger than ``block_terms``
    but by the chance of the hash."""
    kept = materialise(counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
                       .filter(F.col("docs") >= least_docs).select("lang", "term", "lang_n"), "kept-terms")
    blocks = max(1, -(-kept.count() // block_terms))
    return kept.withColumn("block", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int")).withColumn(
        "id", F.row_number().over(Window.partitionBy("lang", "block").orderBy("term")) - 1)


def group_blocks(docs: DataFrame, terms: DataFrame, joined: DataFrame, tile_sources: int = 8) -> DataFrame:
    """A row for every group of ``docs`` and every block of its language (block 0 of none), also where the group
    has no term: (lang, source, total, lang_total, tile, tiles, block, size).

    Totals are N + 5 V of the group and of its language; ``tile`` deals the ``tiles`` of a language's sources;
    ``size`` is the block's number of terms.
    """
    groups = docs.select(*[clean_text(c).alias(c) for c in ("lang", "source")]).distinct()
    blocks = terms.groupBy("lang", "block").agg(F.count(F.lit(1)).alias("size"), F.sum("lang_n").alias("n"))
    langs = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")).join(
        blocks.groupBy("lang").agg(F.sum("size").alias("v"), F.sum("n").alias("lang_n")), "lang", "left").select(
        "lang", F.ceil(F.col("sources") / tile_sources).cast("int").alias("tiles"),
        F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("lang_n", F.lit(0)).alias("lang_n"))
    sums = joined.groupBy("lang", "source").agg(F.sum("n").alias("kept_n"))
    totals = groups.join(langs, "lang").join(sums, ["lang", "source"], "left").select(
        "lang", "source", (F.coalesce("kept_n", F.lit(0)) + SMOOTHING * F.col("v")).alias("total"),
        (F.col("lang_n") + SMOOTHING * F.col("v")).alias("lang_total"),
        F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int").alias("tile"), "tiles")
    return totals.join(blocks.select("lang", "block", "size"), "lang", "left").withColumns(
        {c: F.coalesce(c, F.lit(0)) for c in ("block", "size")})


def sparse_arrays(joined: DataFrame, groups: DataFrame) -> DataFrame:
    """``groups`` with the sorted ``ids`` of the group's terms in the block and their ``counts``."""
    found = joined.groupBy("lang", "source", "block").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("e"))
    empty = F.array().cast("array<struct<id:int,n:bigint>>")
    return groups.join(found, ["lang", "source", "block"], "left").withColumn("e", F.coalesce("e", empty)).select(
        *groups.columns, F.col("e.id").alias("ids"), F.col("e.n").alias("counts"))


def prices(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(10^9 (c + 5) / total), exactly."""
    whole, rest = np.divmod(np.asarray(counts, np.int64) + SMOOTHING, total)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + more
    return whole + 1


def gallop(short: np.ndarray, long: np.ndarray, run: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``short`` and ``long``, both sorted without repeats, of the values they share.

    For each run of keys, steps that double find how far the run reaches in ``long``; a binary search inside
    places its keys.
    """
    at_short, at_long, low = [], [], 0
    for start in range(0, len(short), run):
        keys = short[start:start + run]
        step = len(keys)
        while low + step < len(long) and long[low + step] < keys[-1]:
            step *= 2
        window = long[low:low + step + 1]
        if not len(window):
            break
        spots = np.searchsorted(window, keys)
        hit = window[np.minimum(spots, len(window) - 1)] == keys
        at_short.append(start + np.flatnonzero(hit))
        at_long.append(low + spots[hit])
        low += int(spots[-1])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *at_short]), np.concatenate([none, *at_long])


def merged(a: tuple, b: tuple, size: int) -> int:
    """Sum of |p - q| over a block's ``size`` terms; ``a`` and ``b`` are (ids, counts, total)."""
    if size == 0:
        return 0
    if len(a[0]) > len(b[0]):
        a, b = b, a
    p, q = prices(a[1], a[2]), prices(b[1], b[2])
    floor_p, floor_q = (int(prices(np.zeros(1, np.int64), x[2])[0]) for x in (a, b))
    in_a, in_b = gallop(a[0], b[0])
    both = np.abs(p[in_a] - q[in_b]).sum()
    only_a = np.abs(p - floor_q).sum() - np.abs(p[in_a] - floor_q).sum()
    only_b = np.abs(q - floor_p).sum() - np.abs(q[in_b] - floor_p).sum()
    absent = size - len(p) - len(q) + len(in_a)
    return int(both + only_a + only_b) + absent * abs(floor_p - floor_q)


def pair_values(arrays: DataFrame) -> DataFrame:
    """(lang, a, b, value) for each unordered pair a < b of a language's sources."""
    keys = ["lang", "block", "x", "y"]
    held = ["size", "source", "total", "ids", "counts"]
    left = arrays.select("lang", "block", F.col("tile").alias("x"), F.explode(
        F.sequence("tile", F.col("tiles") - 1)).alias("y"), *held)
    right = arrays.select(F.col("lang").alias("r_lang"), F.col("block").alias("r_block"),
                         F.explode(F.sequence(F.lit(0), "tile")).alias("r_x"), F.col("tile").alias("r_y"),
                         *[F.col(c).alias(f"r_{c}") for c in held])

    def groups(table: pa.Table) -> list[tuple]:
        """(source, ids, counts, total) of each row; columns as in ``keys`` and ``held``."""
        columns = [table.column(k).to_pylist() for k in (5, 6)]
        lists = [[x.values.to_numpy(zero_copy_only=False) for x in table.column(k)] for k in (7, 8)]
        return list(zip(columns[0], lists[0], lists[1], columns[1]))

    def merge(key, left_rows: pa.Table, right_rows: pa.Table) -> pa.Table:
        lang, _, x, y = (k.as_py() for k in key)
        size = left_rows.column("size")[0].as_py() if len(left_rows) else 0
        found = []
        others = groups(right_rows)
        for one in groups(left_rows):
            for other in others:
                if x != y or one[0].encode() < other[0].encode():
                    low, high = sorted((one[0], other[0]), key=str.encode)
                    found.append((low, high, merged(one[1:], other[1:], size)))
        names, seconds, values = zip(*found) if found else ((), (), ())
        return pa.table({"lang": pa.array([lang] * len(found), pa.string()), "a": pa.array(names, pa.string()),
                         "b": pa.array(seconds, pa.string()), "value": pa.array(values, pa.int64())})

    workers_import(arrays.sparkSession)
    found = left.groupBy(*keys).cogroup(right.groupBy(*[f"r_{k}" for k in keys])).applyInArrow(
        merge, "lang string, a string, b string, value long")
    return found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def price(n: Column, total: Column) -> Column:
    """``prices`` as a column."""
    big = (n + SMOOTHING).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", big, total.cast("decimal(19,0)")) + 1


def term_values(joined: DataFrame, groups: DataFrame, top: int = 50) -> DataFrame:
    """(lang, source, item, value, rank): the terms a group has above its language's price, ``top`` a group."""
    priced = joined.join(groups.select("lang", "source", "block", "total", "lang_total"), ["lang", "source", "block"])
    gap = price(F.col("n"), F.col("total")) - price(F.col("lang_n"), F.col("lang_total"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return priced.select("lang", "source", F.col("term").alias("item"), gap.alias("value")).filter(
        "value > 0").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)


def divergence(docs: DataFrame, least_docs: int = 30, top: int = 50, block_terms: int = 50_000,
               tile_sources: int = 8) -> DataFrame:
    """(lang, source, part, item, value, rank); see the module's text."""
    counts = materialise(term_counts(docs), "term-counts")
    terms = materialise(vocabulary(counts, least_docs, block_terms), "vocabulary")
    joined = materialise(counts.select("lang", "source", "term", "n").join(terms, ["lang", "term"]), "group-terms")
    groups = materialise(group_blocks(docs, terms, joined, tile_sources), "group-blocks")
    pairs = materialise(pair_values(materialise(sparse_arrays(joined, groups), "arrays")), "pairs")
    both = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        pairs.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    far = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = both.withColumn("rank", F.row_number().over(far))
    order = ["lang", "source", "part", "item", "value", "rank"]
    return ranked.withColumn("part", F.lit("pair")).select(order).unionByName(
        term_values(joined, groups, top).withColumn("part", F.lit("term")).select(order))


def report(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value, rank."""
    return divergence(docs)


REPORT_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  coalesce(text, '') AS text FROM documents),
words AS (
  SELECT row, lang, source, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM t),
k AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT row) >= 30),
c AS MATERIALIZED (SELECT w.lang, w.source, w.term, count(*) AS n
                   FROM words w JOIN k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM t),
totals AS MATERIALIZED (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0) + 5 * coalesce(any_value(v.v), 0) AS total
  FROM g LEFT JOIN v ON g.lang = v.lang LEFT JOIN c ON g.lang = c.lang AND g.source = c.source GROUP BY ALL),
p AS MATERIALIZED (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // s.total::HUGEINT AS p
  FROM totals s JOIN k ON s.lang = k.lang
  LEFT JOIN c ON s.lang = c.lang AND s.source = c.source AND k.term = c.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT p.lang, p.source, 'term' AS part, p.term AS item, CAST(
           p.p - (1 + (1000000000::HUGEINT * (k.n + 5)) // (v.total + 5 * v.v)::HUGEINT) AS BIGINT) AS value
  FROM p JOIN k ON p.lang = k.lang AND p.term = k.term JOIN v ON v.lang = p.lang WHERE p.n > 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms WHERE value > 0))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""

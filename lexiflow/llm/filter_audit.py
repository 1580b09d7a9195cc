r"""How filters interact: what each order of them keeps, removes and loses.

A document fails some of five filters A to E (bits 0 to 4).  Its survival word is a truth table: bit S of
32 is set if no filter of subset S fails it.  Counting each bit over the documents of a part (a language)
and a label gives the survivors of every subset, and each figure of each of the 120 orders is a difference
of two such counts, so that no order is ever run.

1. One scan of whole texts measures A to D and digests each text (``measured``).
2. E looks up the smallest id of equal texts (``repeats``).  Only texts that occur twice are looked up.
   Digests with more than 1/512 of the rows, 512 at most, are joined by broadcast, so that a text that
   fills a third of the table is not sent to one task; the others by sort-merge.
3. ``survivors`` counts bits inside each task by a carry-save adder: three words become a sum word and
   a carry word of twice the weight until at most two words of each weight are left.  Tasks send 32
   counts a part and label, which Spark adds.

Failure conditions (words are maximal runs of ``[^\x20\x09-\x0D]``, case counts): A under 200 words; B under
half of the words are distinct; C over 3 capital letters A-Z in 100 code points; D holds any of ``#$%&*|``;
E equals the text of a row with a smaller id, whichever language that has and whether or not it is removed.

Defined results: null text and language count as empty; an empty text fails A, and E if an earlier row is empty
too; a null id is smaller than none and greater than none; rows that repeat an id count each, and equal
rows with one id are copies of each other in no direction; a document is good (toxic) if any of its rows
in ``labels`` has quality (toxic) 1, null labels say no; a document of any length is one unit (its
distinct words are held); further columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import clean_text, map_texts, materialise, workers_import

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
SPACES = re.compile(rb"[\x20\x09-\x0D]")
CAPITALS = bytes(range(65, 91))
LEADING = bytes(b for b in range(256) if b & 0xC0 != 0x80)
SYMBOLS = re.compile(rb"[#$%&*|]")
#: A digest is looked up by broadcast if it has more than this share of the rows.
HOT_SHARE = 1 / 512
#: Rows whose words are counted at once in a task.
COUNTED = 1 << 18
LABELS = ("all", "good", "toxic")


def pieces(text: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """``text`` cut at white space into pieces of about ``size`` bytes."""
    start = 0
    while len(text) - start > size:
        cut = SPACES.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def failed(text: bytes) -> int:
    """Bits of the filters A to D that fail ``text``."""
    n, distinct = 0, set()
    for piece in pieces(text):
        words = piece.split()
        n += len(words)
        distinct.update(words)
    points = len(text) - len(text.translate(None, LEADING))  # bytes that begin a code point
    capitals = len(text) - len(text.translate(None, CAPITALS))
    return ((n < 200) | (100 * len(distinct) < 50 * n) << 1 | (100 * capitals > 3 * points) << 2
            | bool(SYMBOLS.search(text)) << 3)


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, part, fails, digest) of each row: the failed filters of A to D, and the text's SHA-256."""
    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t.encode() for t in batch.column(2).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([failed(t) for t in texts], pa.int32()),
                 pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())],
                ["doc_id", "part", "fails", "digest"])
        return work

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), clean_text("lang").alias("part"), "text")
    return map_texts(rows, ["doc_id", "part"], "text", "doc_id long, part string, fails int, digest binary", make)


def repeats(rows: DataFrame) -> DataFrame:
    """``rows`` with filter E's bit added to ``fails`` where a smaller id has the same digest."""
    groups = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    twice = materialise(groups.filter("n > 1"), "repeated")
    hot = twice.filter(F.col("n") > F.lit(rows.count() * HOT_SHARE)).select("digest", "first")
    cold = twice.select("digest", "first").join(F.broadcast(hot.select("digest")), "digest", "left_anti")
    found = rows.join(F.broadcast(hot), "digest").unionByName(
        rows.join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(cold.hint("merge"), "digest", "left"))
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return found.select("doc_id", "part", F.when(later, F.col("fails").bitwiseOR(F.lit(1 << 4))).otherwise(
        F.col("fails")).alias("fails"))


def survival_word(fails: Column) -> Column:
    """The 32-bit truth table: bit S is set if ``fails`` and S have no filter in common."""
    dead: Column = F.lit(0)
    for k in range(len(FILTERS)):
        subsets = sum(1 << s for s in range(SUBSETS) if s >> k & 1)  # all that hold filter k
        signed = subsets - (1 << 32) if subsets >> 31 else subsets
        dead = dead.bitwiseOR(F.when(F.getbit(fails, F.lit(k)) == 1, F.lit(signed)).otherwise(F.lit(0)))
    return F.bitwise_not(dead)


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with booleans ``good`` and ``toxic``."""
    marks = labels.filter("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    known = rows.filter("doc_id IS NOT NULL").join(marks, "doc_id", "left")
    both = known.unionByName(rows.filter("doc_id IS NULL"), allowMissingColumns=True)
    return both.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})


def bit_counts(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit ``words`` have each bit, by a carry-save adder."""
    counts = np.zeros(32, np.int64)
    plane, weight = np.ascontiguousarray(words, np.uint32), 1
    while len(plane):
        carries = []
        while len(plane) >= 3:
            third = len(plane) // 3
            a, b, c, rest = plane[:third], plane[third:2 * third], plane[2 * third:3 * third], plane[3 * third:]
            half = a ^ b
            carries.append((a & b) | (half & c))
            plane = np.concatenate([half ^ c, rest])
        for word in plane:
            counts += weight * ((int(word) >> np.arange(32)) & 1)
        plane, weight = np.concatenate(carries) if carries else plane[:0], weight * 2
    return counts


def survivors(rows: DataFrame) -> DataFrame:
    """(part, label, subset, n): the documents of each part and label (all, good, toxic) that survive each
    subset of filters, from (part, word, good, toxic); zeros included."""
    def count(table: pa.Table) -> pa.RecordBatch:
        parts = table.column("part").combine_chunks().dictionary_encode()
        codes = parts.indices.to_numpy()
        order = np.argsort(codes, kind="stable")
        cuts = np.searchsorted(codes[order], np.arange(len(parts.dictionary) + 1))
        words = table.column("word").to_numpy().astype(np.int32).view(np.uint32)[order]
        chosen = [np.ones(len(order), bool), *(table.column(c).to_numpy()[order].astype(bool) for c in LABELS[1:])]
        counts = [bit_counts(words[a:b][pick[a:b]]) for a, b in zip(cuts[:-1], cuts[1:]) for pick in chosen]
        names = np.repeat(np.arange(len(parts.dictionary)), len(LABELS) * SUBSETS)
        return pa.RecordBatch.from_arrays(
            [pc.take(parts.dictionary, pa.array(names)),
             pa.array(np.tile(np.repeat(LABELS, SUBSETS), len(parts.dictionary)).tolist(), pa.string()),
             pa.array(np.tile(np.arange(SUBSETS, dtype=np.int32), len(names) // SUBSETS)),
             pa.array(np.concatenate(counts))], ["part", "label", "subset", "n"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= COUNTED:
                yield count(pa.Table.from_batches(held))
                held, size = [], 0
        if size:
            yield count(pa.Table.from_batches(held))

    workers_import(rows.sparkSession)
    partial = rows.select("part", "word", *LABELS[1:]).mapInArrow(run, "part string, label string, subset int, n long")
    return partial.groupBy("part", "label", "subset").agg(F.sum("n").alias("n"))


def orders_of(counts: DataFrame) -> DataFrame:
    """One row a part, order and step from ``survivors``; all figures are differences of subset counts."""
    by_label = [F.transform(F.array_sort(F.collect_list(F.when(F.col("label") == label, F.struct("subset", "n")))),
                            lambda x: x["n"]).alias(label) for label in LABELS]
    parts = counts.groupBy("part").agg(*by_label)
    names = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    steps = parts.select("*", F.explode(names).alias("filter_order")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))

    def bits(n: Column) -> Column:
        """The first ``n`` filters of the order as a subset."""
        places = F.filter(F.sequence(F.lit(1), F.lit(len(FILTERS))), lambda i: i <= n)
        return F.aggregate(places, F.lit(0), lambda s, i: s + F.call_function(
            "shiftleft", F.lit(1), F.ascii(F.substr("filter_order", i, F.lit(1))) - ord(FILTERS[0])))

    steps = steps.select("*", bits(F.col("step") - 1).alias("before"), bits(F.col("step")).alias("after"))
    own = F.col("after") - F.col("before")

    def left(label: str, subset: Column) -> Column:
        return F.element_at(label, subset + 1)

    def lost(label: str) -> Column:
        return left(label, F.col("before")) - left(label, F.col("after"))

    everything = F.lit(SUBSETS - 1)
    # a subset of size s comes just before this filter in s! (4 - s)! of the orders
    ways = F.array(*[F.lit(factorial(s) * factorial(len(FILTERS) - 1 - s)) for s in range(len(FILTERS))])
    without = F.filter(F.sequence(F.lit(0), everything), lambda s: s.bitwiseAND(own) == 0)
    shapley = F.aggregate(without, F.lit(0).cast("long"), lambda acc, s: acc + F.element_at(
        ways, F.bit_count(s) + 1) * (left("all", s) - left("all", s + own)))
    return steps.select(
        "part", "filter_order", "step", left("all", F.col("after")).alias("kept"), lost("all").alias("removed"),
        (left("all", F.lit(0)) - left("all", own) - lost("all")).alias("redundant"),
        (left("all", everything - own) - left("all", everything)).alias("unique_fails"),
        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), shapley.alias("shapley"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    rows = repeats(materialise(measured(docs), "filter-rows"))
    words = labelled(rows, labels).withColumn("word", survival_word(F.col("fails")))
    return orders_of(materialise(survivors(words), "survivors"))


REPORT_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, part, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM t),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
             max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT w.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(words) < 200 THEN 1 ELSE 0 END AS a,
    CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 1 ELSE 0 END AS b,
    CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) THEN 1 ELSE 0 END AS c,
    CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 1 ELSE 0 END AS d,
    CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY text) THEN 1 ELSE 0 END AS e
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
cells AS (SELECT part, CASE WHEN a = 1 THEN 'A' ELSE '' END || CASE WHEN b = 1 THEN 'B' ELSE '' END
                 || CASE WHEN c = 1 THEN 'C' ELSE '' END || CASE WHEN d = 1 THEN 'D' ELSE '' END
                 || CASE WHEN e = 1 THEN 'E' ELSE '' END AS failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
          FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT p.x || q.x || r.x || s.x || u.x AS filter_order FROM x p, x q, x r, x s, x u
      WHERE len(list_distinct([p.x, q.x, r.x, s.x, u.x])) = 5),
steps AS (SELECT filter_order, step, substr(filter_order, step, 1) AS own,
                 substr(filter_order, 1, step - 1) AS earlier
          FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
marked AS (
  SELECT part, filter_order, step, own, n, good, toxic, contains(failed, own) AS fails,
         earlier <> '' AND regexp_matches(failed, '[' || earlier || 'x]') AS gone, failed = own AS only_own
  FROM cells, steps),
figures AS (
  SELECT part, filter_order, step, own,
    CAST(coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (NOT gone AND fails), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (gone AND fails), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (only_own), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(good) FILTER (NOT gone AND fails), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(toxic) FILTER (NOT gone AND fails), 0) AS BIGINT) AS toxic_lost
  FROM marked GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM figures
"""

"""Lemmatize cleaned text with a (form, lemma) table.

The reference ran a per-row Python lemmatizer model inside a UDF.  Here the
lemma table is data: each space-separated token is looked up, unknown tokens
stay as they are, and the tokens are joined back with single spaces, so
spacing (and the empty tokens of double spaces) is preserved exactly.

There is one plan, whatever the sizes:

1. The frame is written once with a row number (``checkpoint``: the number is
   fixed and the text is not cleaned again).
2. The most frequent forms of every 16th row, ``HELD_FORMS`` of ``HELD_LENGTH``
   characters at most, are looked up once and sent to the tasks as a dictionary.
3. Each row's *different* non-empty tokens that the dictionary doesn't know are
   joined with the table by a sort-merge join.  Forms that hold more than 1/512
   of these (row, form) pairs (there are at most 512) are dealt out to as many
   tasks as the count of the most frequent asks; every 16th row is counted for that.
4. Only matched pairs go back to their rows, and the tokens of a row are replaced
   in one pass by them and the dictionary.  Texts themselves are never shuffled
   by token, and a row's time is linear in its tokens.

Null forms, null lemmas and forms that are their own lemma change nothing and
are dropped from the table first; a form listed several times keeps its
smallest lemma.  A null text stays null, an empty one empty; rows may repeat.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, workers_import

#: A form is dealt out if it has more than this share of the (row, form) pairs.
HOT_SHARE = 1 / 512
#: Rows counted for that: every 16th.
COUNTED_ROWS = 16
#: Frequent forms that every task holds, and their greatest length.
HELD_FORMS, HELD_LENGTH = 200_000, 40
#: Text that is cut into tokens at a time.
PART_BYTES = 4 << 20


def tokens(text_col: str) -> Column:
    return F.split(F.col(text_col), " ", -1)


def lemma_pairs(lemmas: DataFrame, form_col: str = "form", lemma_col: str = "lemma") -> DataFrame:
    """The table's useful rows: one (form, lemma) per form, form <> lemma."""
    named = lemmas.select(F.col(form_col).alias("form"), F.col(lemma_col).alias("lemma"))
    return named.filter("form IS NOT NULL AND lemma IS NOT NULL").groupBy("form").agg(
        F.min("lemma").alias("lemma")).filter("form <> lemma")


def _held(frame: DataFrame, text_col: str, useful: DataFrame) -> dict[str, str]:
    """form -> lemma (or the form itself) of the most frequent forms in the rows counted, HELD_FORMS at most."""
    present = F.array_remove(F.array_distinct(tokens(text_col)), "")
    top = _counted(frame).select(F.explode_outer(present).alias("form")).filter(
        F.length("form") <= HELD_LENGTH).groupBy("form").agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.col("n").desc(), "form").limit(HELD_FORMS)
    found = top.join(useful.filter(F.length("lemma") <= 2 * HELD_LENGTH), "form", "left").join(
        useful.filter(F.length("lemma") > 2 * HELD_LENGTH).select("form"), "form", "left_anti")
    return {r.form: r.form if r.lemma is None else r.lemma for r in found.select("form", "lemma").collect()}


def text_parts(texts: pa.Array) -> Iterator[pa.Array]:
    """The array in slices of about PART_BYTES of text, one row at least: a slice's words fit a processor's cache."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + PART_BYTES, "right")))
        yield texts.slice(start, stop - start)
        start = stop


def _coded(texts: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]:
    """The texts' lists of tokens, their different tokens (as a column and as strings), and every token's place among these."""
    lists = pc.split_pattern(texts, " ")
    coded = pc.dictionary_encode(lists.flatten())
    return lists, coded.dictionary, coded.dictionary.to_numpy(zero_copy_only=False), coded.indices.to_numpy()


def _unknown(texts: pa.Array, held: dict[str, str]) -> pa.Array:
    """Of each text its different non-empty tokens that ``held`` doesn't know; none of a null text."""
    lists, words, strings, codes = _coded(texts)
    new = np.fromiter((w not in held and w != "" for w in strings), bool, len(words))
    at = np.flatnonzero(new[codes])
    rows = np.repeat(np.arange(len(texts)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
    pairs = np.unique(rows[at] * np.int64(max(len(words), 1)) + codes[at])
    row, code = np.divmod(pairs, max(len(words), 1))
    ends = np.searchsorted(row, np.arange(len(texts) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), words.take(pa.array(code)))


def _replaced(texts: pa.Array, held: dict[str, str], own: dict[str, str]) -> pa.Array:
    """The texts with their tokens replaced by ``own`` and ``held``; null texts stay null."""
    lists, words, strings, codes = _coded(texts)
    new = [held.get(w, w) for w in strings]
    if own:
        new = [own.get(w, to) for w, to in zip(strings, new)]
    new = pa.array(new, words.type).take(pa.array(codes))
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), new, mask=pc.is_null(texts)), " ")


def _row_functions(held: dict[str, str]):
    """Two functions of a text: its different non-empty tokens that ``held`` doesn't know, and the text with
    its tokens replaced by ``held`` and by the rows' own (form, lemma) pairs.  A form has one lemma, and each row that
    has a matched form has its pair, so the pairs of the rows of a slice are looked up together."""
    @F.arrow_udf("array<string>")
    def unknown(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.concat_arrays([_unknown(p, held) for p in text_parts(texts)] or [pa.array([], pa.list_(texts.type))])

    @F.arrow_udf("string")
    def replaced(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, forms, lemmas in batches:
            out, start = [], 0
            for part in text_parts(texts):
                own = [x.slice(start, len(part)).flatten().to_numpy(zero_copy_only=False) for x in (forms, lemmas)]
                out.append(_replaced(part, held, dict(zip(*own))))
                start += len(part)
            yield pa.concat_arrays(out or [texts])

    return unknown, replaced


def _counted(frame: DataFrame) -> DataFrame:
    return frame.filter(F.col("_row") % COUNTED_ROWS == 0)


def _dealt(pairs: DataFrame) -> tuple[Column, int]:
    """Whether a ``form`` is dealt out, and to how many tasks, by the ``pairs`` of the rows counted.  Reads the hashes
    of 1 / HOT_SHARE forms at most."""
    counts = pairs.groupBy(F.xxhash64("form").alias("key")).agg(
        F.count(F.lit(1)).alias("n")).checkpoint(eager=True)
    share = (counts.agg(F.sum("n")).first()[0] or 0) * HOT_SHARE
    hot = counts.filter(F.col("n") > F.lit(share)).collect()
    return (F.xxhash64("form").isin([r.key for r in hot]) if hot else F.lit(False),
            max([math.ceil(r.n / share) for r in hot], default=1))


def lemmatize(df: DataFrame, lemmas: DataFrame | Callable[[DataFrame, str], DataFrame], text_col: str,
              output_col: str | None = None, form_col: str = "form", lemma_col: str = "lemma") -> DataFrame:
    """Replace each token of ``text_col`` by its lemma; output in ``output_col``.

    ``lemmas`` may be a function that makes the table of (frame, ``text_col``): it gets the written frame, so that a
    table made of the corpus doesn't clean the texts once more."""
    output_col = output_col or text_col
    ensure_checkpoint_dir(df.sparkSession)
    workers_import(df.sparkSession)
    frame = df.withColumn("_row", F.monotonically_increasing_id()).checkpoint(eager=True)
    useful = lemma_pairs(lemmas(frame, text_col) if callable(lemmas) else lemmas, form_col, lemma_col)
    unknown, replaced = _row_functions(_held(frame, text_col, useful))
    each = lambda rows: rows.select("_row", F.explode_outer(unknown(text_col)).alias("form")).filter(
        "form IS NOT NULL")
    pairs = each(frame)
    dealt, tasks = _dealt(each(_counted(frame)))
    salt = F.when(dealt, F.pmod(F.xxhash64("_row"), F.lit(tasks))).otherwise(F.lit(0))
    copies = F.explode(F.when(dealt, F.sequence(F.lit(0), F.lit(tasks - 1))).otherwise(F.array(F.lit(0))))
    table = useful.withColumn("_salt", copies)
    matched = pairs.withColumn("_salt", salt.cast("int")).join(table.hint("merge"), ["form", "_salt"]).groupBy(
        "_row").agg(F.collect_list(F.struct("form", "lemma")).alias("_own"))
    found = frame.join(matched.hint("merge"), "_row", "left")
    value = replaced(text_col, F.col("_own.form"), F.col("_own.lemma"))
    return found.withColumn(output_col, value).select(*df.columns, *([output_col] if output_col not in df.columns else []))


# English suffix rules in order (pattern, replacement) and exceptions.
SUFFIX_RULES = (("^(.{2,})sses$", "$1ss"), ("^(.{2,})ies$", "$1y"), ("^(.{3,})ing$", "$1"), ("^(.{3,})ed$", "$1"),
                ("^(.{2,}[^su])s$", "$1"))
EXCEPTIONS = {"was": "be", "were": "be", "been": "be", "has": "have", "had": "have", "does": "do", "did": "do",
              "children": "child", "men": "man", "women": "woman", "feet": "foot", "mice": "mouse",
              "thing": "thing", "string": "string", "this": "this", "during": "during"}


def rule_lemma(form: Column) -> Column:
    """Lemma of a form: an exception, else the first suffix rule that fits, else the form."""
    out = form
    for pattern, replacement in reversed(SUFFIX_RULES):
        out = F.when(form.rlike(pattern), F.regexp_replace(form, pattern, replacement)).otherwise(out)
    for word, lemma in EXCEPTIONS.items():
        out = F.when(form == word, F.lit(lemma)).otherwise(out)
    return out


def distinct_forms(df: DataFrame, text_col: str) -> DataFrame:
    """(form): the different non-empty tokens of a corpus; a task sends those of a batch of rows once each."""
    def find(batches):
        for batch in batches:
            parts = [pc.split_pattern(p, " ").flatten().unique() for p in text_parts(batch.column(0))]
            if parts:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(parts).unique()], ["form"])

    workers_import(df.sparkSession)
    return df.select(text_col).mapInArrow(find, "form string").filter("form <> ''").distinct()


def rule_table(df: DataFrame, text_col: str) -> DataFrame:
    """A lemma table for the distinct tokens of a corpus, by suffix rules and exceptions."""
    return distinct_forms(df, text_col).select("form", rule_lemma(F.col("form")).alias("lemma")).filter("form <> lemma")

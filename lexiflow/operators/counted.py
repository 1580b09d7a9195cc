"""Term counts of feature sets, by one function a row instead of a chain of Spark ML stages.

The stages (``Tokenizer``, ``StopWordsRemover``, ``NGram``, ``CountVectorizerModel``, ``HashingTF``) each turn a row's
tokens into objects and back.  Here a task cuts the texts of a few MB at a time into Arrow columns, and looks tokens up as
columns; sets of one text and the same stop words share their tokens.  Terms and vectors are the stages' own: tokens end at
each single white space character, empty ones inside a text are kept and trailing ones dropped; an empty text is one empty
token, and a null one is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from ..session import workers_import
from .lemma import text_parts
from .linear import sparse_parts, totals

#: Words with counts that a task gathers before it adds them up, and adds up before it sends them on.
HELD_WORDS = 2_000_000
#: Words that a task sends at a time.
SENT_WORDS = 50_000
#: Seed of ``HashingTF``.
SEED = 42


def _lower(words: pa.Array) -> pa.Array:
    """Lower case as Java's of words without A-Z: those beyond ASCII one by one, for characters that become two, and final
    sigmas; each different one once."""
    other = pc.invert(pc.string_is_ascii(words))
    if not pc.any(other).as_py():
        return words
    coded = pc.dictionary_encode(words.filter(other))
    lowered = pa.array([w.lower() for w in coded.dictionary.to_numpy(zero_copy_only=False)], words.type)
    return pc.replace_with_mask(words, other, lowered.take(coded.indices))


@dataclass(frozen=True)
class Terms:
    """A set's terms: the tokens of a text without stop words, counted by their place in a vocabulary, or (without one) as
    bigrams that are hashed to ``width`` numbers."""
    text_col: str
    stop_words: tuple[str, ...] = ()
    vocabulary: tuple[str, ...] | None = None
    width: int = 0


def _token_lists(texts: pa.Array) -> pa.Array:
    """The tokens of each text, A-Z lower-cased; null for a text of white space."""
    if texts.null_count:
        raise ValueError("a null text has no terms")
    one_space = pc.ascii_lower(pc.replace_substring_regex(texts, r"[\t\n\x0B\f\r]", " "))
    trimmed = pc.ascii_rtrim(one_space, " ")
    blank = pc.and_(pc.equal(trimmed, ""), pc.not_equal(one_space, ""))
    return pc.split_pattern(pc.if_else(blank, pa.scalar(None, texts.type), trimmed), " ")


def _rows(lists: pa.Array) -> np.ndarray:
    """The row of each token."""
    return np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())


def words_and_counts(texts: pa.Array, stop_words: tuple[str, ...] = ()) -> tuple[pa.Array, pa.Array]:
    """The texts' words without stop words, and how often each is there.  A word may be there twice if its letters beyond
    ASCII had two cases."""
    words, n = pc.value_counts(_token_lists(texts).flatten()).flatten()
    words = _lower(words)
    if stop_words:
        kept = pc.invert(_among(words, stop_words))
        words, n = words.filter(kept), n.filter(kept)
    return words, n


def cut(texts: pa.Array, stop_words: tuple[str, ...] = ()) -> tuple[np.ndarray, pa.Array]:
    """The row of each token in order, and the tokens; without stop words."""
    lists = _token_lists(texts)
    rows, words = _rows(lists), _lower(lists.flatten())
    if stop_words:
        kept = pc.invert(_among(words, stop_words))
        rows, words = rows[kept.to_numpy(zero_copy_only=False)], words.filter(kept)
    return rows, words


def _among(words: pa.Array, stop_words: tuple[str, ...]) -> pa.Array:
    return pc.is_in(words, pa.array([w.lower() for w in stop_words], words.type))


def _added_up(parts: list[tuple[pa.Array, pa.Array]]) -> tuple[pa.Array, pa.Array]:
    """(words, counts): each word of the parts once."""
    every = pa.table({"term": pa.chunked_array([w for w, _ in parts], pa.string()),
                      "n": pa.chunked_array([n for _, n in parts], pa.int64())})
    found = every.group_by("term", use_threads=False).aggregate([("n", "sum")])
    return found["term"].combine_chunks(), found["n_sum"].combine_chunks()


def term_totals(df: DataFrame, sets: dict[str, Terms]) -> DataFrame:
    """(set, term, n): how often each term is in the corpus; a task sends the words of many rows once each."""
    texts = list(dict.fromkeys(t.text_col for t in sets.values()))

    def count(batches):
        held = {name: [] for name in sets}

        def send(name):
            words, n = _added_up(held[name])
            held[name] = []
            for start in range(0, len(words), SENT_WORDS):
                some = words.slice(start, SENT_WORDS)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(some)), some, n.slice(start, SENT_WORDS)], names)

        for batch in batches:
            for name, terms in sets.items():
                for part in text_parts(batch.column(texts.index(terms.text_col))):
                    held[name].append(words_and_counts(part, terms.stop_words))
                    if sum(len(w) for w, _ in held[name]) > HELD_WORDS:
                        held[name] = [_added_up(held[name])]
                        if len(held[name][0][0]) > HELD_WORDS // 2:
                            yield from send(name)
        for name in sets:
            yield from send(name)

    workers_import(df.sparkSession)
    names = ["set", "term", "n"]
    return df.select(*texts).mapInArrow(count, "set string, term string, n long").groupBy("set", "term").agg(
        F.sum("n").alias("n"))


def hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Murmur3 (32 bits, signed) of the byte runs of ``data``, which goes on for four bytes behind the last; all runs
    that have a next four bytes are advanced together."""
    blocks = sizes >> 2
    most = int(blocks.max(initial=0))
    order = np.argsort((-blocks).astype(np.int16 if most < 1 << 15 else np.int64), kind="stable")
    at, left = starts[order], blocks[order]
    four = np.ndarray((len(data) - 3,), "<u4", np.ascontiguousarray(data), strides=(1,))

    def mixed(k):
        k = k * np.uint32(0xCC9E2D51)
        return ((k << np.uint32(15)) | (k >> np.uint32(17))) * np.uint32(0x1B873593)

    h = np.full(len(at), SEED, np.uint32)
    for j in range(most):
        n = int(np.searchsorted(-left, -j, "left"))  # those with more than j blocks
        x = h[:n] ^ mixed(four[at[:n] + 4 * j])
        h[:n] = ((x << np.uint32(13)) | (x >> np.uint32(19))) * np.uint32(5) + np.uint32(0xE6546B64)
    length = sizes[order]
    h ^= mixed(four[at + 4 * left] & np.array([0, 0xFF, 0xFFFF, 0xFFFFFF], np.uint32)[length & 3])
    h ^= length.astype(np.uint32)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h = (h ^ (h >> np.uint32(shift))) * np.uint32(factor)
    out = np.empty(len(h), np.uint32)
    out[order] = h ^ (h >> np.uint32(16))
    return out.view(np.int32)


def _vectors(n_rows: int, width: int, rows: np.ndarray, indices: np.ndarray) -> pa.Array:
    """Sparse count vectors of (row, index) pairs."""
    keys = rows * width + indices
    if n_rows * width <= 8 * len(keys) + 100_000:
        counts = np.bincount(keys, minlength=n_rows * width)
        keys = np.flatnonzero(counts)
        counts = counts[keys]
    else:
        keys, counts = np.unique(keys, return_counts=True)
    row, index = np.divmod(keys, max(width, 1))
    ends = pa.array(np.searchsorted(row, np.arange(n_rows + 1)).astype(np.int32))
    return pa.StructArray.from_arrays(
        [pa.array(np.zeros(n_rows, np.int8)), pa.array(np.full(n_rows, width, np.int32)),
         pa.ListArray.from_arrays(ends, pa.array(index.astype(np.int32))),
         pa.ListArray.from_arrays(ends, pa.array(counts.astype(np.float64)))],
        names=["type", "size", "indices", "values"])


def vectors_of(texts: pa.Array, sets: list[Terms]) -> list[pa.Array]:
    """The vectors of texts by each of the sets, which have the same text and stop words."""
    rows, words = cut(texts, sets[0].stop_words)
    return [_vectors_by(len(texts), rows, words, terms) for terms in sets]


def _vectors_by(n_rows: int, rows: np.ndarray, words: pa.Array, terms: Terms) -> pa.Array:
    if terms.vocabulary is None:
        return _vectors(n_rows, terms.width, *_hashed_bigrams(rows, words, terms.width))
    place = pc.fill_null(pc.index_in(words, pa.array(terms.vocabulary, words.type)), -1).to_numpy()
    known = place >= 0
    return _vectors(n_rows, len(terms.vocabulary), rows[known], place[known].astype(np.int64))


def _hashed_bigrams(rows: np.ndarray, words: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, number) of each two words that follow each other in a row."""
    # each token and a space: a bigram is a run of these bytes, without its last space
    spaced = pc.binary_join_element_wise(words.cast(pa.large_string()), *[pa.scalar(x, pa.large_string()) for x in ("", " ")])
    run = pa.concat_arrays([spaced, pa.array(["    "], pa.large_string())])
    ends = np.frombuffer(run.buffers()[1], np.int64, len(run) + 1)
    first = np.flatnonzero(rows[1:] == rows[:-1])
    found = hashes(np.frombuffer(run.buffers()[2], np.uint8, ends[-1]), ends[first], ends[first + 2] - 1 - ends[first])
    return rows[first], found.astype(np.int64) % width


def _by_part(text_col: str, terms: Terms) -> Column:
    @F.arrow_udf(VectorUDT())
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.concat_arrays([vectors_of(p, [terms])[0] for p in text_parts(texts)] or [
                _vectors(0, 0, *np.zeros((2, 0), np.int64))])

    return vectors(text_col)


def vocabulary_counts(text_col: str, vocabulary: list[str], stop_words: list[str] = ()) -> Column:
    """The vector that ``CountVectorizerModel`` makes of the text's tokens."""
    return _by_part(text_col, Terms(text_col, tuple(stop_words), tuple(vocabulary)))


def hashed_bigram_counts(text_col: str, width: int, stop_words: list[str]) -> Column:
    """The vector that ``HashingTF`` makes of the bigrams of the text's tokens without stop words."""
    return _by_part(text_col, Terms(text_col, tuple(stop_words), None, width))


def counted_side_by_side(df: DataFrame, keep: tuple[str, ...], sets: dict[str, Terms]) -> DataFrame:
    """The ``keep`` columns, and each set's vectors as ``v_<set>``; texts are read once, and cut once for the sets that
    share their tokens."""
    groups: dict[tuple, list[str]] = {}
    for name, terms in sets.items():
        groups.setdefault((terms.text_col, terms.stop_words), []).append(name)
    texts = list(dict.fromkeys(col for col, _ in groups))
    schema = StructType(df.select(*keep).schema.fields)
    for name in sets:
        schema = schema.add(f"v_{name}", VectorUDT())
    names = schema.names

    def count(batches):
        for batch in batches:
            found = {}
            for (col, _), members in groups.items():
                parts = [vectors_of(p, [sets[n] for n in members]) for p in text_parts(batch.column(texts.index(col)))]
                found |= {n: pa.concat_arrays(own) for n, own in zip(members, zip(*parts))}
            if found:
                yield pa.RecordBatch.from_arrays([*batch.columns[len(texts):], *(found[n] for n in sets)], names)

    workers_import(df.sparkSession)
    given = df.select(*[F.col(c).alias(f"_text{k}") for k, c in enumerate(texts)], *keep)
    return given.mapInArrow(count, schema)


def _listed(n_rows: int, rows: np.ndarray, words: pa.Array) -> pa.Array:
    """The words of each row, which are in the order of their rows."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, np.arange(n_rows + 1)).astype(np.int32)), words)


def term_columns(texts: pa.Array, terms: Terms, made: dict[str, str]) -> list[pa.Array]:
    """The columns ``made``, by what they are: ``tokens``, ``kept`` (these without stop words), ``bigrams`` of the kept, or
    ``counts``, the vectors."""
    n = len(texts)
    rows, words = cut(texts)
    found = {"tokens": lambda: _listed(n, rows, words)}
    kept = pc.invert(_among(words, terms.stop_words))
    kept_rows, kept_words = rows[kept.to_numpy(zero_copy_only=False)], words.filter(kept)
    found["kept"] = lambda: _listed(n, kept_rows, kept_words)
    found["counts"] = lambda: _vectors_by(n, kept_rows, kept_words, terms)

    def bigrams():
        first = np.flatnonzero(kept_rows[1:] == kept_rows[:-1])
        return _listed(n, kept_rows[first], pc.binary_join_element_wise(
            kept_words.take(pa.array(first)), kept_words.take(pa.array(first + 1)), " "))

    found["bigrams"] = bigrams
    return [found[what]() for what in made.values()]


def with_term_columns(df: DataFrame, terms: Terms, made: dict[str, str]) -> DataFrame:
    """All columns, and those ``made`` as ``term_columns`` has them."""
    schema = StructType([*df.schema.fields])
    for name, what in made.items():
        schema = schema.add(name, VectorUDT() if what == "counts" else ArrayType(StringType()))
    names, text = schema.names, df.columns.index(terms.text_col)

    def make(batches):
        for batch in batches:
            start = 0
            for part in text_parts(batch.column(text)):
                own = term_columns(part, terms, made)
                yield pa.RecordBatch.from_arrays([*batch.slice(start, len(part)).columns, *own], names)
                start += len(part)

    workers_import(df.sparkSession)
    return df.mapInArrow(make, schema)


def document_frequencies(rows: DataFrame, widths: dict[str, int]) -> tuple[int, list[int]]:
    """The number of rows, and in how many of them each entry of the vector columns, one column's after another's, isn't
    zero; a task adds up its own before they meet."""
    most = max(widths.values())

    def add(batch: pa.RecordBatch, sums: np.ndarray) -> None:
        for k in range(len(widths)):
            idx, val = (batch.column(2 * k + n).flatten().to_numpy(zero_copy_only=False) for n in (0, 1))
            sums[k, :most] += np.bincount(idx[val != 0], minlength=most)
        sums[0, -1] += batch.num_rows

    parts = [p.alias(f"p{2 * k + n}") for k, c in enumerate(widths) for n, p in enumerate(sparse_parts(c))]
    sums = totals(rows.select(*parts), len(widths), most + 1, add)
    return int(sums[0, -1]), [int(d) for row, w in zip(sums, widths.values()) for d in row[:w]]

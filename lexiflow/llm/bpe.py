"""BPE encoding and decoding by a prefix-sharing trie.

The encoding of a word under BPE has a last token, and what stands before that token is itself the
encoding of a shorter prefix.  So one (last token, node before it) pair at every trie node describes the
encoding of the path to that node.  Distinct words are inserted into a trie; its nodes are visited depth
first and each gets its pair from the pairs of its ancestors.  Words that share a prefix share these
nodes, so the prefix is encoded once.

The last token at a node is the one vocabulary token that (a) ends the path and (b) may follow the last
token of the node where it starts: two tokens may be neighbours if BPE over the joined symbols of both
gives exactly these two.  There is one such token at each node.

Texts are cut at ASCII white space into chunks (no token, normalisation step or special token crosses
it; a file whose settings or a set of probe texts say otherwise is refused).  Each distinct chunk of a task goes once through the tokenizer file's own normaliser and
pre-tokenizer and then through the trie; documents are assembled by lookups.  Nothing is shuffled.

Defined results: a null or empty text has no tokens and decodes to an empty string; texts of any length
are encoded whole; an empty table gives an empty table; repeated rows are encoded alike; further columns
are kept, whatever they are called (a column named like ``output_col`` is replaced).
"""

from __future__ import annotations

import json
import re
import string
from array import array
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import clean_text, slices, workers_import

#: Settings of tokenizer files that the trie doesn't know, and texts that must come out as the library encodes them.
UNSUPPORTED = ("continuing_subword_prefix", "byte_fallback", "ignore_merges", "dropout", "fuse_unk")
UNSUPPORTED_FLAGS = ("single_word", "lstrip", "rstrip")
PROBES = ("Hello World", "  two  spaces\tand\nlines ", "don't (stop) 12,345.60 x_y #tag", "ÀÉ ñandú ß İ 日本語 😀 e\u0301",
          "\u00a0nbsp\u2003em \x1c\x85", "a" * 40 + " supercalifragilistic")
#: Bounds on what a worker keeps between batches.
MAX_CHUNKS, MAX_WORDS, MAX_NODES, MAX_PAIRS = 500_000, 300_000, 250_000, 200_000
#: What it keeps of them when a task ends.
KEPT = 100_000


class Recent:
    """A dictionary of two generations: ``turn`` drops what ``new`` wasn't asked for since the turn before, once
    half of ``limit`` entries are young."""

    def __init__(self, limit: int):
        self.half, self.young, self.old = limit // 2, {}, {}

    def turn(self) -> None:
        if len(self.young) >= self.half:
            self.young, self.old = {}, self.young

    def trim(self, size: int) -> None:
        self.young, self.old = dict(islice(self.young.items(), size)), {}

    def new(self, keys: Iterable) -> list:
        """The keys that are unknown; those known from the older generation become young again."""
        out, young, old = [], self.young, self.old
        for key in keys:
            if key not in young:
                if key in old:
                    young[key] = old[key]
                else:
                    out.append(key)
        return out


class Neighbours:
    """May token ``a`` be followed by token ``b``?  Decided by replaying BPE over both, and remembered."""

    def __init__(self, merges: dict[tuple[int, int], tuple[int, int]], symbols: dict[int, tuple[int, ...]]):
        self.merges, self.symbols, self.known = merges, symbols, {}

    def replay(self, ids: tuple[int, ...]) -> list[int]:
        """Plain BPE: again and again join the leftmost pair of the lowest rank."""
        ids = list(ids)
        while len(ids) > 1:
            best = None
            for i, pair in enumerate(zip(ids, ids[1:])):
                found = self.merges.get(pair)
                if found is not None and (best is None or found[0] < best[0]):
                    best = (found[0], found[1], i)
            if best is None:
                return ids
            ids[best[2]:best[2] + 2] = [best[1]]
        return ids

    def __call__(self, a: int | None, b: int) -> bool:
        answer = self.known.get((a, b))
        if answer is None:
            if len(self.known) >= MAX_PAIRS:
                self.known.clear()
            if a is None:
                answer = self.replay(self.symbols[b]) == [b]
            else:
                answer = self.replay(self.symbols[a] + self.symbols[b]) == [a, b]
            self.known[a, b] = answer
        return answer


class WordTrie:
    """Trie over the byte-level symbols of words; each node knows the last token of its path."""

    def __init__(self, model: dict):
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model.get("end_of_word_suffix") or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made, symbols = {}, {}
        for rank, (left, right) in enumerate(merges):
            made[self.vocab[left], self.vocab[right]] = (rank, self.vocab[left + right])
        for token, i in self.vocab.items():
            body = token[:-len(self.end)] if self.end and token.endswith(self.end) else token
            parts = list(body)
            if parts and len(body) != len(token):
                parts[-1] += self.end
            if all(p in self.vocab for p in parts):
                symbols[i] = tuple(self.vocab[p] for p in parts)
        self.tokens = {t: i for t, i in self.vocab.items() if i in symbols}
        self.longest = max(len(s) for s in symbols.values())
        self.may_follow = Neighbours(made, symbols)
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}
        self.last: list[int | None] = [None]
        self.before: list[int] = [0]

    def _state(self, path: list[int], text: str, depth: int) -> tuple[int, int]:
        """(last token, depth before it) of ``text`` of ``depth`` symbols; ``path[i]`` is the node after i."""
        last, tokens, known = self.last, self.tokens, self.may_follow.known
        for start in range(depth - 1, max(0, depth - self.longest) - 1, -1):  # most last tokens are short
            token = tokens.get(text[start:])
            if token is not None:
                answer = known.get((last[path[start]], token))
                if answer or answer is None and self.may_follow(last[path[start]], token):
                    return token, start
        raise ValueError(f"no token for {text!r}")

    def encode_all(self, words: Iterable[str]) -> dict[str, bytes]:
        """Encodings (int32 as bytes) of distinct byte-level words, visited in the trie's depth-first order.

        Sorted words are the trie's words in depth-first order: ``path`` is the way from the root to the
        current node, cut back to what the next word shares with the last one.
        """
        if len(self.last) >= MAX_NODES:
            self.clear()
        out, path, previous, child, last, before = {}, [0], "", self.child, self.last, self.before
        for word in sorted(words):
            inner = len(word) - 1  # the last symbol carries the end mark, so it is a leaf of its own kind
            shared = 0
            top = min(inner, len(path) - 1)
            while shared < top and word[shared] == previous[shared]:
                shared += 1
            del path[shared + 1:]
            for depth in range(shared, inner):
                edge = path[depth] << 21 | ord(word[depth])
                node = child.get(edge)
                if node is None:
                    token, start = self._state(path, word[:depth + 1], depth + 1)
                    node = child[edge] = len(last)
                    last.append(token)
                    before.append(path[start])
                path.append(node)
            token, start = self._state(path, word + self.end, len(word))
            ids, node = [token], path[start]
            while node:
                ids.append(last[node])
                node = before[node]
            ids.reverse()
            out[word] = array("i", ids).tobytes()
            previous = word
        return out


class Encoder:
    """Text -> ids for one tokenizer file; holds the trie and the chunks seen by a task."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        unsupported = [k for k in UNSUPPORTED if spec["model"].get(k)] if spec["model"]["type"] == "BPE" else ["model type"]
        unsupported += [f"{flag} of {t['content']}" for t in spec.get("added_tokens", []) for flag in UNSUPPORTED_FLAGS
                        if t.get(flag)]
        if unsupported:
            raise ValueError(f"{path}: not supported: {', '.join(unsupported)}")
        whole = Tokenizer.from_file(path)
        whole.no_truncation()
        whole.no_padding()
        self.normalise = whole.normalizer.normalize_str if whole.normalizer else str
        self.cut = whole.pre_tokenizer.pre_tokenize_str if whole.pre_tokenizer else lambda text: [(text, (0, len(text)))]
        letters = string.ascii_letters
        self.lowers = [w for w, _ in self.cut(self.normalise(letters))] == [letters.lower()]
        size = whole.get_vocab_size(with_added_tokens=True)
        self.names = pa.array([whole.id_to_token(i) or "" for i in range(size)], pa.string())
        self.decoder = whole if whole.decoder is not None else None
        self.trie = WordTrie(spec["model"])
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.special = special
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True)))
                                        + ")").split if special else lambda chunk: [chunk]
        self.known, self.words = Recent(MAX_CHUNKS), Recent(MAX_WORDS)
        for probe in (*PROBES, *[f"a{t}b {t} {t}{t}" for t in special][:100]):
            ids = self.encode_batch([probe.encode()]).flatten().to_pylist()
            if ids != whole.encode(probe, add_special_tokens=False).ids:
                raise ValueError(f"{path}: not supported: texts can't be cut at white space, as {probe!r} shows")
        self.known, self.words = Recent(MAX_CHUNKS), Recent(MAX_WORDS)
        self.trie.clear()

    def _pieces(self, chunk: str) -> list[str]:
        """The byte-level words of a chunk; special tokens as they are, marked by a leading space."""
        if self.lowers and chunk.isascii() and chunk.isalpha() and chunk not in self.special:
            return [chunk.lower()]
        out: list[str] = []
        for part in self.split_special(chunk):
            if part in self.special:
                self.words.young[" " + part] = array("i", [self.special[part]]).tobytes()
                out.append(" " + part)
            elif part:
                out.extend(word for word, _ in self.cut(self.normalise(part)))
        return out

    def learn(self, chunks: Iterable[bytes]) -> None:
        """Make sure that every chunk is known."""
        new = self.known.new(chunks)
        if not new:
            return
        pieces = {c: self._pieces(c.decode("utf-8")) for c in new}
        unknown = self.words.new(set(chain.from_iterable(pieces.values())))
        words, known = self.words.young, self.known.young
        words.update(self.trie.encode_all(unknown))
        for chunk, parts in pieces.items():
            known[chunk] = words[parts[0]] if len(parts) == 1 else b"".join([words[p] for p in parts])

    def encode_batch(self, texts: list[bytes | None]) -> pa.ListArray:
        """Ids of UTF-8 texts."""
        chunks = [(t or b"").split() for t in texts]
        self.known.turn()
        self.words.turn()
        self.learn(set(chain.from_iterable(chunks)))
        known = self.known.young
        rows = [b"".join([known[c] for c in row]) for row in chunks]
        ends = np.cumsum([0, *map(len, rows)]) // 4
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(
            np.frombuffer(b"".join(rows), np.int32), pa.int32()))


    def decode_batch(self, ids: pa.ListArray) -> pa.Array:
        """Texts of lists of token ids as the tokenizer file's decoder gives them, special tokens kept.

        A file without a decoder joins its tokens by one space; that case is done on whole Arrow arrays.
        """
        if ids.null_count:
            ids = pc.fill_null(ids, pa.scalar([], ids.type))
        if self.decoder is not None:
            return pa.array(self.decoder.decode_batch(ids.to_pylist(), skip_special_tokens=False), pa.string())
        ends = np.cumsum([0, *pc.list_value_length(ids).to_pylist()])
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), self.names.take(ids.flatten())), " ")

    def trim(self) -> None:
        """Give most memory back; recent words and the known neighbours stay for the worker's next task."""
        self.known.trim(KEPT)
        self.words.trim(KEPT)
        self.trie.clear()


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """One encoder a Python worker: Spark reuses workers, so later tasks find the words of earlier ones."""
    return Encoder(path)


def _add(df: DataFrame, source: Column, path: str, ids_col: str | None, text_col: str | None) -> DataFrame:
    """Add ids of a text, or the text of ids, or both in one pass (the text then is that of the new ids)."""
    workers_import(df.sparkSession)
    new = [c for c in (ids_col, text_col) if c]
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in new], source.alias("_source"))
    at = len(kept.columns) - 1
    schema = T.StructType(kept.schema.fields[:-1])
    if ids_col:
        schema = schema.add(ids_col, T.ArrayType(T.IntegerType()))
    if text_col:
        schema = schema.add(text_col, T.StringType())

    def run(batches):
        encoder = encoder_of(path)
        try:
            for batch in batches:
                for part in slices(batch, at, 2 << 20):
                    columns, last = part.columns[:-1], part.column(at)
                    if ids_col:
                        last = encoder.encode_batch(last.cast(pa.binary()).to_pylist())
                        columns.append(last)
                    if text_col:
                        columns.append(encoder.decode_batch(last))
                    yield pa.RecordBatch.from_arrays(columns, schema.names)
        finally:
            encoder.trim()

    return kept.mapInArrow(run, schema)


def encode(df: DataFrame, path: str, text_col: str = "text", output_col: str = "ids") -> DataFrame:
    """Add the token ids of ``text_col`` under the tokenizer file ``path`` (present on every executor)."""
    return _add(df, clean_text(text_col), path, output_col, None)


def decode(df: DataFrame, path: str, ids_col: str = "ids", output_col: str = "decoded") -> DataFrame:
    """Add the text of ``ids_col``; null ids give an empty text."""
    return _add(df, F.coalesce(F.col(ids_col), F.array().cast("array<int>")), path, None, output_col)


def round_trip(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids",
               output_col: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` in one pass, so that the ids needn't go to Python again."""
    return _add(df, clean_text(text_col), path, ids_col, output_col)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    coded = round_trip(docs.select("doc_id", "text"), path).select("doc_id", "ids", "decoded")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lexiflow.llm import bpe
from tests.llm.helpers import odd_docs, odd_texts

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_encoder_equals_library_on_random_texts(whole):
    r = random.Random(5)
    alphabet = "abcdefghij'ßñé日😀ΣİÅ 1;.<|>\t́ń​\xa0\x1c\x85"
    texts = ["".join(r.choices(alphabet, k=r.randint(0, 60))) for _ in range(3000)]
    texts += ["a<|endoftext|>b <|startoftext|>", "İstanbul ΟΔΟΣ don't we'll", "a" * 3000, *(t or "" for _, t in odd_texts())]
    encoder = bpe.Encoder(PATH)
    got = encoder.encode_batch([t.encode() for t in texts]).to_pylist()
    assert got == [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]


def test_caches_may_be_emptied(whole, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_NODES", 5)
    monkeypatch.setattr(bpe, "MAX_PAIRS", 5)
    monkeypatch.setattr(bpe, "MAX_CHUNKS", 4)
    encoder = bpe.Encoder(PATH)
    for text in ("the walls of the river", "rivers walled off the otherwise", "the walls of the river"):
        assert encoder.encode_batch([text.encode()]).to_pylist() == [whole.encode(text, add_special_tokens=False).ids]


def test_shared_prefixes_are_encoded_once():
    encoder = bpe.Encoder(PATH)
    encoder.trie.encode_all(["walking", "walked", "walks"])
    nodes = len(encoder.trie.last)
    encoder.trie.encode_all(["walking", "walked", "walks"])
    assert len(encoder.trie.last) == nodes == 1 + len("walk") + len("in") + len("e")


def test_report_on_odd_rows(spark, whole):
    docs = odd_docs(spark)
    got = sorted((tuple(r) for r in bpe.digests(docs, PATH).collect()), key=str)
    want = []
    for i, t in odd_texts():
        ids = whole.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(whole.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.digests(docs.limit(0), PATH).collect() == []


def test_encode_then_decode_keeps_other_columns(spark):
    docs = odd_docs(spark).withColumnRenamed("score", "ids")
    both = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert set(both.columns) == set(docs.columns) | {"decoded"}
    once = bpe.round_trip(docs, PATH)
    key = lambda df: sorted(map(str, df.select("doc_id", "text", "ids", "decoded", "key").collect()))
    assert key(both) == key(once)

import hashlib
import random

import numpy as np
import pytest

from lexiflow.llm import minhash as M
from lexiflow.llm import substring as S
from lexiflow.llm.components import components
from tests.llm.helpers import odd_docs, odd_texts, prose, words


def shingles(text, width):
    w = [x.lower() for x in words(text)]
    if not w:
        return frozenset()
    width = min(width, len(w))
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))


def brute_links(rows, width):
    """(id, size, component) with rows that share an id told apart."""
    sets = [shingles(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if 100 * min(len(sets[i]), len(sets[j])) < 80 * max(len(sets[i]), len(sets[j])):
                continue
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), min(ids) if ids and sets[i] else doc))
    return out


def near_copies():
    r, rows, n = random.Random(9), [], 1000
    for group in range(6):
        base = prose(100 + group, 60).split()
        for _ in range(14):
            copy = list(base)
            for _ in range(r.choice([0, 1, 2, 3, 4, 6, 8])):
                copy[r.randrange(len(copy))] = f"new{r.randrange(10 ** 6)}"
            rows.append((n, " ".join(copy)))
            n += 1
    for k in range(40):  # a chain: neighbours are similar, ends aren't
        rows.append((n + k, " ".join(f"c{i}" for i in range(3 * k, 3 * k + 60))))
    r.shuffle(rows)
    return rows


order = lambda rows: sorted(rows, key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("width, block", [(2, 256), (2, 2), (5, 256)])
def test_links_equal_brute_force(spark, monkeypatch, width, block):
    monkeypatch.setattr(M, "BLOCK", block)
    rows = near_copies() + [r for r in odd_texts() if r[0] is not None]
    got = M.link(odd_docs(spark, rows), width).collect()
    assert order((r.doc_id, r.n_shingles, r.component_id) for r in got) == order(brute_links(rows, width))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_null_ids_and_empty_table(spark):
    got = M.report(odd_docs(spark)).collect()
    assert order((r.doc_id, r.n_shingles, r.component_id) for r in got) == order(brute_links(odd_texts(), 2))
    assert M.report(odd_docs(spark).limit(0)).collect() == []


def test_sketches_fill_and_estimate():
    r = np.random.default_rng(4)
    pool = r.integers(0, 2 ** 63, 4000, dtype=np.uint64)
    sets = [np.unique(pool[:n]) for n in (1, 2, 5, 400, 4000)] + [np.unique(pool[a:a + 1000]) for a in (0, 200)]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    sketch = M.sketches(owner, np.concatenate(sets), len(sets) + 1, 406)
    assert (sketch[:-1] != M.EMPTY).all() and (sketch[-1] == M.EMPTY).all()
    assert abs((sketch[5] == sketch[6]).mean() - 800 / 1200) < 0.1
    alone = M.sketches(np.zeros(5, np.int64), sets[2], 1, 406)
    assert (alone[0] == sketch[2]).all()  # a sketch depends on its set alone


def test_keep_one(spark):
    rows = near_copies() + odd_texts()
    docs = odd_docs(spark, rows)
    out = M.keep_one(docs, 2)
    assert out.columns == docs.columns
    first = {(i, t) for (i, t), (_, _, c) in zip(rows, brute_links(rows, 2)) if i == c}
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(first, key=str)


def test_components_of_paths_stars_and_nothing(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 200)]
    random.Random(1).shuffle(links)
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    want = {i: 0 for i in range(61)} | {100 + i: 100 for i in range(30)} | {200: 200, 201: 200}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_repeats(rows):
    last = S.LAST_ID
    rows = [(last if i is None else i, words(t)) for i, t in rows]
    first = {}
    for i, w in rows:
        for p in range(len(w) - 49):
            key = tuple(w[p:p + 50])
            first[key] = min(first.get(key, last), i)
    out = []
    for i, w in rows:
        gone = set()
        for p in range(len(w) - 49):
            if first[tuple(w[p:p + 50])] < i:
                gone.update(range(p, p + 50))
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((None if i == last else i, len(w), len(gone), kept))
    return out


def passages():
    r, rows = random.Random(11), []
    shared = [prose(500 + k, 55 + 7 * k).split() for k in range(4)]
    for i in range(40):
        text = prose(600 + i, r.choice([10, 40, 90])).split()
        for _ in range(r.choice([0, 1, 1, 2])):
            part, at = r.choice(shared), r.randrange(len(text))
            cut = r.choice([0, 0, 3, 8])
            text[at:at] = part[cut:]
        rows.append((2000 + i, " ".join(text)))
    rows += [(2100 + i, "ab cd " * (40 + i)) for i in range(4)]
    return rows


@pytest.mark.parametrize("large", [1000, 1])
def test_repeats_equal_brute_force(spark, monkeypatch, large):
    monkeypatch.setattr(S, "LARGE", large)
    rows = passages() + odd_texts()
    docs = odd_docs(spark, rows)
    key = lambda r: (r[0] is None, str(r))
    want = brute_repeats(rows)
    assert sum(w[2] for w in want) > 2000
    got = S.report(docs).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=key) == sorted(
        ((i, n, m, hashlib.sha256(k).hexdigest()) for i, n, m, k in want), key=key)
    if large > 1:
        texts = S.remove_repeats(docs).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in texts), key=key) == sorted(
            ((i, n, m, k.decode()) for i, n, m, k in want), key=key)
        for r in texts:
            assert sum(x.end - x.start for x in r.spans) == r.n_removed
            assert all(x.end - x.start >= 50 for x in r.spans)
            assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))
        assert S.report(docs.limit(0)).collect() == []


def test_windows_agree_on_equal_content():
    hashes, windows = S.WordHashes(), S.Windows()
    a, b = prose(1, 30).split(), prose(2, 70).split()
    p1, m1 = windows.of(hashes.of([w.encode() for w in a + b]))
    p2, m2 = windows.of(hashes.of([w.encode() for w in b]))
    assert (p1[30:] == p2).all() and (m1[30:] == m2).all() and len(set(m1.tolist())) == len(m1)


def test_only_bucket_mates_are_compared(spark):
    """A chain in which each text is similar at 0.74 to the next: one group of ties, and work that
    grows with the buckets, not with the square of the group."""
    r = random.Random(21)
    n = 1500
    stream = [f"v{r.randrange(10**9)}" for _ in range(15 * n + 100)]
    rows = [(i, " ".join(stream[15 * i:15 * i + 100])) for i in range(n)]  # neighbours share 84 of 114 shingles
    rows += [(n + i, t + " tail") for i, t in rows[:40]]                    # and some near copies of links of it
    docs = odd_docs(spark, rows)
    nodes = M.materialise(M._sketch_table(docs.select("doc_id", "text"), ["doc_id"], "text", 2).withColumn(
        "node", M.F.monotonically_increasing_id()), "t-nodes")
    buckets = M.materialise(M._shared_buckets(nodes), "t-buckets")
    pairs = buckets.groupBy("key").count().selectExpr("sum(count * (count - 1) / 2) AS p").first().p
    group = M.components(M._ties(buckets)).groupBy("component").count().agg(M.F.max("count")).first()[0]
    assert group > n / 3 and pairs < 20 * n
    got = {x.doc_id: x.component_id for x in M.link(docs, 2).collect()}
    assert got == {i: c for i, _, c in brute_links(rows, 2)}


def test_large_buckets_of_distant_texts_equal_brute_force(spark, monkeypatch):
    """Texts of one template, similar at about 0.7 to the leader and in families of near copies."""
    r = random.Random(5)
    base = [f"b{i}" for i in range(160)]
    rows = []
    for family in range(25):
        own = [w if r.random() < 0.9 else f"x{r.randrange(10**6)}" for w in base]
        for _ in range(r.randrange(1, 5)):
            rows.append((len(rows), " ".join(w if r.random() < 0.985 else f"y{r.randrange(10**6)}" for w in own)))
    for block in (256, 3):
        monkeypatch.setattr(M, "BLOCK", block)
        got = {x.doc_id: x.component_id for x in M.link(odd_docs(spark, rows), 2).collect()}
        assert got == {i: c for i, _, c in brute_links(rows, 2)}

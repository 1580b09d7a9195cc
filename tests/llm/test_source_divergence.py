import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from lexiflow.llm import source_divergence as D
from tests.llm.helpers import odd_docs, prose



def by_force(rows, least, top=50):
    """Everything in Python integers from (lang, source, text)."""
    found = []
    langs = defaultdict(list)
    for lang, source, text in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
        langs[lang or ""].append((source or "", Counter(re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in terms)))
    for lang, docs in langs.items():
        df = Counter(t for _, c in docs for t in c)
        kept = [t for t in df if df[t] >= least]
        counts = defaultdict(Counter)
        for source, c in docs:
            counts[source].update({t: n for t, n in c.items() if t in set(kept)})
            counts[source] += Counter()
        total = Counter()
        for c in counts.values():
            total.update(c)

        def price(c, t):
            return 1 + 10 ** 9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept))

        for source, c in counts.items():
            pairs = [(sum(abs(price(c, t) - price(o, t)) for t in kept), other) for other, o in counts.items() if other != source]
            terms = [(price(c, t) - price(total, t), t) for t in kept if c[t] > 0]
            for part, items in (("pair", pairs), ("term", [x for x in terms if x[0] > 0])):
                ordered = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                found += [(lang, source, part, item, value, k) for k, (value, item) in enumerate(ordered, 1)
                          if part == "pair" or k <= top]
    return sorted(found)


def docs_of(spark, rows):
    return spark.createDataFrame([(t, lang, s, 1, "x", 2, 3, 4) for lang, s, t in rows],
                                 "text string, lang string, source string, doc_id long, term string, v long, id int, block int")


def mixed(n=400):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(n):
        source = "hot" if k % 3 == 0 else f"s{rng.integers(0, 21)}" if k % 7 else None
        lang = [None, "", "de", "fr"][int(rng.integers(0, 4))]
        words = [f"{'Ää'[w % 2]}w{chr(97 + w % 26)}{'x' * (w // 26)}" for w in rng.zipf(1.4, 30) % 60]
        rows.append((lang, source, " ".join(words) + (" only" + chr(97 + k % 5)) * (k % 4)))
    return rows + [("xx", "alone", "word"), ("yy", "a", None), ("yy", "b", ""), ("de", "empty", None), ("de", "ZZ", "1 2 3")]


@pytest.mark.parametrize("block,tile,least", [(50_000, 8, 30), (3, 2, 30), (7, 50, 1)])
def test_equals_plain_counting(spark, block, tile, least):
    rows = mixed()
    got = D.divergence(docs_of(spark, rows), least, 50, block, tile)
    assert sorted(map(tuple, got.collect())) == by_force(rows, least)


def test_odd_and_empty_tables(spark):
    docs = odd_docs(spark)
    rows = [(r.lang, r.source, r.text) for r in docs.collect()]
    assert sorted(map(tuple, D.divergence(docs, 2).collect())) == by_force(rows, 2)
    assert D.report(docs.limit(0)).count() == 0
    assert sorted(map(tuple, D.report(docs).collect())) == by_force(rows, 30)


def test_report_equals_sql(spark):
    docs = docs_of(spark, mixed(600))
    con = duckdb.connect()
    documents = docs.select("lang", "source", "text").toPandas()  # noqa: F841
    assert sorted(map(tuple, D.report(docs).collect())) == sorted(con.execute(D.REPORT_SQL).fetchall())


def test_prices_are_exact():
    counts = [0, 1, 7, 10 ** 9, 10 ** 12, 8 * 10 ** 14]
    for total in (1, 5, 12345, 10 ** 9 + 7, 8_999_999_999_999_999):
        some = [c for c in counts if c <= total * 8]
        assert D.prices(np.array(some), total).tolist() == [1 + 10 ** 9 * (c + 5) // total for c in some]


def test_gallop_finds_shared_ids():
    rng = np.random.default_rng(1)
    for n, m in ((0, 0), (0, 5), (5, 0), (1, 1), (3, 1000), (500, 600), (700, 50_000)):
        a, b = (np.sort(rng.choice(60_000, k, replace=False)) for k in (n, m))
        x, y = D.gallop(a, b)
        assert a[x].tolist() == b[y].tolist() == sorted(set(a) & set(b))
    x, y = D.gallop(np.arange(300), np.arange(299, 400))
    assert x.tolist() == [299] and y.tolist() == [0]


def test_long_text_is_read_in_pieces(monkeypatch, spark):
    monkeypatch.setattr(D, "PIECE", 100)
    text = prose(3, 400)
    whole = Counter(t for part in D._pieces(text.encode().translate(D.TO_TERMS)) for t in part)
    assert whole == Counter(text.encode().translate(D.TO_TERMS).split())


def test_terms_keep_other_capitals():
    assert "ÄB É\x00z1y".encode().translate(D.TO_TERMS).split() == ["Äb".encode(), "É".encode(), b"z", b"y"]

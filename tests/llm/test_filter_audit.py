import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from lexiflow.llm import filter_audit as A
from tests.llm.helpers import odd_docs, odd_texts, prose

LABELS = "doc_id long, quality int, toxic int, part string, fails int, word int, good int"


def failures(rows, k):
    """The failed filters of row k by plain reading of the rules."""
    i, text = rows[k][0], rows[k][1] or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    copies = [j for j, t in rows if (t or "") == text and j is not None and i is not None and j < i]
    tests = (len(words) < 200, 100 * len(set(words)) < 50 * len(words),
             100 * len(re.findall("[A-Z]", text)) > 3 * len(text), bool(re.search(r"[#$%&*|]", text)), bool(copies))
    return {f for f, bad in zip("ABCDE", tests) if bad}


def by_force(rows, parts, marks):
    """All figures by running each order over the documents."""
    fails = [failures(rows, k) for k in range(len(rows))]
    good = [any(q == 1 for i, q, _ in marks if i is not None and i == r[0]) for r in rows]
    toxic = [any(t == 1 for i, _, t in marks if i is not None and i == r[0]) for r in rows]
    out, share = {}, Counter()
    for part in set(parts):
        mine = [k for k in range(len(rows)) if parts[k] == part]
        for order in map("".join, permutations("ABCDE")):
            alive = set(mine)
            for step, f in enumerate(order, 1):
                here = {k for k in alive if f in fails[k]}
                redundant = sum(f in fails[k] for k in mine) - len(here)
                alive -= here
                share[part, f] += len(here)
                out[part, order, step] = [len(alive), len(here), redundant, sum(fails[k] == {f} for k in mine),
                                          sum(good[k] for k in here), sum(toxic[k] for k in here)]
    return {key: tuple(v) + (share[key[0], key[1][key[2] - 1]],) for key, v in out.items()}


def cases():
    long = prose(7, 250)
    rows = odd_texts() + [(30, long), (31, long), (31, long + "#"), (32, "the " * 300), (33, prose(8, 300) + " $"),
                          (34, long.upper()), (29, long), (35, prose(9, 220)), (36, "")]
    marks = [(30, 1, 0), (30, None, 1), (31, 1, None), (33, 0, 1), (35, 1, 1), (None, 1, 1), (99, 1, 1), (7, None, None)]
    return rows, marks


def test_report_equals_every_order_run_in_turn(spark):
    rows, marks = cases()
    docs = odd_docs(spark, rows)
    labels = spark.createDataFrame([(*m, "x", 1, 2, 3) for m in marks], LABELS)
    parts = [r.lang or "" for r in docs.collect()]
    got = {tuple(r)[:3]: tuple(r)[3:] for r in A.report(docs, labels).collect()}
    assert got == by_force(rows, parts, marks)


def test_hot_text_and_hot_null_ids(spark):
    rows = [(i if i % 2 else None, "copy of one text") for i in range(900)] + [(1000 + i, prose(i, 5)) for i in range(700)]
    docs = odd_docs(spark, rows)
    marks = [(i, 1, i % 2) for i in range(0, 1700, 3)]
    labels = spark.createDataFrame([(*m, "x", 1, 2, 3) for m in marks], LABELS)
    got = {tuple(r)[:3]: tuple(r)[3:] for r in A.report(docs, labels).collect()}
    assert len(got) == 600 * len({r.lang for r in docs.collect()})
    assert sum(v[1] for k, v in got.items() if k[1:] == ("EABCD", 1)) == 449  # odd ids but the first


def test_empty_tables(spark):
    docs = odd_docs(spark)
    none = spark.createDataFrame([], LABELS)
    assert A.report(docs.limit(0), none).count() == 0
    out = A.report(docs, none)
    assert out.count() == 2 * 600 and out.filter("good_lost > 0 OR toxic_lost > 0").count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 64, 1000, 12345])
def test_carry_save_counts(n):
    words = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
    expect = [int(((words >> np.uint32(i)) & 1).sum()) for i in range(32)]
    assert A.bit_counts(words).tolist() == expect


def test_survival_words(spark):
    words = {r.f: r.w & 0xFFFFFFFF for r in spark.range(32).selectExpr("CAST(id AS INT) f").select(
        "f", A.survival_word(A.F.col("f")).alias("w")).collect()}
    assert all(words[f] >> s & 1 == (f & s == 0) for f in range(32) for s in range(32))


def test_long_text_is_read_in_pieces():
    text = ("word " * 300_000 + "é" * 2_000_000 + " $").encode()
    assert b"".join(A.pieces(text)) == text and len(list(A.pieces(text))) > 1
    assert A.failed(text) == 0b1010

"""Small tables with the cases every operator must stand."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id long, score string, "
          "node string, key string, row string, kept string")
WORDS = "the of and rain falls on old stone walls while quiet birds sing near the river bank".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", ",", "."]) + str(r.randrange(40)) for _ in range(n))


def odd_texts() -> list[tuple]:
    long = prose(1, 9000)
    base = prose(2, 120)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "two words"), (6, "Two WORDS"), (7, base),
            (8, base.replace(" ", "  \n")), (9, base + " tail"), (10, long), (11, long + " end"), (12, "ÀÉ ñandú 日本 😀"),
            (13, "a b c d e " * 40), (14, prose(3, 60) + " " + " ".join(base.split()[10:90])), (15, prose(4, 70)),
            (16, "x" * 5000), (15, prose(4, 70)), (17, base), (None, base), (None, None), (18, prose(5, 55)),
            (18, prose(6, 55)), (19, " nbsp em\x1cfs\x85nel"), (20, None)]
    return rows


def odd_docs(spark, rows=None):
    """The odd texts as documents with null languages and further columns of clashing names."""
    rows = odd_texts() if rows is None else rows
    data = [(i, t, None if (i or 0) % 3 else "en", None if (i or 0) % 4 == 1 else "s", len(t or ""), 7, "x", None,
             "k", "r", "no") for i, t in rows]
    return spark.createDataFrame(data, SCHEMA)


def words(text) -> list[bytes]:
    return (text or "").encode().split()

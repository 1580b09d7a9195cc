"""DuckDB SQL for the queries of ``checks``."""

from __future__ import annotations

from . import oracle as O

BAD = "regexp_matches(line, '^[A-D]')"

LINES = r"""WITH parts AS (
  SELECT CAST(((doc_id % 10) + 10) % 10 AS INTEGER) AS tenth, lang, unnest(string_split(text, chr(10))) AS line FROM documents)"""

SQL: dict[str, str] = {}

SQL["labeled_files"] = f"""{LINES}
SELECT tenth, string_split(line, ';')[1] AS text, string_split(line || ';' || lang, ';')[2] AS emotion, count(*) AS n
FROM parts WHERE NOT {BAD} GROUP BY ALL"""

SQL["malformed_lines"] = f"""{LINES}
SELECT tenth, replace(line, ';', ',') AS line, count(*) AS n FROM parts WHERE {BAD} GROUP BY ALL"""

SQL["feature_digests"] = f"""WITH {O.DOCS}
SELECT name AS feature_set, split, count(*) AS n_rows, true AS same
FROM docs, (VALUES ('G1'), ('G2'), ('G3'), ('G4')) AS s(name) GROUP BY ALL"""

SQL["results_csv"] = O.SQL["nb_results"]

# MurmurHash3 (x86, 32 bits, seed 42) of the UTF-8 bytes, by arithmetic modulo 2^32.
MASK = "4294967295"


def _turn(x: str, by: int) -> str:
    return f"((({x}) << {by}) & {MASK} | (({x}) >> {32 - by}))"


def _mixed(x: str) -> str:
    first = f"(({x}) * 3432918353 & {MASK})"
    return f"({_turn(first, 15)} * 461845907 & {MASK})"


def _little(start: str, size: int) -> str:
    """The 1 to 4 bytes from ``start`` (0-based) of the hex text h as an unsigned number."""
    return "(" + " + ".join(f"CAST('0x' || substr(h, 2 * ({start} + {i}) + 1, 2) AS UBIGINT) * {256 ** i}"
                            for i in range(size)) + ")"


SQL["hashed_bigrams"] = f"""{O.BASE},
{O.G1_TOKENS},
grams AS (SELECT doc_id, unnest(list_transform(range(1, greatest(len(toks), 1)), lambda i: toks[i] || ' ' || toks[i + 1])) AS gram
          FROM g1tok),
counted AS (SELECT doc_id, gram, count(*) AS n FROM grams GROUP BY ALL),
hexed AS (SELECT gram, hex(gram) AS h, CAST(length(hex(gram)) // 2 AS UBIGINT) AS size FROM (SELECT DISTINCT gram FROM grams)),
words AS (SELECT gram, h, size, list_transform(range(CAST(size // 4 AS BIGINT)), lambda i: {_little('4 * i', 4)}) AS k FROM hexed),
body AS (SELECT gram, h, size, CAST(4 * (size // 4) AS BIGINT) AS pos, list_reduce(
           list_concat([CAST(42 AS UBIGINT)], k), lambda a, k: ({_turn(f'xor(a, {_mixed("k")})', 13)} * 5 + 3864292196) & {MASK}) AS a
         FROM words),
tailed AS (SELECT gram, size, CASE size % 4 WHEN 1 THEN xor(a, {_mixed(_little('pos', 1))})
             WHEN 2 THEN xor(a, {_mixed(_little('pos', 2))}) WHEN 3 THEN xor(a, {_mixed(_little('pos', 3))}) ELSE a END AS a
           FROM body),
f0 AS (SELECT gram, xor(a, size) AS a FROM tailed),
f1 AS (SELECT gram, (xor(a, a >> 16) * 2246822507) & {MASK} AS a FROM f0),
f2 AS (SELECT gram, (xor(a, a >> 13) * 3266489909) & {MASK} AS a FROM f1),
f3 AS (SELECT gram, xor(a, a >> 16) AS a FROM f2),
hashed AS (SELECT gram, CAST(((CASE WHEN a >= 2147483648 THEN CAST(a AS BIGINT) - 4294967296 ELSE CAST(a AS BIGINT) END) % 1000 + 1000)
                             % 1000 AS INTEGER) AS bucket FROM f3)
SELECT doc_id, bucket, CAST(sum(n) AS BIGINT) AS n FROM counted JOIN hashed USING (gram) GROUP BY ALL"""

_TRAIN = f"""{O.BASE}
SELECT label, count(*) AS n, true AS objective_ok, true AS descent_ok FROM prepared WHERE split = 'train' GROUP BY label"""
SQL["svm_fit_checked"] = _TRAIN
SQL["logreg_fit_checked"] = _TRAIN
SQL["mlp_fit_checked"] = f"WITH {O.DOCS}\nSELECT count(*) AS n, true AS ok FROM docs WHERE split = 'train'"

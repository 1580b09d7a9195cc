r"""Secret scans over a trigram inverted index.

1. ``trigram_query`` reads a regular expression and derives what every match must contain: a Boolean query over lower-case
   trigrams (``and`` over a string's trigrams, ``or`` over alternatives).  Rules without a mandatory trigram have none
   and scan every text.
2. ``build_index``: rows are numbered and written once; posting lists (trigram, block of 65,536 row numbers,
   rows) hold, for each trigram that some rule asks for, the rows that contain it.  A list is never longer than
   its block, however common the trigram.
3. ``candidates``: within each block, posting lists are intersected and united as the queries say.
4. ``spans_of``: the rule's expression runs on its candidates only (on all rows for rules without a query).
   The text between matches and the matches themselves give the positions as running sums.

Only DataFrame functions.  Two shuffles carry a block's posting lists and the spans found; texts move only when the candidates
are joined with them, which Spark broadcasts when their written size allows it.  Index and rules are
separate, so a rule whose trigrams are in the index can be asked for later (``scan`` checks that they are).

Matches are leftmost and don't overlap within a kind, positions count code points, ends are exclusive.  A match whose
value (group 1) is shorter than the rule's least length is dropped; the text it took is still taken.

Defined results: null text counts as empty; every row gives a row, rows with null or repeated ids too; spans with the
same start follow in the order of the rules; texts of any length are read whole; further columns are not
read; an empty table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from re import _parser as parser

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import clean_text, materialise

#: Row numbers of a posting list differ in their last BLOCK_BITS bits only.
BLOCK_BITS = 16
#: Most strings that an alternative is multiplied out to.
MOST_STRINGS = 64

#: None: anything may match.  A trigram, or ("and" / "or", queries).
Query = None | str | tuple[str, tuple]


@dataclass(frozen=True)
class Rule:
    """A kind of secret.  ``pattern`` means the same in Java, Python and RE2; its group 1 is the value, of at
    least ``least`` code points."""
    kind: str
    pattern: str
    least: int = 1


def either_case(*words: str) -> str:
    """Alternatives in ASCII letters of either case; ``_?`` stays as it is."""
    return "|".join(re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", w) for w in words)


#: Base rules.  A run of hex digits is maximal, so asking for 16 of them at once finds the runs of 16 or more.
BASE = (
    Rule("assign", f"(?:{either_case('password', 'passwd', 'secret', 'token', 'api_?key')})"
         r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12),
    Rule("access", "(AKIA[A-Z0-9]+)", 18),
    Rule("hex", "([0-9a-f]{16,})", 16),
)
#: Further rules: formats of keys that their issuers have published, and passwords inside addresses.
MORE = (
    Rule("private", "(-----BEGIN [A-Z ]*PRIVATE KEY-----)"),
    Rule("github", "(gh[pousr]_[A-Za-z0-9]{36,})"),
    Rule("slack", "(xox[abprs]-[A-Za-z0-9-]{10,})"),
    Rule("google", "(AIza[A-Za-z0-9_-]{35})"),
    Rule("stripe", "([sr]k_live_[A-Za-z0-9]{16,})"),
    Rule("jwt", r"(eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})"),
    Rule("url", r"(://[^\x20\x09-\x0D/:@]+:[^\x20\x09-\x0D/:@]+@)"),
)
RULES = BASE + MORE


def _both(kind: str, queries: list[Query]) -> Query:
    """``queries`` joined by and / or, without repeats and empty levels."""
    if kind == "or" and None in queries:
        return None
    found: list[Query] = []
    for q in queries:
        for one in q[1] if isinstance(q, tuple) and q[0] == kind else [q]:
            if one is not None and one not in found:
                found.append(one)
    return None if not found else found[0] if len(found) == 1 else (kind, tuple(found))


def _strings(strings: set[str]) -> Query:
    """A text holds one of ``strings``; an alternative that asks for more than another says nothing new."""
    ways = {s: {s[i:i + 3] for i in range(len(s) - 2)} for s in sorted(strings, key=lambda s: (len(s), s))}
    plain = [s for s in ways if not any(ways[t] <= ways[s] and (ways[t] < ways[s] or t < s) for t in ways)]
    return _both("or", [_both("and", [s[i:i + 3] for i in range(len(s) - 2)]) for s in plain])


def _letters(items: list) -> set[str] | None:
    """The lower-case characters of a class; None if there are many, or any outside ASCII."""
    found: set[str] = set()
    for op, value in items:
        if op is parser.LITERAL:
            low, high = value, value
        elif op is parser.RANGE:
            low, high = value
        else:
            return None
        if high > 127 or high - low > MOST_STRINGS:
            return None
        found |= {chr(c).lower() for c in range(low, high + 1)}
    return found if len(found) <= 8 else None


def _item(op, value) -> tuple[set[str] | None, Query]:
    """What an item of a parsed expression is exactly (None if open-ended), and else its query."""
    if op is parser.LITERAL and value < 128:
        return {chr(value).lower()}, None
    if op is parser.IN:
        return _letters(value), None
    if op in (parser.AT, parser.ASSERT, parser.ASSERT_NOT):
        return {""}, None
    if op is parser.SUBPATTERN:
        return _sequence(value[3])
    if op is parser.BRANCH:
        ways = [_sequence(way) for way in value[1]]
        if all(exact is not None for exact, _ in ways):
            exact = set().union(*(exact for exact, _ in ways))
            if len(exact) <= MOST_STRINGS:
                return exact, None
        return None, _both("or", [_strings(e) if e is not None else q for e, q in ways])
    if op in (parser.MAX_REPEAT, parser.MIN_REPEAT):
        least, most, inner = value
        exact, query = _sequence(inner)
        if exact is not None and (least, most) == (0, 1):
            return exact | {""}, None
        if exact is not None and least == most and len(exact) ** least <= MOST_STRINGS:
            return reduce(lambda a, b: {x + y for x in a for y in b}, [exact] * least, {""}), None
        return None, None if least == 0 else _strings(exact) if exact is not None else query
    return None, None


def _sequence(items) -> tuple[set[str] | None, Query]:
    run, queries, whole = {""}, [], True
    for op, value in items:
        exact, query = _item(op, value)
        if exact is not None and len(exact) * len(run) <= MOST_STRINGS:
            run = {a + b for a in run for b in exact}
            continue
        queries += [_strings(run), _strings(exact) if exact is not None else query]
        run, whole = {""}, False
    return (run, None) if whole else (None, _both("and", [*queries, _strings(run)]))


def trigram_query(pattern: str) -> Query:
    """What a lower-cased text must contain for ``pattern`` to match; None if that says nothing."""
    exact, query = _sequence(parser.parse(pattern))
    return _strings(exact) if exact is not None else query


def trigrams(query: Query) -> set[str]:
    if query is None or isinstance(query, str):
        return {query} - {None}
    return set().union(*map(trigrams, query[1]))


def numbered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, text) written once, so that row numbers stay what they are."""
    return materialise(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                                   clean_text(text_col).alias("text")), "numbered")


def build_index(rows: DataFrame, terms: set[str]) -> DataFrame:
    """Posting lists (trigram, block, rows) of ``terms`` over (row, text); lists are sorted."""
    low = rows.select("row", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in sorted(terms)]))
    # outer: else Spark evaluates the list once more to see that it isn't empty
    found = low.select("row", F.explode_outer(held).alias("trigram")).filter("trigram IS NOT NULL")
    return found.groupBy("trigram", F.shiftright("row", BLOCK_BITS).alias("block")).agg(
        F.sort_array(F.collect_list("row")).alias("rows"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(row, kinds): rows that may match, by the rules that have a query."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    lists = index.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "rows"))).alias("lists"))
    none = F.array().cast("array<bigint>")

    def rows_of(query: Query) -> Column:
        if isinstance(query, str):
            return F.coalesce(F.try_element_at("lists", F.lit(query)), none)
        return reduce(F.array_intersect if query[0] == "and" else F.array_union, map(rows_of, query[1]))

    each = [F.struct(F.lit(kind).alias("kind"), rows_of(q).alias("rows")) for kind, q in queries.items() if q is not None]
    if not each:
        return index.select(F.lit(0).cast("long").alias("row"), F.array(F.lit("")).alias("kinds")).limit(0)
    by_rule = lists.select(F.explode(F.array(*each)).alias("c")).select("c.kind", F.explode("c.rows").alias("row"))
    return by_rule.groupBy("row").agg(F.collect_set("kind").alias("kinds"))


def spans_of(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(row, kind, rank, start, end, value) of the matches in (row, text, kinds)."""
    known = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(k).alias("rank"), F.lit(r.pattern).alias("pattern"),
                               F.lit(r.least).alias("least")) for k, r in enumerate(rules)])
    asked = texts.select("row", "text", F.explode(F.filter(known, lambda r: F.array_contains("kinds", r["kind"]))).alias("r"))
    hits = asked.select("row", "text", "r.*", F.regexp_extract_all("text", F.col("r.pattern"), F.lit(0)).alias("hits"))
    hits = hits.filter(F.size("hits") > 0)
    gaps = F.transform(F.split("text", F.col("pattern"), F.lit(-1)), lambda x: F.length(x).cast("long"))
    placed = hits.select("row", "kind", "rank", "least", F.posexplode(F.arrays_zip(
        gaps.alias("gap"), F.transform("hits", F.length).alias("size"),
        F.regexp_extract_all("text", F.col("pattern"), F.lit(1)).alias("value"))).alias("at", "m"))
    upto = Window.partitionBy("row", "rank").orderBy("at")
    ended = placed.filter("m.size IS NOT NULL").withColumn("end", F.sum(F.col("m.gap") + F.col("m.size")).over(upto))
    return ended.filter(F.length("m.value") >= F.col("least")).select(
        "row", "kind", "rank", (F.col("end") - F.col("m.size")).alias("start"), "end", "m.value")


def scan(rows: DataFrame, index: DataFrame, terms: set[str], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``spans_of`` all ``rows`` (row, text) by ``index``, which holds the trigrams ``terms``."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    unknown = set().union(*map(trigrams, queries.values())) - terms
    if unknown:
        raise ValueError(f"the index has no lists for {sorted(unknown)}")
    found = materialise(candidates(index, rules), "candidates")
    texts = rows.select("row", "text").join(found, "row")
    everywhere = [F.lit(kind) for kind, q in queries.items() if q is None]
    if everywhere:
        texts = texts.unionByName(rows.select("row", "text", F.array(*everywhere).alias("kinds")))
    return spans_of(texts, rules)


def report(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row."""
    rows = numbered(docs)
    terms = set().union(*(trigrams(trigram_query(r.pattern)) for r in rules))
    index = materialise(build_index(rows, terms), "postings")
    spans = materialise(scan(rows, index, terms, rules), "spans")
    by_row = spans.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "rank", "kind", "end"))).alias("s"))
    found = rows.select("row", "id").join(by_row, "row", "left")
    s = F.coalesce("s", F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>"))

    def line(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def n(kind: str) -> Column:
        return F.size(F.filter(s, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(s, lambda x: x["rank"] < len(BASE))
    return found.select(F.col("id").alias("doc_id"), *[n(r.kind) for r in BASE],
                        F.sha2(line(base), 256).alias("base_sha256"), line(s).alias("spans"))


def _sql_rules() -> str:
    return ",\n  ".join("({}, {}, '{}', {})".format(k, f"'{r.kind}'", r.pattern.replace("'", "''"), r.least)
                        for k, r in enumerate(RULES))


REPORT_SQL = rf"""
WITH rules(rank, kind, pattern, least) AS (VALUES
  {_sql_rules()}),
t AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
m AS (SELECT row, rank, kind, least, regexp_extract_all(text, pattern, 0) AS hits,
             regexp_extract_all(text, pattern, 1) AS vals, regexp_split_to_array(text, pattern) AS gaps
      FROM t, rules WHERE regexp_matches(text, pattern)),
x AS (SELECT row, rank, kind, least, unnest(hits) AS hit, unnest(vals) AS val,
             unnest(list_slice(gaps, 1, len(hits))) AS gap, unnest(range(len(hits))) AS k FROM m),
p AS (SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY row, rank ORDER BY k) AS ended FROM x),
s AS (SELECT row, rank, kind, CAST(ended - length(hit) AS BIGINT) AS start,
             kind || ':' || CAST(ended - length(hit) AS BIGINT) || ':' || CAST(ended AS BIGINT) AS span
      FROM p WHERE length(val) >= least),
g AS (SELECT row, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(span, ',' ORDER BY start, rank) FILTER (rank < {len(BASE)}) AS base,
             string_agg(span, ',' ORDER BY start, rank) AS spans FROM s GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN g USING (row)
"""

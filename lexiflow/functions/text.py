"""Column expressions for parsing and cleaning text.

Everything here is a plain Catalyst expression (``regexp_replace``, ``split``,
``get``...), so it runs inside whole-stage codegen with no Python on the
executors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cleaning patterns, applied in this order.
TAG_PATTERN = r"<[^>]+>"
# [^a-zA-Z ], said so that Java makes no negated union of it: the tasks of a JVM slow each other down tenfold in those.
NON_LETTER_PATTERN = r"[\P{Alpha}&&[^ ]]"
SHORT_WORD_PATTERN = r"\b\w{1,2}\b"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_quote(literal: str) -> str:
    """Quote a literal separator for Java regex functions such as ``split``."""
    return "\\Q" + literal.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def split_part(c: str | Column, sep: str, index: int) -> Column:
    """Part ``index`` (0-based) of ``c`` split on the literal ``sep``; null if absent.

    ``F.get`` returns null past the end, where ``getItem`` raises under ANSI mode.
    """
    return F.get(F.split(_col(c), java_quote(sep)), F.lit(index))


def strip_tags(c: str | Column) -> Column:
    """Remove ``<...>`` tags with nothing in their place (neighbours join)."""
    return F.regexp_replace(_col(c), TAG_PATTERN, "")


def keep_letters(c: str | Column) -> Column:
    """Keep ASCII letters and spaces only; digits, newlines and accents vanish."""
    return F.regexp_replace(_col(c), NON_LETTER_PATTERN, "")


def drop_short_words(c: str | Column) -> Column:
    """Remove words of one or two characters, leaving the spaces around them."""
    return F.regexp_replace(_col(c), SHORT_WORD_PATTERN, "")


def clean_text(c: str | Column) -> Column:
    """Tags, then non-letters, then short words; case is kept.

    The order matters: the apostrophe of "I'm" is removed before short words
    are, so "Im" is then dropped as a two-letter word.
    """
    return drop_short_words(keep_letters(strip_tags(c)))


def join_tokens(c: str | Column, sep: str = " ") -> Column:
    """Join an array of strings with ``sep``."""
    return F.array_join(_col(c), sep)

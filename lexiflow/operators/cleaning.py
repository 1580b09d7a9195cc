"""Cleaning of texts as Arrow columns.

``functions/text.py`` cleans by three of Java's regular expressions, which turn each text into a Java string and back and go
through it a character at a time.  Here the same three patterns run over the bytes of a few MB of texts at once: what they
keep is ASCII, so that a letter beyond it goes whether it is read as one character or as its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import SHORT_WORD_PATTERN, TAG_PATTERN
from .lemma import text_parts

#: ``NON_LETTER_PATTERN`` of bytes, a run at a time.
NON_LETTERS = "[^a-zA-Z ]+"


def cleaned(texts: pa.Array) -> pa.Array:
    """Tags, then non-letters, then short words go; null texts stay null."""
    found = texts.cast(pa.binary())
    for pattern in (TAG_PATTERN, NON_LETTERS, SHORT_WORD_PATTERN):
        found = pc.replace_substring_regex(found, pattern, "")
    return found.cast(texts.type)


def clean_text(text_col: str) -> Column:
    """What ``functions.text.clean_text`` makes of the column; the session needs ``workers_import``."""
    @F.arrow_udf("string")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.concat_arrays([cleaned(p) for p in text_parts(texts)] or [texts])

    return clean(text_col)

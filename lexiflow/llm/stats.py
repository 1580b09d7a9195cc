"""Statistics of whole texts, measured in one pass over each text.

Words are runs of anything but ASCII white space.  An empty text has zero of everything.
"""

from __future__ import annotations

import numpy as np

#: Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = b"0123456789"
MARKS = b".,;:!?'\"()[]{}-_/\\@+=~^`"

#: What ``measure`` returns, in order.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct",
          "n_adjacent", "n_top", "n_upper", "n_caps_words", "n_digits", "n_marks", "n_exclaim", "n_periods",
          "n_pipes", "n_short")


def repeated(ids: np.ndarray, kinds: int) -> int:
    """Words inside a 3-word window that occurs at least twice."""
    if len(ids) < 4:
        return 0
    if kinds < 1 << 21:
        windows = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
    else:
        pairs = np.unique(ids[:-1] * kinds + ids[1:], return_inverse=True)[1].reshape(-1)
        windows = pairs[:-1] * kinds + ids[2:]
    _, where, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[where.reshape(-1)] > 1
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[shift:shift + len(again)] |= again
    return int(covered.sum())


def removed(text: bytes, characters: bytes) -> int:
    return len(text) - len(text.translate(None, characters))


def measure(text: str) -> tuple[int, ...]:
    """The counts named in ``COUNTS`` for one text."""
    raw = text.encode("utf-8")
    words = raw.split()
    kinds: dict[bytes, int] = {}
    ids = np.fromiter((kinds.setdefault(w, len(kinds)) for w in words), np.int64, len(words))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (len(words), len(text) - removed(raw, b" \t\n\x0b\x0c\r"), removed(raw, SYMBOLS),
            len(lines) - len(set(lines)), repeated(ids, len(kinds)), len(lines), len(kinds),
            int((ids[1:] == ids[:-1]).sum()), int(np.bincount(ids).max()) if words else 0,
            removed(raw, UPPER), sum(map(bytes.isupper, words)), removed(raw, DIGITS), removed(raw, MARKS),
            raw.count(b"!"), raw.count(b"."), raw.count(b"|"), sum(len(w) < 2 for w in words))

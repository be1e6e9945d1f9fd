"""Per-text counts used by the quality rules and the quality classifier.

Words are maximal runs without ASCII white space (space, tab, \\n, \\v, \\f,
\\r), which is what ``bytes.split`` gives. All counts are of whole texts and
exact; memory is linear in the longest text.
"""

from __future__ import annotations

import numpy as np

SYMBOLS = b"#*$%&|<>"
WINDOW = 8


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in ``window``-word windows (``window`` at least 2) that occur
    twice or more, the first occurrence included.

    Words become numbers, then runs of 2, 4, ... words become the rank of
    their two halves; two windows are equal exactly if their ranks are.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    rank = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    if len(seen) == len(words):
        return 0
    size = 1
    while size < window:
        step = min(size, window - size)  # the halves may overlap
        pair = rank[:-step] * len(words) + rank[step:]
        _, rank, times = np.unique(pair, return_inverse=True, return_counts=True)
        if len(times) == len(pair):
            return 0  # runs of this size are all different, so are the windows
        size += step
    edge = np.zeros(len(words) + 1, np.int64)
    start = np.flatnonzero(times[rank] > 1)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + window, -1)
    return int(np.count_nonzero(np.cumsum(edge)))


def duplicate_lines(lines: list[bytes]) -> int:
    """Lines with a word that equal an earlier line."""
    return len(lines) - len(set(lines))


def word_counts(text: bytes | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines
    (lines with a word)."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (len(words), len(b"".join(words).decode("utf-8", "replace")), len(text) - len(text.translate(None, SYMBOLS)),
            duplicate_lines(lines), repeated_words(words), len(lines))


__all__ = ["SYMBOLS", "WINDOW", "repeated_words", "duplicate_lines", "word_counts"]

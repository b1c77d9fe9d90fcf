"""Counts over whole texts, by numpy inside tasks."""

from __future__ import annotations

import numpy as np

#: Fixed sets of the rules: white space between words, and symbol characters.
SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
_WIDE = 1 << 20


def codes(words: list) -> np.ndarray:
    """A number for each distinct word, in order of first sight."""
    seen: dict = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def repeat_words(c: np.ndarray, width: int = 3) -> int:
    """Words (as codes) that lie in a window of ``width`` words found twice or more; exact for any number of words."""
    n = len(c) - width + 1
    if n < 2:
        return 0
    key = c[:n]
    for i in range(1, width):
        if i > 1 or len(c) > _WIDE:
            key = np.unique(key, return_inverse=True)[1]
        key = key * (int(c.max()) + 1) + c[i : n + i]
    _, back, times = np.unique(key, return_inverse=True, return_counts=True)
    twice = times[back] > 1
    mark = np.zeros(len(c) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(mark, at, 1)
    np.add.at(mark, at + width, -1)
    return int(np.count_nonzero(np.cumsum(mark)[:-1]))


def duplicate_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
    return len(lines), len(lines) - len(set(lines))


def byte_counts(text: bytes) -> np.ndarray:
    return np.bincount(np.frombuffer(text, np.uint8), minlength=256)


SYMBOL_CODES = np.frombuffer(SYMBOLS, np.uint8)
SPACE_CODES = np.frombuffer(SPACES, np.uint8)


def rule_counts(text: bytes) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    words = text.split()
    seen = byte_counts(text)
    chars = len(text) - int(seen[128:192].sum()) - int(seen[SPACE_CODES].sum())
    lines, dup = duplicate_lines(text)
    return len(words), chars, int(seen[SYMBOL_CODES].sum()), lines, dup, repeat_words(codes(words))

"""Repetition coverage: how much of a text lies inside repeated n-grams and lines.

A text is read as UTF-8 bytes. Words are runs of bytes other than the six ASCII spaces; every word gets a 64-bit rolling
hash from prefix sums, and n-gram hashes for all lengths grow from the ones a word shorter, all in numpy. An n-gram
that occurs twice or more (the first included) covers its words; the coverage of a length is the share of the words'
characters that are covered. Lines that equal an earlier line cover theirs. A text fails when a coverage exceeds its
limit, when it has fewer than MIN_WORDS words, when its 3-word windows repeat over most words, or when it has over
SYMBOL_PERCENT symbols for every hundred words, as tables and debris of markup have.

Null is the empty text: no words, so it fails. Each row is judged alone, so ties and repeated rows get equal results; an
empty table gives an empty one.
Memory is a few arrays of the longest text.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .shared import map_texts, utf8

MIN_WORDS = 50
#: Greatest share of word characters inside repeated n-grams, by n. Far above what one line said twice makes of a
#: short clean text, far below what looped text reaches.
NGRAM_LIMITS = {5: 0.40, 6: 0.39, 7: 0.38, 8: 0.37, 9: 0.36, 10: 0.35}
LINE_LIMIT = 0.35
#: Most symbols for a hundred words; the limit that published rule sets give for symbols.
SYMBOL_PERCENT = 10
#: Greatest percentage of words in repeated 3-word windows.
WINDOW_PERCENT = 50

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def _grow(n: int) -> None:
    """Powers of the base and of its inverse modulo 2 ** 64, kept for the longest text so far."""
    global _powers, _inverse
    if len(_powers) < n:
        m = 1 << (n - 1).bit_length()
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(m - 1, _BASE))), dtype=np.uint64)
        _inverse = np.cumprod(np.concatenate(([np.uint64(1)], np.full(m - 1, inverse))), dtype=np.uint64)


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end byte of each word."""
    edge = np.diff(np.concatenate(([True], SPACE[data], [True])).view(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _grow(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers[: len(data)], out=sums[1:])
    h = (sums[end] - sums[start]) * _inverse[start]
    h = (h ^ (h >> np.uint64(31))) * _MIX
    h = (h ^ (h >> np.uint64(27))) * _STEP
    return h ^ (h >> np.uint64(33))


def covered(grams: np.ndarray, n: int, n_words: int) -> np.ndarray | None:
    """Which words lie in an n-gram that occurs twice or more; None if there is none."""
    ordered = np.sort(grams)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if twice.size == 0:
        return None
    at = np.minimum(np.searchsorted(twice, grams), twice.size - 1)
    hit = np.flatnonzero(twice[at] == grams)
    steps = np.zeros(n_words + 1, np.int32)
    steps[hit] += 1
    np.subtract.at(steps, hit + n, 1)
    return np.cumsum(steps[:-1]) > 0


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SHARES = ["dup_line_share", *(f"dup_{n}gram_share" for n in NGRAM_LIMITS)]


def measure(text: str | None) -> list:
    """COLUMNS, then SHARES of one text."""
    raw = utf8(text)
    data = np.frombuffer(raw, np.uint8)
    start, end = word_spans(data)
    n = len(start)
    if n == 0:
        return [0, 0, int(SYMBOL[data].sum()), 0, 0, *([0.0] * len(SHARES))]
    first_bytes = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    chars = first_bytes[end] - first_bytes[start]
    total = int(chars.sum())
    seen: set[bytes] = set()
    dup_lines = dup_line_chars = 0
    for line in raw.split(b"\n"):
        if line in seen:
            dup_lines += 1
            dup_line_chars += sum(len(w.decode("utf-8", "surrogatepass")) for w in line.split())
        elif line and not line.isspace():
            seen.add(line)
    m = word_hashes(data, start, end)
    repeat, shares, grams = 0, [], m
    for size in range(2, max(NGRAM_LIMITS) + 1):
        if n < size:
            break
        grams = grams[: n - size + 1] * _STEP + m[size - 1 :]
        if size == 3 and (hit := covered(grams, 3, n)) is not None:
            repeat = int(hit.sum())
        elif size in NGRAM_LIMITS:
            if (hit := covered(grams, size, n)) is None:
                break  # no longer one repeats either
            shares.append(float(chars[hit].sum()) / total)
        elif size == 3:
            break
    shares += [0.0] * (len(NGRAM_LIMITS) - len(shares))
    return [n, total, int(SYMBOL[data].sum()), dup_lines, repeat, dup_line_chars / total, *shares]


def repetition(docs: DataFrame, columns: list[str] | None = None, text: str = "text") -> DataFrame:
    """docs (or the given columns of it) plus COLUMNS, SHARES, base_failed and kept; such names in docs are replaced."""
    added = [*COLUMNS, *SHARES, "base_failed", "kept"]
    columns = [c for c in (docs.columns if columns is None else columns) if c not in added]
    limits = np.array([LINE_LIMIT, *NGRAM_LIMITS.values()])
    fields = [T.StructField(c, T.LongType()) for c in COLUMNS] + [T.StructField(c, T.DoubleType()) for c in SHARES] + [T.StructField(c, T.BooleanType()) for c in ("base_failed", "kept")]

    def values(texts):
        found = [measure(t) for t in texts]
        failed = [x[0] < MIN_WORDS or 100 * x[4] > WINDOW_PERCENT * x[0] for x in found]
        kept = [not f and 100 * x[2] <= SYMBOL_PERCENT * x[0] and bool((np.array(x[5:]) <= limits).all()) for f, x in zip(failed, found)]
        return [*map(list, zip(*found)), failed, kept]

    return map_texts(docs, columns, text, fields, lambda: values)

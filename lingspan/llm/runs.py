"""Periodic runs of words: maximal stretches that repeat with a smallest period, found by a suffix automaton.

The words of a text enter a suffix automaton. Its suffix links form a tree in which the path from a prefix's state to
the root holds that prefix's suffixes, longest first. Every state carries the last word number at which its strings ended;
words are visited in order, and each recolours its whole path with its own number. States that share an old number lie
together on the path, and the deepest of them says how long a suffix ended there before. If the distance between the
old and the new end is within that length, the two occurrences touch or overlap: a square, and with the whole length its
run. A run shows up at every end from its second period on, always under its smallest period, since a longer distance
would have met a later end first; so the last end seen for (period, start) is the run's end.

The access is that of link-cut trees with heavy paths as preferred paths: the automaton is complete before the first
access, so no link is cut any more, and a stack of coloured segments for each heavy path takes the place of splay trees.
A path meets O(log n) heavy paths and pushes one segment on each, which bounds all pops: O(n log n) for n words.

Only stretches that can hold a run enter an automaton. In a run of at least MIN_LENGTH words, every word lies in a window
of WINDOW words that occurs a second time in the run; so a stretch of words not covered by repeated windows cuts the
text, and the pieces are cut again until nothing changes. Windows are compared by 64-bit hashes; equal windows have equal
hashes, so no run is lost, and a clash only sends more words to the automaton.

Nulls and ties: a null or empty text and one of white space have no words and no runs; a null doc_id rewrites nothing;
equal rows get equal results; among runs of equal length the smallest start, then the smallest period is the longest; an
empty table gives an empty result. Columns of the input that clash with the result's are replaced; all others stay. A text
is one row and is read whole in one task; a worker holds one batch of texts (shared.CHUNK_BYTES) at a time.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import free_names, map_texts, utf8

#: A run has this many words or more, and at least two periods.
MIN_LENGTH = 12
#: Words in a window of the cut: MIN_LENGTH // 2, the longest that the shortest run must hold twice for every period.
WINDOW = MIN_LENGTH // 2
_MIX = np.uint64(0x9E3779B97F4A7C15)

FIELDS = [T.StructField(name, T.LongType()) for name in ("n_words", "n_runs", "start", "length", "period", "exponent_milli")]
FIELDS += [T.StructField("runs_sha256", T.StringType()), T.StructField("collapsed_sha256", T.StringType())]
RUNS = T.StructField("runs", T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])))


class SuffixAutomaton:
    """States by number; 0 is the root. `prefix[i]` is the state of the first i + 1 symbols."""

    def __init__(self, symbols: list[int]) -> None:
        follow: list[dict[int, int]] = [{}]
        link, length, prefix = [-1], [0], []
        last = 0
        for symbol in symbols:
            new = len(follow)
            follow.append({})
            length.append(length[last] + 1)
            link.append(0)
            prefix.append(new)
            at = last
            while at >= 0 and symbol not in follow[at]:
                follow[at][symbol] = new
                at = link[at]
            if at >= 0:
                old = follow[at][symbol]
                if length[old] == length[at] + 1:
                    link[new] = old
                else:
                    copy = len(follow)
                    follow.append(dict(follow[old]))
                    length.append(length[at] + 1)
                    link.append(link[old])
                    link[old] = link[new] = copy
                    while at >= 0 and follow[at].get(symbol) == old:
                        follow[at][symbol] = copy
                        at = link[at]
            last = new
        self.link, self.length, self.prefix = link, length, prefix


class HeavyPaths:
    """The suffix-link tree cut into heavy paths: `head[v]` is the top state of v's path."""

    def __init__(self, automaton: SuffixAutomaton) -> None:
        link, n = automaton.link, len(automaton.link)
        downwards = np.argsort(np.array(automaton.length), kind="stable").tolist()
        size, heavy = [1] * n, [-1] * n
        for v in reversed(downwards[1:]):  # children before parents
            up = link[v]
            size[up] += size[v]
            if heavy[up] < 0 or size[v] > size[heavy[up]]:
                heavy[up] = v
        self.head = head = [0] * n
        for v in downwards[1:]:
            up = link[v]
            head[v] = head[up] if heavy[up] == v else v


def squares(symbols: list[int]) -> dict[tuple[int, int], int]:
    """(period, start) -> end (exclusive) of every run of at least two periods."""
    automaton = SuffixAutomaton(symbols)
    link, length, head = automaton.link, automaton.length, HeavyPaths(automaton).head
    segments: dict[int, list[tuple[int, int]]] = {}  # of a heavy path, deepest first: (longest length, last end)
    found: dict[tuple[int, int], int] = {}
    for end, at in enumerate(automaton.prefix):
        below = -1  # the last end at the top of the heavy path below: its segment may go on in this one
        while at > 0:
            top, reach = head[at], length[at]
            stack = segments.setdefault(top, [])
            first = stack[-1][1] if stack else -1
            while stack:
                deepest, before = stack[-1]
                shared = min(deepest, reach)
                if end - before <= shared and before != below:
                    found[end - before, before - shared + 1] = end + 1
                if deepest > reach:
                    break
                stack.pop()
                if deepest == reach:
                    break
            stack.append((reach, end))
            at, below = link[top], first
    return found


def _covered(ids: np.ndarray) -> np.ndarray:
    """Which words lie in a window of WINDOW words that occurs twice in ids."""
    n = len(ids) - WINDOW + 1
    keys = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        keys = (keys ^ ids[k : n + k]) * _MIX
        keys ^= keys >> np.uint64(29)
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edges, np.flatnonzero(twice), 1)
    np.add.at(edges, np.flatnonzero(twice) + WINDOW, -1)
    return np.cumsum(edges[:-1]) > 0


def stretches(ids: np.ndarray) -> list[tuple[int, int]]:
    """[start, end) of pieces that hold every run of MIN_LENGTH words or more."""
    open_, done = [(0, len(ids))], []
    while open_:
        a, b = open_.pop()
        if b - a < MIN_LENGTH:
            continue
        ends = np.flatnonzero(np.diff(np.concatenate(([0], _covered(ids[a:b]).view(np.int8), [0]))))
        pieces = [(a + s, a + e) for s, e in zip(ends[::2].tolist(), ends[1::2].tolist())]
        if pieces == [(a, b)]:
            done.append((a, b))
        else:
            open_ += pieces
    return done


def word_runs(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    known: dict = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.uint64, len(words))
    if len(known) > len(words) - WINDOW:  # a run repeats at least so many words
        return []
    out = []
    for a, b in stretches(ids):
        for (period, start), end in squares(ids[a:b].tolist()).items():
            if end - start >= MIN_LENGTH:
                out.append((a + start, end - start, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words left when every run keeps its first period only, joined by one space."""
    if runs:
        edges = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            edges[start + period] += 1
            edges[start + length] -= 1
        words = [w for w, gone in zip(words, np.cumsum(edges[:-1]).tolist()) if not gone]
    return b" ".join(words)


def looped(words: list[bytes], seed: int | None) -> list[bytes]:
    """The contract's rewriting: every tenth seed loops the text from some word on."""
    n = len(words)
    if seed is None or seed % 10 or not n:
        return words
    g = seed // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def _make(rewrite: bool):
    def values_of(texts: list) -> list[list]:
        out: list[list] = [[] for _ in range(len(FIELDS) + 1)]
        for text in texts:
            seed = None
            if rewrite:
                head, text = text.split(":", 1)
                seed = int(head) if head else None
            words = looped(utf8(text).split(), seed)  # bytes.split cuts at the six ASCII white spaces
            runs = word_runs(words)
            start, length, period = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None, None, None)
            said = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
            row = [len(words), len(runs), start, length, period, 1000 * length // period if runs else None, hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs)).hexdigest(), runs]
            for column, value in zip(out, row):
                column.append(value)
        return out

    return values_of


def periodic_runs(docs: DataFrame, columns: list[str] | None = None, text: str = "text", loop_by: str | None = None) -> DataFrame:
    """The given columns (default: all) plus FIELDS and `runs`, an array of (start, length, period) in words. With
    `loop_by`, an integer column, every text is first rewritten as `looped` says."""
    names = [f.name for f in [*FIELDS, RUNS]]
    columns = [c for c in (docs.columns if columns is None else columns) if c not in names]
    read = text
    if loop_by:  # the seed travels before the text
        (read,) = free_names(docs.columns, "seeded")
        docs = docs.withColumn(read, F.concat(F.coalesce(F.col(loop_by).cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))))
    rewrite = bool(loop_by)
    return map_texts(docs, columns, read, [*FIELDS, RUNS], lambda: _make(rewrite))

"""Quality classifier: a generalised additive model with pairwise interactions.

Features of a text are cut into quantile bins. Boosting goes round the features in turn; each turn fits a tree of three
leaves over one feature's bins to the current gradient and adds it, shrunk, to that feature's lookup table. The pairs
of features whose coarse grids explain most of what is left get two-dimensional tables, boosted in turn by trees of
four leaves. A score is the sum of the looked-up values of all tables, through a logistic function: vectorised bin
additions, no tree is walked.

Fitting takes a bounded sample: the first SAMPLE labelled rows by a hash of doc_id. Null is the empty text; it has
features and a score like any other. Without labels the score is 0.5 everywhere. Repeated rows score alike.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .repetition import word_hashes, word_spans
from .shared import map_texts, utf8

SAMPLE = 20_000
BINS = 32
COARSE = 8
PAIRS = 6
ROUNDS = 120
RATE = 0.12


def _class(chars: bytes) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[list(chars)] = 1
    return table


_CLASSES = {
    "upper": _class(bytes(range(65, 91))),
    "lower": _class(bytes(range(97, 123))),
    "digit": _class(b"0123456789"),
    "shout": _class(b"!?"),
    "bar": _class(b"|<>{}[]\\/_=~^"),
    "symbol": _class(b"#*$%&@+"),
    "stop": _class(b".,;:"),
    "line": _class(b"\n"),
    "wide": _class(bytes(range(0xC0, 256))),
}
FEATURES = [
    "log_words", "mean_word", "sd_word", *(f"{c}_share" for c in _CLASSES), "upper_words", "odd_words", "same_as_last", "same_as_last_but_one",
    "distinct_share", "top_word_share", "dup_line_share", "long_words",
]


def features(text: str | None) -> list[float]:
    raw = utf8(text)
    data = np.frombuffer(raw, np.uint8)
    start, end = word_spans(data)
    n, size = len(start), max(1, len(data))
    counts = np.bincount(data, minlength=256)
    shares = [float(counts @ table) / size for table in _CLASSES.values()]
    if n == 0:
        return [0.0, 0.0, 0.0, *shares, *([0.0] * 8)]
    length = end - start
    upper = np.concatenate(([0], np.cumsum(_CLASSES["upper"][data])))
    odd = np.concatenate(([0], np.cumsum((_CLASSES["symbol"] | _CLASSES["shout"] | _CLASSES["bar"])[data])))
    h = word_hashes(data, start, end)
    ordered = np.sort(h)
    edges = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1], [True])))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    return [
        float(np.log1p(n)), float(length.mean()), float(length.std()), *shares,
        float((upper[end] - upper[start] >= np.maximum(2, length // 2)).mean()), float((odd[end] > odd[start]).mean()),
        float((h[1:] == h[:-1]).sum()) / n, float((h[2:] == h[:-2]).sum()) / n,
        (len(edges) - 1) / n, float(np.diff(edges).max()) / n, 1 - len(set(lines)) / len(lines), float((length > 20).mean()),
    ]


class Additive:
    """Edges, one table a feature, and (i, j, table) pairs."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.base, self.edges, self.tables, self.pairs = 0.0, [], [], []
        if len(y) == 0:
            self.edges, self.tables = [np.zeros(0)] * len(FEATURES), [np.zeros(1)] * len(FEATURES)
            return
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        bins = self._bins(x)
        rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(rate / (1 - rate)))
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        margin = np.full(len(y), self.base)
        for _ in range(ROUNDS):
            for j, table in enumerate(self.tables):
                p = 1 / (1 + np.exp(-margin))
                g = np.bincount(bins[:, j], y - p, len(table))
                h = np.bincount(bins[:, j], p * (1 - p), len(table))
                step = RATE * _three_leaves(g, h)
                table += step
                margin += step[bins[:, j]]
        coarse = self._coarse(bins)
        p = 1 / (1 + np.exp(-margin))
        gain = []
        for i in range(x.shape[1]):
            for j in range(i):
                g, h = (np.bincount(coarse[:, i] * COARSE + coarse[:, j], w, COARSE * COARSE) for w in (y - p, p * (1 - p)))
                gain.append((float((g * g / (h + 5)).sum()), i, j))
        self.pairs = [(i, j, np.zeros(COARSE * COARSE)) for _, i, j in sorted(gain, reverse=True)[:PAIRS]]
        for _ in range(ROUNDS // 2):
            for i, j, table in self.pairs:
                at = coarse[:, i] * COARSE + coarse[:, j]
                p = 1 / (1 + np.exp(-margin))
                step = RATE * _four_leaves(np.bincount(at, y - p, COARSE * COARSE), np.bincount(at, p * (1 - p), COARSE * COARSE))
                table += step
                margin += step[at]

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="right") for e, c in zip(self.edges, x.T)], axis=1)

    def _coarse(self, bins: np.ndarray) -> np.ndarray:
        return np.stack([b * COARSE // (len(e) + 1) for e, b in zip(self.edges, bins.T)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        if len(x) == 0:
            return np.zeros(0)
        bins = self._bins(x)
        margin = self.base + sum(t[bins[:, j]] for j, t in enumerate(self.tables))
        if self.pairs:
            coarse = self._coarse(bins)
            margin = margin + sum(t[coarse[:, i] * COARSE + coarse[:, j]] for i, j, t in self.pairs)
        return 1 / (1 + np.exp(-margin))


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best split of a run of bins."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl * gl / (hl + 5) + gr * gr / (hr + 5) - g.sum() ** 2 / (h.sum() + 5)
    best = int(np.argmax(gain))
    return float(gain[best]), best + 1


def _three_leaves(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    _, a = _cut(g, h)
    left, right = _cut(g[:a], h[:a]), _cut(g[a:], h[a:])
    cuts = sorted({0, len(g), a, left[1] if left[0] >= right[0] else a + right[1]})
    out = np.zeros(len(g))
    for i, j in zip(cuts, cuts[1:]):
        out[i:j] = g[i:j].sum() / (h[i:j].sum() + 5)
    return out


def _four_leaves(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    g2, h2 = g.reshape(COARSE, COARSE), h.reshape(COARSE, COARSE)
    _, a = _cut(g2.sum(axis=1), h2.sum(axis=1))
    out = np.zeros((COARSE, COARSE))
    for rows in (slice(0, a), slice(a, COARSE)):
        _, b = _cut(g2[rows].sum(axis=0), h2[rows].sum(axis=0))
        for cols in (slice(0, b), slice(b, COARSE)):
            if g2[rows, cols].size:
                out[rows, cols] = g2[rows, cols].sum() / (h2[rows, cols].sum() + 5)
    return out.ravel()


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Additive:
    """docs (doc_id, text), labels (doc_id, label 0 or 1) of the training fold; features are computed by Spark and at
    most `sample` labels' rows come to the driver."""
    labels = labels.where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    some = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.join(F.broadcast(some), "doc_id")  # at most `sample` rows
    found = with_features(rows, ["doc_id", "label"]).groupBy("doc_id", "label").agg(F.first("_features").alias("x")).toPandas().sort_values("doc_id")
    return Additive(np.array(found["x"].tolist(), float).reshape(len(found), len(FEATURES)), found["label"].to_numpy(float))


def with_features(docs: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    return map_texts(docs, columns, text, [T.StructField("_features", T.ArrayType(T.DoubleType()))], lambda: lambda texts: [[features(t) for t in texts]])


def score(docs: DataFrame, model: Additive, columns: list[str] | None = None, text: str = "text") -> DataFrame:
    """docs (or the given columns of it) plus score; a column of that name is replaced."""
    columns = [c for c in (docs.columns if columns is None else columns) if c != "score"]
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a few tables of BINS numbers

    def values(texts):
        return [sent.value.score(np.array([features(t) for t in texts], float).reshape(len(texts), len(FEATURES)))]

    return map_texts(docs, columns, text, [T.StructField("score", T.DoubleType())], lambda: values)

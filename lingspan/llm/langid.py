"""Language identification by words first, with backoff to shorter and shorter character n-grams.

A known word adds its log frequency in each language. An unseen word is padded and read as 5-grams, and if none of
these is known as 4-grams, and so on down to single letters; the known ones' mean log frequencies count. The sums over
all words, per word and scaled to at most EVIDENCE words, go through a softmax.

Fitting takes a bounded sample of labelled rows: SAMPLE documents with a language, the first by a hash of doc_id. Spark
counts the n-grams of all its words; the model keeps GRAMS n-grams a length and, a language, WORDS words that occur
twice or more and have at most 40 letters. Other words are read as n-grams. A word is a run of letters (Unicode category
L), in fitting and in scoring. Every label of the sample with a letter in
its texts is a language of the model; what a language lacks weighs the same in all of them. Scoring reads every whole text. Null texts and texts without
a letter are 'und' with score 0; if nothing could be learned, all are. Ties go to the language first in order.
"""

from __future__ import annotations

from itertools import islice

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import map_texts, materialize

SAMPLE = 20_000
WORDS = 40_000
GRAMS = 40_000
LONGEST = 5
PIECE = 1_000
EVIDENCE = 40
MEMO = 500_000
UNKNOWN = "und"

_letters = regex.compile(r"\p{L}+").findall
_letter = regex.compile(r"\p{L}").search


class Model:
    """Log frequencies by word and by n-gram, a column a language; `langs` is sorted."""

    def __init__(self, langs: list[str], words: dict[str, list[int]], grams: dict[int, dict[str, list[int]]]):
        """Counts by language, in the order of langs; grams by length."""
        self.langs = langs
        self._scorer: Scorer | None = None
        self.words, logs = _logs(words)
        self.grams: dict[int, dict[str, int]] = {}
        rows = [logs.reshape(-1, len(langs))] if langs else [np.zeros((0, 0))]
        for length, table in grams.items():
            index, logs = _logs(table)
            if index:
                before = sum(map(len, rows))
                self.grams[length] = {g: i + before for g, i in index.items()}
                rows.append(logs)
        self.logs = np.concatenate(rows)

    def scorer(self) -> Scorer:
        """The model's own, which a Python worker keeps from task to task."""
        if self._scorer is None:
            self._scorer = Scorer(self)
        return self._scorer

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_scorer": None}

    def rows_of(self, word: str) -> list[int]:
        """Rows of logs whose mean is the word's: its own, or those of its longest known n-grams; none if none is known."""
        if (known := self.words.get(word)) is not None:
            return [known]
        for length in range(LONGEST, 0, -1):
            table = self.grams.get(length, {})
            hits = [table[g] for g in ngrams(word, length) if g in table]
            if hits:
                return hits
        return []


def _logs(table: dict[str, list[int]]) -> tuple[dict[str, int], np.ndarray]:
    if not table:
        return {}, np.zeros((0, 0))
    counts = np.array(list(table.values()), float)
    totals = counts.sum(axis=0)
    most = totals.max()
    shares = (counts / np.maximum(totals, 1) * most + 0.5) / (most + 0.5 * len(counts))
    return {k: i for i, k in enumerate(table)}, np.log(shares)


def ngrams(word: str, size: int) -> list[str]:
    padded = f"<{word}>"
    return [padded[i : i + size] for i in range(max(1, len(padded) - size + 1))]


class Scorer(dict):
    """Rows of a matrix by white-space piece; emptied when full."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.rows = np.zeros((MEMO + 1, len(model.langs) + 1), np.float32)

    def learn(self, pieces: set[str]) -> None:
        """Rows for new pieces: the sum of their words' means, and the number of words."""
        at, to, of, weight = len(self), [], [], []
        for row, piece in enumerate(pieces, at):
            low = piece.lower()  # first: a letter may become a letter and a mark
            words = [low] if low.isalpha() else _letters(low)
            self[piece] = row
            self.rows[row, -1] = len(words)
            for w in words:
                if hits := self.model.rows_of(w):
                    to += [row - at] * len(hits)
                    of += hits
                    weight += [1 / len(hits)] * len(hits)
        logs = self.model.logs[of] * np.array(weight).reshape(-1, 1)
        for j in range(len(self.model.langs)):
            self.rows[at : len(self), j] = np.bincount(to, logs[:, j], len(pieces)) if of else 0

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.model.langs or not _letter(text):
            return UNKNOWN, 0.0
        pieces = iter(text.split())
        total = np.zeros(self.rows.shape[1])
        while chunk := list(islice(pieces, 50_000)):
            if len(self) + len(chunk) > MEMO:
                self.clear()
            if new := {x for x in chunk if x not in self}:
                self.learn(new)
            total += self.rows[np.fromiter(map(self.__getitem__, chunk), np.int64, len(chunk))].sum(axis=0, dtype=np.float64)
        logs = total[:-1] * (min(total[-1], EVIDENCE) / max(total[-1], 1.0))
        best = int(np.argmax(logs))
        return self.model.langs[best], float(1 / np.exp(logs - logs[best]).sum())


def _grams(counts: DataFrame) -> DataFrame:
    """(lang, word, n) -> (length, gram, total, by): the n-grams of all words as ngrams() gives them, with their counts
    by language. Long words are cut into overlapping pieces, so no letter is looked up from the far start of a word."""
    padded = counts.select("lang", "n", F.concat(F.lit("<"), "word", F.lit(">")).alias("p")).withColumn("len", F.length("p"))
    pieces = padded.withColumn("from", F.explode(F.expr(f"sequence(0, len - 1, {PIECE})")))
    pieces = pieces.select("lang", "n", "len", "from", F.expr(f"substring(p, from + 1, {PIECE + LONGEST - 1})").alias("p"))
    starts = pieces.withColumn("s", F.explode(F.expr(f"sequence(1, least({PIECE}, len - from))")))
    sized = starts.withColumn("length", F.explode(F.expr(f"sequence(1, {LONGEST})"))).where("from + s <= greatest(1, len - length + 1)")
    each = sized.groupBy("length", F.expr("substring(p, s, length)").alias("gram"), "lang").agg(F.sum("n").alias("n"))
    return each.groupBy("length", "gram").agg(F.sum("n").alias("total"), F.collect_list(F.struct("lang", "n")).alias("by"))


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """From (doc_id, text, lang) rows; the counts are Spark's, the model has at most WORDS words a language and GRAMS
    n-grams a length."""
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    ids = rows.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    words = rows.join(F.broadcast(ids.distinct()), "doc_id", "left_semi").select("lang", F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word"))
    counts = materialize(words.where("word <> ''").groupBy("lang", "word").agg(F.count("*").alias("n")), "words")
    langs = sorted(x["lang"] for x in counts.select("lang").distinct().collect())
    at = {lang: i for i, lang in enumerate(langs)}
    table: dict[str, list[int]] = {}
    kept = counts.where("n >= 2 AND length(word) <= 40")
    for lang in langs:  # a handful; each language's best words are found by all tasks together
        for word, n in kept.where(F.col("lang") == lang).orderBy(F.desc("n"), "word").limit(WORDS).select("word", "n").collect():
            table.setdefault(word, [0] * len(langs))[at[lang]] = n
    grams, found = {}, materialize(_grams(counts), "grams")
    for length in range(1, LONGEST + 1):
        grams[length] = {}
        for gram, by in found.where(F.col("length") == length).orderBy(F.desc("total"), "gram").limit(GRAMS).select("gram", "by").collect():
            row = grams[length][gram] = [0] * len(langs)
            for lang, n in by:
                row[at[lang]] = n
    return Model(langs, table, grams)


def identify(docs: DataFrame, model: Model, columns: list[str] | None = None, text: str = "text") -> DataFrame:
    """docs (or the given columns of it) plus lang_pred and score; such names in docs are replaced."""
    columns = [c for c in (docs.columns if columns is None else columns) if c not in ("lang_pred", "score")]
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by WORDS and GRAMS

    def make():
        scorer = sent.value.scorer()
        return lambda texts: [*map(list, zip(*(scorer.predict(t) for t in texts)))]

    return map_texts(docs, columns, text, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())], make)

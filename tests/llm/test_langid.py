"""Languages whose training words do not repeat or are long; n-grams against counting."""

from __future__ import annotations

import random
from collections import Counter

from lingspan.llm import langid


def test_words_that_do_not_repeat(spark):
    r = random.Random(4)
    clause = lambda letters, n: "".join(r.choice(letters) for _ in range(n))
    rows = [(i, " ".join(r.choice(["aba", "cab", "bac", "dab"]) for _ in range(50)), "aa") for i in range(40)]
    rows += [(100 + i, clause("mnopqr", 60), "mm") for i in range(6)] + [(200 + i, clause("tuvwxyz", 15), "tt") for i in range(3)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == ["aa", "mm", "tt"]
    scorer = langid.Scorer(model)
    assert [scorer.predict(t)[0] for t in ("dab cab", clause("mnopqr", 60), clause("tuvwxyz", 15))] == ["aa", "mm", "tt"]


def test_grams_of_long_words(spark, monkeypatch):
    monkeypatch.setattr(langid, "PIECE", 7)
    words = ["a", "ab", "abcdefg", "\u00e9\u4e16" * 20, "abcabcabcabcabcabcabcabc"]
    got = langid._grams(spark.createDataFrame([("x", w, 3) for w in words], "lang string, word string, n long")).collect()
    wanted = Counter({})
    for w in words:
        for length in range(1, langid.LONGEST + 1):
            for g in langid.ngrams(w, length):
                wanted[length, g] += 3
    assert {(x["length"], x["gram"]): x["total"] for x in got} == wanted

"""The pipeline on planted documents: what each stage must take out, and what it must leave alone."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def words(r, n):
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(n))


def test_run(spark, tmp_path):
    r = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        t = words(r, r.randint(60, 120))
        bad = i % 6 == 0
        rows.append((i, " ".join(w + "###" for w in t.split()) if bad else t))
        labels.append((i, 0 if bad else 1, 0))
    good = [t for i, t in rows if i % 6]
    rows += [(1000 + k, good[k]) for k in range(20)] + [(2000 + k, good[40 + k].replace(good[40 + k].split()[5], "zzz", 1)) for k in range(20)]
    rows += [(3000 + k, words(r, 80) + f" a{k}@b.org") for k in range(20)]
    spark.createDataFrame([(i, t, "en", f"src{i % 3}", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / f"s{len(seen)}"))
        docs = spark.read.parquet(str(tmp_path / f"s{len(seen)}"))
        seen.append((name, docs))
        if len(seen) < len(corpus_pipeline.STAGES):
            assert docs.columns == columns
    ids = lambda df: {x["doc_id"] for x in df.collect()}
    clean = {i for i, _ in rows if i >= 1000 or i % 6}
    assert ids(seen[0][1]) == clean
    assert ids(seen[1][1]) == clean - set(range(1000, 1020)) - set(range(2000, 2020))
    assert not any(re.search(r"a\d+@b\.org", x["text"]) for x in seen[2][1].collect()) and ids(seen[2][1]) == ids(seen[1][1])
    budget = sum(-(-len(x["text"]) // 4) for x in seen[2][1].collect()) * 4 // 5
    taken = sum(-(-len(x["text"]) // 4) for x in seen[3][1].collect())
    assert 0.8 * budget < taken <= budget
    final = seen[4][1].collect()
    assert all(x["round_trip"] and len(x["token_ids"]) == 4 * x["n_tokens"] for x in final) and len(final) == seen[3][1].count()
    assert np.frombuffer(final[0]["token_ids"], "<u4").max() < 50_256


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _text string, _features string, score double, mix_a string, kept string, token_ids binary, round_trip string"


@pytest.mark.parametrize("kind", ["odd", "empty"])
def test_odd_rows_and_names(spark, tmp_path, kind):
    """Nulls in every column, empty and long texts, repeated rows, no rows; names that the stages use themselves."""
    r = random.Random(2)
    texts = [None, "", " \n", "word", "x " * 30_000, "same words " * 30, words(r, 100) + " +1 (487) 555-7209"] + [words(r, 80) for _ in range(40)]
    rows = [(i if i % 9 else None, t, "en" if i % 5 else None, "src1" if i % 4 else None, len(t) if t else None, "a", None, 0.5 if i % 2 else None, "m", "k", b"z", "r") for i, t in enumerate(texts * 2)]
    spark.createDataFrame(rows if kind == "odd" else [], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, i % 3 // 2, 0) for i in range(90)] if kind == "odd" else [], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        got = stage(spark, docs, str(tmp_path))
        assert got.columns == docs.columns
        got.write.parquet(str(tmp_path / f"s{n}"))
        if n in (1, 2):
            assert spark.read.parquet(str(tmp_path / f"s{n}")).where("_text <> 'a' OR mix_a <> 'm' OR kept <> 'k' OR round_trip <> 'r' OR score <> 0.5").isEmpty()
        docs = docs if n == 0 else spark.read.parquet(str(tmp_path / f"s{n}"))  # whatever the tiny classifier keeps, the others see all rows
        assert (docs.count() == 0) == (kind == "empty")
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert len(last) == docs.count() and all(x["round_trip"] is True for x in last)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() >= 0


def test_mixing_plans_its_budgets_once(spark):
    """The plan over the documents holds the running sum and no budget's windows: the driver plans these once, over leaves."""
    docs = spark.createDataFrame([(i, "word " * (i % 7), "en", f"src{i % 3}", 5) for i in range(40)], "doc_id long, text string, lang string, source string, n_chars long")
    plan = corpus_pipeline.mixture(spark, docs, "")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1

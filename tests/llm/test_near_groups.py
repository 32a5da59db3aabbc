"""near_groups against the components of the exact Jaccard graph, by brute force over all pairs."""

from __future__ import annotations

import random
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lingspan.llm import near, shared


def words_of(r, n):
    return ["".join(r.choice("abcdefghijkl") for _ in range(r.randint(2, 7))) for _ in range(n)]


def shingles(words):
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute_components(texts):
    """The smallest position of each text's component."""
    sets, of = [shingles(t) for t in texts], list(range(len(texts)))

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and Fraction(shared, len(sets[i]) + len(sets[j]) - shared) >= Fraction(4, 5):
                x, y = root(i), root(j)
                of[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(texts))]


def check(spark, texts):
    wanted = brute_components(texts)
    rows = near.near_groups(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")).collect()
    least = {}
    for x in rows:
        least[x["component"]] = min(least.get(x["component"], x["doc_id"]), x["doc_id"])
    assert [least[x["component"]] for x in sorted(rows, key=lambda x: x["doc_id"])] == wanted
    return wanted


def test_short_and_long_texts_with_few_edits(spark):
    """Pairs at 0.8 exactly or a little above and below; fingerprints of short ones are far apart."""
    r, texts = random.Random(1), []
    for n in (14, 20, 30, 100, 200):
        for k in range(40):
            t = words_of(r, n)
            u = list(t)
            if n <= 30:
                u[-1] = "zz"
                if k % 4 == 3:
                    u[0] = "zz"
            else:
                for j in r.sample(range(n), r.randint(1, 1 + n // 50)):
                    u[j] = "zz"
            texts += [t, u]
    assert len(set(check(spark, texts))) < 320


def test_chains_of_near_copies(spark):
    """Groups in which most members are below 0.8 to each other, and hang together by others between."""
    r, texts = random.Random(2), []
    for n in (100, 200):
        for _ in range(2):
            group = [words_of(r, n)]
            while len(group) < 60:
                t = list(r.choice(group))
                for j in r.sample(range(n), r.randint(1, 4)):
                    t[j] = words_of(r, 1)[0]
                group.append(t)
            texts += group
    check(spark, texts)


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 1000])
def test_keys_over_several_batches(rows):
    """A key that two nodes have, or a common one, gives each node once, however its rows are cut."""
    r = random.Random(rows)
    table = sorted((k, r.randrange(40), 9, 0, k == 6) for k in (1, 2, 3, 4, 4, 4, 5, 6, 7) for _ in range(r.choice([1, 1, 60])))
    columns = [np.array(c) for c in zip(*table)]
    whole = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "node", "size", "at", "common"])
    cut = [whole.slice(at, rows) for at in range(0, len(table), rows)]
    got = [tuple(x[c] for c in ("key", "node")) for b in near._shared_keys(iter(cut)) for x in b.to_pylist()]
    nodes = {k: sorted({x[1] for x in table if x[0] == k}) for k in range(1, 8)}
    assert got == [(k, n) for k, v in sorted(nodes.items()) for n in v if len(v) > 1 or k == 6]


def crowd(r, size, n, edits):
    """Copies of one text, each with its own edits: many are below 0.8 to many others."""
    text, out = words_of(r, size), []
    for _ in range(n):
        t = list(text)
        for j in r.sample(range(size), r.randint(*edits)):
            t[j] = words_of(r, 1)[0]
        out.append(t)
    return out


@pytest.mark.parametrize("pivots, turns", [(8, 3), (1, 1), (10_000, 0)])
def test_crowds_whatever_the_pivots(spark, monkeypatch, pivots, turns):
    """Pivots decide what is compared when, never the groups; unlike texts with one common passage stay apart."""
    monkeypatch.setattr(near, "PIVOTS", pivots)
    monkeypatch.setattr(near, "TURNS", turns)
    r = random.Random(7)
    passage = words_of(r, 40)
    texts = crowd(r, 80, 70, (0, 4)) + crowd(r, 150, 60, (1, 5)) + [words_of(r, 6) + passage + words_of(r, 5) for _ in range(60)] + [passage + words_of(r, 3) for _ in range(20)]
    check(spark, texts)


def test_one_row_of_each_group_stays(spark):
    """Rows without a key last, of two texts under one key either, of repeated rows one; null and empty texts are copies;
    names that the work uses stay columns."""
    r = random.Random(8)
    a, b, c = (" ".join(words_of(r, 60)) for _ in range(3))
    near_a = a + " zz"
    rows = [(None, a, 1), (5, near_a, 2), (5, near_a, 3), (1, b, 4), (1, c, 5), (7, b.upper(), 6), (9, None, 7), (8, "", 8), (None, " ", 9)]
    docs = spark.createDataFrame([(k, t, n, n, n, n, n) for k, t, n in rows], "doc_id long, text string, r1 long, _r2 long, nth int, node long, key int")
    kept = near.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(x["r1"] for x in kept.collect()) in ([2, 4, 5, 8], [3, 4, 5, 8])
    assert near.drop_near_duplicates(docs.limit(0)).collect() == []


def test_clashing_halves_of_hashes_are_told_apart(spark):
    rows = spark.createDataFrame([(7, 1), (7, 1), (7, 2), (8, 3)], "node long, check long")
    assert sorted(x["node"] for x in near._told_apart(rows).collect()) == [1, 1, 2, 8]


def test_long_texts_near_the_threshold(spark):
    """Sets of several hundred shingles from 0.77 to 0.83: decided by all of them."""
    r, texts = random.Random(3), []
    for k in range(60):
        t = words_of(r, 500)
        u = list(t)
        for j in r.sample(range(0, 500, 5), 8 + k % 5):
            u[j] = "zz"
        texts += [t, u]
    assert 60 < len(set(check(spark, texts))) < 120


def test_tables_of_the_steps_are_deleted(spark, tmp_path, monkeypatch):
    r = random.Random(9)
    base = words_of(r, 60)
    docs = spark.createDataFrame([(i, " ".join(base if i % 2 else words_of(r, 60))) for i in range(20)], "doc_id long, text string")
    monkeypatch.setattr(shared, "shared_dir", lambda spark: str(tmp_path))
    kept = near.drop_near_duplicates(docs)
    assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["kept"]
    assert kept.count() == 11 and kept.count() == 11


def test_crowds_of_unlike_texts_leave_the_prefixes(spark, monkeypatch):
    """Unlike texts with a common run of words that the sample does not see, and crowds below 0.8: the groups are the exact
    ones, and components of a key hardly ever meet."""
    r, met = random.Random(11), []
    run = words_of(r, 9)
    texts = crowd(r, 60, 30, (0, 2))
    for _ in range(200):
        t = words_of(r, 60)
        texts.append(t[:20] + run + t[20:])
    texts += crowd(r, 90, 60, (8, 12))
    monkeypatch.setattr(near, "common_shingles", lambda docs: np.array([], np.uint64))
    mixed = near._mixed

    def counted(of, linked):
        of = mixed(of, linked)
        there = of.groupBy("key").agg(F.countDistinct("component").alias("n"))
        met.append(there.agg(F.coalesce(F.sum(F.expr("n * (n - 1) div 2")), F.lit(0))).first()[0])
        return of

    monkeypatch.setattr(near, "_mixed", counted)
    check(spark, texts)
    with_order = met[-1]
    met.clear()
    monkeypatch.setattr(near, "crowded_shingles", lambda docs, common: common)
    check(spark, texts)
    assert with_order * 5 < met[-1]

"""Operators that must hold at any size: near reuse, bundles in parts, numbers of lines over splits, published versions,
glossary terms by their rarest word, previews, and groups without arrays."""

from __future__ import annotations

import glob
import json
import os
import random
import urllib.parse
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lingspan.operators import glossary, graph, lint, reuse, review, rules, usage
from lingspan.plans import bundles, queries_files, sync
from lingspan.schema import GLOSSARY, GLOSSARY_T, KEYS, TRANSLATIONS, Corpus, Glossary
from lingspan.sources import corpus as corpora
from lingspan.sources import lines, trees, versions
from lingspan.streaming import lints as streams


def corpus_of(spark, texts, langs=("de",)):
    """texts (key, source): keys with a source text on two platforms, and the same text with the language's name."""
    keys = [(f"id:{i}", i, i, k, None, ["ios", "other"] if i % 2 else [], False, False, "Surface: the very same long line\nx", None, None, []) for i, (k, _) in enumerate(texts)]
    values = [(f"id:{i}", lang, "", t if lang == "en" else f"{lang} {t}", False, False) for i, (_, t) in enumerate(texts) for lang in ("en", *langs)]
    return Corpus(spark.createDataFrame(keys, KEYS), spark.createDataFrame(values, TRANSLATIONS))


# Near reuse


def grams(text):
    return {text[i : i + 4] for i in range(max(len(text) - 3, 1))}


def brute_groups(texts):
    sets = {t: grams(t) for t in {t.strip().casefold() for _, t in texts if t}}
    root = {t: t for t in sets}

    def find(t):
        while root[t] != t:
            t = root[t]
        return t

    for a in sets:
        for b in sets:
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    out = defaultdict(set)
    for i, (_, t) in enumerate(texts):
        if t:
            out[find(t.strip().casefold())].add(f"id:{i}")
    return sorted(sorted(g) for g in out.values() if len(g) > 1)


def test_near_reuse_against_all_pairs(spark):
    r = random.Random(1)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(3, 9))) for _ in range(300)]
    texts = [("empty", ""), ("short", "ok"), ("short2", "OK "), ("short3", "no")]
    for i in range(60):
        base = [r.choice(words) for _ in range(r.randint(4, 30))]
        for j in range(r.randint(1, 4)):
            texts.append((f"k{i}_{j}", " ".join(w if r.random() > 0.04 else r.choice(words) for w in base)))
    texts += [(f"same{i}", "Every third key says this") for i in range(80)]
    got = defaultdict(set)
    rows = reuse.near_reuse(corpus_of(spark, texts)).collect()
    for row in rows:
        got[row["group"]].add(row["rec_id"])
    want = brute_groups(texts)
    assert sorted(sorted(g) for g in got.values()) == want and any(len(g) > 2 for g in want if len(g) < 80)
    big = [row for row in rows if row["n_keys"] == 80]
    assert len(big) == 80 and {row["n_texts"] for row in big} == {1}


def test_near_texts_travel_to_bands(spark, monkeypatch):
    """A crowd of near texts: every pair is found, over small blocks too, and texts travel far fewer times than there are pairs;
    long texts that share a key and are not near are not written as pairs."""
    r = random.Random(5)
    base = [f"{r.randrange(10**6):06d}" for _ in range(60)]
    texts = {" ".join(w if i != j % 60 else f"{j:06d}" for i, w in enumerate(base)) for j in range(50)}
    pool = [f"{r.randrange(10**6):06d}" for _ in range(80)]
    texts |= {" ".join(w for w in pool if r.random() < 0.75) for _ in range(60)}
    want = sum(5 * len(grams(a) & grams(b)) >= 4 * len(grams(a) | grams(b)) for a in texts for b in texts if a < b)
    rows, write = {}, reuse.materialize
    monkeypatch.setattr(reuse, "materialize", lambda df, name: rows.setdefault(name, write(df, name)))
    whole = spark.createDataFrame([(t,) for t in texts], "text string")
    assert reuse.near_texts(whole).count() == want
    assert rows["pairs"].count() < 1.5 * want
    dealt = rows["dealt"].select("band", "at_a", "at_b", F.explode(F.array("a", "b")).alias("id")).distinct().count()
    assert dealt < rows["pairs"].count()
    monkeypatch.setattr(reuse, "BLOCK", 7)
    assert reuse.near_texts(whole).count() == want


def test_recall_of_bands(spark):
    """Pairs made near the threshold: at least 0.99 of those at 0.8 or more are found, and only those."""
    r = random.Random(2)
    texts, near = [], 0
    for i in range(400):
        a = [f"{r.randrange(10**6):06d}" for _ in range(30)]
        b = [w if r.random() > 0.06 else f"{r.randrange(10**6):06d}" for w in a]
        x, y = grams(" ".join(a)), grams(" ".join(b))
        near += x != y and 5 * len(x & y) >= 4 * len(x | y)
        texts += [(" ".join(a),), (" ".join(b),)]
    found = reuse.near_texts(spark.createDataFrame(texts, "text string")).count()
    assert 100 < near and 0.99 * near <= found <= near


@pytest.mark.parametrize("kind", ["path", "star", "random", "none"])
def test_components(spark, kind):
    r = random.Random(3)
    edges = {"path": [(i, i + 1) for i in range(60)], "star": [(7, i) for i in range(40)], "random": [(r.randrange(80), r.randrange(80)) for _ in range(50)], "none": [(3, 3), (None, 1)]}[kind]
    root = {}
    for a, b in edges:
        if a is not None and a != b:
            x, y = a, b
            while root.setdefault(x, x) != x:
                x = root[x]
            while root.setdefault(y, y) != y:
                y = root[y]
            root[max(x, y)] = min(x, y)

    def find(x):
        return x if root[x] == x else find(root[x])

    got = graph.components(spark.createDataFrame(edges, "a int, b int"))
    assert {x["node"]: x["component"] for x in got.collect()} == {x: find(x) for x in root}


# Bundles in parts


@pytest.mark.parametrize("platform", ["ios", "android", "server"])
def test_bundle_parts_are_the_bundle(spark, tmp_path, platform):
    texts = [(f"key{i:04d}", f'Say "{i}" & <b> [%1$s]\n' + "é" * (i % 7)) for i in range(200)] + [("key0005", "again"), ("key0006", "twice"), ("key0006", "twice")]
    c = corpus_of(spark, texts, ("de", "pt_BR"))
    bundles.write_bundle_parts(c, platform, f"{tmp_path}/b", parts=9)
    got, most = {}, 0
    for folder in glob.glob(f"{tmp_path}/b/platform=*/file=*"):
        parts = sorted(glob.glob(f"{folder}/part-*"))
        most = max(most, len(parts))
        got[urllib.parse.unquote(folder.split("file=")[1])] = "".join(open(p, encoding="utf-8", newline="").read() for p in parts)
    assert got == {r["rel_path"]: r["text"] for r in bundles.render_bundle(c, platform).collect()} and most > 1


def test_a_key_without_a_name_on_the_platform_is_left_out(spark):
    c = corpus_of(spark, [("a", "x")])
    named = c.keys.withColumns({"key_name": F.lit(None).cast("string"), "key_by_platform": F.create_map(F.lit("ios"), F.lit("only_ios"))})
    assert bundles.bundle_entries(Corpus(named, c.translations), "server").count() == 0 and bundles.bundle_entries(Corpus(named, c.translations), "ios").count() == 2


# Lines


def test_bad_lines_are_named_over_splits(spark, tmp_path):
    for name, odd in (("a", (3, 700)), ("b", ())):
        body = [f'{{"key": "k{i}", "key_id": {i}, "t": {{"de": "{"x" * (i % 40)}"}}}}' if i not in odd else '{"key": ' for i in range(1, 1001)]
        body[9:11] = ["", "  "]
        (tmp_path / f"{name}.ndjson").write_text("\n".join(body), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        whole = lines.numbered_lines(spark, str(tmp_path / "b.ndjson"))
        assert whole.where("line <> '' AND trim(line) <> '' AND NOT contains(line, concat('\"k', lineno, '\"'))").isEmpty() and whole.count() == 1000
        assert spark.read.text(str(tmp_path / "b.ndjson")).rdd.getNumPartitions() > 5
        got = sorted((os.path.basename(r["path"]), r["lineno"]) for r in corpora.bad_lines(spark, str(tmp_path)).collect())
        assert got == [("a.ndjson", 3), ("a.ndjson", 700)]
        with pytest.raises(ValueError, match=r"a\.ndjson:3: .*a\.ndjson:700: "):
            corpora.read_corpus(spark, str(tmp_path))
        assert corpora.read_corpus(spark, str(tmp_path / "b.ndjson")).keys.count() == 998
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


# Versions


def test_one_of_two_writers_loses(spark, tmp_path):
    base = str(tmp_path / "table")
    assert versions.publish(spark.range(3), base, -1, "first") == 0
    assert versions.publish(spark.range(5), base, 0, "second\nline") == 1
    with pytest.raises(versions.Moved):
        versions.publish(spark.range(9), base, 0)
    folder = versions.history(spark, base)[0].folder
    with pytest.raises(versions.Moved):  # both saw version 1 and wrote; the other one committed in between
        versions._commit(spark, base, 1, folder, "late")
    assert versions.latest(spark, base) == 1 and versions.read_version(spark, base).count() == 5 and not glob.glob(f"{base}/log/draft*")
    assert versions.restore(spark, base, 0, 1) == 2 and versions.read_version(spark, base).count() == 3
    assert [v.note for v in versions.history(spark, base)] == ["first", "second\nline", "restored 0"]
    assert versions.retain(spark, base, 2) == [0]
    assert versions.read_version(spark, base, 2).count() == 3  # its data is version 0's
    assert versions.retain(spark, base, 1) == [1] and len(glob.glob(f"{base}/data-*")) == 1
    with pytest.raises(ValueError):
        versions.read_version(spark, base, 1)
    assert versions.history(spark, str(tmp_path / "none")) == []


def test_bundle_files_are_never_one_row(spark, tmp_path, monkeypatch):
    """Line counts of a bundle whose files no step holds whole."""
    texts = [(f"key{i:04d}", f"x\n{i}\r" if i % 3 else f"<{i}>") for i in range(60)]
    monkeypatch.setattr(queries_files, "forms_corpus", lambda *_: corpus_of(spark, texts, ("de",)))
    monkeypatch.setattr(bundles, "render_bundle", None)  # a row a file
    rows = queries_files.bundle_files(spark, "")
    live = [t for i, (_, t) in enumerate(texts) if i % 2 == 0]  # the others are not on Android
    assert sorted(map(tuple, rows.collect())) == [(d, 3 + sum(1 + t.count("\n") for t in live)) for d in ("values", "values-de")]


def test_gate_lints_once(spark):
    """The findings of a gate are read from where they were written, not made again."""
    c = corpus_of(spark, [("a", "x — y"), ("b", "fine")])
    found, free = lint.gate(c, ["de"])
    assert not free and [r["code"] for r in found.collect()] == ["em-dash"]
    for df in (found, lint.report(found)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Generate" not in plan


# Glossary terms, previews, groups


def test_terms_meet_texts_by_their_rarest_word(spark):
    long = " ".join(f"w{i}" for i in range(30))
    names = ["Pay", "pay now", "the the", long, "absent word"]
    terms = spark.createDataFrame([(n, None, None, False, False, False, []) for n in names], GLOSSARY)
    texts = ["Pay the bill", "now pay now", "the-the end", f"x {long.upper()}! y", long.replace("w7", "w8"), "", "now pay"]
    values = spark.createDataFrame([(f"id:{i}", "de", t, "z") for i, t in enumerate(texts)], "rec_id string, lang string, source string, value string")
    got = sorted((r["rec_id"], r["term"]) for r in glossary.hits(Glossary(terms, spark.createDataFrame([], GLOSSARY_T)), values).collect())
    assert got == [("id:0", "Pay"), ("id:1", "Pay"), ("id:1", "pay now"), ("id:2", "the the"), ("id:3", long), ("id:6", "Pay")]
    words = spark.createDataFrame([("pay",), ("pay",), ("now",)], "word string")
    parts = spark.createDataFrame([("pay now", ["pay", "now"]), ("pay later", ["pay", "later"])], "term string, parts array<string>")
    assert [tuple(r) for r in glossary.anchors(parts, words).collect()] == [("pay now", "now")]


def test_terms_of_common_words_meet_only_texts_that_have_them(spark):
    """Words that many terms and texts share bring no pairs that are none; a term named thrice is found thrice."""
    names = [f"a{i} b{j}" for i in range(20) for j in range(20)]
    terms = spark.createDataFrame([(n, None, None, False, False, False, []) for n in names + ["a0 b0"] * 2], GLOSSARY)
    values = spark.createDataFrame([(f"id:{k}", "de", f"Buy {n.upper()} now", "z") for k, n in enumerate(names)], "rec_id string, lang string, source string, value string")
    places = glossary.term_places(terms.selectExpr("term", "split(term, ' ') AS parts"), values.select("rec_id", "source"))
    assert sorted(map(tuple, places.collect())) == sorted((f"id:{k}", n) for k, n in enumerate(names))
    plan = places._jdf.queryExecution()
    met = [int(m.value()) for m in _join_rows(plan.executedPlan()) if m is not None]
    assert met and max(met) <= len(names)  # 8,000 pairs met by their rarest words
    got = [r["term"] for r in glossary.hits(Glossary(terms, spark.createDataFrame([], GLOSSARY_T)), values).collect()]
    assert sorted(got) == sorted(names + ["a0 b0"] * 2)


def _join_rows(plan):
    """The metrics of rows out of the joins of a plan that has run."""
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        return _join_rows(plan.executedPlan())
    if plan.getClass().getSimpleName().endswith("QueryStageExec"):
        return _join_rows(plan.plan())
    own = [plan.metrics().get("numOutputRows").get()] if plan.getClass().getSimpleName().endswith("JoinExec") else []
    return own + [m for i in range(plan.children().size()) for m in _join_rows(plan.children().apply(i))]


def test_preview_counts_the_rest(spark):
    said = "array<struct<language_iso: string, translation: string, is_unverified: boolean>>"
    updates = spark.createDataFrame([(f"id:{i}", i, "k", [("de", "x", True), ("en", "y", False)]) for i in (30, 4, 100, 7, 2)], f"rec_id string, key_id long, key string, translations {said}")
    creates = spark.createDataFrame([("new:1", "b", [("en", "y", False)])], f"rec_id string, key_name string, translations {said}")
    meta = spark.createDataFrame([], "rec_id string, key_id long, fields array<string>")
    got = sorted(tuple(r) for r in sync.preview(updates, creates, meta).collect())
    assert got == [("create", 1, "b", "en", 0), ("update", 1, "2", "de,en", 2), ("update", 2, "4", "de,en", 2), ("update", 3, "7", "de,en", 2)]


def test_groups_are_rows(spark):
    c = corpus_of(spark, [(f"fam_{i}", "Same " if i % 2 else f"own {i}") for i in range(40)])
    assert {(r["text"], r["n"]) for r in rules.reuse_candidates(c).collect()} == {("same", 20)} and rules.reuse_candidates(c).count() == 20
    assert usage.shared_boilerplate(c.keys.select(F.col("key_name").alias("key"), "context")).select("n").distinct().first()["n"] == 40
    for df in (rules.reuse_candidates(c), usage.shared_boilerplate(c.keys.select(F.col("key_name").alias("key"), "context"))):
        assert "collect_" not in df._jdf.queryExecution().optimizedPlan().toString()


# Trees, order, names, narrow lints

TREE = ("src/A.swift", "build/B.swift", "src/X.xcassets/C.swift", "src/R.x.generated.swift", "src/L.strings", "src/D.kt", "fastlane/E.swift", "node_modules/F.kt", ".gradle/G.kt", "Podfile", "a b+c/é.test.swift", "m/x.yml", "Pods/y.yml")


@pytest.mark.parametrize(
    "rules, want",
    [
        (trees.UNUSED_KEYS, {"src/A.swift", "fastlane/E.swift", "Podfile", "a b+c/é.test.swift", "m/x.yml"}),
        (trees.CONTEXTS, {"src/A.swift", "src/X.xcassets/C.swift", "src/R.x.generated.swift", "a b+c/é.test.swift"}),
        (trees.ANDROID_TREE, {"src/D.kt", "node_modules/F.kt"}),
    ],
)
def test_trees_open_chosen_files_only(spark, tmp_path, rules, want):
    root = tmp_path / "my tree"
    for name in TREE:
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(f"in {name}", encoding="utf-8")
    df = trees.tree(spark, str(root), rules)
    assert {r["path"]: r["text"] for r in df.collect()} == {name: f"in {name}" for name in want}
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().get("numFiles").get().value() == len(want)


def test_ten_parts_in_the_order_of_their_names(spark, tmp_path):
    c = corpus_of(spark, [(f"k{i}", f"text {i}") for i in range(500)])
    shuffled = Corpus(c.keys.withColumn("key_id", F.when(F.col("ord") % 7 != 0, (F.col("ord") * 37) % 1009)), c.translations)
    corpora.write_corpus(shuffled, f"{tmp_path}/c", parts=10)
    parts = sorted(glob.glob(f"{tmp_path}/c/part-*"))
    got = [json.loads(line) for p in parts for line in open(p, encoding="utf-8")]
    want = sorted((x["key_id"] is None, x["key_id"] or 0, x["ord"]) for x in shuffled.keys.collect())
    assert len(parts) == 10 and [(x.get("key_id") is None, x.get("key_id") or 0) for x in got] == [w[:2] for w in want]
    assert [x["key"] for x in got if "key_id" not in x] == [f"k{w[2]}" for w in want if w[0]]


def test_numbers_keep_columns_of_any_name(spark):
    rows = spark.createDataFrame([(i % 3, i, f"p{i}", i, i, i, i) for i in range(50)], "g int, x int, part string, _row int, _first int, n int, of int")
    got = review.numbered(rows, F.desc("x"), by="g").collect()
    assert set(got[0].asDict()) == {"g", "x", "part", "_row", "_first", "n", "of", "entry"} and all(r["part"] == f"p{r['x']}" and r["n"] == r["_row"] == r["x"] for r in got)
    assert sorted((r["g"], r["entry"]) for r in got) == sorted((g, k + 1) for g in range(3) for k in range(len(range(g, 50, 3))))


def test_lints_shuffle_no_values(spark):
    """Values are read once, and what is shuffled by key is narrow."""
    c = corpus_of(spark, [(f"k{i}", f"see https://x.example/{i} [%s] [%s]") for i in range(5)])
    for check, n in ((lint.lint_urls, 0), (lint.lint_placeholder_count, 0), (lint.lint_placeholder_indexing, 5)):
        made = check(c)
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("value#") > 0 and not any("value#" in line for line in plan.splitlines() if line.strip().startswith(("Window", "+- Window", "Filter (_some")))
        assert made.count() == n


# Spelling


def test_us_pairs_by_the_texts_own_words(spark):
    pairs = {
        "colour": "color", "colours": "colors", "favourite": "favorite", "behaviour": "behavior", "organise": "organize", "organisation": "organization", "analyse": "analyze", "centre": "center", "fibre": "fiber",
        "cancelled": "canceled", "travelling": "traveling", "catalogue": "catalog", "defence": "defense", "licences": "licenses", "neighbourhood": None,
    }
    innocent = ["promise", "advise", "four", "for", "hour", "your", "more", "before", "there", "litre", "liter", "called", "filling", "filing", "rise", "rize", "science", "absence", "sunrise", "exercise", "contour", "are", "acre", "league", "our", "or"]
    words = [w for w in [*pairs, *pairs.values(), *innocent] if w]
    got = rules.us_pairs(spark.createDataFrame([(w, 3) for w in words], "word string, n long")).collect()
    found = {(r["word"], r["us"]) for r in got}
    want = {(w, u) for w, u in pairs.items() if u}
    assert found == want, found ^ want
    assert rules.us_pairs(spark.createDataFrame([("colour", 3), ("color", 1)], "word string, n long"), least=2).count() == 0
    c = corpus_of(spark, [("a", "Neighbours, colour and flavour"), ("b", "a flavor; organise"), ("c", "promise")])
    assert {(r["rec_id"], r["token"]) for r in rules.us_spelling(c).collect()} == {("id:0", "colour -> color"), ("id:0", "flavour -> flavor"), ("id:1", "organise -> organize")}


# Streams


def test_streams_find_what_batches_find(spark, tmp_path):
    """Two runs of a query over files that come in between; the second goes on from the checkpoint of the first."""
    texts = [(f"k{i}", ["fine", "a — b", "ночь 5% off [%s]", " %d gone", "%1$#@v@ of", "two  gaps%%"][i % 6]) for i in range(60)] + [("k4::v", "x")]
    c = corpus_of(spark, texts)
    contexts = F.when(F.col("ord") % 3 == 0, "Surface: x\nRegister: \nTone: calm").when(F.col("ord") % 3 == 1, "Surface: это длинная фраза").otherwise("Surface: x")
    c = Corpus(c.keys.withColumn("context", contexts), c.translations)
    values, keys = lint.live_values(c, "platforms").select("rec_id", "key", "lang", "value", "platforms"), lint.live_keys(c).select("rec_id", "key", "context")
    owners = lint.key_names(c).join(lint.companions(c), "name", "left_semi").select("rec_id").distinct()
    runs = 0
    for half in (0, 1):
        values.where(F.abs(F.xxhash64("rec_id")) % 2 == half).write.mode("append").parquet(f"{tmp_path}/values")
        keys.where(F.abs(F.xxhash64("rec_id")) % 2 == half).write.mode("append").parquet(f"{tmp_path}/keys")
        found = streams.stream_lints(spark.readStream.schema(values.schema).parquet(f"{tmp_path}/values"), owners)
        said = streams.stream_lint_contexts(spark.readStream.schema(keys.schema).parquet(f"{tmp_path}/keys"))
        for df, name in ((found, "found"), (said, "said")):
            query = streams.append_findings(df, f"{tmp_path}/{name}", f"{tmp_path}/{name}-checkpoint")
            assert query.awaitTermination(120) and query.exception() is None
            runs += 1
    batch = lint.lint_values(c).unionByName(lint.lint_source_script(c)).unionByName(lint.lint_placeholders(c))
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert runs == 4 and rows(spark.read.parquet(f"{tmp_path}/found")) == rows(batch) and len({r[4] for r in rows(batch)}) >= 6
    assert rows(spark.read.parquet(f"{tmp_path}/said")) == rows(lint.lint_context(c)) and lint.lint_context(c).count() > 20


# Names of resources


def test_names_of_resources_are_not_broadcast(spark, tmp_path):
    """How many names files hold can't be told from their size: no side of the joins is sent whole to the executors. Fields with an
    exact name stand for it alone, others for every name written so."""
    rows = [("res/values/s.xml", '<string name="a.b"/><string name="a-b"/><string name="c.d"/><string name="c_d"/><string name="e"/>'), ("F.kt", 'R.string.a_b R.string.c_d\nimport x.R.string as S\nS.e getString("c.d")'), ("l.xml", "@string/a.b @string/a_b"), (None, "R.string.e")]
    spark.createDataFrame(rows, "path string, text string").write.parquet(f"{tmp_path}/files")
    files = spark.read.parquet(f"{tmp_path}/files")
    used = usage.android_usage(files)
    assert sorted(map(tuple, used.collect())) == [("a-b", "F.kt:R.string"), ("a.b", "F.kt:R.string"), ("a.b", "l.xml:@resource"), ("c.d", "F.kt:dynamic-string"), ("c_d", "F.kt:R.string"), ("e", "F.kt:S")]
    for df in (used, usage.unused_keys(usage.android_defined_keys(files), used)):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()

"""Small corpora with one defect each, and invariants of edits and synchronisation."""

from __future__ import annotations

import json


from pyspark.sql import functions as F

from lingspan.operators import edits, glossary, lint, review, rules, usage
from lingspan.plans import bundles, sync
from lingspan.schema import GLOSSARY, GLOSSARY_T, KEYS, TRANSLATIONS, Corpus, Glossary
from lingspan.sources import corpus as corpora
from lingspan.sources import dumps
from lingspan.streaming.lints import stream_lint_values


def make(spark, keys, values):
    """keys: (name, platforms, options); values: (name, lang, form, value, flags)."""
    rows, ids = [], {}
    for i, (name, platforms, o) in enumerate(keys):
        key_id = None if o.get("new") else i + 1
        ids[name] = f"id:{i + 1}" if key_id else f"new:{name}"
        rows.append((ids[name], key_id, i, None if o.get("by") else name, o.get("by"), platforms, o.get("plural", False), o.get("archived", False), o.get("context"), None, o.get("files"), o.get("dirty_meta", [])))
    texts = [(ids[n], lang, form, v, "u" in f, "d" in f) for n, lang, form, v, f in values]
    return Corpus(spark.createDataFrame(rows, KEYS), spark.createDataFrame(texts, TRANSLATIONS))


def found(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def small(spark):
    return make(
        spark,
        [("a", ["ios"], {}), ("b", ["other"], {}), ("c", [], {}), ("gone", ["ios"], {"archived": True}), ("p", ["ios"], {"plural": True}), ("s", ["ios"], {}), ("s::v", ["ios"], {})],
        [
            ("a", "en", "", "Hi [%1$s] [%2$i]", ""), ("a", "de", "", "Hallo [%s]", "d"), ("a", "fr", "", "", ""), ("a", "es", "", "[%s] [%i]", "u"),
            ("b", "en", "", "70% — x", ""), ("b", "de", "", " 70% %d  x", ""), ("c", "de", "", "see https://a.b/1.", ""), ("c", "fr", "", "see https://a.b/2", ""),
            ("gone", "en", "", "—", ""), ("p", "en", "one", "1%", ""), ("p", "en", "other", "ok", ""), ("s", "en", "", "%1$#@v@ %2$d", ""), ("s::v", "en", "", "x %%", ""),
        ],
    )


def test_lint_values(spark):
    got = found(lint.lint_values(small(spark)), "key", "lang", "code", "token")
    assert got == [("b", "de", "double-space", "2 spaces"), ("b", "de", "edge-whitespace", "leading"), ("b", "en", "em-dash", "—")]


def test_lint_placeholders(spark):
    got = found(lint.lint_placeholders(small(spark)), "key", "lang", "severity", "code", "token")
    # no lone percent on a platform that doesn't format; the paired substitution variable is fine
    assert got == [("b", "de", "error", "bare-placeholder", "%d"), ("p", "en", "error", "lone-percent", "%"), ("s::v", "en", "warn", "literal-percent-escape", "%%")]


def test_group_checks(spark):
    c = small(spark)
    assert found(lint.lint_placeholder_count(c), "key", "lang", "token") == [("a", "de", "%s×1")]
    assert found(lint.lint_placeholder_count(c, ["fr"]), "key", "lang") == []  # the filter comes after the comparison
    assert found(lint.lint_placeholder_indexing(c), "key", "lang", "severity") == [("a", "es", "error")]
    assert found(lint.lint_urls(c), "key", "lang", "token") == [("c", "fr", "https://a.b/2")]  # a tie goes to the first language


def test_gate_and_summary(spark):
    c = small(spark)
    assert lint.gate(c, ["fr"])[1] and not lint.gate(c, ["de"])[1]
    assert lint.summary(lint.lint_values(c)).first()["errors"] == 1


def test_native_plans(spark):
    for f in (lint.lint_all, usage.cap_violations, review.coverage):
        plan = f(small(spark))._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_backlog_states(spark):
    c = make(spark, [("a", [], {}), ("b", [], {}), ("c", [], {}), ("d", [], {})], [("b", "de", "", "", ""), ("c", "de", "", "x", "u"), ("d", "de", "", "x", "")])
    assert found(review.backlog(c, "de"), "key", "status") == [("a", "missing"), ("b", "empty"), ("c", "unverified")]


def test_numbers_over_many_ranges(spark):
    """Ranges that AQE joins together, ties, nulls, and a group with most of the rows."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        rows = spark.range(1_000_000).selectExpr("xxhash64(id) % 700000 AS k", "CASE WHEN id % 10 = 0 THEN NULL WHEN id % 10 < 8 THEN 'hot' ELSE concat('g', id % 7) END AS g", "repeat('x', 20) AS pad")
        got = review.numbered(rows, "k").selectExpr("entry", "lead(entry) OVER (ORDER BY k, entry) - entry AS step")
        assert got.selectExpr("count(*)", "min(entry)", "max(entry)", "count_if(step <> 1)").first()[:] == (1_000_000, 1, 1_000_000, 0)
        mine = review.numbered(rows, "k", by="g").groupBy("g").agg(F.count("*").alias("n"), F.min("entry").alias("low"), F.max("entry").alias("high"), F.count_distinct("entry").alias("numbers"))
        assert all(x["low"] == 1 and x["high"] == x["n"] == x["numbers"] for x in mine.collect()) and mine.count() == 9
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_numbering_and_slices(spark):
    c = small(spark)
    got = review.numbered(c.keys, *review.corpus_order())
    assert [r["entry"] for r in got.orderBy("key_id").collect()] == list(range(1, 8))
    assert review.slice_of(got, 2, 3).count() == 2
    for start, end in ((0, 1), (6, 9)):
        try:
            review.slice_of(got, start, end)
            raise AssertionError("no error")
        except ValueError:
            pass


def test_apply_touches_only_what_is_named(spark):
    c = small(spark)
    e = spark.createDataFrame([("a", "de", "", "neu", 0), ("a", "de", "", "neuer", 1), ("a", "es", "", "[%s] [%i]", 0), ("zz", "de", "", "x", 0), ("p", "de", "", "x", 0), ("p", "de", "odd", "x", 0)], "key string, lang string, form string, value string, pos int")
    new, report = edits.apply_edits(c, e)
    assert found(report, "key", "lang", "form", "status") == [("a", "de", "", "apply"), ("a", "es", "", "apply"), ("p", "de", "", "type_mismatched"), ("p", "de", "odd", "unknown_form"), ("zz", "de", "", "unmatched")]
    rows = {(r["rec_id"], r["lang"]): r for r in new.translations.where("rec_id = 'id:1'").collect()}
    assert rows["id:1", "de"]["value"] == "neuer" and rows["id:1", "de"]["is_dirty"] and rows["id:1", "de"]["is_unverified"]
    assert rows["id:1", "es"]["is_unverified"] and not rows["id:1", "es"]["is_dirty"]  # the same value again
    assert found(edits.corpus_diff(c, new), "rec_id", "lang", "change") == [("id:1", "de", "changed")]
    assert edits.check_changed_set(edits.corpus_diff(c, new), report.where("status = 'apply'")).collect()[0]["problem"] == "unchanged"


def test_backlog_edits_are_all_or_nothing(spark):
    c = small(spark)
    e = spark.createDataFrame([("a", "es", "", "[%1$s] a\u00a0b", 0), ("b", "es", "", "ok", 0)], "key string, lang string, form string, value string, pos int")
    same, problems = edits.apply_backlog_edits(c, e, "es")
    assert same is c and {r["problem"] for r in problems.collect()} == {"forbidden space", "placeholders differ"}


def test_platforms_context_files(spark):
    c = small(spark)
    ops = spark.createDataFrame([("a", ["web"], None, None)], "key string, add array<string>, remove array<string>, replace array<string>")
    row = edits.set_platforms(c, ops).keys.where("rec_id = 'id:1'").first()
    assert row["platforms"] == ["ios", "web"] and row["dirty_meta"] == ["platforms"]
    ops = spark.createDataFrame([("a", None, ["ios"], None)], "key string, add array<string>, remove array<string>, replace array<string>")
    try:
        edits.set_platforms(c, ops).keys.collect()
        raise AssertionError("no error")
    except Exception as e:
        assert "needs a platform" in str(e)
    c2 = edits.set_context(c, spark.createDataFrame([("a", "  ")], "key string, new_context string"))
    assert c2.keys.where("rec_id = 'id:1'").first()["dirty_meta"] == []
    c3 = edits.set_filename(c, spark.createDataFrame([("a", "ios", "X.strings")], "key string, platform string, filename string"))
    assert c3.keys.where("rec_id = 'id:1'").first()["filenames"] == {"ios": "X.strings"}


def test_push_verify_drain(spark):
    c = make(spark, [("a", ["ios"], {"dirty_meta": ["context"]}), ("n", [], {"new": True})], [("a", "en", "", "x", "d"), ("a", "de", "", "y", "du"), ("n", "en", "", "z", "d")])
    updates, creates, meta = sync.push_plan(c)
    assert creates.first()["platforms"] == ["ios"] and meta.first()["description"] == ""
    sent = sync.sent_values(updates)
    plural = c.keys.select("rec_id", "plural")
    stored = spark.createDataFrame([(1, "en", "x"), (1, "de", "other")], "key_id bigint, lang string, stored string")
    bad = sync.verify_push(sent, stored, plural)
    assert found(bad, "lang", "problem") == [("de", "differs")]
    assert found(sync.drain(c, sent, bad).translations.where("is_dirty"), "rec_id", "lang") == [("id:1", "de"), ("new:n", "en")]
    stamped = sync.stamp_created(c, spark.createDataFrame([("n", 9)], "name string, new_id bigint"))
    assert stamped.keys.where("rec_id = 'new:n'").first()["key_id"] == 9


def test_refs_and_renames(spark):
    keys = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "key_id bigint, key_name string")
    refs = spark.createDataFrame([("1", "id"), ("7", "id"), ("a", "name"), ("b", "name")], "ref string, kind string")
    assert found(sync.resolve_refs(keys, refs), "ref", "status") == [("1", "ok"), ("7", "not_found"), ("a", "ok"), ("b", "ambiguous")]
    plan = sync.rename_plan(spark.createDataFrame([(1, "x"), (2, "x"), (3, "1bad"), (None, "ok")], "key_id bigint, new_name string"))
    assert [r["problem"] for r in plan.orderBy("new_name", "key_id").collect()] == ["invalid name", "no key id", "duplicate target", "duplicate target"]


def test_json_round_trip(spark, tmp_path):
    lines = [
        {"key_id": 2, "key": "k", "platforms": ["ios"], "en": "x", "context": "c", "unverified": ["de"], "t": {"de": "", "en": "x"}},
        {"key_id": 1, "key": {"ios": "p", "web": "q"}, "platforms": ["ios", "web"], "plural": True, "en": "b", "t": {"en": {"one": "a", "other": "b"}}},
    ]
    (tmp_path / "c.ndjson").write_text("\n".join(json.dumps(x) for x in lines) + "\n\n")
    c = corpora.read_corpus(spark, str(tmp_path / "c.ndjson"))
    got = [json.loads(r["line"]) for r in corpora.to_json_lines(c).orderBy("key_id").collect()]
    assert got == lines[::-1]
    corpora.write_corpus(c, str(tmp_path / "out"))
    again = corpora.read_corpus(spark, str(tmp_path / "out"))
    assert edits.corpus_diff(c, again).count() == 0
    (tmp_path / "bad.ndjson").write_text("[1]\n")
    try:
        corpora.read_corpus(spark, str(tmp_path / "bad.ndjson")).keys.collect()
        raise AssertionError("no error")
    except Exception as e:
        assert "no JSON object" in str(e)


def test_findings_table(spark):
    text = "| # | key | lang | verdict | suggestion | applied_value |\n|---|---|---|---|---|---|\n| 1 | `a` | DE | accept | s | — |\n| 2 | b | de | modify | s | x \\| y |\n| 3 | c | de | reject | s | z |\n| 4 | d | de |\n"
    good, bad = dumps.findings_table(spark.createDataFrame([("f", text)], "path string, text string"), "de")
    assert found(good, "key", "value") == [("a", "s"), ("b", "x | y")] and bad.count() == 1


def test_glossary(spark):
    terms = spark.createDataFrame([("Water", 1, " d ", False, True, False, ["domain"]), ("water", None, None, False, False, True, ["a", "b", "c", "d"]), ("", None, "x", False, True, False, [])], GLOSSARY)
    texts = spark.createDataFrame([("Water", "de", "Wasser", None), ("Water", "fr", None, "n"), ("Water", "en", "w", None), ("Water", "xx", "w", None)], GLOSSARY_T)
    g = Glossary(terms, texts)
    got = {(r["term"], r["problem"]) for r in glossary.lint_glossary(g, ["de", "fr"]).collect()}
    assert {("", "empty term"), ("water", "frozen and forbidden"), ("water", "4 tags, at most 3"), ("Water", "note without translation: fr"), ("Water", "source form repeated"), ("Water", "unknown language: xx"), ("water", "differs only in case"), ("water", "no description")} <= got
    csv = [r["line"] for r in glossary.to_csv(Glossary(terms.where("term = 'Water'"), texts.where("lang = 'de'"))).collect()]
    assert csv == ["term;description;casesensitive;translatable;forbidden;tags;de", "Water;d;no;yes;no;domain;Wasser"]
    plan = glossary.upsert_plan(Glossary(terms.where("term <> ''"), texts), spark.createDataFrame([(7, "water")], "term_id bigint, term string"))
    assert found(plan, "term", "action", "remote_id") == [("Water", "create", None), ("water", "update", 7)]
    values = spark.createDataFrame([("r", "de", "Drink water now", "Trink jetzt")], "rec_id string, lang string, source string, value string")
    assert found(glossary.hits(Glossary(terms.where("term = 'Water'"), texts), values), "term", "kind") == [("Water", "divergence")]


def test_usage(spark):
    files = spark.createDataFrame([("src/A.swift", 'R.string.localizable.hello() "plain_key" /* strings.other */'), ("res/values/strings.xml", '<string name="one.two">x</string><item type="string" name="three"/>'), ("B.kt", "import a.b.R.string as S\nS.one_two getString(\"three\")")], "path string, text string")
    entries = spark.createDataFrame([("Localizable.strings", k, "en", "p") for k in ("hello", "plain_key", "other", "lost")], "pool string, key string, locale string, path string")
    generated = spark.createDataFrame([("localizable", k, "Localizable.strings", k) for k in ("hello", "other", "lost")], "table string, accessor string, pool string, key string")
    used = usage.ios_usage(files, generated, entries)
    assert {r["key"] for r in used.collect()} == {"hello", "other", "plain_key"}
    assert found(usage.pool_status(entries, used).where("status = 'all_unused'"), "key") == [("lost",)]
    assert {r["key"] for r in usage.android_usage(files).collect()} == {"one.two", "three"}


def test_context_against_code(spark):
    c = make(spark, [("hello", ["ios"], {"context": "Shown in HomeScreen and LostScreen.swift, GoalPicker. At most 5 chars"}), ("quiet", ["ios"], {"by": {"ios": "quiet"}})], [("hello", "en", "", "[%s] is a long text", "")])
    files = spark.createDataFrame([("Home/HomeScreen.swift", "class HomeScreen { R.string.localizable.hello() }\nclass GoalPickerView {}\nlet q = \"quiet\"")], "path string, text string")
    none = files.limit(0)
    rows = {r["key"]: r for r in usage.lint_context_against_code(c, dumps.lines_of(files), files, dumps.lines_of(none), none).collect()}
    assert rows["hello"]["referenced"] == "ios" and rows["hello"]["dead_citations"] == ["LostScreen", "LostScreen.swift"] and rows["hello"]["surface_mismatch"] == ["GoalPicker"]
    assert rows["hello"]["margin"] == 14 and rows["hello"]["placeholder_unexplained"]
    assert rows["ios=quiet"]["usage_sites"] == ["Home/HomeScreen.swift:3 (literal)"]


def test_bundles(spark):
    c = make(spark, [("b", ["ios"], {}), ("a", ["ios", "other"], {})], [("a", "en", "", "[%1$s] 5[%]", ""), ("a", "de", "", "", "u"), ("b", "en", "", 'q"x', ""), ("b", "de", "", "y", "u")])
    files = {r["rel_path"]: r["text"] for r in bundles.render_bundle(c, "ios").collect()}
    assert files["de.lproj/Localizable.strings"] == '"a" = "%1$s 5%%";\n"b" = "y";\n'.replace("%1$s", "%1$@")
    staged = bundles.render_bundle(c, "ios").select("rel_path", "text")
    assert bundles.lint_bundle(staged, ["en", "de"], "ios").count() == 0
    assert found(bundles.release_gate(c, "ios"), "lang", "empty", "unverified") == [("de", 1, 1)]
    assert json.loads({r["rel_path"]: r["text"] for r in bundles.render_bundle(c, "server").collect()}["en.json"]) == {"a": "%1$s 5%"}


def test_rules(spark):
    c = make(
        spark, [("tM", [], {"context": "Surface: s\nType: button label\nContext: c"}), ("tF", [], {"context": "Type: nonsense"}), ("pl", [], {"plural": True})],
        [("tM", "de", "", "gleich", ""), ("tF", "de", "", "gleich", ""), ("tM", "en", "", "My favourite colour is here.", ""), ("tM", "ja", "", "水!", ""), ("tM", "ru", "", "ваш", ""), ("pl", "id", "one", "x", ""), ("pl", "id", "other", "x", "")],
    )
    assert found(rules.gender_pairs(c), "lang", "code") == [("de", "gender-identical")]
    assert found(rules.us_spelling(c), "token") == [("colour -> color",), ("favourite -> favorite",)]
    assert found(rules.final_period(c), "lang") == [("en",)] and found(rules.length_budget(c), "lang") == [("en",)]
    assert found(rules.cjk_halfwidth(c), "lang") == [("ja",)] and found(rules.formal_register_leak(c), "token") == [("ваш",)]
    assert found(rules.plural_categories(c), "token") == [("extra one",)]
    assert ("id:2", "missing Surface") in found(rules.context_coverage(c), "rec_id", "token") and ("id:2", "unknown role: nonsense") in found(rules.context_coverage(c), "rec_id", "token")


def test_streaming_lint(spark, tmp_path):
    rows = spark.createDataFrame([("r", "de", "a — b")], "rec_id string, lang string, value string")
    rows.write.parquet(str(tmp_path / "in"))
    q = stream_lint_values(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName("found").start()
    q.processAllAvailable()
    q.stop()
    assert found(spark.table("found"), "code") == [("em-dash",)]


def test_qa_merge(spark):
    rows = spark.createDataFrame([(1, "de", "spelling", 2, 9, "v2", "q"), (1, "de", "caps", 1, 8, "v1", None)], "key_id bigint, lang string, issue string, pass_ord int, translation_id bigint, value string, qa string")
    r = review.merge_qa_issues(rows).first()
    assert (r["issues"], r["translation_id"], r["value"], r["qa"]) == (["caps", "spelling"], 8, "v1", "q")


def test_versions(spark, tmp_path):
    base = str(tmp_path / "v")
    for i in range(3):
        late = corpora.write_versioned(spark.range(i + 1), base, f"2024-01-0{i + 1}", retain=2)
    assert late == ["2024-01-01"] and corpora.restore(spark, base, "2024-01-02").count() == 2


def test_empty_corpus(spark):
    c = make(spark, [], [])
    assert lint.lint_all(c).count() == 0 and review.coverage(c).count() == 0 and corpora.to_json_lines(c).count() == 0


def test_glossary_hits_of_long_terms(spark):
    """Terms of one, five and seven words; a text shorter than the longest."""
    names = ["Pay", "Terms of Use and Sale", "one two three four five six seven"]
    terms = spark.createDataFrame([(n, None, None, False, False, False, []) for n in names], GLOSSARY)
    texts = spark.createDataFrame([], GLOSSARY_T)
    values = spark.createDataFrame([("id:1", "de", "See the Terms of use, and sale.", "x"), ("id:2", "de", "one two three four five six seven eight pay", "x")], "rec_id string, lang string, source string, value string")
    assert found(glossary.hits(Glossary(terms, texts), values), "rec_id", "term") == [("id:1", names[1]), ("id:2", names[0]), ("id:2", names[2])]

"""Readers of dumps and trees, and reports, on small files."""

from __future__ import annotations

import json

from lingspan.operators import review, usage
from lingspan.sources import corpus as corpora
from lingspan.sources import dumps, reports


def put(folder, name, data):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(data if isinstance(data, str) else json.dumps(data), encoding="utf-8")
    return str(folder)


def test_service_keys_and_rebuild(spark, tmp_path):
    key = {
        "key_id": 5, "key_name": {"ios": "a", "web": "a"}, "platforms": ["ios"], "filenames": {"ios": "X.strings", "web": ""}, "tags": ["t"], "description": " d ", "context": "", "char_limit": 0, "is_archived": False, "is_hidden": False,
        "is_plural": True, "translations": [{"translation_id": 1, "language_iso": "de", "translation": '{"one":"1","other":"n"}', "is_unverified": True, "is_fuzzy": False}, {"translation_id": 2, "language_iso": "fr", "translation": "", "is_unverified": True, "is_fuzzy": False}],
    }
    put(tmp_path, "p1.json", {"keys": [key, key | {"key_id": 6, "is_archived": True}]})
    raw = dumps.service_keys(spark, str(tmp_path))
    assert [r["key_id"] for r in raw.collect()] == [5] and dumps.service_keys(spark, str(tmp_path), "only").first()["key_id"] == 6
    assert dumps.service_keys(spark, str(tmp_path), names=["a"], tags=["t"], platforms=["ios"]).count() == 1
    c = dumps.corpus_from_service(raw)
    k = c.keys.first()
    assert (k["key_name"], k["context"], k["char_limit"], k["filenames"], k["plural"]) == ("a", "d", None, {"ios": "X.strings"}, True)
    assert sorted((r["lang"], r["form"], r["value"], r["is_unverified"]) for r in c.translations.collect()) == [("de", "one", "1", True), ("de", "other", "n", True), ("fr", "other", "", False)]


def test_other_dumps(spark, tmp_path):
    put(tmp_path / "l", "a.json", {"languages": [{"lang_id": 7, "lang_iso": "de"}]})
    assert tuple(dumps.service_languages(spark, str(tmp_path / "l")).first()) == ("de", 7)
    put(tmp_path / "g", "a.json", json.dumps({"data": [{"id": 1, "term": "x", "translatable": "no", "translations": [{"langId": 7, "translation": "y"}]}]}) + "\n" + json.dumps({"id": 2, "term": "z"}))
    assert sorted(r["term"] for r in dumps.service_glossary(spark, str(tmp_path / "g")).collect()) == ["x", "z"]
    put(tmp_path / "q", "issue=spelling/a.json", {"translations": [{"translation_id": 1, "key_id": 5, "language_iso": "de", "translation": "v"}]})
    assert review.merge_qa_issues(dumps.service_translations(spark, str(tmp_path / "q"))).first()["issues"] == ["spelling"]


def test_packs_maps_and_lists(spark, tmp_path):
    put(tmp_path / "p", "es_ES.json", {"k": "v", "n": {"translation": "t", "notes": "x"}})
    assert sorted(tuple(r) for r in dumps.locale_packs(spark, str(tmp_path / "p")).collect()) == [("k", "es", "v"), ("n", "es", "t")]
    put(tmp_path / "e", "de.json", {"a": "x", "b": {"one": "1", "odd": "2"}})
    good, bad = dumps.read_edit_maps(spark, str(tmp_path / "e"))
    assert sorted((r["key"], r["lang"], r["form"], r["value"]) for r in good.collect()) == [("a", "de", "", "x"), ("b", "de", "one", "1")] and bad.first()["problem"] == "unknown form"
    put(tmp_path, "t.json", {"term": {"de": "x"}})
    assert tuple(dumps.read_term_edits(spark, str(tmp_path / "t.json")).first()) == ("term", "de", "x")
    put(tmp_path, "ids.txt", "# c\n12\n\nx\n")
    assert [r["ref"] for r in dumps.read_key_list(spark, str(tmp_path / "ids.txt"), "id").collect()] == ["12"]
    put(tmp_path, "r.json", [{"key_id": 1, "new_name": "n"}])
    assert dumps.read_rename_map(spark, str(tmp_path / "r.json")).first()["new_name"] == "n"


def test_source_tree(spark, tmp_path):
    for name in ("src/A.swift", "build/B.swift", "src/X.xcassets/C.swift", "src/R.x.generated.swift", "src/L.strings", "src/D.kt"):
        put(tmp_path, name, "line 1\nline 2")
    files = dumps.source_tree(spark, str(tmp_path), [".swift", ".strings"])
    assert [r["path"] for r in files.collect()] == ["src/A.swift"]
    assert [(r["lineno"], r["line"]) for r in dumps.lines_of(files).collect()] == [(1, "line 1"), (2, "line 2")]
    put(tmp_path, "en.lproj/Localizable.strings", '"a\\"b" = "x";')
    entries = usage.pool_entries(dumps.string_tables(spark, str(tmp_path)))
    assert [(r["pool"], r["key"], r["locale"]) for r in entries.collect()] == [("Localizable.strings", 'a"b', "en")]


def test_meta_languages_and_glossary_file(spark, tmp_path):
    put(tmp_path, "m.json", {"languages": ["de", "en", "ru"]})
    langs = corpora.read_languages(spark, str(tmp_path / "m.json"))
    assert [r[0] for r in corpora.target_langs(langs).collect()] == ["de"] and corpora.translation_langs(langs).count() == 2
    assert corpora.read_languages(spark, str(tmp_path / "none.json")).count() == 21
    put(tmp_path, "g.ndjson", json.dumps({"term": "b", "forbidden": True, "tags": ["ui"], "t": {"de": "x"}, "t_notes": {"fr": "n"}}) + "\n" + json.dumps({"term": "A"}))
    g = corpora.read_glossary(spark, str(tmp_path / "g.ndjson"))
    assert [json.loads(r["line"]) for r in corpora.glossary_lines(g).collect()] == [{"term": "A"}, {"term": "b", "forbidden": True, "tags": ["ui"], "t_notes": {"fr": "n"}, "t": {"de": "x"}}]
    assert corpora.read_glossary(spark, str(tmp_path / "gone.ndjson")).terms.count() == 0


def test_usage_report(spark, tmp_path):
    entries = spark.createDataFrame([("p", "a"), ("p", "b")], "pool string, key string")
    used = spark.createDataFrame([("p", "a")], "pool string, key string")
    names = spark.createDataFrame([("z",)], "name string")
    reports.write_usage_report(usage.pool_status(entries, used), usage.pool_counts(entries, used), names, str(tmp_path / "r"))
    assert spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "r/candidates")).first()["key"] == "b"

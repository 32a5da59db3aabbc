"""Edits as joins: each takes a corpus and a table of edits and gives a new corpus and a report.

A key is named by any of its names; of keys that share a name the first in order is meant. Of edits of one value the
last wins. Nothing but the named (key, language) pairs changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lingspan.functions import text as X
from lingspan.operators.lint import key_names
from lingspan.operators.review import flat_text
from lingspan.schema import META_FIELDS, PLURAL_FORMS, SOURCE_LANG, Corpus


def first_named(corpus: Corpus) -> DataFrame:
    """(name, rec_id): the first key in order for each name."""
    names = key_names(corpus).join(corpus.keys.select("rec_id", "ord", "plural"), "rec_id")
    return names.groupBy("name").agg(F.min_by(F.struct("rec_id", "plural"), F.struct("ord", "rec_id")).alias("k")).select("name", "k.rec_id", "k.plural")


def last_wins(edits: DataFrame) -> DataFrame:
    """edits (key, lang, form, value, pos) -> one for each (key, lang, form)."""
    return edits.groupBy("key", "lang", "form").agg(F.max_by("value", "pos").alias("value"))


def resolve_edits(corpus: Corpus, edits: DataFrame) -> DataFrame:
    """edits plus rec_id and status: apply, unmatched, type_mismatched (plural forms for a flat key or the reverse) or
    unknown_form."""
    rows = last_wins(edits).join(first_named(corpus).withColumnRenamed("name", "key"), "key", "left")
    status = (
        F.when(F.col("rec_id").isNull(), "unmatched")
        .when(F.coalesce("plural", F.lit(False)) != (F.col("form") != ""), "type_mismatched")
        .when((F.col("form") != "") & ~F.col("form").isin(*PLURAL_FORMS), "unknown_form")
        .otherwise("apply")
    )
    return rows.withColumn("status", status).drop("plural")


def set_translations(corpus: Corpus, values: DataFrame) -> Corpus:
    """values (rec_id, lang, form, value) replace what their (key, language) pairs hold. A target becomes unverified
    even if its value stays; the source never does. A language is dirty if its value, all forms together, changed."""
    whole = lambda rows, name: rows.groupBy("rec_id", "lang").agg(F.array_sort(F.collect_list(F.struct("form", "value"))).alias(name))
    old = whole(corpus.translations.join(values.select("rec_id", "lang").distinct(), ["rec_id", "lang"], "left_semi"), "old")
    flags = corpus.translations.groupBy("rec_id", "lang").agg(F.bool_or("is_dirty").alias("was_dirty"))
    now = whole(values, "new").join(old, ["rec_id", "lang"], "left").join(flags, ["rec_id", "lang"], "left")
    now = now.select(
        "rec_id", "lang", F.explode("new").alias("v"), (F.col("lang") != SOURCE_LANG).alias("is_unverified"),
        (F.coalesce("was_dirty", F.lit(False)) | ~F.col("new").eqNullSafe(F.col("old"))).alias("is_dirty"),
    ).select("rec_id", "lang", "v.form", "v.value", "is_unverified", "is_dirty")
    kept = corpus.translations.join(values.select("rec_id", "lang").distinct(), ["rec_id", "lang"], "left_anti")
    return Corpus(corpus.keys, kept.select(now.columns).unionByName(now))


def apply_edits(corpus: Corpus, edits: DataFrame) -> tuple[Corpus, DataFrame]:
    """All languages at once: languages are disjoint, so order does not matter. The report has a row an edit."""
    report = resolve_edits(corpus, edits)
    return set_translations(corpus, report.where("status = 'apply'").select("rec_id", "lang", "form", "value")), report


def apply_counts(report: DataFrame) -> DataFrame:
    return report.groupBy("lang", "status").agg(F.count("*").alias("n"))


def missing_edit_files(corpus: Corpus, edits: DataFrame, requested: DataFrame) -> DataFrame:
    """Requested languages for which there is no edit: reported and skipped."""
    return requested.select("lang").distinct().join(edits.select("lang").distinct(), "lang", "left_anti")


def lint_edits(corpus: Corpus, edits: DataFrame, lang: str) -> DataFrame:
    """(key, form, problem): what keeps a backlog's edits from being applied; empty if all may be."""
    rows = last_wins(edits.where(F.col("lang") == lang)).join(first_named(corpus).withColumnRenamed("name", "key"), "key", "left")
    texts = flat_text(corpus).where(F.col("lang").isin(lang, SOURCE_LANG)).groupBy("rec_id").agg(
        F.max(F.when(F.col("lang") == SOURCE_LANG, F.col("text"))).alias("source"), F.max(F.when(F.col("lang") == lang, F.col("text"))).alias("target"),
        F.coalesce(F.bool_or(F.when(F.col("lang") == lang, F.col("is_unverified"))), F.lit(False)).alias("is_unverified"),
    )
    rows = rows.join(texts, "rec_id", "left")
    has_other = F.max((F.col("form") == "other").cast("int")).over(Window.partitionBy("key")) == 1
    found = F.col("rec_id").isNotNull()
    open_ = (F.col("target").isNull()) | (F.col("target") == "") | F.col("is_unverified")
    problem = lambda when, name: F.when(when, F.lit(name))
    problems = F.array_compact(F.array(
        problem(~found, "not found"),
        problem(found & ~open_, "not in backlog"),
        problem(found & (F.col("plural") != (F.col("form") != "")), "plural shape"),
        problem((F.col("form") != "") & ~F.col("form").isin(*PLURAL_FORMS), "unknown form"),
        problem((F.col("form") != "") & ~has_other, "no 'other' form"),
        problem(X.strip("value") == "", "empty value"),
        problem(F.col("value").startswith("<MISSING IN "), "missing sentinel"),
        problem(F.size(X.invisible_spaces("value")) > 0, "forbidden space"),
        problem(found & (X.placeholder_signature("value") != X.placeholder_signature(F.coalesce("source", F.lit("")))), "placeholders differ"),
    ))
    return rows.withColumn("problems", problems).select("key", "form", F.explode("problems").alias("problem"))


def apply_backlog_edits(corpus: Corpus, edits: DataFrame, lang: str) -> tuple[Corpus, DataFrame]:
    """All or nothing: with any problem the corpus stays as it is."""
    problems = lint_edits(corpus, edits, lang)
    if not problems.isEmpty():
        return corpus, problems
    return apply_edits(corpus, edits.where(F.col("lang") == lang))[0], problems


def _change_keys(corpus: Corpus, ops: DataFrame, column: str, value: Column, field: str) -> Corpus:
    """ops (key, ...) joined to keys; `value` becomes `column`, and `field` dirty where that is a change."""
    named = ops.join(first_named(corpus).withColumnRenamed("name", "key").drop("plural"), "key").drop("key").withColumn("_op", F.lit(True))
    rows = corpus.keys.join(named, "rec_id", "left").withColumn("_new", F.when(F.col("_op"), value).otherwise(F.col(column)))
    same = F.to_json(F.struct(F.array_sort(F.map_entries("_new")).alias("v"))) if column == "filenames" else F.to_json(F.struct(F.col("_new").alias("v")))
    was = F.to_json(F.struct(F.array_sort(F.map_entries(column)).alias("v"))) if column == "filenames" else F.to_json(F.struct(F.col(column).alias("v")))
    dirty = F.when(~same.eqNullSafe(was), F.array_sort(F.array_union("dirty_meta", F.array(F.lit(field))))).otherwise(F.col("dirty_meta"))
    rows = rows.withColumns({"dirty_meta": dirty}).withColumn(column, F.col("_new"))
    return Corpus(rows.select(corpus.keys.columns), corpus.translations)


def set_platforms(corpus: Corpus, ops: DataFrame) -> Corpus:
    """ops (key, add, remove, replace: arrays or null). A replacement excludes the others; a key never loses its last
    platform: such an operation raises."""
    next_ = F.coalesce("replace", F.array_except(F.array_union("platforms", F.coalesce("add", F.array().cast("array<string>"))), F.coalesce("remove", F.array().cast("array<string>"))))
    checked = F.when(F.col("replace").isNotNull() & (F.col("add").isNotNull() | F.col("remove").isNotNull()), F.raise_error("replace excludes add and remove").cast("array<string>"))
    checked = checked.when(F.size(next_) == 0, F.raise_error("a key needs a platform").cast("array<string>")).otherwise(X.ordered_platforms(next_))
    return _change_keys(corpus, ops, "platforms", checked, META_FIELDS[0])


def set_context(corpus: Corpus, ops: DataFrame) -> Corpus:
    """ops (key, new_context): stripped; an empty one clears."""
    return _change_keys(corpus, ops, "context", F.nullif(X.strip("new_context"), F.lit("")), META_FIELDS[1])


def set_filename(corpus: Corpus, ops: DataFrame) -> Corpus:
    """ops (key, platform, filename): one slot; an empty name clears it, a path through a locale folder raises."""
    slot = F.when(F.col("filename").contains(".lproj/"), F.raise_error("a locale folder in a file name").cast("string")).otherwise(F.col("filename"))
    old = F.coalesce("filenames", F.create_map().cast("map<string,string>"))
    new = F.map_concat(F.map_filter(old, lambda k, v: k != F.col("platform")), F.create_map(F.col("platform"), slot))
    kept = F.map_filter(new, lambda k, v: F.coalesce(v, F.lit("")) != "")
    return _change_keys(corpus, ops, "filenames", F.when(F.size(kept) > 0, kept), META_FIELDS[2])


def import_packs(corpus: Corpus, packs: DataFrame, platforms: list[str], exclude: list[str] = ()) -> tuple[Corpus, DataFrame]:
    """packs (key, lang, value) of keys the corpus lacks become new keys; languages without a value get ''; of values
    for one (key, lang) the least counts. The report has the keys that were there already."""
    names = key_names(corpus).select(F.col("name").alias("key")).distinct()
    wanted = packs.where(~F.col("key").isin(*exclude)) if exclude else packs
    fresh = wanted.join(names, "key", "left_anti")
    there = wanted.select("key").distinct().join(names, "key", "left_semi")
    rec_id = F.concat(F.lit("new:"), F.sha1(F.col("key").cast("binary")))
    one = fresh.select("key").distinct()
    empty = {c: F.lit(None).cast(corpus.keys.schema[c].dataType) for c in ("key_id", "key_by_platform", "context", "char_limit", "filenames")}
    last = corpus.keys.agg(F.coalesce(F.max("ord"), F.lit(-1))).scalar()
    keys = one.withColumns({"rec_id": rec_id, "ord": last + 1, "key_name": F.col("key"), "platforms": F.array(*[F.lit(p) for p in platforms]), "plural": F.lit(False), "archived": F.lit(False), "dirty_meta": F.array().cast("array<string>"), **empty})
    langs = corpus.translations.select("lang").unionAll(packs.select("lang")).distinct()
    slots = one.crossJoin(F.broadcast(langs))  # languages are a handful
    texts = slots.join(fresh.groupBy("key", "lang").agg(F.min("value").alias("value")), ["key", "lang"], "left")
    rows = texts.select(rec_id.alias("rec_id"), "lang", F.lit("").alias("form"), F.coalesce("value", F.lit("")).alias("value"), ((F.col("lang") != SOURCE_LANG) & (F.coalesce("value", F.lit("")) != "")).alias("is_unverified"), F.lit(True).alias("is_dirty"))
    return Corpus(corpus.keys.unionByName(keys.select(corpus.keys.columns)), corpus.translations.unionByName(rows)), there


def corpus_diff(old: Corpus, new: Corpus) -> DataFrame:
    """(rec_id, lang, form, change): values added, removed or changed."""
    a = old.translations.select("rec_id", "lang", "form", F.struct("value").alias("a"))
    b = new.translations.select("rec_id", "lang", "form", F.struct("value").alias("b"))
    rows = a.join(b, ["rec_id", "lang", "form"], "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
    return rows.select("rec_id", "lang", "form", F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").otherwise("changed").alias("change"), F.col("a.value").alias("old_value"), F.col("b.value").alias("new_value"))


def check_changed_set(diff: DataFrame, values: DataFrame) -> DataFrame:
    """What changed without an edit ('collateral') and edits that changed nothing ('unchanged'), by key and language."""
    k = ["rec_id", "lang"]
    changed, edited = diff.select(*k).distinct(), values.select(*k).distinct()
    return changed.join(edited, k, "left_anti").withColumn("problem", F.lit("collateral")).unionByName(edited.join(changed, k, "left_anti").withColumn("problem", F.lit("unchanged")))


def propagate_source_change(corpus: Corpus, edits: DataFrame) -> Corpus:
    """edits (rec_id, lang, form, value) with new sources: every target of a changed key that is not re-authored here
    becomes '', unverified and dirty."""
    changed = edits.where(F.col("lang") == SOURCE_LANG).select("rec_id").distinct()
    stale = corpus.translations.where(F.col("lang") != SOURCE_LANG).join(changed, "rec_id", "left_semi").join(edits.select("rec_id", "lang").distinct(), ["rec_id", "lang"], "left_anti")
    return set_translations(corpus, edits.select("rec_id", "lang", "form", "value").unionByName(stale.select("rec_id", "lang", "form", F.lit("").alias("value"))))

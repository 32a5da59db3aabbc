"""Synchronisation with a translation-management service as plan tables. Nothing is sent from here: a caller sends the
planned rows, dumps what is stored then, and verify and drain work on that dump."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lingspan.functions import text as X
from lingspan.operators.edits import first_named
from lingspan.operators.lint import key_names
from lingspan.schema import META_FIELDS, PLATFORM_ORDER, SOURCE_LANG, Corpus

CHUNK = 500


def named_keys(corpus: Corpus, requested: list[str]) -> DataFrame:
    return key_names(corpus).where(F.col("name").isin(*requested)).select("rec_id").distinct()


def missing_names(corpus: Corpus, requested: DataFrame) -> DataFrame:
    """Requested names that no key has."""
    return requested.select("name").distinct().join(key_names(corpus), "name", "left_anti")


def push_langs(corpus: Corpus, langs: list[str] | None = None, keys: list[str] | None = None) -> DataFrame:
    """Values to push: of the requested languages; else of named keys all; else the dirty ones."""
    rows = corpus.translations
    if keys is not None:
        rows = rows.join(named_keys(corpus, keys), "rec_id", "left_semi")
    if langs:
        return rows.where(F.col("lang").isin(*langs))
    return rows if keys is not None else rows.where("is_dirty")


def push_meta_fields(corpus: Corpus, langs: list[str] | None = None, keys: list[str] | None = None) -> DataFrame:
    """keys plus fields: none with a language scope; of named keys platforms and what exists; else the dirty ones."""
    if langs:
        return corpus.keys.withColumn("fields", F.array().cast("array<string>")).limit(0)
    if keys is not None:
        rows = corpus.keys.join(named_keys(corpus, keys), "rec_id", "left_semi")
        there = F.array_compact(F.array(F.lit("platforms"), F.when(F.coalesce("context", F.lit("")) != "", "context"), F.when(F.size(F.coalesce("filenames", F.create_map().cast("map<string,string>"))) > 0, "filenames")))
        return rows.withColumn("fields", there)
    return corpus.keys.withColumn("fields", F.array_intersect(F.array(*[F.lit(f) for f in META_FIELDS]), "dirty_meta")).where(F.size("fields") > 0)


def _file_slots() -> Column:
    return F.create_map(*[x for p in PLATFORM_ORDER for x in (F.lit(p), F.coalesce(F.try_element_at("filenames", F.lit(p)), F.lit("")))])


def push_plan(corpus: Corpus, langs: list[str] | None = None, keys: list[str] | None = None, mark_verified: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(updates, creates, meta_updates). Archived keys are in. The source goes verified always, targets with
    mark_verified. A new key without platforms is planned for the first one; one without a name is left out."""
    values = push_langs(corpus, langs, keys)
    one = values.groupBy("rec_id", "lang").agg(
        F.max(F.when(F.col("form") == "", F.col("value"))).alias("flat"),
        F.array_sort(F.collect_list(F.when(F.col("form") != "", F.struct("form", "value")))).alias("forms"),
    )
    value = F.when(F.size("forms") > 0, F.to_json(F.map_from_entries("forms"))).otherwise(F.col("flat"))
    unverified = (F.col("lang") != SOURCE_LANG) & F.lit(not mark_verified)
    payload = F.array_sort(F.collect_list(F.struct(F.col("lang").alias("language_iso"), value.alias("translation"), unverified.alias("is_unverified"))))
    rows = one.groupBy("rec_id").agg(payload.alias("translations")).join(corpus.keys.withColumn("key", X.display_key("key_name", "key_by_platform")), "rec_id")
    updates = rows.where("key_id IS NOT NULL").select("rec_id", "key_id", "key", "translations")
    name = F.coalesce("key_name", F.when(F.size("key_by_platform") > 0, F.to_json("key_by_platform")))
    creates = rows.where(F.col("key_id").isNull() & name.isNotNull()).select(
        "rec_id", name.alias("key_name"), F.when(F.size("platforms") > 0, F.col("platforms")).otherwise(F.array(F.lit(PLATFORM_ORDER[0]))).alias("platforms"),
        "translations", "plural", F.nullif("context", F.lit("")).alias("description"), F.when(F.size("filenames") > 0, _file_slots()).alias("filenames"),
    )
    has = lambda f: F.array_contains("fields", f)
    meta = push_meta_fields(corpus, langs, keys).where("key_id IS NOT NULL")
    meta = meta.select(
        "rec_id", "key_id", "fields", F.when(has("platforms"), F.col("platforms")).alias("platforms"),
        F.when(has("context"), F.coalesce("context", F.lit(""))).alias("description"),
        F.when(has("filenames"), F.transform_values(_file_slots(), lambda k, v: v)).alias("filenames"),
    )
    return updates, creates, meta


def preview(updates: DataFrame, creates: DataFrame, meta: DataFrame, shown: int = 3) -> DataFrame:
    """push_plan's tables -> (action, nth, label, detail, rest): the first `shown` of each action, keys by id, new keys by name, with
    their languages or fields, and how many more there are. Only the shown rows of each part of a plan are ordered
    together; an action without rows has none."""
    langs = F.array_join(F.transform("translations", lambda t: t["language_iso"]), ",")
    by_id = F.col("key_id").cast("string")
    said = lambda rows, action, ord_, label, detail: rows.select(F.lit(action).alias("action"), ord_.alias("ord"), label.alias("label"), detail.alias("detail"))
    rows = said(updates, "update", F.col("key_id"), by_id, langs).unionAll(said(creates, "create", F.lit(0).cast("long"), F.col("key_name"), langs))
    rows = rows.unionAll(said(meta, "update-meta", F.col("key_id"), by_id, F.array_join(F.array_sort("fields"), ",")))
    counts = rows.groupBy("action").agg(F.count("*").alias("n"))
    first = rows.withColumn("nth", F.row_number().over(Window.partitionBy("action").orderBy("ord", "label", "detail"))).where(F.col("nth") <= shown)
    return first.join(counts, "action").select("action", "nth", "label", "detail", F.greatest(F.col("n") - shown, F.lit(0)).alias("rest"))


def chunks(plan: DataFrame, size: int = CHUNK, buckets: int = 64) -> DataFrame:
    """plan plus bucket and chunk: at most `size` rows share a (bucket, chunk)."""
    rows = plan.withColumn("bucket", F.pmod(F.xxhash64("rec_id"), F.lit(buckets)).cast("int"))
    return rows.withColumn("chunk", F.ceil(F.row_number().over(Window.partitionBy("bucket").orderBy("rec_id")) / size).cast("int"))


def sent_values(updates: DataFrame) -> DataFrame:
    return updates.select("rec_id", "key_id", F.explode("translations").alias("t")).select("rec_id", "key_id", F.col("t.language_iso").alias("lang"), F.col("t.translation").alias("sent"))


def verify_push(sent: DataFrame, stored: DataFrame, plural: DataFrame) -> DataFrame:
    """sent (rec_id, key_id, lang, sent), stored (key_id, lang, stored), plural (rec_id, plural) -> what isn't stored as
    sent: missing_key, missing_lang or differs."""
    there = stored.select("key_id").distinct().withColumn("_key", F.lit(True))
    rows = sent.join(there, "key_id", "left").join(stored.withColumn("_lang", F.lit(True)), ["key_id", "lang"], "left").join(plural, "rec_id", "left")
    problem = F.when(F.col("_key").isNull(), "missing_key").when(F.col("_lang").isNull(), "missing_lang").when(~X.value_matches(F.col("sent"), "stored", F.coalesce("plural", F.lit(False))), "differs")
    return rows.withColumn("problem", problem).where("problem IS NOT NULL").select("rec_id", "key_id", "lang", "problem")


def verify_meta(meta: DataFrame, stored: DataFrame) -> DataFrame:
    """stored (key_id, stored_platforms, stored_description, stored_filenames) -> fields not stored as sent."""
    rows = meta.join(stored.withColumn("_there", F.lit(True)), "key_id", "left")
    slots = F.transform(F.array(*[F.lit(p) for p in PLATFORM_ORDER]), lambda p: F.coalesce(F.try_element_at(F.col("filenames"), p), F.lit("")) == F.coalesce(F.try_element_at(F.col("stored_filenames"), p), F.lit("")))
    bad = F.array_compact(F.array(
        F.when(F.array_contains("fields", "platforms") & ~F.array_sort("platforms").eqNullSafe(F.array_sort("stored_platforms")), "platforms"),
        F.when(F.array_contains("fields", "context") & ~F.col("description").eqNullSafe(F.coalesce("stored_description", F.lit(""))), "context"),
        F.when(F.array_contains("fields", "filenames") & F.exists(slots, lambda s: ~s), "filenames"),
    ))
    found = F.when(F.col("_there").isNull(), F.col("fields")).otherwise(bad)
    return rows.select("rec_id", "key_id", F.explode(found).alias("field"))


def stamp_created(corpus: Corpus, created: DataFrame) -> Corpus:
    """created (name, new_id): ids of keys that the service made; such keys have no dirty fields left."""
    names = key_names(corpus).join(created, "name").groupBy("rec_id").agg(F.min("new_id").alias("new_id"))
    rows = corpus.keys.join(names, "rec_id", "left")
    fresh = F.col("key_id").isNull() & F.col("new_id").isNotNull()
    rows = rows.withColumn("dirty_meta", F.when(fresh, F.array().cast("array<string>")).otherwise(F.col("dirty_meta"))).withColumn("key_id", F.coalesce("key_id", "new_id"))
    return Corpus(rows.select(corpus.keys.columns), corpus.translations)


def drain(corpus: Corpus, sent: DataFrame, mismatches: DataFrame, meta: DataFrame | None = None, meta_mismatches: DataFrame | None = None) -> Corpus:
    """Dirty marks of what was sent and is stored go; those of mismatches stay."""
    clean = sent.select("rec_id", "lang").distinct().join(mismatches.select("rec_id", "lang"), ["rec_id", "lang"], "left_anti").withColumn("_clean", F.lit(True))
    rows = corpus.translations.join(clean, ["rec_id", "lang"], "left")
    rows = rows.withColumn("is_dirty", F.col("is_dirty") & F.col("_clean").isNull()).select(corpus.translations.columns)
    keys = corpus.keys
    if meta is not None:
        stuck = meta_mismatches.groupBy("rec_id").agg(F.collect_set("field").alias("_stuck"))
        done = meta.select("rec_id", F.col("fields").alias("_sent")).join(stuck, "rec_id", "left")
        done = done.select("rec_id", F.array_except("_sent", F.coalesce("_stuck", F.array().cast("array<string>"))).alias("_done"))
        keys = keys.join(done, "rec_id", "left").withColumn("dirty_meta", F.array_except("dirty_meta", F.coalesce("_done", F.array().cast("array<string>")))).select(corpus.keys.columns)
    return Corpus(keys, rows)


# Tags, names, files, keys


def resolve_refs(keys: DataFrame, refs: DataFrame) -> DataFrame:
    """refs (ref, kind: 'id' or 'name'), keys (key_id, key_name) -> refs plus key_id and status: ok, not_found, ambiguous."""
    by_id = refs.where("kind = 'id'").withColumn("key_id", F.col("ref").try_cast("bigint")).join(keys.select("key_id", "key_name"), "key_id", "left_semi").select("ref", "kind", "key_id")
    by_name = refs.where("kind = 'name'").join(keys.select("key_id", F.col("key_name").alias("ref")), "ref").select("ref", "kind", "key_id")
    hits = by_id.unionByName(by_name).groupBy("ref", "kind").agg(F.count_distinct("key_id").alias("n"), F.min("key_id").alias("key_id"))
    rows = refs.distinct().join(hits, ["ref", "kind"], "left")
    return rows.select("ref", "kind", F.when(F.col("n") == 1, F.col("key_id")).alias("key_id"), F.when(F.coalesce("n", F.lit(0)) == 0, "not_found").when(F.col("n") > 1, "ambiguous").otherwise("ok").alias("status"))


def tag_plan(keys: DataFrame, op: str, tags: list[str], used_on_android: DataFrame | None = None, guarded: str = "unused-localization", instead: str = "android_only") -> DataFrame:
    """keys (key_id, key_name, tags) -> (key_id, new_tags). 'add' sends every row; 'remove' and 'set' leave out rows
    that would not change. A guarded tag becomes another one on keys that Android code uses (key_name)."""
    given = F.array(*[F.lit(t) for t in tags])
    if used_on_android is not None:
        keys = keys.join(used_on_android.select("key_name").distinct().withColumn("_used", F.lit(True)), "key_name", "left")
        given = F.when(F.col("_used"), F.array_distinct(F.transform(given, lambda t: F.when(t == guarded, F.lit(instead)).otherwise(t)))).otherwise(given)
    new = {"add": F.array_union("tags", given), "remove": F.array_except("tags", given), "set": given}[op]
    rows = keys.withColumn("new_tags", F.array_sort(new))
    return (rows if op == "add" else rows.where(~F.col("new_tags").eqNullSafe(F.array_sort("tags")))).select("key_id", "new_tags")


def rename_plan(renames: DataFrame) -> DataFrame:
    """renames (key_id, new_name) plus problem: no whole id, no valid name, an id or a target named twice; null if fine."""
    ids, names = Window.partitionBy("key_id"), Window.partitionBy("new_name")
    problem = (
        F.when(F.col("key_id").isNull(), "no key id").when(~F.coalesce(X.valid_key_name("new_name"), F.lit(False)), "invalid name")
        .when(F.count("*").over(ids) > 1, "duplicate key id").when(F.count("*").over(names) > 1, "duplicate target")
    )
    return renames.withColumn("problem", problem)


def verify_names(plan: DataFrame, stored: DataFrame) -> DataFrame:
    """Planned names that are not stored: stored (key_id, key_name)."""
    return plan.join(stored.select("key_id", F.col("key_name").alias("new_name")), ["key_id", "new_name"], "left_anti")


def delete_plan(keys: DataFrame, refs: DataFrame) -> DataFrame:
    return resolve_refs(keys, refs).where("status = 'ok'").select("key_id").distinct()


def filename_plan(keys: DataFrame, platform: str, filename: str | None = None) -> DataFrame:
    """keys (key_id, filenames) -> (key_id, new_filenames) where they change: locale folders taken out of every slot, or
    one slot set, an empty name clearing it."""
    old = F.coalesce("filenames", F.create_map().cast("map<string,string>"))
    if filename is None:
        new = F.transform_values(old, lambda k, v: F.regexp_replace(v, r"^[^/]*\.lproj/", ""))
    else:
        new = F.map_filter(F.map_concat(F.map_filter(old, lambda k, v: k != platform), F.create_map(F.lit(platform), F.lit(filename))), lambda k, v: v != "")
    entries = lambda m: F.array_sort(F.map_entries(m))
    return keys.withColumn("new_filenames", new).where(entries("new_filenames") != entries(old)).select("key_id", "new_filenames")


def verify_filenames(plan: DataFrame, stored: DataFrame) -> DataFrame:
    rows = plan.join(stored.select("key_id", F.col("filenames").alias("stored")), "key_id", "left")
    entries = lambda m: F.array_sort(F.filter(F.map_entries(m), lambda e: e["value"] != ""))
    return rows.where(~entries("new_filenames").eqNullSafe(entries("stored"))).select("key_id")


def create_plan(payloads: DataFrame, corpus: Corpus, most: int = CHUNK) -> DataFrame:
    """payloads (key_name, platforms, ...) plus problem: no name, invalid, there already, named twice, or beyond `most`."""
    there = first_named(corpus).select(F.col("name").alias("key_name"), F.lit(True).alias("_there"))
    rows = payloads.join(there, "key_name", "left")
    problem = (
        F.when(F.coalesce("key_name", F.lit("")) == "", "no name").when(~X.valid_key_name("key_name"), "invalid name").when(F.col("_there"), "exists")
        .when(F.count("*").over(Window.partitionBy("key_name")) > 1, "duplicate").when(F.coalesce(F.size("platforms"), F.lit(0)) <= 0, "no platforms")
    )
    return rows.withColumn("problem", problem).drop("_there")


def update_plan(payloads: DataFrame, keys: DataFrame) -> DataFrame:
    """payloads (key_id, ...) plus problem: unknown or repeated ids."""
    rows = payloads.join(keys.select("key_id", F.lit(True).alias("_there")).distinct(), "key_id", "left")
    return rows.withColumn("problem", F.when(F.col("_there").isNull(), "unknown key").when(F.count("*").over(Window.partitionBy("key_id")) > 1, "duplicate")).drop("_there")


def list_keys(keys: DataFrame, ids: list[int] | None = None, names: list[str] | None = None, tags: list[str] | None = None, platforms: list[str] | None = None, archived: str = "exclude") -> DataFrame:
    """keys (key_id, key_name, tags, platforms, archived) that pass every filter given; archived: exclude, include, only."""
    rows = keys
    for column, values in (("key_id", ids), ("key_name", names)):
        rows = rows.where(F.col(column).isin(*values)) if values else rows
    for column, values in (("tags", tags), ("platforms", platforms)):
        rows = rows.where(F.arrays_overlap(column, F.array(*[F.lit(v) for v in values]))) if values else rows
    return rows if archived == "include" else rows.where(F.col("archived") == F.lit(archived == "only"))


def key_table(keys: DataFrame) -> DataFrame:
    return keys.select(F.concat_ws("\t", F.col("key_id").cast("string"), "key_name", F.array_join("platforms", ","), F.array_join("tags", ",")).alias("line"))

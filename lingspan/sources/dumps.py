"""Reading what others left: service dumps, source trees, locale packs, edit maps, findings tables and lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lingspan.functions import text as X
from lingspan.schema import PLURAL_FORMS, SOURCE_LANG, Corpus

_TRANSLATION = "translation_id bigint, language_iso string, translation string, is_unverified boolean, is_fuzzy boolean"
_KEY = (
    "key_id bigint, key_name map<string,string>, platforms array<string>, filenames map<string,string>, tags array<string>, description string, context string, "
    f"char_limit int, is_archived boolean, is_hidden boolean, is_plural boolean, translations array<struct<{', '.join(p.replace(' ', ':', 1) for p in _TRANSLATION.split(', '))}>>"
)
# What trees leave out.
SKIPPED_FOLDERS = (".git", ".build", ".gradle", ".idea", "DerivedData", "Pods", "Carthage", "build", "fastlane", "node_modules")
PACK_LANGS = {"es_ES": "es"}


def service_keys(spark: SparkSession, folder: str, archived: str = "exclude", ids: list[int] | None = None, names: list[str] | None = None, tags: list[str] | None = None, platforms: list[str] | None = None) -> DataFrame:
    """Key objects of all response pages in a folder."""
    pages = spark.read.schema(f"keys array<struct<{_struct(_KEY)}>>").json(folder, multiLine=True)
    rows = pages.select(F.explode("keys").alias("k")).select("k.*")
    rows = rows if archived == "include" else rows.where(F.coalesce("is_archived", F.lit(False)) == F.lit(archived == "only"))
    rows = rows.where(F.col("key_id").isin(*ids)) if ids else rows
    rows = rows.where(F.exists(F.map_values("key_name"), lambda n: n.isin(*names))) if names else rows
    for column, values in (("tags", tags), ("platforms", platforms)):
        rows = rows.where(F.arrays_overlap(column, F.array(*[F.lit(v) for v in values]))) if values else rows
    return rows


def _struct(ddl: str) -> str:
    out, depth, field = [], 0, ""
    for c in ddl + ",":
        depth += (c == "<") - (c == ">")
        if c == "," and depth == 0:
            out.append(field.strip().replace(" ", ":", 1))
            field = ""
        else:
            field += c
    return ", ".join(out)


def corpus_from_service(raw: DataFrame) -> Corpus:
    """A full rebuild from a dump: local marks are dropped; a value counts as unverified if it is not empty."""
    text = lambda c: F.nullif(X.strip(c), F.lit(""))
    none = F.array().cast("array<string>")
    name = X.collapse_key_name(F.col("key_name"))
    rec_id = F.concat(F.lit("id:"), F.col("key_id").cast("string"))
    files = F.map_filter("filenames", lambda k, v: F.coalesce(v, F.lit("")) != "")
    keys = raw.select(
        rec_id.alias("rec_id"), "key_id", F.col("key_id").alias("ord"), name.alias("key_name"), F.when(name.isNull(), F.map_filter("key_name", lambda k, v: v != "")).alias("key_by_platform"),
        F.coalesce("platforms", none).alias("platforms"), F.coalesce("is_plural", F.lit(False)).alias("plural"), F.coalesce("is_archived", F.lit(False)).alias("archived"),
        F.coalesce(text("description"), text("context")).alias("context"), F.nullif("char_limit", F.lit(0)).alias("char_limit"), F.when(F.size(files) > 0, files).alias("filenames"), none.alias("dirty_meta"),
    )
    rows = raw.select(rec_id.alias("rec_id"), F.coalesce("is_plural", F.lit(False)).alias("plural"), F.explode("translations").alias("t"))
    value = F.coalesce("t.translation", F.lit(""))
    forms = F.when(F.col("plural"), X.plural_value(value)).otherwise(F.create_map(F.lit(""), value))
    waits = (F.coalesce("t.is_unverified", F.lit(False)) | F.coalesce("t.is_fuzzy", F.lit(False))) & (value != "") & (F.col("t.language_iso") != SOURCE_LANG)
    texts = rows.select("rec_id", F.col("t.language_iso").alias("lang"), waits.alias("is_unverified"), F.explode(forms).alias("form", "value"))
    return Corpus(keys, texts.select("rec_id", "lang", "form", "value", "is_unverified", F.lit(False).alias("is_dirty")))


def service_translations(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the quality passes, a sub-folder issue=<name> each, numbered in the order of their names."""
    pages = spark.read.schema("translations array<struct<translation_id:bigint, key_id:bigint, language_iso:string, translation:string, qa:string>>, issue string").json(folder, multiLine=True)
    rows = pages.select("issue", F.explode("translations").alias("t"))
    order = Window.orderBy("issue")
    passes = rows.select("issue").distinct().withColumn("pass_ord", F.row_number().over(order))  # a row an issue type
    return rows.join(F.broadcast(passes), "issue").select(F.col("t.key_id").alias("key_id"), F.col("t.language_iso").alias("lang"), "issue", "pass_ord", F.col("t.translation_id").alias("translation_id"), F.col("t.translation").alias("value"), F.col("t.qa").alias("qa"))


def service_languages(spark: SparkSession, folder: str) -> DataFrame:
    """(lang, lang_id)"""
    return spark.read.schema("languages array<struct<lang_id:bigint, lang_iso:string>>").json(folder, multiLine=True).select(F.explode("languages").alias("l")).select(F.col("l.lang_iso").alias("lang"), F.col("l.lang_id").alias("lang_id"))


def service_glossary(spark: SparkSession, folder: str) -> DataFrame:
    """Terms under `data`, or bare ones, one object a line."""
    term = "id bigint, term string, description string, caseSensitive string, translatable string, forbidden string, tags array<string>, translations array<struct<langId:bigint, translation:string, description:string>>"
    rows = spark.read.schema(f"data array<struct<{_struct(term)}>>, {term}").json(folder)
    listed = rows.where("data IS NOT NULL").select(F.explode("data").alias("d")).select("d.*")
    return listed.unionByName(rows.where("data IS NULL AND term IS NOT NULL").drop("data"))


def source_tree(spark: SparkSession, root: str, suffixes: list[str], skipped: tuple[str, ...] = SKIPPED_FOLDERS) -> DataFrame:
    """(path, text) of files with the suffixes, path relative to root; build folders, asset catalogues, string tables
    and generated accessors are left out."""
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    bare = root.removeprefix("file://").rstrip("/")
    files = files.withColumn("path", F.regexp_replace(F.regexp_replace("path", "^file:/+", "/"), "^" + bare.replace(".", r"\.") + "/+", ""))
    folders = F.slice(F.split("path", "/"), 1, F.size(F.split("path", "/")) - 1)
    name = F.element_at(F.split("path", "/"), -1)
    keep = ~F.exists(folders, lambda p: p.isin(*skipped) | p.endswith(".xcassets")) & ~name.rlike(r"\.strings(dict)?$|^R\..*\.generated\.swift$")
    return files.where(keep & F.concat(F.lit("."), F.element_at(F.split(name, r"\."), -1)).isin(*suffixes))


def string_tables(spark: SparkSession, root: str) -> DataFrame:
    """(path, text) of .strings and .stringsdict files."""
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return files.where(F.col("path").rlike(r"\.strings(dict)?$"))


def lines_of(files: DataFrame) -> DataFrame:
    """(path, lineno, line), from 1."""
    return files.select("path", F.posexplode(F.split("text", r"\r?\n")).alias("p", "line")).select("path", (F.col("p") + 1).alias("lineno"), "line")


def locale_packs(spark: SparkSession, folder: str, lang_map: dict[str, str] = PACK_LANGS) -> DataFrame:
    """(key, lang, value) of <lang>.json files: text, or an object with `translation`."""
    files = spark.read.text(folder, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.json$", 1).alias("stem"), "value").where("stem <> ''")
    codes = F.create_map(*[F.lit(x) for kv in (lang_map or {"": ""}).items() for x in kv])
    rows = files.select(F.coalesce(F.try_element_at(codes, F.col("stem")), F.col("stem")).alias("lang"), F.explode(F.from_json("value", "map<string,string>")).alias("key", "v"))
    return rows.select("key", "lang", F.when(F.col("v").startswith("{"), F.coalesce(F.get_json_object("v", "$.translation"), F.lit(""))).otherwise(F.col("v")).alias("value"))


def edit_map(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """texts (lang, text) with {key: text or {form: text}} -> edits (key, lang, form, value, pos) and what was refused."""
    rows = texts.select("lang", F.explode(F.from_json("text", "map<string,string>")).alias("key", "v"))
    plain = rows.where(~F.col("v").startswith("{") | F.col("v").isNull()).select("key", "lang", F.lit("").alias("form"), F.col("v").alias("value"))
    forms = rows.where(F.col("v").startswith("{")).select("key", "lang", F.explode(F.from_json("v", "map<string,string>")).alias("form", "value"))
    every = plain.unionByName(forms).withColumn("pos", F.lit(0))
    bad = F.col("value").isNull() | ((F.col("form") != "") & ~F.col("form").isin(*PLURAL_FORMS))
    return every.where(~bad), every.where(bad).withColumn("problem", F.when(F.col("value").isNull(), "no text").otherwise("unknown form"))


def read_edit_map(spark: SparkSession, path: str, lang: str) -> tuple[DataFrame, DataFrame]:
    return edit_map(spark.read.text(path, wholetext=True).select(F.lit(lang).alias("lang"), F.col("value").alias("text")))


def read_edit_maps(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """A file <lang>.json for each language."""
    return edit_map(spark.read.text(folder, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.json$", 1).alias("lang"), F.col("value").alias("text")))


def read_term_edits(spark: SparkSession, path: str, lang: str | None = None) -> DataFrame:
    """(term, lang, text) from {term: text} in one language or {term: {lang: text}}."""
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")).alias("term", "v"))
    if lang:
        return rows.select("term", F.lit(lang).alias("lang"), F.col("v").alias("text"))
    return rows.select("term", F.explode(F.from_json("v", "map<string,string>")).alias("lang", "text"))


def findings_table(texts: DataFrame, lang: str) -> tuple[DataFrame, DataFrame]:
    """texts (path, text) of Markdown tables -> edits (key, lang, form, value, pos) of accepted rows of the language, and
    rows with another number of cells than their header. Cells are parted by unescaped bars; an applied value that is a
    dash or empty falls back to the suggestion."""
    cells_of = F.transform(F.split(F.regexp_replace(F.regexp_replace(X.strip("line"), r"^\|", ""), r"(?<!\\)\|$", ""), r"(?<!\\)\|"), lambda c: X.strip(F.replace(c, F.lit("\\|"), F.lit("|"))))
    rows = texts.select("path", F.posexplode(F.split("text", r"\r?\n")).alias("pos", "line")).where(F.col("line").rlike(r"^\s*\|")).withColumn("cells", cells_of)
    rows = rows.where(~F.forall("cells", lambda c: c.rlike("^:?-*:?$")))
    low = F.transform("cells", F.lower)
    head = F.when(F.array_contains(low, "key") & F.array_contains(low, "verdict"), low)
    above = Window.partitionBy("path").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("head", head).withColumn("names", F.last("head", ignorenulls=True).over(above)).where("head IS NULL AND names IS NOT NULL")
    whole = F.size("cells") == F.size("names")
    get = lambda name: F.get(F.col("cells"), F.array_position("names", name).cast("int") - 1)
    good = rows.where(whole & F.lower(get("verdict")).isin("accept", "modify") & (F.lower(get("lang")) == lang.lower()))
    value = F.when(F.coalesce(get("applied_value"), F.lit("")).isin("—", "-", ""), get("suggestion")).otherwise(get("applied_value"))
    edits = good.select(F.regexp_replace(get("key"), '^["`]+|["`]+$', "").alias("key"), F.lit(lang).alias("lang"), F.lit("").alias("form"), value.alias("value"), "pos")
    return edits, rows.where(~whole).select("path", "pos", "line")


def read_key_list(spark: SparkSession, path: str, kind: str = "name") -> DataFrame:
    """(ref, kind): a line each; blank lines and comments are left out. kind 'id' keeps whole numbers only."""
    rows = spark.read.text(path).select(F.trim("value").alias("ref")).where("ref <> '' AND NOT startswith(ref, '#')")
    rows = rows.where(F.col("ref").try_cast("bigint").isNotNull()) if kind == "id" else rows
    return rows.withColumn("kind", F.lit(kind))


def read_rename_map(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("key_id bigint, new_name string, old string").json(path, multiLine=True)


def read_create_payload(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("key_name string, platforms array<string>, description string, tags array<string>, translations array<struct<language_iso:string, translation:string>>").json(path, multiLine=True)


def read_update_payload(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("key_id bigint, description string, platforms array<string>, tags array<string>").json(path, multiLine=True)


def android_name(name: Column | str, by_platform: Column | str, platforms: Column | str) -> Column:
    """A key's name on Android; null if it is no Android key."""
    n = F.coalesce(F.try_element_at(by_platform, F.lit("android")), F.col(name) if isinstance(name, str) else name)
    return F.when(X.has_platform(platforms, "android"), n)

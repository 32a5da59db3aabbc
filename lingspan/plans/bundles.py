"""Per-platform bundles: what is exported, how values are written, and checks of staged files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lingspan.functions import text as X
from lingspan.operators.review import flat_text
from lingspan.schema import SOURCE_LANG, Corpus

# How languages and placeholders are written by platform. The third part says whether '[%]' is escaped.
LANG_CODES = {"ios": {"pt_BR": "pt-BR", "zh_CN": "zh-Hans"}, "android": {"es": "es-rES", "id": "in", "pt_BR": "pt-rBR", "zh_CN": "zh-rCN"}, "server": {"es": "es_ES"}}
EXCLUDED = {"server": ("ar",)}
PLACEHOLDERS = {
    "ios": ((r"\[%(\d+\$)?s[^\]]*\]", "%$1@"), (r"\[%(\d+\$)?[id][^\]]*\]", "%$1li"), (r"\[%(\d+\$)?(\.\d+)?f[^\]]*\]", "%$1$2f")),
    "android": ((r"\[%(\d+\$)?s[^\]]*\]", "%$1s"), (r"\[%(\d+\$)?[id][^\]]*\]", "%$1d"), (r"\[%(\d+\$)?(\.\d+)?f[^\]]*\]", "%$1$2f")),
    "server": ((r"\[%(\d+\$)?s[^\]]*\]", "%$1s"), (r"\[%(\d+\$)?[id][^\]]*\]", "%$1d"), (r"\[%(\d+\$)?(\.\d+)?f[^\]]*\]", "%$1$2f")),
}
ESCAPED_PERCENT = {"ios": True, "android": True, "server": False}
PLATFORM_OF = {"ios": "ios", "android": "android", "server": "other"}


def export_plan(langs: DataFrame, platform: str) -> DataFrame:
    """langs (lang) -> (platform, lang, code) of the languages that go out."""
    codes = F.create_map(*[F.lit(x) for kv in LANG_CODES[platform].items() for x in kv])
    rows = langs.select("lang").distinct().where(~F.col("lang").isin(*EXCLUDED.get(platform, ("",))))
    return rows.select(F.lit(platform).alias("platform"), "lang", F.coalesce(F.try_element_at(codes, F.col("lang")), F.col("lang")).alias("code"))


def convert_placeholders(value: Column | str, platform: str) -> Column:
    out = F.col(value) if isinstance(value, str) else value
    for pattern, instead in PLACEHOLDERS[platform]:
        out = F.regexp_replace(out, pattern, instead)
    return F.replace(out, F.lit("[%]"), F.lit("%%" if ESCAPED_PERCENT[platform] else "%"))


def _file_of(platform: str, file: Column) -> Column:
    if platform == "ios":
        return F.concat("code", F.lit(".lproj/"), file)
    if platform == "android":
        return F.concat(F.when(F.col("lang") == SOURCE_LANG, "values").otherwise(F.concat(F.lit("values-"), "code")), F.lit("/strings.xml"))
    return F.concat("code", F.lit(".json"))


def bundle_entries(corpus: Corpus, platform: str) -> DataFrame:
    """(platform, file, lang, key, value): keys of the platform in every language; a blank value falls back to the source. A key that
    has names by platform, but none for this one, is left out."""
    p = PLATFORM_OF[platform]
    keys = corpus.keys.where(X.has_platform("platforms", p) & ~F.coalesce("archived", F.lit(False)))
    name = F.coalesce(F.try_element_at("key_by_platform", F.lit(p)), F.col("key_name"))
    file = F.coalesce(F.nullif(F.try_element_at("filenames", F.lit(p)), F.lit("")), F.lit("Localizable.strings"))
    keys = keys.select("rec_id", name.alias("key"), file.alias("f")).where("key IS NOT NULL")
    texts = flat_text(corpus).select("rec_id", "lang", "text")
    source = texts.where(F.col("lang") == SOURCE_LANG).select("rec_id", F.col("text").alias("source"))
    plan = export_plan(corpus.translations.select("lang"), platform)
    slots = keys.crossJoin(F.broadcast(plan.select("lang", "code")))  # a project's languages
    rows = slots.join(texts, ["rec_id", "lang"], "left").join(source, "rec_id", "left")
    value = F.coalesce(F.when(X.strip("text") != "", F.col("text")), F.col("source"), F.lit(""))
    return rows.select(F.lit(platform).alias("platform"), _file_of(platform, F.col("f")).alias("file"), "lang", "key", convert_placeholders(value, platform).alias("value"))


def _entry_lines(corpus: Corpus, platform: str) -> tuple[DataFrame, tuple[str, str, str]]:
    """(platform, file, key, line) of the entries, and what stands before, between and after a file's."""
    json_text = lambda c: F.regexp_extract(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", 1)
    xml_text = F.replace(F.replace(F.replace(F.replace("value", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("'"), F.lit("\\'")), F.lit('"'), F.lit('\\"'))
    line = {
        "ios": F.concat(json_text(F.col("key")), F.lit(" = "), json_text(F.col("value")), F.lit(";")),
        "android": F.concat(F.lit('    <string name="'), "key", F.lit('">'), xml_text, F.lit("</string>")),
        "server": F.concat(F.lit("  "), json_text(F.col("key")), F.lit(": "), json_text(F.col("value"))),
    }[platform]
    around = {"ios": ("", "\n", "\n"), "android": ('<?xml version="1.0" encoding="utf-8"?>\n<resources>\n', "\n", "\n</resources>\n"), "server": ("{\n", ",\n", "\n}\n")}[platform]
    return bundle_entries(corpus, platform).select("platform", "file", "key", line.alias("line")), around


def render_bundle(corpus: Corpus, platform: str) -> DataFrame:
    """(platform, rel_path, text): files with their entries from A to Z. A file holds one language of one platform's keys, and is
    one value here; `write_bundle_parts` writes bundles whose files are too large for that."""
    lines, (head, between, tail) = _entry_lines(corpus, platform)
    rows = lines.groupBy("platform", "file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("key", "line"))), lambda x: x["line"]), between).alias("body"))
    return rows.select("platform", F.col("file").alias("rel_path"), F.concat(F.lit(head), "body", F.lit(tail)).alias("text"))


def bundle_pieces(corpus: Corpus, platform: str) -> DataFrame:
    """(platform, rel_path, key, nth, text): a row an entry. In the order of key and nth, with a line end after each, the texts of a
    file are the file: the first carries what comes before the entries, the last what comes after. First and last are
    found by an aggregation that a shuffle combines, not by an order of whole files; entries of one key and one line, which
    are equal, are told apart by `nth`, counted within such a group."""
    lines, (head, between, tail) = _entry_lines(corpus, platform)
    same = lines.groupBy("platform", "file", "key", "line").agg(F.count("*").alias("times"))
    ends = same.groupBy("platform", "file").agg(F.min(F.struct("key", "line")).alias("first"), F.max(F.struct("key", "line")).alias("last"))
    here = F.struct("key", "line")
    rows = same.join(ends, ["platform", "file"]).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    opened = F.when((here == F.col("first")) & (F.col("copy") == 1), F.lit(head)).otherwise(F.lit(""))
    closed = F.when((here == F.col("last")) & (F.col("copy") == F.col("times")), F.lit(tail.removesuffix("\n"))).otherwise(F.lit(between.removesuffix("\n")))
    return rows.select("platform", F.col("file").alias("rel_path"), "key", F.struct("line", "copy").alias("nth"), F.concat(opened, "line", closed).alias("text"))


def write_bundle_parts(corpus: Corpus, platform: str, path: str, parts: int | None = None) -> None:
    """The bundle as text parts under platform=/file=: ranges of (file, key), so a file of any size is written by many tasks and
    its parts, joined in the order of their names, are its text. Reading a part again gives back no other file's lines."""
    order = ["rel_path", "key", "nth"]
    rows = bundle_pieces(corpus, platform)
    dealt = rows.repartitionByRange(parts, *order) if parts else rows.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).select("platform", F.col("rel_path").alias("file"), F.col("text").alias("value")).write.partitionBy("platform", "file").text(path)


def diff_set(expected: DataFrame, produced: DataFrame, column: str) -> DataFrame:
    """(column, side): missing or unexpected."""
    a, b = expected.select(column).distinct(), produced.select(column).distinct()
    return a.join(b, column, "left_anti").withColumn("side", F.lit("missing")).unionByName(b.join(a, column, "left_anti").withColumn("side", F.lit("unexpected")))


def same_key_set(a: DataFrame, b: DataFrame, column: str = "key") -> bool:
    return diff_set(a, b, column).isEmpty()


def file_count_check(staged: DataFrame, n_codes: int) -> DataFrame:
    """File names whose count is not the number of languages."""
    return staged.groupBy(F.element_at(F.split("rel_path", "/"), -1).alias("name")).agg(F.count("*").alias("n")).where(F.col("n") != n_codes)


def lint_bundle(staged: DataFrame, codes: list[str], platform: str) -> DataFrame:
    """(rel_path, problem) of staged files (rel_path, text)."""
    spark = staged.sparkSession
    folder = F.element_at(F.split("rel_path", "/"), 1)
    said = lambda rows, problem: rows.select("rel_path", F.lit(problem).alias("problem"))
    found = said(staged.where(F.col("text").contains("[%")), "unconverted placeholder")
    if platform == "server":
        want = spark.createDataFrame([(f"{c}.json",) for c in codes if c != "ar"], "rel_path string")
        sets = diff_set(want, staged, "rel_path").select("rel_path", F.concat("side", F.lit(" file")).alias("problem"))
        flat = F.from_json("text", "map<string,string>")
        broken = said(staged.where(F.try_parse_json("text").isNull() | flat.isNull() | F.exists(F.map_values(flat), lambda v: v.isNull() | v.startswith("{") | v.startswith("["))), "no flat JSON")
        return found.unionByName(sets).unionByName(broken).unionByName(said(staged.where("rel_path = 'ar.json'"), "language not exported"))
    names = [f"{c}.lproj" for c in codes] if platform == "ios" else ["values", *(f"values-{c}" for c in codes if c != SOURCE_LANG)]
    want = spark.createDataFrame([(n,) for n in names], "rel_path string")
    sets = diff_set(want, staged.select(folder.alias("rel_path")), "rel_path").select("rel_path", F.concat("side", F.lit(" folder")).alias("problem"))
    found = found.unionByName(sets)
    if platform == "ios":
        counts = file_count_check(staged, len(codes)).select(F.col("name").alias("rel_path"), F.lit("file count").alias("problem"))
        blank = said(staged.where(F.col("text").rlike(r'(?m)=\s*""\s*;')), "blank value")
        return found.unionByName(counts).unionByName(blank).unionByName(said(staged.where(F.col("text").rlike(r"(?m)^\s*(/\*|//)")), "comment"))
    return found.unionByName(said(staged.where(F.col("text").rlike(r"%(\d+\$)?@|%(\d+\$)?#@")), "iOS placeholder"))


def write_bundle(staged: DataFrame, path: str) -> None:
    """A folder for each platform and language folder or file."""
    rows = staged.withColumns({"dir": F.element_at(F.split("rel_path", "/"), 1), "name": F.element_at(F.split("rel_path", "/"), -1)})
    rows.select("platform", "dir", "name", F.col("text").alias("value")).write.partitionBy("platform", "dir", "name").text(path)


def release_gate(corpus: Corpus, platform: str) -> DataFrame:
    """(lang, empty, unverified, blocked): any empty or unverified target blocks a release; a missing value is empty."""
    keys = corpus.keys.where(X.has_platform("platforms", PLATFORM_OF[platform]) & ~F.coalesce("archived", F.lit(False))).select("rec_id")
    langs = export_plan(corpus.translations.select("lang"), platform).where(F.col("lang") != SOURCE_LANG).select("lang")
    rows = keys.crossJoin(F.broadcast(langs)).join(flat_text(corpus), ["rec_id", "lang"], "left")  # a project's languages
    counts = rows.groupBy("lang").agg(F.count_if(F.coalesce("text", F.lit("")) == "").alias("empty"), F.count_if(F.col("is_unverified") & (F.coalesce("text", F.lit("")) != "")).alias("unverified"))
    return counts.withColumn("blocked", (F.col("empty") > 0) | (F.col("unverified") > 0))


def staged_order(staged: DataFrame) -> DataFrame:
    return staged.withColumn("n", F.row_number().over(Window.partitionBy("platform").orderBy("rel_path")))


def empty_bundle(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "platform string, rel_path string, text string")

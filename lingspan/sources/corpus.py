"""Reading and writing the corpus, glossary and quality flags as JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from lingspan.functions import text as X
from lingspan.operators.glossary import glossary_order, normalize
from lingspan.operators.review import numbered
from lingspan.schema import DEFAULT_LANGUAGES, PLURAL_FORMS, SOURCE_LANG, CO_SOURCE_LANG, Corpus, Glossary
from lingspan.sources.lines import placed_lines, with_line_numbers

_LINE = (
    "key_id bigint, key string, platforms array<string>, plural boolean, filenames map<string,string>, context string, char_limit int, archived boolean, "
    "unverified array<string>, dirty array<string>, dirty_meta array<string>, t map<string,string>, _bad string"
)
_TERM = (
    "term string, term_id bigint, description string, case_sensitive string, translatable string, forbidden string, tags array<string>, "
    "t_notes map<string,string>, t map<string,string>, _bad string"
)


def _parsed(lines: DataFrame, schema: str) -> DataFrame:
    """Lines that aren't blank, with their object `r` and whether they are none."""
    rows = lines.where(F.trim("line") != "").withColumn("r", F.from_json("line", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    return rows.withColumn("bad", F.col("r._bad").isNotNull() | ~F.col("line").rlike(r"^\s*\{"))


def bad_lines(spark: SparkSession, path: str, schema: str = _LINE) -> DataFrame:
    """(path, line, lineno) of lines that are no JSON objects."""
    lines = placed_lines(spark, path)
    return with_line_numbers(_parsed(lines, schema).where("bad").select("path", "split", "at", "line"), lines)


def json_lines(spark: SparkSession, path: str, schema: str, shown: int = 5) -> DataFrame:
    """(path, at, line, r): parsed lines that aren't blank, in the order of `at` within a file. The files are checked first, in
    a pass of its own: a line that is no JSON object is an error that names the file and number of `shown` such lines."""
    lines = placed_lines(spark, path)
    rows = _parsed(lines, schema)
    if not rows.where("bad").isEmpty():
        some = bad_lines(spark, path, schema).orderBy("path", "lineno").limit(shown).collect()
        raise ValueError("no JSON object in " + "; ".join(f"{r['path']}:{r['lineno']}: {r['line'][:80]}" for r in some))
    return rows.select("path", "at", "line", "r")


def read_corpus(spark: SparkSession, path: str) -> Corpus:
    rows = json_lines(spark, path, _LINE).select("at", "r.*")
    by_platform = F.from_json("key", "map<string,string>")
    rec_id = F.coalesce(F.concat(F.lit("id:"), F.col("key_id").cast("string")), F.concat(F.lit("new:"), F.sha1(F.concat_ws("|", "key", F.col("at").cast("string")).cast("binary"))))
    none = F.array().cast("array<string>")
    is_map = F.col("key").startswith("{")
    rows = rows.withColumns({"rec_id": rec_id, "plural": F.coalesce("plural", F.lit(False))})
    keys = rows.select(
        "rec_id", "key_id", F.col("at").alias("ord"), F.when(~is_map, F.col("key")).alias("key_name"), F.when(is_map, by_platform).alias("key_by_platform"),
        F.coalesce("platforms", none).alias("platforms"), "plural", F.coalesce("archived", F.lit(False)).alias("archived"), "context", "char_limit", "filenames", F.coalesce("dirty_meta", none).alias("dirty_meta"),
    )
    forms = F.when(F.col("plural"), F.from_json("v", "map<string,string>")).otherwise(F.create_map(F.lit(""), F.col("v")))
    texts = rows.select("rec_id", "plural", "unverified", "dirty", F.explode("t").alias("lang", "v")).where("v IS NOT NULL")
    texts = texts.select("rec_id", "lang", "unverified", "dirty", F.explode(forms).alias("form", "value"))
    has = lambda c: F.coalesce(F.array_contains(c, F.col("lang")), F.lit(False))
    return Corpus(keys, texts.select("rec_id", "lang", "form", "value", (has("unverified") & (F.col("lang") != SOURCE_LANG)).alias("is_unverified"), has("dirty").alias("is_dirty")))


def normalize_corpus(corpus: Corpus) -> Corpus:
    """State lists sorted, each entry once; file names in platform order without blanks; the source never unverified."""
    files = F.map_filter("filenames", lambda k, v: F.coalesce(v, F.lit("")) != "")
    order = X.ordered_platforms(F.map_keys(files))
    keys = corpus.keys.withColumns({
        "dirty_meta": F.array_sort(F.array_distinct("dirty_meta")), "platforms": F.array_distinct("platforms"),
        "filenames": F.when(F.size(files) > 0, F.map_from_entries(F.transform(order, lambda p: F.struct(p.alias("key"), F.try_element_at(files, p).alias("value"))))),
    })
    return Corpus(keys, corpus.translations.withColumn("is_unverified", F.col("is_unverified") & (F.col("lang") != SOURCE_LANG)))


def to_json_lines(corpus: Corpus) -> DataFrame:
    """(key_id, ord, line): a lean object a key: languages sorted, the source text repeated as en, empty lists left out,
    state lists and then the values last."""
    c = normalize_corpus(corpus)
    forms = F.array_position(F.array(*[F.lit(f) for f in PLURAL_FORMS]), F.col("form"))
    by_lang = c.translations.groupBy("rec_id", "lang").agg(
        F.max(F.when(F.col("form") == "", F.col("value"))).alias("flat"), F.array_sort(F.collect_list(F.when(F.col("form") != "", F.struct(forms.alias("o"), "form", "value")))).alias("forms"),
        F.bool_or("is_unverified").alias("u"), F.bool_or("is_dirty").alias("d"),
    )
    texts = by_lang.groupBy("rec_id").agg(F.array_sort(F.collect_list(F.struct("lang", F.struct("flat", "forms", "u", "d").alias("x")))).alias("s"))
    map_of = lambda get: F.map_from_entries(F.transform("s", lambda e: F.struct(e["lang"], get(e["x"]))))
    flat, nested = map_of(lambda x: x["flat"]), map_of(lambda x: F.map_from_entries(F.transform(x["forms"], lambda f: F.struct(f["form"], f["value"]))))
    listed = lambda flag: _filled(F.transform(F.filter("s", lambda e: e["x"][flag]), lambda e: e["lang"]))
    source = F.coalesce(F.get(F.filter("s", lambda e: e["lang"] == SOURCE_LANG), F.lit(0))["x"]["flat"], F.get(F.filter(F.get(F.filter("s", lambda e: e["lang"] == SOURCE_LANG), F.lit(0))["x"]["forms"], lambda f: f["form"] == "other"), F.lit(0))["value"])
    rows = c.keys.join(texts, "rec_id", "left").withColumn("s", F.coalesce("s", F.array().cast(texts.schema["s"].dataType)))
    true = lambda name: F.when(F.col(name), True)

    def line(values: Column) -> Column:
        body = lambda key: F.to_json(F.struct("key_id", key.alias("key"), "platforms", true("plural").alias("plural"), source.alias("en"), "filenames", F.nullif("context", F.lit("")).alias("context"), "char_limit", true("archived").alias("archived"), listed("u").alias("unverified"), listed("d").alias("dirty"), _filled(F.col("dirty_meta")).alias("dirty_meta"), values.alias("t")))
        return F.when(F.col("key_name").isNotNull(), body(F.col("key_name"))).otherwise(body(F.col("key_by_platform")))

    return rows.select("key_id", "ord", F.when(F.col("plural"), line(nested)).otherwise(line(flat)).alias("line"))


def _filled(items: Column) -> Column:
    return F.when(F.size(items) > 0, items)


def write_corpus(corpus: Corpus, path: str, parts: int | None = None) -> None:
    """Text parts by ranges of the order, key ids first and keys without one last: read in the order of their names they are the
    corpus in its order."""
    order = [F.col("key_id").asc_nulls_last(), F.col("ord")]
    rows = to_json_lines(corpus)
    dealt = rows.repartitionByRange(parts, *order) if parts else rows.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).select("line").write.text(path)


def write_versioned(df: DataFrame, base: str, version: str, retain: int = 20) -> list[str]:
    """Writes base/v=<version> and names the versions beyond the newest `retain`; nothing is overwritten. One writer names its
    versions here; `lingspan.sources.versions` publishes those of several."""
    df.write.parquet(f"{base}/v={version}")
    return expired_versions(df.sparkSession, base, retain)


def versions(spark: SparkSession, base: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName()[2:] for s in fs.listStatus(path) if s.getPath().getName().startswith("v="))


def expired_versions(spark: SparkSession, base: str, retain: int = 20) -> list[str]:
    return versions(spark, base)[: -retain or None] if retain else versions(spark, base)


def restore(spark: SparkSession, base: str, version: str) -> DataFrame:
    return spark.read.parquet(f"{base}/v={version}")


def build_meta(corpus: Corpus) -> DataFrame:
    """One row: languages, platforms and counts."""
    langs = corpus.translations.agg(F.array_sort(F.collect_set("lang")).alias("languages"), F.count_distinct(F.when(F.col("is_unverified"), F.col("rec_id"))).alias("unverified_key_count"))
    keys = corpus.keys.agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("platforms")))).alias("platforms"), F.count("*").alias("key_count"),
        F.count_if("archived").alias("archived_count"), F.count_if("plural").alias("plural_count"),
    )
    return keys.crossJoin(langs).withColumns({"source_lang": F.lit(SOURCE_LANG), "generated_at": X.utc_stamp(F.current_timestamp())})  # a row each


def read_languages(spark: SparkSession, meta_path: str, fallback: bool = True) -> DataFrame:
    """Languages of the meta file; without one the default list, or an error if there is to be no fallback."""
    try:
        return spark.read.json(meta_path, multiLine=True).select(F.explode("languages").alias("lang"))
    except AnalysisException:
        if not fallback:
            raise
        return spark.createDataFrame([(x,) for x in DEFAULT_LANGUAGES], "lang string")


def translation_langs(langs: DataFrame) -> DataFrame:
    return langs.where(F.col("lang") != SOURCE_LANG)


def target_langs(langs: DataFrame) -> DataFrame:
    return langs.where(~F.col("lang").isin(SOURCE_LANG, CO_SOURCE_LANG))


def read_glossary(spark: SparkSession, path: str) -> Glossary:
    """A missing file is an empty glossary."""
    try:
        rows = json_lines(spark, path, _TERM).select("r.*")
    except AnalysisException:
        rows = spark.createDataFrame([], _TERM)
    terms = rows.select("term", "term_id", "description", X.truthy("case_sensitive").alias("case_sensitive"), X.falsy_or("translatable", True).alias("translatable"), X.truthy("forbidden").alias("forbidden"), "tags")
    langs = F.array_distinct(F.concat(F.coalesce(F.map_keys("t"), F.array().cast("array<string>")), F.coalesce(F.map_keys("t_notes"), F.array().cast("array<string>"))))
    texts = rows.select("term", "t", "t_notes", F.explode(langs).alias("lang")).select("term", "lang", F.try_element_at("t", F.col("lang")).alias("text"), F.try_element_at("t_notes", F.col("lang")).alias("note"))
    return normalize(Glossary(terms.withColumn("case_sensitive", F.coalesce("case_sensitive", F.lit(False))).withColumn("forbidden", F.coalesce("forbidden", F.lit(False))), texts))


def glossary_lines(glossary: Glossary) -> DataFrame:
    """(term, line) in order; flags at their defaults and empty parts are left out."""
    g = normalize(glossary)
    side = lambda c, name: g.texts.where(F.col(c).isNotNull()).groupBy("term").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("lang", c)))).alias(name))
    rows = g.terms.join(side("text", "t"), "term", "left").join(side("note", "t_notes"), "term", "left")
    body = F.to_json(F.struct("term", "term_id", "description", F.when(F.col("case_sensitive"), True).alias("case_sensitive"), F.when(~F.col("translatable"), False).alias("translatable"), F.when(F.col("forbidden"), True).alias("forbidden"), _filled(F.col("tags")).alias("tags"), "t_notes", "t"))
    return rows.select("term", body.alias("line")).orderBy(*glossary_order())


def read_qa_issues(spark: SparkSession, path: str) -> DataFrame:
    return json_lines(spark, path, "key_id bigint, lang string, translation_id bigint, issues array<string>, value string, qa string, _bad string").select("r.key_id", "r.lang", "r.translation_id", "r.issues", "r.value", "r.qa")


def qa_lines(flags: DataFrame) -> DataFrame:
    return flags.orderBy(F.col("key_id").asc_nulls_last(), "lang").select(F.to_json(F.struct("key_id", "lang", "translation_id", "issues", "value", "qa")).alias("line"))


def first_by_name(names: DataFrame) -> DataFrame:
    """names (name, rec_id, ord) -> the first of each name."""
    return names.withColumn("_n", F.row_number().over(Window.partitionBy("name").orderBy("ord"))).where("_n = 1").drop("_n")


def entries(corpus: Corpus) -> DataFrame:
    return numbered(corpus.keys, F.col("key_id").asc_nulls_last(), "ord")

"""Queries over readers and writers: files are written from the given tables into the shared folder, then read back."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lingspan.operators import edits, glossary, lint, review, rules, usage
from lingspan.plans import bundles, sync
from lingspan.plans.derived import derived_corpus, table
from lingspan.plans.forms import forms_corpus
from lingspan.plans.queries import FAMILY, G, MERGED, WITH, _glossary, _passes, query
from lingspan.plans.queries_code import ANDROID, RENDERED
from lingspan.plans.queries_forms import FORMS
from lingspan.functions import text as X
from lingspan.schema import Glossary
from lingspan.sources import corpus as corpora
from lingspan.sources import dumps, lines, reports, trees, versions
from lingspan.tables import shared_dir


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _files(rows: DataFrame, name: str, *by: str, most: int = 0) -> str:
    """Text files of rows (value, ...), a folder for each value of `by` and at most `most` rows a file; their folder."""
    path = _folder(rows.sparkSession, name)
    (rows.write.partitionBy(*by) if by else rows.write).option("maxRecordsPerFile", most).text(path)
    return path


#: Pages in a file of a tree. A file a page would cost its making, moving and listing for each page, most of it in the driver.
PAGES = 200


# The corpus, glossary and flags as JSON lines


def _read_back(spark: SparkSession, sf_dir: str):
    path = _folder(spark, "corpus")
    corpora.write_corpus(forms_corpus(spark, sf_dir), path)
    return corpora.read_corpus(spark, path)


@query(FORMS + "SELECT concat('id:', key_id) AS rec_id, lang, form, value, unverified, dirty FROM t")
def corpus_file_values(spark, sf_dir):
    return _read_back(spark, sf_dir).translations.select("rec_id", "lang", "form", "value", F.col("is_unverified").alias("unverified"), F.col("is_dirty").alias("dirty"))


@query(FORMS + "SELECT key_id, key_name, name_ios, name_android, platforms_csv, plural, archived, nullif(context, '') AS context, char_limit, file_ios FROM k")
def corpus_file_keys(spark, sf_dir):
    names = F.col("key_by_platform")
    return _read_back(spark, sf_dir).keys.select(
        "key_id", "key_name", names["ios"].alias("name_ios"), names["android"].alias("name_android"), F.array_join("platforms", ",").alias("platforms_csv"), "plural", "archived", "context", "char_limit", F.col("filenames")["ios"].alias("file_ios")
    )


@query(FORMS + """, s AS (SELECT key_id, '["' || string_agg(DISTINCT lang, '","' ORDER BY lang) FILTER (unverified) || '"]' AS unverified, '["' || string_agg(DISTINCT lang, '","' ORDER BY lang) FILTER (dirty) || '"]' AS dirty FROM t GROUP BY key_id)
SELECT k.key_id, key_name, name_ios, e.text AS en, CASE WHEN k.plural THEN 'true' END AS plural, p.value AS pl_few, d.text AS ja, s.unverified, s.dirty FROM k LEFT JOIN s USING (key_id) LEFT JOIN (SELECT * FROM ft WHERE lang = 'en') e USING (key_id)
LEFT JOIN (SELECT * FROM t WHERE lang = 'pl' AND form = 'few') p USING (key_id) LEFT JOIN (SELECT ft.* FROM ft JOIN k USING (key_id) WHERE lang = 'ja' AND NOT k.plural) d USING (key_id)""")  # fmt: skip
def json_line_fields(spark, sf_dir):
    at = lambda path, name: F.get_json_object("line", path).alias(name)
    rows = corpora.to_json_lines(forms_corpus(spark, sf_dir))
    flat = F.get_json_object("line", "$.plural").isNull()
    return rows.select(
        "key_id", F.when(~F.get_json_object("line", "$.key").startswith("{"), F.get_json_object("line", "$.key")).alias("key_name"), at("$.key.ios", "name_ios"), at("$.en", "en"), at("$.plural", "plural"), at("$.t.pl.few", "pl_few"),
        F.when(flat, F.get_json_object("line", "$.t.ja")).alias("ja"), at("$.unverified", "unverified"), at("$.dirty", "dirty"),
    )


def _read_glossary(spark: SparkSession, sf_dir: str) -> Glossary:
    return corpora.read_glossary(spark, _files(corpora.glossary_lines(_glossary(spark, sf_dir)).select("line"), "glossary"))


@query(G + "SELECT term, CASE WHEN k % 3 = 0 THEN k END AS term_id, CASE WHEN k % 4 <> 0 THEN lower(p_type) END AS description, k % 6 = 0 AS case_sensitive, k % 10 <> 0 AS translatable, k % 15 = 0 AS forbidden, CASE WHEN k % 9 = 0 THEN 'ui,unit,odd,legal' ELSE 'ui' END AS tags FROM g")
def glossary_file_terms(spark, sf_dir):
    return _read_glossary(spark, sf_dir).terms.withColumn("tags", F.array_join("tags", ","))


@query(G + "SELECT term, 'de' AS lang, concat('Teil ', k) AS text, CASE WHEN k % 8 = 0 THEN 'siehe; oben' END AS note FROM x")
def glossary_file_texts(spark, sf_dir):
    return _read_glossary(spark, sf_dir).texts.distinct()


@query(f"SELECT key_id, lang, issues, translation_id, qa FROM ({MERGED})")
def qa_file(spark, sf_dir):
    path = _files(corpora.qa_lines(review.merge_qa_issues(_passes(spark, sf_dir))), "flags")
    return corpora.read_qa_issues(spark, path).select("key_id", "lang", F.array_join("issues", ",").alias("issues"), "translation_id", "qa")


# Dumps of a service


def _page_files(rows: DataFrame, field: str, name: str, *by: str) -> str:
    """Objects with a page of rows each under `field`, a file a page."""
    said = [c for c in rows.columns if c not in by]
    pages = rows.groupBy(*by).agg(F.collect_list(F.struct(*said)).alias("_page"))
    return _files(pages.select(F.to_json(F.struct(F.col("_page").alias(field))).alias("value"), *by), name, *by)


def _dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, name = F.col("p_partkey"), F.replace("p_name", F.lit(" "), F.lit("_"))
    said = lambda lang, value, waits, fuzzy: F.struct(F.lit(lang).alias("language_iso"), value.alias("translation"), waits.alias("is_unverified"), fuzzy.alias("is_fuzzy"))
    plural = k % 5 == 0
    de = F.when(k % 7 == 0, "").when(plural, F.to_json(F.struct(F.col("p_type").alias("one"), F.col("p_brand").alias("other"), F.lit("x").alias("odd")))).otherwise(F.col("p_brand"))
    rows = table(spark, sf_dir, "part").select(
        F.floor(k / 100).alias("page"), k.alias("key_id"), F.create_map(F.lit("ios"), name, F.lit("web"), F.when(k % 3 == 0, F.concat(name, F.lit("_w"))).otherwise(name)).alias("key_name"), F.array(F.lit("ios"), F.lit("web")).alias("platforms"),
        F.create_map(F.lit("ios"), F.when(k % 2 == 0, "A.strings").otherwise("")).alias("filenames"), F.when(k % 4 == 0, " ").otherwise(F.concat(F.lit(" said "), k.cast("string"))).alias("description"), F.lit("older").alias("context"),
        F.when(k % 6 == 0, 0).otherwise(40).alias("char_limit"), (k % 8 == 1).alias("is_archived"), plural.alias("is_plural"), F.array(said("en", F.col("p_type"), F.lit(True), F.lit(False)), said("de", de, k % 3 == 1, k % 11 == 2)).alias("translations"),
    )
    return dumps.service_keys(spark, _page_files(rows, "keys", "dump", "page"), archived="include")


@query("""SELECT p_partkey AS key_id, CASE WHEN p_partkey % 3 <> 0 THEN replace(p_name, ' ', '_') END AS key_name, CASE WHEN p_partkey % 3 = 0 THEN concat(replace(p_name, ' ', '_'), '_w') END AS name_web, p_partkey % 5 = 0 AS plural, p_partkey % 8 = 1 AS archived,
CASE WHEN p_partkey % 4 = 0 THEN 'older' ELSE concat('said ', p_partkey) END AS context, CASE WHEN p_partkey % 6 <> 0 THEN 40 END AS char_limit, CASE WHEN p_partkey % 2 = 0 THEN 'A.strings' END AS file FROM part""")  # fmt: skip
def dump_keys(spark, sf_dir):
    keys = dumps.corpus_from_service(_dump(spark, sf_dir)).keys
    return keys.select("key_id", "key_name", F.col("key_by_platform")["web"].alias("name_web"), "plural", "archived", "context", "char_limit", F.col("filenames")["ios"].alias("file"))


@query("""WITH v AS (SELECT p_partkey AS k, 'en' AS lang, CASE WHEN p_partkey % 5 = 0 THEN 'other' ELSE '' END AS form, p_type AS value FROM part UNION ALL SELECT p_partkey, 'de', CASE WHEN p_partkey % 5 = 0 THEN 'other' ELSE '' END, CASE WHEN p_partkey % 7 = 0 THEN '' ELSE p_brand END FROM part
UNION ALL SELECT p_partkey, 'de', 'one', p_type FROM part WHERE p_partkey % 5 = 0 AND p_partkey % 7 <> 0)
SELECT concat('id:', k) AS rec_id, lang, form, value, lang = 'de' AND k % 7 <> 0 AND (k % 3 = 1 OR k % 11 = 2) AS unverified FROM v""")  # fmt: skip
def dump_values(spark, sf_dir):
    return dumps.corpus_from_service(_dump(spark, sf_dir)).translations.select("rec_id", "lang", "form", "value", F.col("is_unverified").alias("unverified"))


@query("SELECT user_id AS key_id, concat('l', event_id % 3) AS lang, event_type AS issue, dense_rank() OVER (ORDER BY event_type) AS pass_ord, event_id AS translation_id FROM events")
def dump_passes(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("issue"), F.floor(F.col("event_id") / 1000).alias("page"), F.col("event_id").alias("translation_id"), F.col("user_id").alias("key_id"), F.concat(F.lit("l"), (F.col("event_id") % 3).cast("string")).alias("language_iso"), F.lit("v").alias("translation"), F.lit("").alias("qa"))
    return dumps.service_translations(spark, _page_files(rows, "translations", "passes", "issue", "page")).select("key_id", "lang", "issue", F.col("pass_ord").cast("bigint").alias("pass_ord"), "translation_id")


@query("SELECT n_name AS lang, n_nationkey + 600 AS lang_id FROM nation")
def dump_languages(spark, sf_dir):
    rows = table(spark, sf_dir, "nation").select(F.floor(F.col("n_nationkey") / 10).alias("page"), (F.col("n_nationkey") + 600).alias("lang_id"), F.col("n_name").alias("lang_iso"))
    return dumps.service_languages(spark, _page_files(rows, "languages", "languages", "page"))


@query("SELECT p_partkey AS id, p_name AS term, CASE WHEN p_partkey % 2 = 0 THEN 'yes' ELSE 'no' END AS flag, p_brand AS tag FROM part")
def dump_glossary(spark, sf_dir):
    k = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(F.floor(k / 50).alias("page"), k.alias("id"), F.col("p_name").alias("term"), F.when(k % 2 == 0, "yes").otherwise("no").alias("caseSensitive"), F.array("p_brand").alias("tags"))
    listed = rows.where("page % 2 = 0").groupBy("page").agg(F.collect_list(F.struct("id", "term", "caseSensitive", "tags")).alias("data")).select(F.to_json(F.struct("data")).alias("value"))
    bare = rows.where("page % 2 = 1").select(F.to_json(F.struct("id", "term", "caseSensitive", "tags")).alias("value"))
    return dumps.service_glossary(spark, _files(listed.unionAll(bare), "terms")).select("id", "term", F.col("caseSensitive").alias("flag"), F.array_join("tags", ",").alias("tag"))


# Trees, edits, tables and lists


@query("WITH l AS (SELECT unnest(string_split(html, chr(10))) AS line FROM pages WHERE page_id % 5 <> 3) SELECT md5(line) AS h, count(*) AS n FROM l GROUP BY 1")
def source_tree_lines(spark, sf_dir):
    k = F.col("page_id")
    rows = table(spark, sf_dir, "pages").where("html IS NOT NULL").select(F.when(k % 5 == 3, "build").otherwise(F.concat(F.lit("m"), (k % 3).cast("string"))).alias("d"), F.col("html").alias("value"))
    lines = dumps.lines_of(dumps.source_tree(spark, _files(rows, "tree", "d", most=PAGES), [".txt"], skipped=("d=build",)).withColumn("text", F.regexp_replace("text", "\n\\z", "")))
    return lines.groupBy(F.md5("line").alias("h")).agg(F.count("*").alias("n"))


def _maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edit maps of a hundred keys each: texts, plural forms, and forms that do not exist."""
    k = F.col("p_partkey")
    value = F.when(k % 4 == 0, F.format_string('{"one": "1 %s", "odd": "x"}', "p_brand")).when(k % 4 == 1, "null").otherwise(F.format_string('"%s"', "p_name"))
    rows = table(spark, sf_dir, "part").select(F.when(k % 200 < 100, "de").otherwise("fr").alias("lang"), F.floor(k / 100).alias("g"), F.format_string('"key%d": %s', k, value).alias("entry"))
    return rows.groupBy("lang", "g").agg(F.concat(F.lit("{"), F.array_join(F.collect_list("entry"), ","), F.lit("}")).alias("text")).select("lang", "text")


IN_LANG = "CASE WHEN p_partkey % 200 < 100 THEN 'de' ELSE 'fr' END AS lang"


@query(f"SELECT concat('key', p_partkey) AS key, {IN_LANG}, '' AS form, p_name AS value FROM part WHERE p_partkey % 4 > 1 UNION ALL SELECT concat('key', p_partkey), {IN_LANG}, 'one', concat('1 ', p_brand) FROM part WHERE p_partkey % 4 = 0")
def edit_map_entries(spark, sf_dir):
    return dumps.edit_map(_maps(spark, sf_dir))[0].drop("pos")


@query(f"SELECT concat('key', p_partkey) AS key, {IN_LANG}, CASE WHEN p_partkey % 4 = 0 THEN 'unknown form' ELSE 'no text' END AS problem FROM part WHERE p_partkey % 4 < 2")
def edit_map_refused(spark, sf_dir):
    return dumps.edit_map(_maps(spark, sf_dir))[1].select("key", "lang", "problem")


def _findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    row = F.format_string("| %d | `%s` | %s | a \\| %s | %s | %s |%s", k, F.replace("p_name", F.lit(" "), F.lit("_")), F.when(k % 3 == 0, "FR").otherwise("de"), F.col("p_brand"), F.when(k % 2 == 0, "Accept").when(k % 5 == 0, "modify").otherwise("reject"), F.when(k % 7 == 0, "applied").otherwise("—"), F.when(k % 11 == 4, " more |").otherwise(""))
    rows = table(spark, sf_dir, "part").select(F.floor(k / 60).alias("g"), k, row.alias("row")).groupBy("g").agg(F.array_sort(F.collect_list(F.struct("p_partkey", "row"))).alias("rows"))
    head = "# Findings\n\n| # | key | lang | suggestion | verdict | applied_value |\n|---|---|---|---|---|---|\n"
    return rows.select(F.format_string("f%d.md", "g").alias("path"), F.concat(F.lit(head), F.array_join(F.transform("rows", lambda r: r["row"]), "\n")).alias("text"))


@query("SELECT replace(p_name, ' ', '_') AS key, 'fr' AS lang, CASE WHEN p_partkey % 7 = 0 THEN 'applied' ELSE concat('a | ', p_brand) END AS value FROM part WHERE p_partkey % 3 = 0 AND (p_partkey % 2 = 0 OR p_partkey % 5 = 0) AND p_partkey % 11 <> 4")
def findings_edits(spark, sf_dir):
    return dumps.findings_table(_findings(spark, sf_dir), "fr")[0].select("key", "lang", "value")


@query("SELECT concat('f', CAST(floor(p_partkey / 60) AS BIGINT), '.md') AS path, count(*) AS n FROM part WHERE p_partkey % 11 = 4 GROUP BY 1")
def findings_misshapen(spark, sf_dir):
    return dumps.findings_table(_findings(spark, sf_dir), "fr")[1].groupBy("path").agg(F.count("*").alias("n"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS ref, 'id' AS kind FROM orders WHERE o_orderkey % 4 > 1")
def key_list(spark, sf_dir):
    k = F.col("o_orderkey")
    line = F.when(k % 4 == 0, F.concat(F.lit("# "), k.cast("string"))).when(k % 4 == 1, F.concat(F.lit("n"), k.cast("string"))).otherwise(F.concat(F.lit("  "), k.cast("string")))
    return dumps.read_key_list(spark, _files(table(spark, sf_dir, "orders").select(line.alias("value")), "list"), "id")


def _arrays(rows: DataFrame, name: str, by: str) -> str:
    """A JSON array a file."""
    said = [c for c in rows.columns if c != by]
    return _files(rows.groupBy(by).agg(F.to_json(F.collect_list(F.struct(*said))).alias("value")), name, by)


@query("SELECT p_partkey AS key_id, concat(p_name, '!') AS new_name FROM part")
def rename_map(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / 100).alias("page"), F.col("p_partkey").alias("key_id"), F.concat("p_name", F.lit("!")).alias("new_name"))
    return dumps.read_rename_map(spark, _arrays(rows, "renames", "page")).select("key_id", "new_name")


@query("SELECT p_name AS key_name, 'web' AS platforms, p_brand AS description, p_type AS said FROM part")
def create_payloads(spark, sf_dir):
    said = F.array(F.struct(F.lit("en").alias("language_iso"), F.col("p_type").alias("translation")))
    rows = table(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / 100).alias("page"), F.col("p_name").alias("key_name"), F.array(F.lit("web")).alias("platforms"), F.col("p_brand").alias("description"), said.alias("translations"))
    return dumps.read_create_payload(spark, _arrays(rows, "creates", "page")).select("key_name", F.array_join("platforms", ",").alias("platforms"), "description", F.col("translations")[0]["translation"].alias("said"))


@query("SELECT p_partkey AS key_id, p_brand AS description, p_type AS tags FROM part")
def update_payloads(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / 100).alias("page"), F.col("p_partkey").alias("key_id"), F.col("p_brand").alias("description"), F.array("p_type").alias("tags"))
    return dumps.read_update_payload(spark, _arrays(rows, "updates", "page")).select("key_id", "description", F.array_join("tags", ",").alias("tags"))


@query(FORMS + ANDROID + ", l AS (SELECT CASE lang WHEN 'en' THEN 'values' WHEN 'id' THEN 'values-in' ELSE concat('values-', lang) END AS dir, 3 + sum(1 + length(v) - length(replace(v, chr(10), ''))) AS lines FROM v GROUP BY 1) SELECT dir, CAST(lines AS BIGINT) AS lines FROM l")
def bundle_files(spark, sf_dir):
    """Lines of a bundle's files, which are written in ranges and read again line by line, so no task holds a file."""
    path = _folder(spark, "bundle")
    bundles.write_bundle_parts(forms_corpus(spark, sf_dir), "android", path)
    return spark.read.option("lineSep", "\n").text(path).groupBy(F.substring_index("file", "/", 1).alias("dir")).agg(F.count("*").alias("lines"))


@query(FORMS + "SELECT count(*) AS n, true AS within FROM k")
def plan_chunks(spark, sf_dir):
    sizes = sync.chunks(forms_corpus(spark, sf_dir).keys, 7, buckets=16).groupBy("bucket", "chunk").agg(F.count("*").alias("n"))
    return sizes.agg(F.sum("n").alias("n"), (F.max("n") <= 7).alias("within"))


@query(G + "SELECT DISTINCT 'de' AS lang FROM x")
def glossary_langs_without_id(spark, sf_dir):
    return glossary.missing_lang_ids(_glossary(spark, sf_dir), spark.createDataFrame([("fr", 641)], "lang string, lang_id bigint"))


# Files of any size


def _parts_of(spark: SparkSession, sf_dir: str, platform: str) -> DataFrame:
    """A bundle written in ranges, its parts joined again in the order of their names: (platform, rel_path, chars, h)."""
    path = _folder(spark, "parts")
    bundles.write_bundle_parts(forms_corpus(spark, sf_dir), platform, path)
    parts = spark.read.text(path, wholetext=True).select("platform", F.col("file").alias("rel_path"), F.struct(F.col("_metadata.file_name").alias("name"), "value").alias("part"))
    whole = parts.groupBy("platform", "rel_path").agg(F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["value"]), "").alias("text"))
    return whole.select("platform", "rel_path", F.char_length("text").cast("bigint").alias("chars"), F.md5("text").alias("h"))


def _sums(platform: str) -> str:
    tables, files = RENDERED[platform]
    return f"{tables} SELECT platform, rel_path, length(text) AS chars, md5(text) AS h FROM ({files})"


@query(_sums("android"))
def bundle_parts_android(spark, sf_dir):
    return _parts_of(spark, sf_dir, "android")


@query(_sums("ios"))
def bundle_parts_ios(spark, sf_dir):
    return _parts_of(spark, sf_dir, "ios")


@query(_sums("server"))
def bundle_parts_server(spark, sf_dir):
    return _parts_of(spark, sf_dir, "server")


@query("""WITH l AS (SELECT CAST(floor(p_partkey / 50) AS BIGINT) AS g, row_number() OVER (PARTITION BY floor(p_partkey / 50) ORDER BY p_partkey) AS lineno, p_partkey, p_name FROM part)
SELECT g, lineno, CASE WHEN p_partkey % 7 = 3 THEN concat('{"key": ', p_name) ELSE concat('"', p_name, '"') END AS line FROM l WHERE p_partkey % 7 = 3 OR p_partkey % 11 = 6""")  # fmt: skip
def bad_line_numbers(spark, sf_dir):
    k, g = F.col("p_partkey"), F.floor(F.col("p_partkey") / 50).alias("g")
    line = F.when(k % 7 == 3, F.concat(F.lit('{"key": '), "p_name")).when(k % 11 == 6, F.concat(F.lit('"'), "p_name", F.lit('"'))).when(k % 5 == 2, "  ").otherwise(F.concat(F.lit('{"key": "'), "p_name", F.lit('"}')))
    rows = table(spark, sf_dir, "part").select(g, k, line.alias("value")).repartition("g").sortWithinPartitions("g", "p_partkey").select("g", "value")
    bad = corpora.bad_lines(spark, _files(rows, "lines", "g"))
    return bad.select(F.regexp_extract("path", r"/g=(\d+)/", 1).cast("bigint").alias("g"), "lineno", "line")


@query("""WITH l AS (SELECT page_id, string_split(html, chr(10)) AS ls FROM pages), n AS (SELECT page_id, CAST(unnest(range(1, len(ls) + 1)) AS BIGINT) AS lineno, ls FROM l) SELECT page_id, lineno, md5(ls[lineno]) AS h FROM n""")
def file_line_numbers(spark, sf_dir):
    """Files of many pages each, in whose numbers of lines a page's first one is found again."""
    page = F.concat(F.col("page_id").cast("string"), F.lit(" "), F.monotonically_increasing_id().cast("string"), F.lit("\t"))  # one page's mark, whatever its page_id
    rows = table(spark, sf_dir, "pages").where("html IS NOT NULL").select("html", page.alias("mark"))
    marked = rows.select(F.concat("mark", F.replace("html", F.lit("\n"), F.concat(F.lit("\n"), F.col("mark")))).alias("value"))
    found = lines.numbered_lines(spark, _files(marked, "pages"))
    found = found.select("path", F.substring_index("line", "\t", 1).alias("mark"), "lineno", F.md5(F.expr("substr(line, instr(line, '\t') + 1)")).alias("h"))
    first = found.groupBy("path", "mark").agg(F.min("lineno").alias("first"))
    return found.join(first, ["path", "mark"]).select(F.substring_index("mark", " ", 1).cast("bigint").alias("page_id"), (F.col("lineno") - F.col("first") + 1).alias("lineno"), "h")


@query("""WITH v AS (SELECT 2 AS number, 'thirds' AS note, 3 AS m UNION ALL SELECT 3, 'restored 1', 2) SELECT number, note, p_partkey AS key_id, p_name AS name FROM v JOIN part ON p_partkey % m = 0""")
def version_rows(spark, sf_dir):
    """Four versions: all parts, each second, each third, the second again; the newest two are kept."""
    base, parts = _folder(spark, "versions"), table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key_id"), F.col("p_name").alias("name"))
    for number, (step, note) in enumerate(((1, "all"), (2, "halves"), (3, "thirds"))):
        versions.publish(parts.where(F.col("key_id") % step == 0), base, number - 1, note)
    versions.restore(spark, base, 1, 2)
    versions.retain(spark, base, 2)
    kept = [versions.read_version(spark, base, v.number).select(F.lit(v.number).alias("number"), F.lit(v.note).alias("note"), "key_id", "name") for v in versions.history(spark, base)]
    return kept[0].unionAll(kept[1])


FOLDERS = ("src", "build", "Pods", "fastlane", "node_modules", ".gradle", "Icons.xcassets", "app")


def _tree_files(spark: SparkSession, sf_dir: str, rules: trees.TreeRules) -> DataFrame:
    """Pages dealt over folders, a line of JSON each and many in a file, read back by a rule set; the text sink names folders
    d=<name> and all files .txt."""
    k = F.col("page_id")
    folder = F.get(F.array(*map(F.lit, FOLDERS)), (k % len(FOLDERS)).cast("int"))
    root = _files(table(spark, sf_dir, "pages").select(folder.alias("d"), F.to_json(F.struct(k, "html")).alias("value")), "tree", "d", most=PAGES)
    here = replace(rules, suffixes=(".txt",), skipped=tuple(f"d={name}" for name in rules.skipped))
    text = F.regexp_replace("text", "\n\\z", "")  # the sink's last line end
    pages = trees.tree(spark, root, here).select(F.regexp_extract("path", r"^d=([^/]+)/", 1).alias("folder"), F.explode(F.split(text, "\n")).alias("line"))
    page = F.from_json("line", "page_id bigint, html string").alias("page")
    return pages.select("folder", page).select("folder", "page.page_id", F.md5("page.html").alias("h"))


def _tree_sql(rules: trees.TreeRules) -> str:
    left = [i for i, name in enumerate(FOLDERS) if name not in rules.skipped and not name.endswith(rules.skipped_suffixes or ("?",))]
    named = " ".join(f"WHEN {i} THEN '{FOLDERS[i]}'" for i in left)
    return f"SELECT CASE page_id % {len(FOLDERS)} {named} END AS folder, page_id, md5(html) AS h FROM pages WHERE page_id % {len(FOLDERS)} IN ({', '.join(map(str, left))})"


@query(_tree_sql(trees.UNUSED_KEYS))
def tree_unused_keys(spark, sf_dir):
    return _tree_files(spark, sf_dir, trees.UNUSED_KEYS)


@query(_tree_sql(trees.CONTEXTS))
def tree_contexts(spark, sf_dir):
    return _tree_files(spark, sf_dir, trees.CONTEXTS)


@query(_tree_sql(trees.ANDROID_TREE))
def tree_android(spark, sf_dir):
    return _tree_files(spark, sf_dir, trees.ANDROID_TREE)


# Reports, names, contexts, spelling, edits


@query("""WITH w AS (SELECT unnest(string_split(lower(concat(p_name, ' ', p_type)), ' ')) AS stem, p_partkey AS k FROM part), v AS (SELECT concat(stem, CASE WHEN k % 4 = 0 THEN 'our' WHEN k % 4 = 1 THEN 'or' WHEN k % 4 = 2 THEN 'ised' ELSE 'tre' END) AS word FROM w),
c AS (SELECT word, count(*) AS n FROM v GROUP BY 1)
SELECT a.word, b.word AS us, a.n, b.n AS us_n FROM c a JOIN c b ON b.word = regexp_replace(a.word, 'our$', 'or') WHERE a.word LIKE '__%our'""")  # fmt: skip
def us_spelling_pairs(spark, sf_dir):
    k = F.col("p_partkey")
    stems = table(spark, sf_dir, "part").select(k, F.explode(F.split(F.lower(F.concat("p_name", F.lit(" "), "p_type")), " ")).alias("stem"))
    word = F.concat("stem", F.when(k % 4 == 0, "our").when(k % 4 == 1, "or").when(k % 4 == 2, "ised").otherwise("tre"))
    return rules.us_pairs(stems.groupBy(word.alias("word")).agg(F.count("*").alias("n")))


@query(FORMS + """SELECT key_id, CASE WHEN platforms_csv = '' OR contains(platforms_csv, 'android') THEN coalesce(name_android, key_name) END AS name FROM k""")
def android_names(spark, sf_dir):
    return forms_corpus(spark, sf_dir).keys.select("key_id", dumps.android_name("key_name", "key_by_platform", "platforms").alias("name"))


@query("""SELECT p_partkey AS key_id, concat('Surface: ', p_name, chr(10), 'Type: ', p_type, chr(10), 'Context: of ', p_brand, chr(10), 'Constraints: at most ', p_size) AS context, concat('of ', p_brand) AS said FROM part""")
def built_contexts(spark, sf_dir):
    built = X.build_context(F.col("p_name"), F.col("p_type"), F.concat(F.lit("of "), "p_brand"), F.concat(F.lit("at most "), F.col("p_size").cast("string")))
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key_id"), built.alias("context"))
    return rows.select("key_id", "context", X.strip(X.context_fields("context")["Context"]).alias("said"))


@query("""WITH a AS (SELECT DISTINCT p_brand AS key FROM part), b AS (SELECT DISTINCT p_brand AS key FROM part WHERE p_partkey % 2 = 0)
SELECT 'all' AS name, true AS same UNION ALL SELECT 'halves', NOT EXISTS (SELECT 1 FROM a WHERE key NOT IN (SELECT key FROM b))""")
def same_key_sets(spark, sf_dir):
    keys = table(spark, sf_dir, "part").select(F.col("p_brand").alias("key"), "p_partkey")
    return spark.createDataFrame([("all", bundles.same_key_set(keys, keys)), ("halves", bundles.same_key_set(keys, keys.where("p_partkey % 2 = 0")))], "name string, same boolean")


@query(WITH + FAMILY + """, l AS (SELECT family, trim(unnest(string_split(context, chr(10)))) AS line FROM f), m AS (SELECT family, line, count(*) AS n FROM l WHERE (starts_with(line, 'Surface:') OR starts_with(line, 'Constraints:')) AND length(line) > 25 GROUP BY ALL HAVING count(*) >= 3)
SELECT family, line, n FROM m ORDER BY n DESC, family, line LIMIT 40""")
def context_report_boilerplate(spark, sf_dir):
    none = spark.createDataFrame([], "key string, dead_citations array<string>, surface_mismatch array<string>, margin int, cap int, longest int, referenced string")
    return reports.context_report(none, usage.shared_boilerplate(lint.live_keys(derived_corpus(spark, sf_dir))))["boilerplate"]


@query("""WITH p AS (SELECT p_name AS key, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS pools, count(DISTINCT CASE WHEN p_partkey % 40 = 0 THEN p_brand END) AS used, count(DISTINCT p_brand) AS n FROM part GROUP BY 1) SELECT key, pools FROM p WHERE used = 0""")
def usage_report_candidates(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    entries = parts.select(F.col("p_brand").alias("pool"), F.col("p_name").alias("key")).distinct()
    used = parts.where("p_partkey % 40 = 0").select(F.col("p_brand").alias("pool"), F.col("p_name").alias("key")).distinct()
    path = _folder(spark, "usage")
    reports.write_usage_report(usage.pool_status(entries, used), usage.pool_counts(entries, used), parts.select(F.col("p_name").alias("name")), path)
    return spark.read.option("sep", "\t").option("header", True).csv(f"{path}/candidates").select("key", "pools")


@query(FORMS + "SELECT concat('id:', key_id) AS rec_id, lang, form, CASE WHEN lang = 'pl' AND form = '' AND key_id % 6 = 4 AND key_id % 11 <> 4 AND unverified THEN concat('nowy ', key_id) ELSE value END AS value FROM t")
def backlog_edits(spark, sf_dir):
    """Edits of flat Polish values that wait for review: none is refused, so all are applied."""
    c = forms_corpus(spark, sf_dir)
    named = c.keys.where("key_id % 6 = 4 AND key_id % 11 <> 4 AND NOT plural").select("rec_id", "key_id", F.col("key_name").alias("key"))
    rows = named.join(c.translations.where("lang = 'pl' AND is_unverified").select("rec_id").distinct(), "rec_id").select("key", F.lit("pl").alias("lang"), F.lit("").alias("form"), F.concat(F.lit("nowy "), F.col("key_id").cast("string")).alias("value"), F.lit(0).alias("pos"))
    changed, refused = edits.apply_backlog_edits(c, rows, "pl")
    return changed.translations.select("rec_id", "lang", "form", "value")

"""Queries over source trees and bundles. `part` gives the files of an application on two platforms, a definition and at
most one reference for each row; the keys of the corpus with plurals give call-sites and contexts; `pages` staged files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lingspan.operators import usage
from lingspan.plans import bundles
from lingspan.plans.derived import table
from lingspan.plans.forms import forms_corpus
from lingspan.plans.queries import CONVERT, query
from lingspan.plans.queries_forms import FORMS
from lingspan.schema import Corpus


def _one_of(k: Column, n: int, *values) -> Column:
    """The value for the remainder of k, null beyond the values given."""
    out = F.when(k % n == 0, values[0])
    for i, v in enumerate(values[1:], 1):
        out = out.when(k % n == i, v)
    return out


# Two platforms' source trees

NAMED = "WITH n AS (SELECT p_partkey AS k, concat(replace(p_name, ' ', '.'), '_', p_partkey) AS name FROM part)\n"


def _named(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Column, Column]:
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.concat(F.replace("p_name", F.lit(" "), F.lit(".")), F.lit("_"), F.col("p_partkey").cast("string")).alias("name"))
    return rows, F.col("k"), F.col("name")


def _android_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, k, name = _named(spark, sf_dir)
    field = F.replace(name, F.lit("."), F.lit("_"))
    defined = rows.select(F.format_string("app/src/main/res/values/s%d.xml", "k").alias("path"), F.when(k % 4 == 1, F.format_string('<item type="string" name="%s"/>', "name")).otherwise(F.format_string('<string name="%s">x</string>', "name")).alias("text"))
    text = _one_of(k, 6, F.concat(F.lit("val x = R.string."), field), F.format_string('getString("%s")', "name"), F.concat(F.lit("import a.b.R.string as st\nval y = st."), field), F.concat(F.lit("import a.b.R.string."), field), F.lit("// none"), F.concat(F.lit("@string/"), name))
    return defined.unionAll(rows.select(F.when(k % 6 == 5, F.format_string("app/res/layout/l%d.xml", "k")).otherwise(F.format_string("app/src/F%d.kt", "k")), text))


@query(NAMED + "SELECT name FROM n")
def android_defined_keys(spark, sf_dir):
    return usage.android_defined_keys(_android_files(spark, sf_dir))


@query(NAMED + """SELECT name AS key, concat('app/src/F', k, '.kt:', CASE k % 6 WHEN 0 THEN 'R.string' WHEN 1 THEN 'dynamic-string' WHEN 2 THEN 'st' ELSE 'import' END) AS evidence FROM n WHERE k % 6 < 4
UNION ALL SELECT name, concat('app/src/F', k, '.kt:R.string') FROM n WHERE k % 6 = 3 UNION ALL SELECT name, concat('app/res/layout/l', k, '.xml:@resource') FROM n WHERE k % 6 = 5""")  # fmt: skip
def android_usage(spark, sf_dir):
    return usage.android_usage(_android_files(spark, sf_dir))


@query(NAMED + "SELECT name FROM n WHERE k % 12 = 10")
def android_unused_keys(spark, sf_dir):
    files = _android_files(spark, sf_dir)
    rows, k, _ = _named(spark, sf_dir)
    used = usage.android_usage(files).select("key").unionAll(rows.where(k % 12 == 4).select("name"))
    return usage.unused_keys(usage.android_defined_keys(files), used)


POOL = "CASE k % 8 WHEN 1 THEN 'InfoPlist.strings' WHEN 2 THEN 'widget14.strings' WHEN 6 THEN 'widget14.strings' WHEN 3 THEN 'Localizable.stringsdict' WHEN 7 THEN 'Localizable.stringsdict' ELSE 'Localizable.strings' END"


def _pool(k: Column) -> Column:
    return F.when(k % 8 == 1, "InfoPlist.strings").when(k % 4 == 2, "widget14.strings").when(k % 4 == 3, "Localizable.stringsdict").otherwise("Localizable.strings")


def _ios_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, k, _ = _named(spark, sf_dir)
    text = F.when(k % 4 == 3, F.format_string("<key>%s</key>\n<dict>\n<key>NSStringLocalizedFormatKey</key>", "name")).otherwise(F.format_string('"%s" = "v";', "name"))
    return usage.pool_entries(rows.select(F.concat(F.format_string("d%d/en.lproj/", "k"), _pool(k)).alias("path"), text.alias("text")))


@query(NAMED + f"SELECT {POOL} AS pool, name AS key, 'en' AS locale, concat('d', k, '/en.lproj/', {POOL}) AS path FROM n")
def pool_entries(spark, sf_dir):
    return _ios_entries(spark, sf_dir)


def _accessors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _, _ = _named(spark, sf_dir)
    lines = rows.select(F.format_string('static var acc_%d: R { .init(key: "%s", tableName: "Localizable", x) }', "k", "name").alias("line"))
    return usage.generated_accessors(lines, _ios_entries(spark, sf_dir))


@query(NAMED + f"SELECT 'localizable' AS table, concat('acc_', k) AS accessor, {POOL} AS pool, name AS key FROM n WHERE {POOL} LIKE 'Localizable%'")
def generated_accessors(spark, sf_dir):
    return _accessors(spark, sf_dir).select("table", "accessor", "pool", "key")


def _ios_used(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, k, _ = _named(spark, sf_dir)
    text = _one_of(k, 5, F.format_string("R.string(preferred: x).localizable.acc_%d()", "k"), F.format_string("strings.acc_%d", "k"), F.format_string("let strings = _R.string.localizable\n$0.acc_%d", "k"), F.format_string('x("%s")', "name"), F.format_string("<string>%s</string>", "name"))
    files = rows.select(F.when(k % 5 == 4, F.format_string("src/I%d.plist", "k")).otherwise(F.format_string("src/F%d.swift", "k")).alias("path"), text.alias("text"))
    return usage.ios_usage(files, _accessors(spark, sf_dir), _ios_entries(spark, sf_dir))


USED = f""", p AS (SELECT *, {POOL} AS pool FROM n),
used AS (SELECT pool, name AS key, CASE k % 5 WHEN 0 THEN concat('src/F', k, '.swift:R.string.acc_', k) WHEN 1 THEN concat('src/F', k, '.swift:strings.acc_', k) WHEN 2 THEN concat('src/F', k, '.swift:closure.acc_', k) WHEN 3 THEN concat('src/F', k, '.swift:literal') ELSE concat('src/I', k, '.plist:literal') END AS evidence
FROM p WHERE CASE WHEN k % 5 = 4 THEN pool = 'InfoPlist.strings' ELSE pool LIKE 'Localizable%' END)
"""


@query(NAMED + USED + "SELECT * FROM used")
def ios_usage(spark, sf_dir):
    return _ios_used(spark, sf_dir)


@query(NAMED + USED + "SELECT p.pool, count(*) AS entries, count(*) FILTER (u.key IS NULL) AS unused FROM p LEFT JOIN used u ON u.pool = p.pool AND u.key = p.name GROUP BY ROLLUP (p.pool)")
def pool_counts(spark, sf_dir):
    return usage.pool_counts(_ios_entries(spark, sf_dir), _ios_used(spark, sf_dir))


# Contexts held against the code


def _against_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, k = forms_corpus(spark, sf_dir), F.col("key_id")
    cited = F.coalesce(_one_of(k, 5, F.concat(F.lit(" View"), (k % 10).cast("string"), F.lit(".swift")), F.lit(" GoneThing"), F.lit(" NSLocalizedString.x"), F.lit(""), F.lit(" Gone.swift")), F.lit(""))
    c = Corpus(c.keys.withColumn("context", F.concat("context", cited)), c.translations)
    ios, android = F.coalesce("key_name", F.col("key_by_platform")["ios"]), F.coalesce("key_name", F.col("key_by_platform")["android"])
    call = F.coalesce(_one_of(k, 6, F.concat(F.lit("R.string.localizable."), ios, F.lit("()")), F.concat(F.lit('NSLocalizedString("'), ios, F.lit('", c)')), F.concat(F.lit('f("'), ios, F.lit('", 1)'))), F.lit("none"))
    ios_lines = c.keys.select(F.concat(F.lit("Sources/View"), (k % 10).cast("string"), F.lit(".swift")).alias("path"), k.alias("lineno"), call.alias("line"))
    code = c.keys.where("key_id % 4 = 1").select(F.lit("app/A.kt").alias("path"), k.alias("lineno"), F.concat(F.lit("R.string."), android).alias("line"))
    android_lines = code.unionAll(c.keys.where("key_id % 4 = 2").select(F.lit("app/res/values/strings.xml"), k, F.concat(F.lit('<string name="'), android, F.lit('">'))))
    return usage.lint_context_against_code(c, ios_lines, ios_lines.select("path").distinct(), android_lines, android_lines.select("path").distinct())


AGAINST = """, b AS (SELECT key_id, max(length(value)) AS longest FROM t WHERE value <> '' GROUP BY key_id),
a AS (SELECT concat('id:', k.key_id) AS rec_id, key, CASE k.key_id % 6 WHEN 0 THEN 'R.string' WHEN 1 THEN 'NSLocalizedString' WHEN 2 THEN 'literal' END AS kind, k.key_id % 4 AS m, k.key_id % 5 AS five, k.key_id,
 longest, contains(context, '60 chars') AND longest > 65 AS over, coalesce(contains(e.text, '[%'), false) AND NOT k.plural AS unexplained, contains(context, 'Register:') AS has_register
 FROM k LEFT JOIN b USING (key_id) LEFT JOIN (SELECT * FROM ft WHERE lang = 'en') e USING (key_id) WHERE NOT archived),
r AS (SELECT rec_id, key, concat('Sources/View', key_id % 10, '.swift:', key_id, ' (', kind, ')') AS usage_site, CASE WHEN m = 1 THEN concat('app/A.kt:', key_id, ' (R.string)') END AS android_site,
 CASE WHEN kind IS NOT NULL AND m = 1 THEN 'both' WHEN kind IS NOT NULL THEN 'ios' WHEN m IN (1, 2) THEN 'android' ELSE 'none' END AS referenced, CASE five WHEN 1 THEN 'GoneThing' WHEN 4 THEN 'Gone,Gone.swift' END AS dead,
 CASE WHEN five = 2 AND kind IN ('R.string', 'NSLocalizedString') THEN 'NSLocalizedString' END AS mismatch, CASE WHEN over THEN longest END AS longest, unexplained, has_register, kind FROM a)
""".replace("concat('Sources/View', key_id % 10, '.swift:', key_id, ' (', kind, ')') AS usage_site", "CASE WHEN kind IS NOT NULL THEN concat('Sources/View', key_id % 10, '.swift:', key_id, ' (', kind, ')') END AS usage_site")


@query(FORMS + AGAINST + "SELECT * EXCLUDE (kind) FROM r")
def context_against_code(spark, sf_dir):
    said = lambda c, name: F.array_join(c, ",").alias(name)
    return _against_code(spark, sf_dir).select(
        "rec_id", "key", said("usage_sites", "usage_site"), said("android_sites", "android_site"), "referenced", said("dead_citations", "dead"), said("surface_mismatch", "mismatch"), F.col("longest").cast("bigint").alias("longest"),
        F.col("placeholder_unexplained").alias("unexplained"), "has_register",
    )


@query(FORMS + AGAINST + "SELECT count(*) AS keys, count(*) FILTER (referenced = 'none') AS orphans, count(dead) AS dead, count(mismatch) AS mismatch, count(longest) AS caps, count(*) FILTER (unexplained) AS unexplained, count(*) FILTER (has_register) AS with_register FROM r")
def context_summary(spark, sf_dir):
    return usage.context_summary(_against_code(spark, sf_dir))


# Bundles

ANDROID = """, ks AS (SELECT key_id, coalesce(name_android, key_name) AS key FROM k WHERE NOT archived AND (platforms_csv = '' OR contains(platforms_csv, 'android'))),
v AS (SELECT ks.key, l.lang, coalesce(nullif(ft.text, ''), en.text, '') AS v FROM ks CROSS JOIN (SELECT DISTINCT lang FROM t) l LEFT JOIN ft ON ft.key_id = ks.key_id AND ft.lang = l.lang LEFT JOIN (SELECT * FROM ft WHERE lang = 'en') en ON en.key_id = ks.key_id)
"""


def _entries(platform: str, name: str, has: str) -> str:
    return ANDROID.replace("SELECT key_id, coalesce(name_android, key_name) AS key", f"SELECT key_id, coalesce({name}, key_name) AS key, coalesce(file_ios, 'Localizable.strings') AS file").replace("'android'", f"'{has}'").replace("SELECT ks.key, l.lang", "SELECT ks.key, ks.file, l.lang")


CONVERT_IOS = CONVERT.replace("'%\\1s'", "'%\\1@'").replace("'%\\1d'", "'%\\1li'").format("v")
CONVERT_SERVER = CONVERT.replace("'%%'", "'%'").format("v")
#: The rendered files of a platform: common tables, and a query over them.
RENDERED = {
    "android": (FORMS + ANDROID, f"""SELECT 'android' AS platform, CASE lang WHEN 'en' THEN 'values/strings.xml' WHEN 'id' THEN 'values-in/strings.xml' ELSE concat('values-', lang, '/strings.xml') END AS rel_path, concat('<?xml version="1.0" encoding="utf-8"?>', chr(10), '<resources>', chr(10),
string_agg(concat('    <string name="', key, '">', replace(replace(replace(replace({CONVERT.format('v')}, '&', '&amp;'), '<', '&lt;'), '''', '\\'''), '"', '\\"'), '</string>'), chr(10) ORDER BY key), chr(10), '</resources>', chr(10)) AS text FROM v GROUP BY lang"""),
    "ios": (FORMS + _entries("ios", "name_ios", "ios"), f"""SELECT 'ios' AS platform, concat(lang, '.lproj/', file) AS rel_path, concat(string_agg(concat(CAST(to_json(key) AS VARCHAR), ' = ', CAST(to_json({CONVERT_IOS}) AS VARCHAR), ';'), chr(10) ORDER BY key), chr(10)) AS text FROM v GROUP BY lang, file"""),
    "server": (FORMS + _entries("server", "NULL", "other"), f"""SELECT 'server' AS platform, concat(lang, '.json') AS rel_path, concat(chr(123), chr(10), string_agg(concat('  ', CAST(to_json(key) AS VARCHAR), ': ', CAST(to_json({CONVERT_SERVER}) AS VARCHAR)), concat(',', chr(10)) ORDER BY key), chr(10), chr(125), chr(10)) AS text FROM v WHERE key IS NOT NULL GROUP BY lang"""),
}


@query("".join(RENDERED["android"]))
def render_android(spark, sf_dir):
    return bundles.render_bundle(forms_corpus(spark, sf_dir), "android")


@query("".join(RENDERED["ios"]))
def render_ios(spark, sf_dir):
    return bundles.render_bundle(forms_corpus(spark, sf_dir), "ios")


@query("".join(RENDERED["server"]))
def render_server(spark, sf_dir):
    return bundles.render_bundle(forms_corpus(spark, sf_dir), "server")


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("page_id")
    path = F.concat(_one_of(k, 4, F.lit("en"), F.lit("de"), F.lit("fr"), F.lit("xx")), F.lit(".lproj/F"), F.floor(k / 4).cast("string"), F.lit(".strings"))
    text = F.concat("html", F.when(k % 5 == 0, " [%s]").otherwise(""), F.when(k % 7 == 0, '\n"e" = "";').otherwise(""), F.when(k % 9 == 0, "\n // note").otherwise(""))
    return table(spark, sf_dir, "pages").where(k % 11 != 7).select(path.alias("rel_path"), text.alias("text"))


@query("""WITH s AS (SELECT concat(CASE page_id % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'de' WHEN 2 THEN 'fr' ELSE 'xx' END, '.lproj/F', CAST(floor(page_id / 4) AS BIGINT), '.strings') AS rel_path,
concat(html, CASE WHEN page_id % 5 = 0 THEN ' [%s]' ELSE '' END, CASE WHEN page_id % 7 = 0 THEN concat(chr(10), '"e" = "";') ELSE '' END, CASE WHEN page_id % 9 = 0 THEN concat(chr(10), ' // note') ELSE '' END) AS text FROM pages WHERE page_id % 11 <> 7)
SELECT rel_path, 'unconverted placeholder' AS problem FROM s WHERE contains(text, '[%') UNION ALL SELECT 'es.lproj', 'missing folder' UNION ALL SELECT DISTINCT 'xx.lproj', 'unexpected folder' FROM s WHERE starts_with(rel_path, 'xx')
UNION ALL SELECT string_split(rel_path, '/')[2], 'file count' FROM s GROUP BY 1 HAVING count(*) <> 4 UNION ALL SELECT rel_path, 'blank value' FROM s WHERE regexp_matches(text, '=\\s*""\\s*;') UNION ALL SELECT rel_path, 'comment' FROM s WHERE regexp_matches(text, '(?m)^\\s*(/\\*|//)')""")  # fmt: skip
def lint_bundle(spark, sf_dir):
    return bundles.lint_bundle(_staged(spark, sf_dir), ["en", "de", "fr", "es"], "ios")


@query("SELECT concat('F', CAST(floor(page_id / 4) AS BIGINT), '.strings') AS name, count(*) AS n FROM pages WHERE page_id % 11 <> 7 GROUP BY 1 HAVING count(*) <> 4")
def file_count_check(spark, sf_dir):
    return bundles.file_count_check(_staged(spark, sf_dir), 4)

"""Queries over the corpus with plural keys and names by platform: rules of style, edits, plans and the glossary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lingspan.operators import edits, glossary, lint, review, rules
from lingspan.plans import sync
from lingspan.plans.derived import derived_corpus, table
from lingspan.plans.forms import FORM_KEYS_SQL, FORM_VALUES_SQL, forms_corpus
from lingspan.plans.queries import G, ORACLES, WITH, _glossary, _service_keys, query
from lingspan.schema import Corpus, Glossary

FORMS = f"""WITH t AS ({FORM_VALUES_SQL}), k AS (SELECT *, coalesce(key_name, concat('android=', name_android, ', ios=', name_ios)) AS key FROM ({FORM_KEYS_SQL})),
lv AS (SELECT concat('id:', t.key_id) AS rec_id, k.key, t.*, k.context FROM t JOIN k USING (key_id) WHERE NOT k.archived),
ft AS (SELECT key_id, lang, value AS text, unverified FROM t WHERE form IN ('', 'other')),
nm AS (SELECT key_id, unnest(list_filter([key_name, name_ios, name_android], lambda x: x IS NOT NULL)) AS name FROM k),
ro AS (SELECT *, lower(trim(regexp_replace(string_split(regexp_extract(context, 'Type:([^\\n]*)', 1), '/')[1], '\\(.*\\)', ''))) AS role FROM lv)
"""


# Review and rules


@query(FORMS + """SELECT k.key_id, k.key, CASE WHEN p.text IS NULL THEN 'missing' WHEN p.text = '' THEN 'empty' ELSE 'unverified' END AS status, e.text AS source, p.text AS target, k.plural
FROM k LEFT JOIN (SELECT * FROM ft WHERE lang = 'pl') p USING (key_id) LEFT JOIN (SELECT * FROM ft WHERE lang = 'en') e USING (key_id) WHERE (platforms_csv = '' OR contains(platforms_csv, 'android')) AND (p.text IS NULL OR p.text = '' OR p.unverified)""")  # fmt: skip
def plural_backlog(spark, sf_dir):
    return review.backlog(forms_corpus(spark, sf_dir), "pl", "android").select("key_id", "key", "status", "source", "target", "plural")


@query(FORMS + """, r AS (SELECT *, regexp_replace(key, '[MF]$', '') AS stem, right(key, 1) AS g FROM lv WHERE form = '' AND value <> '' AND lang <> 'en' AND regexp_matches(key, '[MF]$')),
p AS (SELECT stem, lang, max(value) FILTER (g = 'M') AS m, max(value) FILTER (g = 'F') AS f, max(rec_id) FILTER (g = 'F') AS rec_id FROM r GROUP BY stem, lang)
SELECT rec_id, lang, CASE WHEN m = f THEN 'gender-identical' ELSE 'gender-different' END AS code, stem AS token FROM p WHERE m IS NOT NULL AND f IS NOT NULL AND (lang IN ('id', 'ja')) <> (m = f)""")  # fmt: skip
def gender_pairs(spark, sf_dir):
    return rules.gender_pairs(forms_corpus(spark, sf_dir))


@query(FORMS + """, f AS (SELECT rec_id, lang, list(DISTINCT form) AS forms, CASE lang WHEN 'pl' THEN ['one', 'few', 'many', 'other'] ELSE ['other'] END AS allowed FROM lv WHERE form <> '' AND lang IN ('pl', 'id') GROUP BY rec_id, lang)
SELECT rec_id, lang, 'plural-category' AS code, unnest(list_concat(list_transform(list_filter(forms, lambda x: NOT list_contains(allowed, x)), lambda x: concat('extra ', x)), list_transform(list_filter(allowed, lambda x: NOT list_contains(forms, x)), lambda x: concat('missing ', x)))) AS token FROM f""")  # fmt: skip
def plural_categories(spark, sf_dir):
    return rules.plural_categories(forms_corpus(spark, sf_dir))


def _endings_sql() -> str:
    made = ", ".join(f"CASE WHEN regexp_matches(word, '{p}') THEN regexp_replace(word, '{p}', '{us.replace('$', chr(92))}') END" for p, us in rules.US_ENDINGS)
    return f"list_distinct(list_filter([{made}], lambda x: x IS NOT NULL))"


@query(FORMS + f""", w AS (SELECT rec_id, lang, unnest(list_distinct(regexp_split_to_array(lower(value), '[^\\p{{L}}]+'))) AS word FROM lv WHERE lang = 'en'),
s(word, us) AS (VALUES ('fulfil', 'fulfill'), ('favourite', 'favorite'), ('colour', 'color'), ('centre', 'center'), ('behaviour', 'behavior'), ('organise', 'organize'), ('analyse', 'analyze')),
d AS (SELECT DISTINCT word FROM w), r AS (SELECT word, unnest({_endings_sql()}) AS us FROM d WHERE word NOT IN ('litre', 'litres', 'millilitre', 'millilitres')),
b AS (SELECT * FROM s UNION ALL SELECT word, us FROM r WHERE us <> word AND us IN (SELECT word FROM d) AND word NOT IN (SELECT word FROM s))
SELECT rec_id, lang, 'us-spelling' AS code, concat(word, ' -> ', us) AS token FROM w JOIN b USING (word)""")  # fmt: skip
def us_spelling(spark, sf_dir):
    return rules.us_spelling(forms_corpus(spark, sf_dir))


@query(FORMS + """SELECT rec_id, lang, 'length-budget' AS code, concat(length(value), ' > ', most) AS token FROM ro JOIN (VALUES ('button label', 15), ('settings row title', 25), ('section header', 20), ('notification body', 80)) b(role, most) USING (role) WHERE length(value) > most""")
def length_budget(spark, sf_dir):
    return rules.length_budget(forms_corpus(spark, sf_dir))


@query(FORMS + """SELECT rec_id, lang, 'final-period' AS code, role AS token FROM ro WHERE regexp_matches(role, '^(button label|badge|toggle|.*title|.*header|.*label|.*value|tip headline)') AND regexp_matches(value, '(^|[^.])[.]$')""")
def final_period(spark, sf_dir):
    return rules.final_period(forms_corpus(spark, sf_dir))


HALF = "[぀-ヿ㐀-鿿가-힯][!?:,]|[!?:,][぀-ヿ㐀-鿿가-힯]"


@query(FORMS + f"""SELECT rec_id, lang, 'cjk-halfwidth' AS code, regexp_replace(regexp_extract(value, '{HALF}'), '[぀-ヿ㐀-鿿가-힯]', '') AS token FROM lv WHERE lang = 'ja' AND regexp_matches(value, '{HALF}')""")
def cjk_halfwidth(spark, sf_dir):
    return rules.cjk_halfwidth(forms_corpus(spark, sf_dir))


@query(FORMS + """, w AS (SELECT rec_id, lang, unnest(list_distinct(regexp_split_to_array(lower(value), '[^\\p{L}]+'))) AS token FROM lv WHERE lang = 'ru' AND NOT contains(context, 'Register: formal'))
SELECT rec_id, lang, 'formal-register' AS code, token FROM w WHERE token IN ('вы', 'вас', 'вам', 'вами', 'ваш', 'ваша', 'ваше', 'ваши', 'вашего', 'вашей', 'вашу', 'ваших')""")  # fmt: skip
def formal_register_leak(spark, sf_dir):
    return rules.formal_register_leak(forms_corpus(spark, sf_dir))


@query(FORMS + """, c AS (SELECT concat('id:', key_id) AS rec_id, context, CASE key_id % 5 WHEN 2 THEN true ELSE false END AS odd FROM k WHERE NOT archived)
SELECT rec_id, '(context)' AS lang, 'context-coverage' AS code, unnest(CASE WHEN context = '' THEN ['no context'] ELSE list_filter([CASE WHEN NOT contains(context, 'Type:') THEN 'missing Type' END, CASE WHEN NOT contains(context, 'Context:') THEN 'missing Context' END, CASE WHEN contains(context, 'Type: Gadget') THEN 'unknown role: gadget' END], lambda x: x IS NOT NULL) END) AS token FROM c""")  # fmt: skip
def typed_context_coverage(spark, sf_dir):
    return rules.context_coverage(forms_corpus(spark, sf_dir))


@query(FORMS + """SELECT rec_id, key, lang, 'error' AS severity, 'cyrillic-in-source' AS code, regexp_extract(value, '[Ѐ-ԯ]+') AS token, CASE WHEN length(value) > 70 THEN concat(left(value, 70), '…') ELSE value END AS snippet FROM lv WHERE lang = 'en' AND regexp_matches(value, '[Ѐ-ԯ]')""")
def lint_source_script(spark, sf_dir):
    return lint.lint_source_script(forms_corpus(spark, sf_dir))


FOUND = "rec_id, key, lang, severity, code, token, snippet"
TOUCHED = "\nUNION ALL ".join(f"SELECT {FOUND} FROM ({ORACLES[q]}) WHERE lang = 'de'" for q in ("lint_values", "lint_urls", "lint_placeholders", "lint_placeholder_count", "lint_placeholder_indexing")) + f"\nUNION ALL SELECT {FOUND} FROM ({ORACLES['lint_context']})"


@query(TOUCHED)
def push_gate(spark, sf_dir):
    """The findings that decide a push of German."""
    return lint.gate(derived_corpus(spark, sf_dir), ["de"])[0]


@query(f"SELECT concat(rpad(severity, 5, ' '), ' ', code, ' ', key, ' [', lang, '] ', token, ': ', snippet) AS line FROM ({TOUCHED})")
def findings_report(spark, sf_dir):
    return lint.report(lint.gate(derived_corpus(spark, sf_dir), ["de"])[0])


@query(FORMS + """, r AS (SELECT key_id, row_number() OVER (ORDER BY key_id) AS entry, key, platforms_csv, context FROM k)
SELECT entry, concat_ws(chr(10), concat('[', entry, '] ', r.key), concat('platforms: ', replace(platforms_csv, ',', ', ')), CASE WHEN context <> '' THEN concat('context: ', context) END, concat('en: ', coalesce(e.text, '<MISSING IN en>')), concat('pl: ', p.text)) AS text
FROM r JOIN (SELECT * FROM ft WHERE lang = 'pl') p USING (key_id) LEFT JOIN (SELECT * FROM ft WHERE lang = 'en') e USING (key_id) WHERE entry BETWEEN 3 AND 30""")  # fmt: skip
def review_text(spark, sf_dir):
    return review.render_review(review.audit_batch(forms_corpus(spark, sf_dir), "pl", 3, 30), ["en", "pl"])


@query(FORMS + """, w AS (SELECT DISTINCT concat(left(lang, 1), '-', upper(right(lang, 1))) AS lang FROM documents WHERE lang IS NOT NULL UNION SELECT 'pl' UNION SELECT 'pt-BR') SELECT lang, CAST(NULL AS VARCHAR) AS hint FROM w WHERE lang NOT IN (SELECT lang FROM t)""")
def unknown_langs(spark, sf_dir):
    codes = table(spark, sf_dir, "documents").where("lang IS NOT NULL").select(F.concat(F.substring("lang", 1, 1), F.lit("-"), F.upper(F.expr("right(lang, 1)"))).alias("lang")).distinct()
    extra = codes.unionAll(spark.createDataFrame([("pl",), ("pt-BR",)], "lang string"))
    return review.unknown_langs(forms_corpus(spark, sf_dir), extra)


# Edits


def _backlog_edits(c: Corpus) -> DataFrame:
    """Polish edits of every third key: right and wrong forms, blank, marked and spaced values, some unknown names."""
    k = F.col("key_id")
    name = F.coalesce("key_name", F.col("key_by_platform")["android"])
    value = F.when(k % 5 == 0, "").when(k % 5 == 1, "ok").when(k % 5 == 2, "a b").when(k % 5 == 3, "<MISSING IN pl>").otherwise("x [%1$s]")
    form = F.when(F.col("plural"), F.when(k % 4 == 1, "one").when(k % 4 == 3, "odd").otherwise("other")).otherwise(F.when(k % 10 == 1, "other").otherwise(""))
    return c.keys.where("key_id % 3 = 1").select(F.when(k % 15 == 1, F.concat(name, F.lit("_gone"))).otherwise(name).alias("key"), F.lit("pl").alias("lang"), form.alias("form"), value.alias("value"), F.lit(0).alias("pos"))


BACKLOG_EDITS = """, e AS (SELECT concat(coalesce(key_name, name_android), CASE WHEN key_id % 15 = 1 THEN '_gone' ELSE '' END) AS key, CASE WHEN plural THEN CASE key_id % 4 WHEN 1 THEN 'one' WHEN 3 THEN 'odd' ELSE 'other' END WHEN key_id % 10 = 1 THEN 'other' ELSE '' END AS form,
CASE key_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'ok' WHEN 2 THEN concat('a', chr(160), 'b') WHEN 3 THEN '<MISSING IN pl>' ELSE 'x [%1$s]' END AS value FROM k WHERE key_id % 3 = 1)
"""
SIGNATURE = "list_sort(list_concat(list_transform(regexp_extract_all({0}, '\\[%[^\\]]*\\]'), lambda x: regexp_replace(x, '^\\[%\\d+\\$', '[%')), list_transform(regexp_extract_all(regexp_replace({0}, '\\[%[^\\]]*\\]', '', 'g'), '(?:^|[^%])(%(?:\\d+\\$)?[-+#0 ]*(?:\\d+|\\*)?(?:\\.(?:\\d+|\\*))?(?:hh|h|ll|l|L|z|t|j)?[@diuoxXfFeEgGcCsSpa])', 1), lambda x: regexp_replace(x, '^%\\d+\\$', '%'))))"


@query(FORMS + BACKLOG_EDITS + f""", j AS (SELECT e.*, nm.key_id IS NOT NULL AS found, k.plural, p.text AS target, p.unverified, coalesce(s.text, '') AS source FROM e LEFT JOIN nm ON e.key = nm.name LEFT JOIN k USING (key_id) LEFT JOIN (SELECT * FROM ft WHERE lang = 'pl') p USING (key_id) LEFT JOIN (SELECT * FROM ft WHERE lang = 'en') s USING (key_id))
SELECT key, form, unnest(list_filter([CASE WHEN NOT found THEN 'not found' END, CASE WHEN found AND target <> '' AND NOT unverified THEN 'not in backlog' END, CASE WHEN found AND plural <> (form <> '') THEN 'plural shape' END, CASE WHEN form = 'odd' THEN 'unknown form' END, CASE WHEN form NOT IN ('', 'other') THEN 'no ''other'' form' END,
CASE WHEN value = '' THEN 'empty value' END, CASE WHEN starts_with(value, '<MISSING IN ') THEN 'missing sentinel' END, CASE WHEN contains(value, chr(160)) THEN 'forbidden space' END, CASE WHEN found AND {SIGNATURE.format('value')} <> {SIGNATURE.format('source')} THEN 'placeholders differ' END], lambda x: x IS NOT NULL)) AS problem FROM j""")  # fmt: skip
def lint_edits(spark, sf_dir):
    c = forms_corpus(spark, sf_dir)
    return edits.lint_edits(c, _backlog_edits(c), "pl")


@query(FORMS + BACKLOG_EDITS + """SELECT 'pl' AS lang, CASE WHEN nm.key_id IS NULL THEN 'unmatched' WHEN k.plural <> (form <> '') THEN 'type_mismatched' WHEN form = 'odd' THEN 'unknown_form' ELSE 'apply' END AS status, count(*) AS n FROM e LEFT JOIN nm ON e.key = nm.name LEFT JOIN k USING (key_id) GROUP BY ALL""")
def edit_counts(spark, sf_dir):
    c = forms_corpus(spark, sf_dir)
    return edits.apply_counts(edits.apply_edits(c, _backlog_edits(c))[1])


@query(FORMS + BACKLOG_EDITS + """, ap AS (SELECT nm.key_id, form, value FROM e JOIN nm ON e.key = nm.name JOIN k USING (key_id) WHERE k.plural = (form <> '') AND form <> 'odd'), old AS (SELECT key_id, form, value, dirty FROM t WHERE lang = 'pl' AND key_id IN (SELECT key_id FROM ap))
SELECT concat('id:', key_id) AS rec_id, lang, form, value, unverified, dirty FROM t WHERE NOT (lang = 'pl' AND key_id IN (SELECT key_id FROM ap))
UNION ALL SELECT concat('id:', key_id), 'pl', ap.form, ap.value, true, coalesce((SELECT bool_or(dirty) OR count(*) <> 1 OR max(old.form) <> ap.form OR max(old.value) <> ap.value FROM old WHERE old.key_id = ap.key_id), true) FROM ap""")  # fmt: skip
def apply_plural_edits(spark, sf_dir):
    c = forms_corpus(spark, sf_dir)
    new, _ = edits.apply_edits(c, _backlog_edits(c))
    return new.translations.select("rec_id", "lang", "form", "value", F.col("is_unverified").alias("unverified"), F.col("is_dirty").alias("dirty"))


def _meta_edited(c: Corpus) -> Corpus:
    k, name = F.col("key_id"), F.coalesce("key_name", F.col("key_by_platform")["ios"]).alias("key")
    c1 = edits.set_context(c, c.keys.where("key_id % 9 = 4").select(name, F.when(k % 2 == 0, " ").otherwise("  said ").alias("new_context")))
    return edits.set_filename(c1, c.keys.where("key_id % 8 = 2").select(name, F.lit("ios").alias("platform"), F.when(k % 16 == 2, "").otherwise("New.strings").alias("filename")))


META = """, m AS (SELECT key_id, CASE WHEN key_id % 9 = 4 THEN CASE WHEN key_id % 2 = 0 THEN NULL ELSE 'said' END ELSE context END AS now, CASE WHEN key_id % 8 = 2 THEN CASE WHEN key_id % 16 = 2 THEN NULL ELSE 'New.strings' END ELSE file_ios END AS file, context, file_ios FROM k),
md AS (SELECT key_id, now, file, list_filter([CASE WHEN now IS DISTINCT FROM context THEN 'context' END, CASE WHEN file IS DISTINCT FROM file_ios THEN 'filenames' END], lambda x: x IS NOT NULL) AS fields FROM m)
"""


@query(FORMS + META + "SELECT key_id, now AS context, file, array_to_string(fields, ',') AS dirty_meta FROM md")
def edit_meta(spark, sf_dir):
    return _meta_edited(forms_corpus(spark, sf_dir)).keys.select("key_id", "context", F.col("filenames")["ios"].alias("file"), F.array_join("dirty_meta", ",").alias("dirty_meta"))


def _packs(spark: SparkSession, sf_dir: str, c: Corpus) -> DataFrame:
    new = table(spark, sf_dir, "part").select(F.replace("p_name", F.lit(" "), F.lit("_")).alias("key"), F.when(F.col("p_size") % 2 == 0, "en").otherwise("ms").alias("lang"), F.col("p_type").alias("value"))
    return new.unionAll(c.keys.where("key_id % 20 = 1 AND key_name IS NOT NULL").select("key_name", F.lit("pl"), F.lit("there")))


PACKS = """, fresh AS (SELECT replace(p_name, ' ', '_') AS key, CASE WHEN p_size % 2 = 0 THEN 'en' ELSE 'ms' END AS lang, min(p_type) AS value FROM part GROUP BY 1, 2), slots AS (SELECT key, lang FROM (SELECT DISTINCT key FROM fresh) CROSS JOIN (SELECT lang FROM t UNION SELECT lang FROM fresh UNION SELECT 'pl'))
"""


@query(FORMS + PACKS + "SELECT key AS key_name, lang, coalesce(value, '') AS value, lang <> 'en' AND coalesce(value, '') <> '' AS unverified FROM slots LEFT JOIN fresh USING (key, lang)")
def import_packs(spark, sf_dir):
    c = forms_corpus(spark, sf_dir)
    new, _ = edits.import_packs(c, _packs(spark, sf_dir, c), ["other"])
    return new.keys.where("key_id IS NULL").join(new.translations, "rec_id").select("key_name", "lang", "value", F.col("is_unverified").alias("unverified"))


@query(FORMS + "SELECT key_name AS key FROM k WHERE key_id % 20 = 1 AND key_name IS NOT NULL")
def packs_already_there(spark, sf_dir):
    c = forms_corpus(spark, sf_dir)
    return edits.import_packs(c, _packs(spark, sf_dir, c), ["other"])[1]


# Plans


@query(FORMS + "SELECT key_id, lang, max(value) FILTER (form IN ('', 'other')) AS text, CASE WHEN max(form) = '' THEN 0 ELSE count(*) END AS forms, lang <> 'en' AS is_unverified FROM t WHERE dirty GROUP BY key_id, lang")
def push_plural(spark, sf_dir):
    sent = F.col("t.translation")
    c = forms_corpus(spark, sf_dir)
    rows = sync.push_plan(c)[0].select("key_id", F.explode("translations").alias("t")).join(c.keys.select("key_id", "plural"), "key_id")
    return rows.select("key_id", F.col("t.language_iso").alias("lang"), F.when(F.col("plural"), F.get_json_object(sent, "$.other")).otherwise(sent).alias("text"), F.when(F.col("plural"), F.size(F.json_object_keys(sent))).otherwise(0).cast("bigint").alias("forms"), F.col("t.is_unverified").alias("is_unverified"))


@query(FORMS + META + """SELECT key_id, field FROM (SELECT key_id, now, file, unnest(fields) AS field FROM md) WHERE key_id % 10 = 3 OR (field = 'context' AND coalesce(now, '') <> coalesce(CASE WHEN key_id % 4 = 1 THEN now || '!' ELSE now END, '')) OR (field = 'filenames' AND coalesce(file, '') <> CASE WHEN key_id % 3 = 2 THEN '' ELSE coalesce(file, '') END)""")
def verify_meta(spark, sf_dir):
    c, k = _meta_edited(forms_corpus(spark, sf_dir)), F.col("key_id")
    stored = c.keys.where("key_id % 10 <> 3").select(
        "key_id", F.col("platforms").alias("stored_platforms"), F.when(k % 4 == 1, F.concat("context", F.lit("!"))).otherwise(F.col("context")).alias("stored_description"), F.when(k % 3 != 2, F.col("filenames")).alias("stored_filenames")
    )
    return sync.verify_meta(sync.push_plan(c)[2], stored).select("key_id", "field")


@query(FORMS + "SELECT concat('id:', key_id) AS rec_id, CASE WHEN key_id % 5 <> 2 THEN key_id WHEN key_id % 10 = 2 THEN key_id + 1000000 END AS key_id FROM k")
def stamp_created(spark, sf_dir):
    c = forms_corpus(spark, sf_dir)
    lost = Corpus(c.keys.withColumn("key_id", F.when(F.col("key_id") % 5 != 2, F.col("key_id"))), c.translations)
    made = c.keys.where("key_id % 10 = 2").select(F.coalesce("key_name", F.col("key_by_platform")["android"]).alias("name"), (F.col("key_id") + 1000000).alias("new_id"))
    return sync.stamp_created(lost, made).keys.select("rec_id", "key_id")


@query("SELECT DISTINCT p_partkey AS key_id FROM part WHERE p_name IN (SELECT p_name FROM part GROUP BY p_name HAVING count(DISTINCT p_partkey) = 1) OR p_partkey IN (SELECT l_partkey FROM lineitem)")
def delete_plan(spark, sf_dir):
    refs = table(spark, sf_dir, "part").select(F.col("p_name").alias("ref"), F.lit("name").alias("kind")).unionAll(table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string"), F.lit("id"))).distinct()
    return sync.delete_plan(_service_keys(spark, sf_dir), refs)


def _filed(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.when(F.col("p_partkey") % 3 == 0, "en.lproj/").otherwise(""), F.replace("p_name", F.lit(" "), F.lit("")), F.lit(".strings"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key_id"), F.create_map(F.lit("ios"), name, F.lit("web"), F.lit("w.json")).alias("filenames"))


@query("SELECT p_partkey AS key_id, concat(replace(p_name, ' ', ''), '.strings') AS ios, 'w.json' AS web FROM part WHERE p_partkey % 3 = 0")
def filename_plan(spark, sf_dir):
    return sync.filename_plan(_filed(spark, sf_dir), "ios").select("key_id", F.col("new_filenames")["ios"].alias("ios"), F.col("new_filenames")["web"].alias("web"))


@query("SELECT p_partkey AS key_id FROM part WHERE p_partkey % 3 = 0 AND p_partkey % 4 <> 1")
def verify_filenames(spark, sf_dir):
    keys = _filed(spark, sf_dir)
    plan = sync.filename_plan(keys, "ios")
    done = plan.where("key_id % 4 = 1").select("key_id", F.col("new_filenames").alias("filenames"))
    return sync.verify_filenames(plan, done.unionAll(keys.where("key_id % 4 <> 1")))


@query(FORMS + """, w AS (SELECT p_partkey AS id, CASE p_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN p_name WHEN 2 THEN concat('pair', p_partkey, 'M') ELSE replace(p_name, ' ', '_') END AS key_name, p_size % 7 = 0 AS bare FROM part)
SELECT id, key_name, CASE WHEN key_name = '' THEN 'no name' WHEN contains(key_name, ' ') THEN 'invalid name' WHEN key_name IN (SELECT name FROM nm) THEN 'exists' WHEN count(*) OVER (PARTITION BY key_name) > 1 THEN 'duplicate' WHEN bare THEN 'no platforms' END AS problem FROM w""")  # fmt: skip
def create_plan(spark, sf_dir):
    k = F.col("p_partkey")
    name = F.when(k % 5 == 0, "").when(k % 5 == 1, F.col("p_name")).when(k % 5 == 2, F.concat(F.lit("pair"), k.cast("string"), F.lit("M"))).otherwise(F.replace("p_name", F.lit(" "), F.lit("_")))
    payloads = table(spark, sf_dir, "part").select(k.alias("id"), name.alias("key_name"), F.when(F.col("p_size") % 7 != 0, F.array(F.lit("web"))).otherwise(F.array().cast("array<string>")).alias("platforms"))
    return sync.create_plan(payloads, forms_corpus(spark, sf_dir)).select("id", "key_name", "problem")


@query("SELECT o_orderkey AS row_id, o_custkey AS key_id, CASE WHEN o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 4 <> 1) THEN 'unknown key' WHEN count(*) OVER (PARTITION BY o_custkey) > 1 THEN 'duplicate' END AS problem FROM orders")
def update_plan(spark, sf_dir):
    payloads = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_custkey").alias("key_id"))
    return sync.update_plan(payloads, table(spark, sf_dir, "customer").where("c_custkey % 4 <> 1").select(F.col("c_custkey").alias("key_id"))).select("row_id", "key_id", "problem")


@query("SELECT concat_ws(chr(9), p_partkey, p_name, CASE WHEN p_size % 2 = 0 THEN 'ios,android' ELSE 'web' END, concat(lower(p_type), ',', p_brand)) AS line FROM part")
def key_table(spark, sf_dir):
    return sync.key_table(_service_keys(spark, sf_dir))


@query(FORMS + "SELECT DISTINCT concat(name, 'x') AS name FROM nm WHERE key_id % 3 = 0")
def missing_names(spark, sf_dir):
    c = forms_corpus(spark, sf_dir)
    names = lint.key_names(c)
    third = F.expr("CAST(substr(rec_id, 4) AS BIGINT) % 3 = 0")
    return sync.missing_names(c, names.select(F.when(third, F.concat("name", F.lit("x"))).otherwise(F.col("name")).alias("name")))


@query("SELECT p_partkey AS key_id, CASE WHEN p_name IN (SELECT p_name FROM part WHERE p_size > 40) THEN 'android_only' ELSE 'unused-localization' END AS new_tags FROM part")
def tag_plan_guarded(spark, sf_dir):
    used = table(spark, sf_dir, "part").where("p_size > 40").select(F.col("p_name").alias("key_name"))
    return sync.tag_plan(_service_keys(spark, sf_dir), "set", ["unused-localization"], used).select("key_id", F.array_join("new_tags", ",").alias("new_tags"))


# Glossary

Y = G + ", y AS (SELECT term, min(k) AS k FROM g GROUP BY term)\n"


def _terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each term once, with the least number of its parts."""
    return table(spark, sf_dir, "part").groupBy(F.concat("p_name", F.lit(" "), "p_brand").alias("term")).agg(F.min("p_partkey").alias("k"))


def _term_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    lang = F.when(k % 4 == 0, "de").when(k % 4 == 1, "fr").when(k % 4 == 2, "en").otherwise("xx")
    return _terms(spark, sf_dir).select(F.when(k % 11 == 0, F.concat("term", F.lit("?"))).otherwise(F.col("term")).alias("term"), lang.alias("lang"), F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("neu "), k.cast("string"))).alias("text"))


TERM_EDITS = """, e AS (SELECT concat(term, CASE WHEN k % 11 = 0 THEN '?' ELSE '' END) AS term, CASE k % 4 WHEN 0 THEN 'de' WHEN 1 THEN 'fr' WHEN 2 THEN 'en' ELSE 'xx' END AS lang, CASE WHEN k % 3 = 0 THEN '' ELSE concat('neu ', k) END AS text, k FROM y)
"""


@query(Y + TERM_EDITS + "SELECT term, lang, text, CASE lang WHEN 'en' THEN 'source_language' WHEN 'xx' THEN 'unknown_language' ELSE CASE WHEN k % 11 = 0 THEN 'unmatched' ELSE 'applied' END END AS status FROM e")
def glossary_edit_report(spark, sf_dir):
    return glossary.apply_edits(_glossary(spark, sf_dir), _term_edits(spark, sf_dir), ["de", "fr"])[1]


@query(Y + TERM_EDITS + """, n AS (SELECT x.term, 'de' AS lang, concat('Teil ', x.k) AS text, CASE WHEN x.k % 8 = 0 THEN 'siehe; oben' END AS note FROM x), a AS (SELECT * FROM e WHERE lang IN ('de', 'fr') AND k % 11 <> 0),
r AS (SELECT coalesce(n.term, a.term) AS term, coalesce(n.lang, a.lang) AS lang, CASE WHEN a.term IS NOT NULL THEN nullif(a.text, '') ELSE n.text END AS text, note FROM n FULL JOIN a ON n.term = a.term AND n.lang = a.lang) SELECT * FROM r WHERE text IS NOT NULL OR note IS NOT NULL""")  # fmt: skip
def glossary_edited(spark, sf_dir):
    return glossary.apply_edits(_glossary(spark, sf_dir), _term_edits(spark, sf_dir), ["de", "fr"])[0].texts


@query(Y + """SELECT term, array_to_string(CASE WHEN k % 7 = 0 THEN ['missing'] ELSE list_filter([CASE WHEN k % 5 = 0 THEN 'description' END, CASE WHEN k % 6 = 0 AND k % 12 <> 0 THEN 'case_sensitive' END, CASE WHEN k % 9 = 0 THEN 'tags' END, CASE WHEN k % 2 = 0 AND (k % 8 = 0 OR k % 10 = 0) THEN 'translation de' END], lambda p: p IS NOT NULL) END, ',') AS problems FROM y
WHERE k % 7 = 0 OR k % 5 = 0 OR (k % 6 = 0 AND k % 12 <> 0) OR k % 9 = 0 OR k % 8 = 0""")  # fmt: skip
def verify_glossary(spark, sf_dir):
    rows, k = _terms(spark, sf_dir), F.col("k")
    fixed = [F.lit(True).alias("translatable"), F.lit(False).alias("forbidden")]
    local = Glossary(rows.select("term", k.alias("term_id"), F.lit("d").alias("description"), (k % 6 == 0).alias("case_sensitive"), *fixed, F.array(F.lit("ui")).alias("tags")), rows.where("k % 2 = 0").select("term", F.lit("de").alias("lang"), F.lit("Teil").alias("text"), F.lit(None).cast("string").alias("note")))
    there = rows.where("k % 7 <> 0")
    remote = Glossary(
        there.select("term", k.alias("term_id"), F.when(k % 5 == 0, "d!").otherwise("d").alias("description"), (k % 12 == 0).alias("case_sensitive"), *fixed, F.when(k % 9 == 0, F.array(F.lit("unit"), F.lit("ui"))).otherwise(F.array(F.lit("ui"))).alias("tags")),
        there.where("k % 2 = 0 AND k % 10 <> 0").select("term", F.lit("de").alias("lang"), F.when(k % 8 == 0, "anders").otherwise("Teil").alias("text"), F.lit(None).cast("string").alias("note")),
    )
    return glossary.verify_glossary(local, remote).select("term", F.array_join("problems", ",").alias("problems"))


@query(Y + "SELECT g.term, CASE WHEN g.k % 3 = 0 THEN g.k END AS term_id, CASE WHEN g.k % 6 = 0 THEN 'true' ELSE 'false' END AS case_sensitive, CASE WHEN x.k IS NOT NULL THEN '640' END AS lang_id, CASE WHEN x.k IS NOT NULL THEN concat('Teil ', x.k) END AS said FROM g LEFT JOIN x USING (term)")
def glossary_payloads(spark, sf_dir):
    made = glossary.payloads(_glossary(spark, sf_dir), spark.createDataFrame([("de", 640)], "lang string, lang_id bigint"))
    at = lambda path, name: F.get_json_object("payload", path).alias(name)
    return made.select("term", "term_id", at("$.caseSensitive", "case_sensitive"), at("$.translations[0].langId", "lang_id"), at("$.translations[0].translation", "said"))


def _raw_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, no = F.col("p_partkey"), F.lit(None).cast("string")
    said = F.array(F.struct(F.when(k % 6 == 0, 641).otherwise(640).alias("langId"), F.when(k % 4 == 0, "").otherwise(F.concat(F.lit("Teil "), k.cast("string"))).alias("translation"), F.lit("").alias("description")))
    return table(spark, sf_dir, "part").select(
        k.cast("string").alias("id"), F.concat("p_name", F.lit(" "), "p_brand", F.when(k % 2 == 0, k.cast("string")).otherwise("")).alias("term"), F.when(k % 3 == 0, " ").otherwise(F.col("p_type")).alias("description"),
        F.when(k % 5 == 0, " Yes").otherwise("0").alias("caseSensitive"), F.when(k % 7 == 0, "no").when(k % 7 == 1, "odd").otherwise(no).alias("translatable"), F.when(k % 14 == 0, "1").otherwise(no).alias("forbidden"),
        F.when(k % 8 != 0, F.array(F.lit("ui"), F.lit(""))).alias("tags"), said.alias("translations"),
    )


RAW = "WITH r AS (SELECT p_partkey AS k, concat(p_name, ' ', p_brand, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_partkey AS VARCHAR) ELSE '' END) AS term, p_type FROM part)\n"
LANG_IDS = [("de", 640), ("fr", 641)]


@query(RAW + "SELECT term, k AS term_id, CASE WHEN k % 3 <> 0 THEN p_type END AS description, k % 5 = 0 AS case_sensitive, k % 7 <> 0 AS translatable, k % 14 = 0 AS forbidden, CASE WHEN k % 8 <> 0 THEN 'ui' ELSE '' END AS tags FROM r")
def glossary_from_service(spark, sf_dir):
    return glossary.from_service(_raw_terms(spark, sf_dir), spark.createDataFrame(LANG_IDS, "lang string, lang_id bigint")).terms.withColumn("tags", F.array_join("tags", ","))


@query(RAW + "SELECT 'error' AS severity, term, 'frozen and forbidden' AS problem FROM r WHERE k % 14 = 0 UNION ALL SELECT 'error', term, concat('duplicate term x', count(*)) FROM r GROUP BY term HAVING count(*) > 1 UNION ALL SELECT 'error', term, 'unknown language: fr' FROM r WHERE k % 6 = 0 AND k % 4 <> 0")
def glossary_regenerate(spark, sf_dir):
    return glossary.regenerate(_raw_terms(spark, sf_dir), spark.createDataFrame(LANG_IDS, "lang string, lang_id bigint"), ["de"])[1]


@query(Y + """SELECT CASE WHEN g.k % 10 = 0 THEN '1 freeze' WHEN g.k % 15 = 0 THEN '3 forbidden' WHEN g.k % 9 = 0 THEN '4 legal' ELSE '4 ui' END AS section, g.term,
concat_ws(' - ', concat(g.term, ' -> ', CASE WHEN g.k % 10 = 0 THEN g.term WHEN x.k IS NULL THEN '<none>' ELSE concat('Teil ', x.k) END), CASE WHEN g.k % 6 = 0 THEN 'case-sensitive' END, coalesce(CASE WHEN x.k % 8 = 0 THEN 'siehe; oben' END, CASE WHEN g.k % 4 <> 0 THEN lower(p_type) END)) AS line FROM g LEFT JOIN x USING (term)""")  # fmt: skip
def glossary_checklist(spark, sf_dir):
    return glossary.checklist(_glossary(spark, sf_dir), "de")


@query(Y + """, v AS (SELECT concat('r', k) AS rec_id, term, k, CASE k % 3 WHEN 0 THEN concat('kauf Teil ', k) WHEN 1 THEN lower(term) ELSE 'kauf' END AS value FROM g),
h AS (SELECT rec_id, g.term, CASE WHEN g.k % 10 = 0 AND NOT contains(lower(value), lower(g.term)) THEN 'freeze' WHEN g.k % 15 = 0 AND x.k IS NOT NULL AND contains(lower(value), concat('teil ', x.k)) THEN 'forbidden' WHEN g.k % 10 <> 0 AND g.k % 15 <> 0 AND x.k IS NOT NULL AND NOT contains(lower(value), concat('teil ', x.k)) THEN 'divergence' END AS kind FROM v JOIN g USING (term) LEFT JOIN x USING (term))
SELECT rec_id, 'de' AS lang, term, kind FROM h WHERE kind IS NOT NULL""")  # fmt: skip
def glossary_hits(spark, sf_dir):
    k, term = F.col("p_partkey"), F.concat("p_name", F.lit(" "), "p_brand")
    value = F.when(k % 3 == 0, F.concat(F.lit("kauf Teil "), k.cast("string"))).when(k % 3 == 1, F.lower(term)).otherwise("kauf")
    rows = table(spark, sf_dir, "part").select(F.concat(F.lit("r"), k.cast("string")).alias("rec_id"), F.lit("de").alias("lang"), F.concat(F.lit("Buy a "), term, F.lit(" now")).alias("source"), value.alias("value"))
    return glossary.hits(_glossary(spark, sf_dir), rows)


@query(WITH + "SELECT DISTINCT concat('id:', key_id) AS rec_id, lang, 'unchanged' AS problem FROM tr WHERE lang = 'de' AND key_id % 2 = 0 UNION ALL SELECT DISTINCT concat('id:', key_id), lang, 'collateral' FROM tr WHERE lang = 'fr' AND key_id % 4 = 1")
def check_changed_set(spark, sf_dir):
    old = derived_corpus(spark, sf_dir)
    k = F.expr("CAST(substr(rec_id, 4) AS BIGINT)")
    new = Corpus(old.keys, old.translations.withColumn("value", F.when((F.col("lang") == "fr") & (k % 4 == 1), F.concat("value", F.lit("+"))).otherwise(F.col("value"))))
    return edits.check_changed_set(edits.corpus_diff(old, new), old.translations.where((F.col("lang") == "de") & (k % 2 == 0)))

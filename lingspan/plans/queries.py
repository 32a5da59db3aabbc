"""The registered queries over the corpus operators, each beside its SQL for DuckDB.

The corpus is derived from `documents`; quality flags from `events`, glossary terms from `part`, source code from
`pages`. Results are flat: arrays are joined to text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lingspan.functions import text as X
from lingspan.operators import edits, glossary, lint, reuse, review, rules, usage
from lingspan.plans import bundles, sync
from lingspan.plans.derived import KEYS_SQL, TRANSLATIONS_SQL, derived_corpus, table
from lingspan.schema import Glossary
from lingspan.sources import corpus as corpora

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WITH = f"""WITH tr AS ({TRANSLATIONS_SQL}), k AS ({KEYS_SQL}),
lv AS (SELECT concat('id:', tr.key_id) AS rec_id, k.key_name AS key, tr.*, k.platforms_csv, k.context FROM tr JOIN k ON tr.key_id = k.key_id WHERE NOT k.archived),
fl AS (SELECT *, regexp_replace(value, '^[\\t-\\r\\x{{1C}}- \\x{{85}}\\x{{A0}}]+|[\\t-\\r\\x{{1C}}- \\x{{85}}\\x{{A0}}]+$', '', 'g') AS bare FROM lv)
"""
SNIP = "CASE WHEN length(value) > 70 THEN concat(left(value, 70), '…') ELSE value END"
FOUND = "rec_id, key, lang, severity, code, token, snippet"


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


# Lints

VALUES_SQL = f"""SELECT rec_id, key, lang, 'error' AS severity, 'em-dash' AS code, '—' AS token, {SNIP} AS snippet FROM fl WHERE contains(value, '—')
UNION ALL SELECT rec_id, key, lang, 'error', 'invisible-space', 'NBSP', {SNIP} FROM fl WHERE contains(value, chr(160))
UNION ALL SELECT rec_id, key, lang, 'warn', 'paren-balance', concat('(', o, '/', c, ')'), {SNIP} FROM (SELECT *, length(p) - length(replace(p, '(', '')) AS o, length(p) - length(replace(p, ')', '')) AS c FROM (SELECT *, regexp_replace(value, '[:;=][''\\-^]?[()]', '', 'g') AS p FROM fl)) WHERE o <> c
UNION ALL SELECT rec_id, key, lang, 'warn', 'edge-whitespace', CASE WHEN left(value, 1) = left(bare, 1) THEN 'trailing' ELSE 'leading' END, {SNIP} FROM fl WHERE bare <> '' AND bare <> value
UNION ALL SELECT rec_id, key, lang, 'warn', 'double-space', concat(list_max(list_transform(regexp_extract_all(value, ' {{2,}}'), lambda x: length(x))), ' spaces'), {SNIP} FROM fl WHERE contains(value, '  ')"""


@query(WITH + VALUES_SQL)
def lint_values(spark, sf_dir):
    return lint.lint_values(derived_corpus(spark, sf_dir))


URLS_SQL = """, u AS (SELECT *, list_sort(list_transform(regexp_extract_all(value, 'https?://[^\\s\\x{A0}"<>]+'), lambda x: regexp_replace(x, '[.,;:!?)\\]}\\'"]+$', ''))) AS urls FROM fl WHERE bare <> ''),
linked AS (SELECT DISTINCT rec_id FROM u WHERE len(urls) > 0),
n AS (SELECT u.rec_id, urls, count(*) AS c, min(lang) AS f FROM u JOIN linked USING (rec_id) GROUP BY ALL),
ref AS (SELECT rec_id, arg_min(urls, (-c, f)) AS common FROM n GROUP BY rec_id), src AS (SELECT rec_id, urls AS source FROM u WHERE lang = 'en')
""".replace("\\'", "''")
SAID = "CASE WHEN len({0}) = 0 THEN 'none' ELSE array_to_string({0}, ', ') END"


@query(WITH + URLS_SQL + f"""SELECT rec_id, key, lang, 'warn' AS severity, 'url-mismatch' AS code, {SAID.format('urls')} AS token, concat('has ', {SAID.format('urls')}, ', en has ', {SAID.format('r')}) AS snippet
FROM (SELECT u.*, CASE WHEN src.rec_id IS NOT NULL THEN source ELSE common END AS r FROM u JOIN ref USING (rec_id) LEFT JOIN src USING (rec_id)) WHERE urls <> r""")  # fmt: skip
def lint_urls(spark, sf_dir):
    return lint.lint_urls(derived_corpus(spark, sf_dir))


BARE = "%(?:\\d+\\$)?0*\\d*(?:\\.\\d+)?(?:hh|h|ll|l|L|z|t|j)?[@diouxXeEfFgGcCsS]"


@query(WITH + f""", p AS (SELECT *, regexp_replace(value, '\\[%[^\\]]*\\]', '', 'g') AS rest FROM fl WHERE contains(value, '%'))
SELECT rec_id, key, lang, 'error' AS severity, 'bare-placeholder' AS code, unnest(regexp_extract_all(replace(rest, '%%', ''), '{BARE}')) AS token, {SNIP} AS snippet FROM p
UNION ALL SELECT rec_id, key, lang, CASE WHEN platforms_csv = 'ios' THEN 'warn' ELSE 'error' END, 'literal-percent-escape', '%%', {SNIP} FROM p WHERE contains(rest, '%%')
UNION ALL SELECT rec_id, key, lang, 'error', 'lone-percent', '%', {SNIP} FROM p WHERE (platforms_csv = '' OR contains(platforms_csv, 'ios') OR contains(platforms_csv, 'android')) AND contains(regexp_replace(replace(rest, '%%', ''), '{BARE}', '', 'g'), '%')""")  # fmt: skip
def lint_placeholders(spark, sf_dir):
    return lint.lint_placeholders(derived_corpus(spark, sf_dir))


TOKENS = """, t AS (SELECT *, regexp_extract_all(value, '\\[%[^\\]]*\\]') AS tokens FROM fl WHERE bare <> ''),
y AS (SELECT *, list_sort(list_transform(tokens, lambda x: coalesce(nullif(regexp_replace(x, '[\\[\\]%\\d$.\\-+# ]', '', 'g'), ''), '?'))) AS types FROM t WHERE rec_id IN (SELECT rec_id FROM t WHERE len(tokens) > 0))
"""
MULTISET = "CASE WHEN len({0}) = 0 THEN 'none' ELSE array_to_string(list_transform(list_sort(list_distinct({0})), lambda d: concat('%', d, '×', len(list_filter({0}, lambda z: z = d)))), ', ') END"


@query(WITH + TOKENS + f""", n AS (SELECT rec_id, types, count(*) AS c, min(lang) AS f FROM y WHERE len(types) > 0 GROUP BY ALL), ref AS (SELECT rec_id, arg_min(types, (-c, f)) AS common FROM n GROUP BY rec_id),
src AS (SELECT rec_id, types AS source FROM y WHERE lang = 'en'), j AS (SELECT y.*, CASE WHEN src.rec_id IS NOT NULL THEN source ELSE common END AS r FROM y JOIN ref USING (rec_id) LEFT JOIN src USING (rec_id))
SELECT rec_id, key, lang, 'error' AS severity, 'placeholder-count' AS code, {MULTISET.format('types')} AS token, concat('has ', {MULTISET.format('types')}, ', en has ', {MULTISET.format('r')}) AS snippet FROM j WHERE types <> r""")  # fmt: skip
def lint_placeholder_count(spark, sf_dir):
    return lint.lint_placeholder_count(derived_corpus(spark, sf_dir))


@query(WITH + TOKENS + """, m AS (SELECT *, len(list_filter(tokens, lambda x: regexp_matches(x, '^\\[%\\d+\\$'))) > 0 AS ix FROM y WHERE len(tokens) >= 2),
w AS (SELECT *, bool_or(ix) OVER (PARTITION BY rec_id) AS any_ix, row_number() OVER (PARTITION BY rec_id ORDER BY ix, lang <> 'en', lang) AS nth FROM m)
SELECT rec_id, key, lang, CASE WHEN any_ix THEN 'error' ELSE 'warn' END AS severity, 'placeholder-indexing' AS code, '[%s]' AS token,
CASE WHEN any_ix THEN 'bare and numbered tokens are mixed over the languages of this key; number them all' ELSE 'several bare tokens; number them so that a translation may change their order' END AS snippet FROM w WHERE NOT ix AND (any_ix OR nth = 1)""")  # fmt: skip
def lint_placeholder_indexing(spark, sf_dir):
    return lint.lint_placeholder_indexing(derived_corpus(spark, sf_dir))


@query(WITH + """SELECT DISTINCT concat('id:', key_id) AS rec_id, key_name AS key, '(context)' AS lang, 'error' AS severity, 'context-empty-field' AS code, 'Constraints' AS token,
CASE WHEN length(context) > 70 THEN concat(left(context, 70), '…') ELSE context END AS snippet FROM k WHERE NOT archived AND regexp_matches(context, 'Constraints:\\s*$')""")  # fmt: skip
def lint_context(spark, sf_dir):
    return lint.lint_context(derived_corpus(spark, sf_dir))


@query(WITH + f"SELECT count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'warn') AS warnings, count(DISTINCT rec_id) AS keys FROM ({VALUES_SQL})")
def findings_summary(spark, sf_dir):
    return lint.summary(lint.lint_values(derived_corpus(spark, sf_dir)))


@query(WITH + f"SELECT code, lang, severity, count(*) AS findings FROM ({VALUES_SQL}) GROUP BY CUBE (code, lang, severity)")
def findings_cube(spark, sf_dir):
    return lint.cube(lint.lint_values(derived_corpus(spark, sf_dir)))


@query(WITH + """SELECT concat('id:', key_id) AS rec_id, '(key)' AS lang, 'key-name' AS code, key_name AS token FROM k WHERE NOT archived AND NOT regexp_matches(key_name, '^[A-Za-z][A-Za-z0-9_]*$')""")
def key_name_grammar(spark, sf_dir):
    return rules.key_name_grammar(derived_corpus(spark, sf_dir))


@query(WITH + """SELECT concat('id:', key_id) AS rec_id, '(context)' AS lang, 'context-coverage' AS code, unnest(['missing Context', 'missing Type']) AS token FROM k WHERE NOT archived""")
def context_coverage(spark, sf_dir):
    return rules.context_coverage(derived_corpus(spark, sf_dir))


# Review


@query(WITH + """SELECT key_id, key_name AS key, CASE WHEN d.value IS NULL THEN 'missing' WHEN d.value = '' THEN 'empty' ELSE 'unverified' END AS status, e.value AS source, d.value AS target
FROM k LEFT JOIN (SELECT * FROM tr WHERE lang = 'de') d USING (key_id) LEFT JOIN (SELECT * FROM tr WHERE lang = 'en') e USING (key_id) WHERE d.value IS NULL OR d.value = '' OR d.unverified""")  # fmt: skip
def backlog(spark, sf_dir):
    return review.backlog(derived_corpus(spark, sf_dir), "de").select("key_id", "key", "status", "source", "target")


@query(WITH + "SELECT CASE WHEN d.value IS NULL THEN 'missing' WHEN d.value = '' THEN 'empty' ELSE 'unverified' END AS status, count(*) AS n FROM k LEFT JOIN (SELECT * FROM tr WHERE lang = 'fr') d USING (key_id) WHERE d.value IS NULL OR d.value = '' OR d.unverified GROUP BY 1")
def backlog_counts(spark, sf_dir):
    return review.backlog_counts(review.backlog(derived_corpus(spark, sf_dir), "fr"))


@query(WITH + "SELECT lang, count(DISTINCT key_id) AS present FROM tr GROUP BY lang")
def coverage(spark, sf_dir):
    return review.coverage(derived_corpus(spark, sf_dir))


@query(WITH + "SELECT DISTINCT lang FROM tr")
def known_langs(spark, sf_dir):
    return review.known_langs(derived_corpus(spark, sf_dir))


@query(WITH + "SELECT key_id, key_name FROM k WHERE key_id NOT IN (SELECT key_id FROM tr WHERE lang = 'en')")
def without_source(spark, sf_dir):
    return review.without_source(derived_corpus(spark, sf_dir)).select("key_id", "key_name")


@query(WITH + """SELECT (SELECT count(*) FROM k) AS key_count, (SELECT count(*) FROM k WHERE archived) AS archived_count, CAST(0 AS BIGINT) AS plural_count, (SELECT string_agg(DISTINCT lang, ',' ORDER BY lang) FROM tr) AS languages,
'android,ios,other,web' AS platforms, (SELECT count(DISTINCT key_id) FROM tr WHERE unverified) AS unverified_key_count, 'en' AS source_lang""")  # fmt: skip
def corpus_meta(spark, sf_dir):
    meta = corpora.build_meta(derived_corpus(spark, sf_dir))
    return meta.select("key_count", "archived_count", "plural_count", F.array_join("languages", ",").alias("languages"), F.array_join("platforms", ",").alias("platforms"), "unverified_key_count", "source_lang")


@query("SELECT p_name AS name, count(*) AS n FROM part GROUP BY p_name HAVING count(*) > 1")
def duplicate_names(spark, sf_dir):
    return review.duplicate_names(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("rec_id"), F.col("p_name").alias("name")))


@query(WITH + "SELECT key_id, key_name, row_number() OVER (ORDER BY key_id) AS entry FROM k")
def entry_numbers(spark, sf_dir):
    return corpora.entries(derived_corpus(spark, sf_dir)).select("key_id", "key_name", "entry")


@query(WITH + """, p AS (SELECT key_id, max(value) FILTER (lang = 'en') AS en, max(value) FILTER (lang = 'de') AS de, max(value) FILTER (lang = 'fr') AS fr FROM tr GROUP BY key_id)
SELECT k.key_id, k.key_name AS key, en, CAST(NULL AS VARCHAR) AS ru, de, fr FROM k LEFT JOIN p USING (key_id) WHERE platforms_csv = '' OR list_contains(string_split(platforms_csv, ','), 'ios')""")  # fmt: skip
def side_by_side(spark, sf_dir):
    return review.side_by_side(derived_corpus(spark, sf_dir), ["de", "fr"], "ios").select("key_id", "key", "en", "ru", "de", "fr")


@query(WITH + """, n AS (SELECT *, row_number() OVER (ORDER BY key_id) AS entry FROM k)
SELECT entry, key_name AS key, e.value AS en, d.value AS de FROM n LEFT JOIN (SELECT * FROM tr WHERE lang = 'en') e USING (key_id) JOIN (SELECT * FROM tr WHERE lang = 'de') d USING (key_id) WHERE entry BETWEEN 5 AND 40""")  # fmt: skip
def audit_batch(spark, sf_dir):
    return review.audit_batch(derived_corpus(spark, sf_dir), "de", 5, 40).select("entry", "key", "en", "de")


@query("SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS entry, CAST(ceil(row_number() OVER (PARTITION BY conv_id ORDER BY turn) / 3.0) AS INTEGER) AS batch FROM conversations")
def review_batches(spark, sf_dir):
    return review.batches(table(spark, sf_dir, "conversations"), 3, "turn", by="conv_id").select("conv_id", "turn", "role", "entry", "batch")


@query(WITH + "SELECT key_id, key_name FROM k WHERE contains(lower(key_name), 'fam1') AND (contains(lower(context), 'screen 3') OR contains(lower(context), 'screen 5'))")
def search_keys(spark, sf_dir):
    return review.search(derived_corpus(spark, sf_dir), key=["FAM1"], context=["screen 3", "Screen 5"]).select("key_id", "key_name")


def _passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("key_id"), F.concat(F.lit("l"), (F.col("event_id") % 3).cast("string")).alias("lang"), F.col("event_type").alias("issue"), F.col("event_id").alias("pass_ord"),
        F.col("event_id").alias("translation_id"), F.col("value").cast("string").alias("value"), F.when(F.col("event_id") % 5 == 0, F.col("props")).alias("qa"),
    )


MERGED = """SELECT user_id AS key_id, concat('l', event_id % 3) AS lang, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS issues, min(event_id) AS translation_id, arg_min(props, event_id) FILTER (event_id % 5 = 0 AND props IS NOT NULL) AS qa FROM events GROUP BY 1, 2"""


@query(MERGED)
def qa_merge(spark, sf_dir):
    return review.merge_qa_issues(_passes(spark, sf_dir)).select("key_id", "lang", F.array_join("issues", ",").alias("issues"), "translation_id", "qa")


@query(f"SELECT issue, count(*) AS n FROM (SELECT unnest(string_split(issues, ',')) AS issue FROM ({MERGED})) GROUP BY issue")
def qa_by_issue(spark, sf_dir):
    return review.qa_summary(review.merge_qa_issues(_passes(spark, sf_dir)))[0]


@query(WITH + f""", q AS ({MERGED}), r AS (SELECT q.*, CASE WHEN k.key_id IS NULL THEN 'no_key' WHEN k.platforms_csv = '' OR list_contains(string_split(k.platforms_csv, ','), 'ios') THEN 'shown' ELSE 'off_platform' END AS status FROM q LEFT JOIN k USING (key_id))
SELECT key_id, lang, status, CASE WHEN status = 'shown' THEN CAST(ceil(row_number() OVER (PARTITION BY lang, status ORDER BY key_id) / 10.0) AS INTEGER) END AS batch FROM r""")  # fmt: skip
def qa_batches(spark, sf_dir):
    return review.qa_batches(derived_corpus(spark, sf_dir), review.merge_qa_issues(_passes(spark, sf_dir)), 10, "ios").select("key_id", "lang", "status", "batch")


# Edits


def _edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New German and French values for every third key, some under names that do not exist, and a repeat."""
    base = derived_corpus(spark, sf_dir).keys.where("key_id % 3 = 1").select(F.col("key_id"), "key_name")
    rows = base.select(F.when(F.col("key_id") % 7 == 2, F.concat("key_name", F.lit("_gone"))).otherwise(F.col("key_name")).alias("key"), F.explode(F.array(F.lit("de"), F.lit("fr"))).alias("lang"), "key_id")
    return rows.select("key", "lang", F.lit("").alias("form"), F.concat(F.lit("new "), F.col("key_id").cast("string")).alias("value"), F.lit(0).alias("pos")).unionAll(
        base.where("key_id % 5 = 0").select("key_name", F.lit("de"), F.lit(""), F.lit("last one"), F.lit(1))
    )


EDITS = """, e0 AS (SELECT CASE WHEN key_id % 7 = 2 THEN concat(key_name, '_gone') ELSE key_name END AS key, unnest(['de', 'fr']) AS lang, concat('new ', key_id) AS value, 0 AS pos FROM k WHERE key_id % 3 = 1
UNION ALL SELECT key_name, 'de', 'last one', 1 FROM k WHERE key_id % 3 = 1 AND key_id % 5 = 0),
e AS (SELECT key, lang, arg_max(value, pos) AS value FROM e0 GROUP BY key, lang), ap AS (SELECT k.key_id, e.* FROM e JOIN k ON e.key = k.key_name),
nu AS (SELECT tr.key_id, tr.lang, tr.value, tr.unverified, tr.dirty FROM tr WHERE NOT EXISTS (SELECT 1 FROM ap WHERE ap.key_id = tr.key_id AND ap.lang = tr.lang)
UNION ALL SELECT ap.key_id, ap.lang, ap.value, true, coalesce(tr.dirty, false) OR tr.value IS DISTINCT FROM ap.value FROM ap LEFT JOIN tr ON ap.key_id = tr.key_id AND ap.lang = tr.lang)
"""


@query(WITH + EDITS + "SELECT concat('id:', key_id) AS rec_id, lang, value, unverified, dirty FROM nu")
def apply_edits(spark, sf_dir):
    new, _ = edits.apply_edits(derived_corpus(spark, sf_dir), _edits(spark, sf_dir))
    return new.translations.select("rec_id", "lang", "value", F.col("is_unverified").alias("unverified"), F.col("is_dirty").alias("dirty"))


@query(WITH + EDITS + "SELECT e.key, e.lang, e.value, CASE WHEN k.key_id IS NULL THEN 'unmatched' ELSE 'apply' END AS status FROM e LEFT JOIN k ON e.key = k.key_name")
def edit_report(spark, sf_dir):
    return edits.resolve_edits(derived_corpus(spark, sf_dir), _edits(spark, sf_dir)).select("key", "lang", "value", "status")


@query(WITH + EDITS + """SELECT concat('id:', coalesce(tr.key_id, nu.key_id)) AS rec_id, coalesce(tr.lang, nu.lang) AS lang, CASE WHEN tr.key_id IS NULL THEN 'added' WHEN nu.key_id IS NULL THEN 'removed' ELSE 'changed' END AS change, tr.value AS old_value, nu.value AS new_value
FROM tr FULL JOIN nu ON tr.key_id = nu.key_id AND tr.lang = nu.lang WHERE tr.value IS DISTINCT FROM nu.value""")  # fmt: skip
def corpus_diff(spark, sf_dir):
    old = derived_corpus(spark, sf_dir)
    return edits.corpus_diff(old, edits.apply_edits(old, _edits(spark, sf_dir))[0]).select("rec_id", "lang", "change", "old_value", "new_value")


@query(WITH + """, c AS (SELECT key_id FROM tr WHERE lang = 'en' AND key_id % 10 = 4)
SELECT concat('id:', key_id) AS rec_id, lang, CASE WHEN key_id IN (SELECT key_id FROM c) THEN CASE WHEN lang = 'en' THEN 'renewed' ELSE '' END ELSE value END AS value,
CASE WHEN key_id IN (SELECT key_id FROM c) THEN lang <> 'en' ELSE unverified END AS unverified, CASE WHEN key_id IN (SELECT key_id FROM c) THEN dirty OR value <> CASE WHEN lang = 'en' THEN 'renewed' ELSE '' END ELSE dirty END AS dirty FROM tr""")  # fmt: skip
def propagate_source_change(spark, sf_dir):
    c = derived_corpus(spark, sf_dir)
    new = c.translations.where("lang = 'en' AND CAST(substr(rec_id, 4) AS BIGINT) % 10 = 4").select("rec_id", "lang", "form", F.lit("renewed").alias("value"))
    return edits.propagate_source_change(c, new).translations.select("rec_id", "lang", "value", F.col("is_unverified").alias("unverified"), F.col("is_dirty").alias("dirty"))


@query(WITH + """SELECT key_id, array_to_string(list_filter(['ios', 'android', 'web', 'other'], lambda p: p = 'web' OR (p <> 'ios' AND list_contains(string_split(platforms_csv, ','), p))), ',') AS platforms,
CASE WHEN array_to_string(list_filter(['ios', 'android', 'web', 'other'], lambda p: p = 'web' OR (p <> 'ios' AND list_contains(string_split(platforms_csv, ','), p))), ',') <> platforms_csv THEN 'platforms' ELSE '' END AS dirty_meta FROM k""")  # fmt: skip
def set_platforms(spark, sf_dir):
    c = derived_corpus(spark, sf_dir)
    ops = c.keys.select(F.col("key_name").alias("key"), F.array(F.lit("web")).alias("add"), F.array(F.lit("ios")).alias("remove"), F.lit(None).cast("array<string>").alias("replace"))
    return edits.set_platforms(c, ops).keys.select("key_id", F.array_join("platforms", ",").alias("platforms"), F.array_join("dirty_meta", ",").alias("dirty_meta"))


# Synchronisation


@query(WITH + "SELECT key_id, lang, value AS sent, lang <> 'en' AS is_unverified FROM tr WHERE dirty")
def push_plan(spark, sf_dir):
    updates, _, _ = sync.push_plan(derived_corpus(spark, sf_dir))
    return updates.select("key_id", F.explode("translations").alias("t")).select("key_id", F.col("t.language_iso").alias("lang"), F.col("t.translation").alias("sent"), F.col("t.is_unverified").alias("is_unverified"))


@query(WITH + """, u AS (SELECT 'update' AS action, key_id, CAST(key_id AS VARCHAR) AS label, string_agg(lang, ',' ORDER BY lang) AS detail FROM tr WHERE dirty GROUP BY key_id), n AS (SELECT *, row_number() OVER (ORDER BY key_id) AS nth, count(*) OVER () AS c FROM u)
SELECT action, CAST(nth AS INTEGER) AS nth, label, detail, greatest(c - 3, 0) AS rest FROM n WHERE nth <= 3""")  # fmt: skip
def push_preview(spark, sf_dir):
    return sync.preview(*sync.push_plan(derived_corpus(spark, sf_dir)))


def _sent_and_stored(spark: SparkSession, sf_dir: str):
    c = derived_corpus(spark, sf_dir)
    sent = sync.sent_values(sync.push_plan(c)[0])
    stored = c.translations.select(F.substring("rec_id", 4, 20).cast("bigint").alias("key_id"), "lang", F.col("value").alias("stored")).where("key_id % 11 <> 3 AND NOT (key_id % 5 = 1 AND lang = 'es')")
    return c, sent, stored.withColumn("stored", F.when(F.col("key_id") % 6 == 2, F.concat("stored", F.lit("!"))).otherwise(F.col("stored")))


VERIFY = """, s AS (SELECT key_id, lang, value FROM tr WHERE dirty), st AS (SELECT key_id, lang, CASE WHEN key_id % 6 = 2 THEN concat(value, '!') ELSE value END AS stored FROM tr WHERE key_id % 11 <> 3 AND NOT (key_id % 5 = 1 AND lang = 'es')),
bad AS (SELECT s.key_id, s.lang, CASE WHEN s.key_id NOT IN (SELECT key_id FROM st) THEN 'missing_key' WHEN st.lang IS NULL THEN 'missing_lang' ELSE 'differs' END AS problem FROM s LEFT JOIN st ON s.key_id = st.key_id AND s.lang = st.lang WHERE st.stored IS DISTINCT FROM s.value)
"""


@query(WITH + VERIFY + "SELECT key_id, lang, problem FROM bad")
def verify_push(spark, sf_dir):
    c, sent, stored = _sent_and_stored(spark, sf_dir)
    return sync.verify_push(sent, stored, c.keys.select("rec_id", "plural")).select("key_id", "lang", "problem")


@query(WITH + VERIFY + "SELECT concat('id:', key_id) AS rec_id, lang FROM bad")
def drain(spark, sf_dir):
    c, sent, stored = _sent_and_stored(spark, sf_dir)
    return sync.drain(c, sent, sync.verify_push(sent, stored, c.keys.select("rec_id", "plural"))).translations.where("is_dirty").select("rec_id", "lang")


def _service_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key_id"), F.col("p_name").alias("key_name"), F.array(F.lower(F.col("p_type")), F.col("p_brand")).alias("tags"), F.split(F.when(F.col("p_size") % 2 == 0, "ios,android").otherwise("web"), ",").alias("platforms"), (F.col("p_size") > 45).alias("archived"))


@query("SELECT p_partkey AS key_id, array_to_string(list_sort(list_distinct([lower(p_type), p_brand, 'checked'])), ',') AS new_tags FROM part")
def tag_plan_add(spark, sf_dir):
    return sync.tag_plan(_service_keys(spark, sf_dir), "add", ["checked"]).select("key_id", F.array_join("new_tags", ",").alias("new_tags"))


@query("SELECT p_partkey AS key_id, p_brand AS new_tags FROM part WHERE p_type = 'PROMO'")
def tag_plan_remove(spark, sf_dir):
    return sync.tag_plan(_service_keys(spark, sf_dir), "remove", ["promo"]).select("key_id", F.array_join("new_tags", ",").alias("new_tags"))


@query("""SELECT p_partkey AS key_id, replace(p_name, ' ', '_') AS new_name, CASE WHEN NOT regexp_matches(replace(p_name, ' ', '_'), '^[A-Za-z][A-Za-z0-9_]*$') THEN 'invalid name' WHEN count(*) OVER (PARTITION BY p_partkey) > 1 THEN 'duplicate key id'
WHEN count(*) OVER (PARTITION BY replace(p_name, ' ', '_')) > 1 THEN 'duplicate target' END AS problem FROM part""")  # fmt: skip
def rename_plan(spark, sf_dir):
    return sync.rename_plan(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key_id"), F.replace("p_name", F.lit(" "), F.lit("_")).alias("new_name"))).select("key_id", "new_name", "problem")


@query("""WITH r AS (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS ref, 'id' AS kind FROM lineitem UNION ALL SELECT DISTINCT concat(p_name, CASE WHEN p_partkey % 2 = 0 THEN '' ELSE 'x' END), 'name' FROM part),
h AS (SELECT ref, kind, p_partkey FROM r JOIN part ON kind = 'id' AND ref = CAST(p_partkey AS VARCHAR) UNION ALL SELECT ref, kind, p_partkey FROM r JOIN part ON kind = 'name' AND ref = p_name),
c AS (SELECT ref, kind, count(DISTINCT p_partkey) AS n, min(p_partkey) AS m FROM h GROUP BY ALL)
SELECT ref, kind, CASE WHEN n = 1 THEN m END AS key_id, CASE WHEN n IS NULL THEN 'not_found' WHEN n > 1 THEN 'ambiguous' ELSE 'ok' END AS status FROM r LEFT JOIN c USING (ref, kind)""")  # fmt: skip
def resolve_refs(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    by_name = part.select(F.concat("p_name", F.when(F.col("p_partkey") % 2 == 0, "").otherwise("x")).alias("ref"), F.lit("name").alias("kind"))
    refs = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("ref"), F.lit("id").alias("kind")).unionAll(by_name).distinct()
    return sync.resolve_refs(_service_keys(spark, sf_dir), refs)


@query("SELECT p_partkey AS key_id, p_name AS key_name FROM part WHERE p_size % 2 = 0 AND p_size <= 45 AND p_brand IN ('Brand#13', 'Brand#5')")
def list_keys(spark, sf_dir):
    return sync.list_keys(_service_keys(spark, sf_dir), tags=["Brand#13", "Brand#5"], platforms=["android"]).select("key_id", "key_name")


# Glossary


def _glossary(spark: SparkSession, sf_dir: str) -> Glossary:
    """A term for each part name and brand; some frozen and forbidden, some with too many tags; a German text for most."""
    p = table(spark, sf_dir, "part").withColumn("term", F.concat("p_name", F.lit(" "), "p_brand"))
    terms = p.select(
        "term", F.when(F.col("p_partkey") % 3 == 0, F.col("p_partkey")).alias("term_id"), F.when(F.col("p_partkey") % 4 != 0, F.lower("p_type")).alias("description"), (F.col("p_partkey") % 6 == 0).alias("case_sensitive"),
        (F.col("p_partkey") % 10 != 0).alias("translatable"), (F.col("p_partkey") % 15 == 0).alias("forbidden"), F.when(F.col("p_partkey") % 9 == 0, F.array(*[F.lit(x) for x in ("ui", "unit", "odd", "legal")])).otherwise(F.array(F.lit("ui"))).alias("tags"),
    )
    return Glossary(terms, p.groupBy("term").agg(F.min("p_partkey").alias("k")).where("k % 2 = 0").select("term", F.lit("de").alias("lang"), F.concat(F.lit("Teil "), F.col("k").cast("string")).alias("text"), F.when(F.col("k") % 8 == 0, "siehe; oben").alias("note")))


G = "WITH g AS (SELECT concat(p_name, ' ', p_brand) AS term, p_partkey AS k, p_type FROM part), x AS (SELECT term, min(k) AS k FROM g GROUP BY term HAVING min(k) % 2 = 0)\n"


@query(G + "SELECT term, count(*) AS n, 'exact' AS kind FROM g GROUP BY term HAVING count(*) > 1")
def glossary_duplicates(spark, sf_dir):
    return glossary.duplicates(_glossary(spark, sf_dir).terms)


@query(G + """SELECT 'error' AS severity, term, 'frozen and forbidden' AS problem FROM g WHERE k % 10 = 0 AND k % 15 = 0 UNION ALL SELECT 'error', term, '4 tags, at most 3' FROM g WHERE k % 9 = 0
UNION ALL SELECT 'warn', term, 'no description' FROM g WHERE k % 4 = 0 UNION ALL SELECT 'warn', term, 'tag not in vocabulary: odd' FROM g WHERE k % 9 = 0
UNION ALL SELECT 'error', term, concat('duplicate term x', count(*)) FROM g GROUP BY term HAVING count(*) > 1""")  # fmt: skip
def lint_glossary(spark, sf_dir):
    return glossary.lint_glossary(_glossary(spark, sf_dir), ["de", "fr"])


@query(G + """SELECT 0 AS position, 'term;description;casesensitive;translatable;forbidden;tags;de;de_description' AS line UNION ALL
SELECT 1, concat(g.term, ';', CASE WHEN g.k % 4 <> 0 THEN lower(p_type) ELSE '' END, ';', CASE WHEN g.k % 6 = 0 THEN 'yes' ELSE 'no' END, ';', CASE WHEN g.k % 10 <> 0 THEN 'yes' ELSE 'no' END, ';', CASE WHEN g.k % 15 = 0 THEN 'yes' ELSE 'no' END, ';',
CASE WHEN g.k % 9 = 0 THEN 'ui,unit,odd,legal' ELSE 'ui' END, ';', coalesce(concat('Teil ', nullif(x.k::VARCHAR, '')), ''), ';', CASE WHEN x.k % 8 = 0 THEN '"siehe; oben"' ELSE '' END) FROM g LEFT JOIN x USING (term)""".replace("coalesce(concat('Teil ', nullif(x.k::VARCHAR, '')), '')", "CASE WHEN x.k IS NULL THEN '' ELSE concat('Teil ', x.k) END"))  # fmt: skip
def glossary_csv(spark, sf_dir):
    return glossary.to_csv(_glossary(spark, sf_dir))


@query(G + """, r AS (SELECT k AS term_id, concat(term, CASE WHEN k % 5 = 0 THEN ' old' ELSE '' END) AS term FROM g WHERE k % 7 <> 0), t AS (SELECT term, max(term_id) AS m FROM r GROUP BY term)
SELECT g.term, CASE WHEN k % 3 = 0 THEN k END AS term_id, coalesce(i.term_id, t.m) AS remote_id, CASE WHEN coalesce(i.term_id, t.m) IS NULL THEN 'create' ELSE 'update' END AS action,
coalesce(i.term_id, t.m) IS NOT NULL AND coalesce(i.term_id, t.m) IS DISTINCT FROM CASE WHEN k % 3 = 0 THEN k END AS stamp FROM g LEFT JOIN r i ON g.k % 3 = 0 AND i.term_id = g.k LEFT JOIN t ON g.term = t.term""")  # fmt: skip
def glossary_upsert(spark, sf_dir):
    g = _glossary(spark, sf_dir)
    remote = table(spark, sf_dir, "part").where("p_partkey % 7 <> 0").select(F.col("p_partkey").alias("term_id"), F.concat("p_name", F.lit(" "), "p_brand", F.when(F.col("p_partkey") % 5 == 0, " old").otherwise("")).alias("term"))
    return glossary.upsert_plan(g, remote)


@query(G + """SELECT CASE WHEN k % 10 = 0 THEN '1 freeze' WHEN k % 15 = 0 THEN '3 forbidden' WHEN k % 9 = 0 THEN '4 legal' ELSE '4 ui' END AS section, count(*) AS n FROM g GROUP BY 1""")
def glossary_checklist_totals(spark, sf_dir):
    return glossary.checklist_totals(glossary.checklist(_glossary(spark, sf_dir), "de"))


# Contexts, code and usage


@query(WITH + """, b AS (SELECT key_id, min((-length(value), lang)) AS m FROM tr WHERE value <> '' GROUP BY key_id) SELECT concat('id:', key_id) AS rec_id, -m[1] AS longest, m[2] AS lang FROM b""")
def longest_translation(spark, sf_dir):
    return usage.longest_translation(derived_corpus(spark, sf_dir)).select("rec_id", F.col("longest").cast("bigint").alias("longest"), "lang")


@query(WITH + """, b AS (SELECT key_id, max(length(value)) AS longest FROM tr WHERE value <> '' GROUP BY key_id) SELECT concat('id:', k.key_id) AS rec_id, CAST(60 AS BIGINT) AS cap, longest, longest - 60 AS margin FROM k JOIN b USING (key_id) WHERE contains(context, '60 chars') AND longest > 65""")
def cap_violations(spark, sf_dir):
    return usage.cap_violations(derived_corpus(spark, sf_dir)).select("rec_id", "cap", F.col("longest").cast("bigint").alias("longest"), F.col("margin").cast("bigint").alias("margin"))


FAMILY = """, f AS (SELECT key_name AS key, coalesce(nullif(regexp_replace(key_name, '_?\\d+[MF]?$', ''), ''), key_name) AS family, contains(context, 'Register:') AS r, context FROM k WHERE NOT archived)
"""


@query(WITH + FAMILY + """, w AS (SELECT *, count(*) FILTER (r) OVER (PARTITION BY family) AS with_register, count(*) FILTER (NOT r) OVER (PARTITION BY family) AS without_register FROM f) SELECT key, family, with_register, without_register FROM w WHERE NOT r AND with_register > 0""")
def family_register(spark, sf_dir):
    return usage.family_register(lint.live_keys(derived_corpus(spark, sf_dir)))


@query(WITH + FAMILY + """, l AS (SELECT key, family, trim(unnest(string_split(context, chr(10)))) AS line FROM f), m AS (SELECT *, count(*) OVER (PARTITION BY family, line) AS n FROM l WHERE (starts_with(line, 'Surface:') OR starts_with(line, 'Constraints:')) AND length(line) > 25) SELECT family, line, n, key FROM m WHERE n >= 3""")
def shared_boilerplate(spark, sf_dir):
    return usage.shared_boilerplate(lint.live_keys(derived_corpus(spark, sf_dir)))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(F.concat(F.lit("p"), F.col("page_id").cast("string"), F.lit(".html")).alias("path"), F.posexplode(F.split("html", "\n")).alias("p", "line")).select("path", (F.col("p") + 1).alias("lineno"), "line")


@query("""WITH l AS (SELECT concat('p', page_id, '.html') AS path, string_split(html, chr(10)) AS ls FROM pages), n AS (SELECT path, unnest(range(1, len(ls) + 1)) AS lineno, ls FROM l)
SELECT path, CAST(lineno AS INTEGER) AS lineno, unnest(regexp_extract_all(ls[lineno], 'href="/([^"]+)"', 1)) AS name, 'href' AS kind FROM n""")  # fmt: skip
def call_sites(spark, sf_dir):
    return usage.call_sites(_lines(spark, sf_dir), {"href": 'href="/([^"]+)"'})


@query("""WITH d AS (SELECT DISTINCT unnest(regexp_extract_all(html, '<a [^>]*>([^<]+)</a>', 1)) AS name FROM pages), u AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z_][A-Za-z0-9_]*')) AS name FROM conversations) SELECT name FROM d WHERE name NOT IN (SELECT name FROM u)""")
def unused_keys(spark, sf_dir):
    defined = table(spark, sf_dir, "pages").select(F.explode(X.matches("html", "<a [^>]*>([^<]+)</a>", 1)).alias("name"))
    return usage.unused_keys(defined, table(spark, sf_dir, "conversations").select(F.explode(X.matches("text", usage.IDENTIFIER)).alias("key")))


@query("""WITH s AS (SELECT DISTINCT left(p_name, 1 + CAST(p_partkey % 9 AS INTEGER)) AS symbol FROM part), w AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z_][A-Za-z0-9_]*')) AS name FROM conversations) SELECT symbol FROM s WHERE EXISTS (SELECT 1 FROM w WHERE starts_with(w.name, s.symbol))""")
def symbols_alive(spark, sf_dir):
    symbols = table(spark, sf_dir, "part").select(F.expr("left(p_name, 1 + CAST(p_partkey % 9 AS INT))").alias("symbol"))
    names = table(spark, sf_dir, "conversations").select(F.explode(X.matches("text", usage.IDENTIFIER)).alias("name")).distinct()
    return usage.alive(symbols, names, names.limit(0))


@query("""WITH e AS (SELECT DISTINCT concat('pool', event_id % 3) AS pool, event_type AS key FROM events), u AS (SELECT DISTINCT concat('pool', event_id % 3) AS pool, event_type AS key FROM events WHERE value > 400 AND event_id % 3 <> 1)
SELECT key, string_agg(pool, ',' ORDER BY pool) AS pools, CASE WHEN bool_and(u.key IS NULL) THEN 'all_unused' WHEN bool_or(u.key IS NULL) THEN 'mixed' ELSE 'all_used' END AS status FROM (SELECT * FROM e) LEFT JOIN u USING (pool, key) GROUP BY key""".replace("u.key IS NULL", "NOT used").replace("SELECT * FROM e) LEFT JOIN u USING (pool, key)", "SELECT e.*, u.key IS NOT NULL AS used FROM e LEFT JOIN u USING (pool, key))"))  # fmt: skip
def pool_status(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.concat(F.lit("pool"), (F.col("event_id") % 3).cast("string")).alias("pool"), F.col("event_type").alias("key"), "value", "event_id")
    rows = usage.pool_status(e, e.where("value > 400 AND event_id % 3 <> 1").select("pool", "key"))
    return rows.select("key", F.array_join("pools", ",").alias("pools"), "status")


# Bundles and rules

CONVERT = "replace(regexp_replace(regexp_replace({0}, '\\[%(\\d+\\$)?s[^\\]]*\\]', '%\\1s', 'g'), '\\[%(\\d+\\$)?[id][^\\]]*\\]', '%\\1d', 'g'), '[%]', '%%')"


@query(WITH + f""", ks AS (SELECT * FROM k WHERE NOT archived AND (platforms_csv = '' OR contains(platforms_csv, 'android'))), s AS (SELECT key_id, lang FROM ks CROSS JOIN (SELECT DISTINCT lang FROM tr)),
v AS (SELECT s.key_id, s.lang, coalesce(nullif(fl2.value, ''), en.value, '') AS v FROM s LEFT JOIN tr fl2 ON s.key_id = fl2.key_id AND s.lang = fl2.lang LEFT JOIN (SELECT * FROM tr WHERE lang = 'en') en ON en.key_id = s.key_id)
SELECT 'android' AS platform, CASE lang WHEN 'en' THEN 'values/strings.xml' WHEN 'es' THEN 'values-es-rES/strings.xml' ELSE concat('values-', lang, '/strings.xml') END AS file, lang, key_name AS key, {CONVERT.format('v')} AS value FROM v JOIN ks USING (key_id)""")  # fmt: skip
def bundle_entries(spark, sf_dir):
    return bundles.bundle_entries(derived_corpus(spark, sf_dir), "android")


@query(WITH + """, ks AS (SELECT key_id FROM k WHERE NOT archived AND (platforms_csv = '' OR contains(platforms_csv, 'ios'))), s AS (SELECT key_id, lang FROM ks CROSS JOIN (SELECT DISTINCT lang FROM tr WHERE lang <> 'en'))
SELECT s.lang, count(*) FILTER (coalesce(value, '') = '') AS empty, count(*) FILTER (coalesce(value, '') <> '' AND unverified) AS unverified, count(*) FILTER (coalesce(value, '') = '' OR unverified) > 0 AS blocked FROM s LEFT JOIN tr ON s.key_id = tr.key_id AND s.lang = tr.lang GROUP BY s.lang""")  # fmt: skip
def release_gate(spark, sf_dir):
    return bundles.release_gate(derived_corpus(spark, sf_dir), "ios")


@query("""WITH a AS (SELECT DISTINCT text FROM conversations WHERE role = 'user'), b AS (SELECT DISTINCT text FROM conversations WHERE role <> 'user')
SELECT md5(text) AS h, 'missing' AS side FROM a WHERE text NOT IN (SELECT text FROM b) UNION ALL SELECT md5(text), 'unexpected' FROM b WHERE text NOT IN (SELECT text FROM a)""")  # fmt: skip
def bundle_diff(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return bundles.diff_set(c.where("role = 'user'"), c.where("role <> 'user'"), "text").select(F.md5("text").alias("h"), "side")


SOURCES = """, s AS (SELECT replace(lower(upper(bare)), 'ß', 'ss') AS text, key, rec_id, platforms_csv FROM fl WHERE lang = 'en' AND value <> '')"""


@query(WITH + SOURCES + "SELECT text, n, rec_id, key FROM (SELECT *, count(*) OVER (PARTITION BY text) AS n FROM s) WHERE n > 1")
def reuse_candidates(spark, sf_dir):
    return rules.reuse_candidates(derived_corpus(spark, sf_dir)).select("text", "n", "rec_id", "key")


@query(WITH + SOURCES + "SELECT rec_id, key, md5(text) AS h FROM s WHERE platforms_csv <> '' AND NOT contains(platforms_csv, 'android') AND text IN (SELECT text FROM s WHERE platforms_csv = '' OR contains(platforms_csv, 'android'))")
def platform_suggestions(spark, sf_dir):
    return rules.platform_suggestions(derived_corpus(spark, sf_dir), "android").select("rec_id", "key", F.md5("text").alias("h"))


@query(WITH.replace("WITH ", "WITH RECURSIVE ", 1) + SOURCES + """, d AS MATERIALIZED (SELECT md5(text) AS id, list_distinct(list_transform(range(1, greatest(length(text) - 3, 1) + 1), lambda i: substr(text, i, 4))) AS g FROM (SELECT DISTINCT text FROM s)),
c AS (SELECT a.id AS a, b.id AS b, len(list_intersect(a.g, b.g)) AS i, len(a.g) + len(b.g) AS u FROM d a JOIN d b ON a.id < b.id AND 5 * least(len(a.g), len(b.g)) >= 4 * greatest(len(a.g), len(b.g))),
e AS MATERIALIZED (SELECT a, b FROM c WHERE 5 * i >= 4 * (u - i)), e2 AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (SELECT id, id AS at_ FROM d UNION SELECT reach.id, e2.b FROM reach JOIN e2 ON reach.at_ = e2.a), r AS (SELECT id, min(at_) AS grp FROM reach GROUP BY id),
m AS (SELECT grp, rec_id, key, id FROM s JOIN r ON md5(text) = id), n AS (SELECT grp, count(*) AS n_keys, count(DISTINCT id) AS n_texts FROM m GROUP BY grp HAVING count(*) > 1)
SELECT grp AS "group", rec_id, key, id AS text_id, n_keys, n_texts FROM m JOIN n USING (grp)""")  # fmt: skip
def near_reuse(spark, sf_dir):
    return reuse.near_reuse(derived_corpus(spark, sf_dir))


@query(WITH + """SELECT concat('id:', key_id) AS rec_id, lang, 'hard-break' AS code, '\\n' AS token FROM lv WHERE contains(value, chr(10)) OR contains(value, '\\n')""")
def hard_breaks(spark, sf_dir):
    return rules.hard_breaks(derived_corpus(spark, sf_dir))


@query(WITH + """, a AS (SELECT key_id, string_agg(concat(CAST(to_json(lang) AS VARCHAR), ':', CAST(to_json(value) AS VARCHAR)), ',' ORDER BY lang) AS t, max(CASE WHEN lang = 'en' THEN CAST(to_json(value) AS VARCHAR) END) AS en,
string_agg(CAST(to_json(lang) AS VARCHAR), ',' ORDER BY lang) FILTER (unverified) AS u, string_agg(CAST(to_json(lang) AS VARCHAR), ',' ORDER BY lang) FILTER (dirty) AS d FROM tr GROUP BY key_id)
SELECT k.key_id, concat('{"key_id":', k.key_id, ',"key":', CAST(to_json(key_name) AS VARCHAR), ',"platforms":[', CASE WHEN platforms_csv <> '' THEN concat('"', replace(platforms_csv, ',', '","'), '"') END, ']', ',"en":' || en, ',"context":' || CAST(to_json(nullif(context, '')) AS VARCHAR),
CASE WHEN archived THEN ',"archived":true' END, ',"unverified":[' || u || ']', ',"dirty":[' || d || ']', ',"t":{', t, '}}') AS line FROM k LEFT JOIN a USING (key_id)""")  # fmt: skip
def json_lines(spark, sf_dir):
    """The corpus as lean JSON lines, in order of nothing."""
    return corpora.to_json_lines(derived_corpus(spark, sf_dir)).select("key_id", "line")

"""Written rules of style as checks. All findings are warnings: (rec_id, lang, code, token)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lingspan.functions import text as X
from lingspan.operators.lint import live_keys, live_values
from lingspan.operators.reuse import source_texts
from lingspan.schema import SOURCE_LANG, Corpus

# Facts of languages and budgets by kind of text.
GENDERLESS = ("id", "ms", "vi", "ja", "ko", "zh_CN", "tr")
PLURALS = {"ar": ("zero", "one", "two", "few", "many", "other"), "hi": ("one", "other"), "pl": ("one", "few", "many", "other"), "id": ("other",), "ms": ("other",), "vi": ("other",)}
US_SPELLING = {"fulfil": "fulfill", "favourite": "favorite", "colour": "color", "centre": "center", "behaviour": "behavior", "organise": "organize", "analyse": "analyze"}
BUDGETS = {"button label": 15, "settings row title": 25, "section header": 20, "notification body": 80}
CJK = ("ja", "zh_CN", "ko")
FORMAL_RU = ("вы", "вас", "вам", "вами", "ваш", "ваша", "ваше", "ваши", "вашего", "вашей", "вашу", "ваших")
NO_PERIOD = r"(?i)^\s*(button label|badge|toggle|.*title|.*header|.*label|.*value|tip headline)"
TYPES = (
    "button label", "badge", "toggle", "picker option", "segmented option", "screen title", "section header", "card title", "feature row title", "popup title", "alert title",
    "confirmation alert title", "tab title", "settings row title", "settings row value", "settings row label", "option label", "paragraph", "notification title", "notification body",
    "alert message", "error message", "success message", "status message", "warning message", "motivational text", "tip", "tip headline", "beverage name", "unit abbreviation",
    "container name", "character name", "achievement title", "achievement description", "permission prompt", "accessibility label", "accessibility hint", "tutorial step",
    "form field label", "placeholder", "label",
)


def _warn(rows: DataFrame, when: Column, code: str, token: Column | str) -> DataFrame:
    t = F.lit(token) if isinstance(token, str) else token
    return rows.where(when).select("rec_id", "lang", F.lit(code).alias("code"), t.alias("token"))


def _typed(corpus: Corpus) -> DataFrame:
    """Values with the first role of their context's Type."""
    rows = live_values(corpus, "context")
    return rows.withColumn("role", first_role("context"))


def first_role(context: Column | str) -> Column:
    """The first role of Type, without its qualifier, in small letters."""
    return F.lower(X.strip(F.regexp_replace(F.get(F.split(X.context_body(context, "Type"), "/"), F.lit(0)), r"\(.*\)", "")))


def gender_pairs(corpus: Corpus) -> DataFrame:
    """Keys that end in M and F on one stem: alike where the language has gender, different where it has none."""
    rows = live_values(corpus).where((F.col("form") == "") & (F.col("value") != "") & (F.col("lang") != SOURCE_LANG) & F.col("key").rlike("[MF]$"))
    rows = rows.withColumns({"stem": F.regexp_replace("key", "[MF]$", ""), "g": F.substring("key", -1, 1)})
    pairs = rows.groupBy("stem", "lang").agg(F.max(F.when(F.col("g") == "M", F.struct("value", "rec_id"))).alias("m"), F.max(F.when(F.col("g") == "F", F.struct("value", "rec_id"))).alias("f"))
    pairs = pairs.where("m IS NOT NULL AND f IS NOT NULL").withColumn("same", F.col("m.value") == F.col("f.value"))
    genderless = F.col("lang").isin(*GENDERLESS)
    bad = pairs.where(genderless != F.col("same"))
    return bad.select(F.col("f.rec_id").alias("rec_id"), "lang", F.when(F.col("same"), "gender-identical").otherwise("gender-different").alias("code"), F.col("stem").alias("token"))


def plural_categories(corpus: Corpus, table: dict[str, tuple[str, ...]] = PLURALS) -> DataFrame:
    """Plural forms that a language lacks or does not have."""
    lookup = F.broadcast(corpus.keys.sparkSession.createDataFrame([(k, list(v)) for k, v in table.items()], "lang string, allowed array<string>"))
    forms = live_values(corpus).where("form <> ''").groupBy("rec_id", "lang").agg(F.array_sort(F.collect_set("form")).alias("forms")).join(lookup, "lang")
    extra, lost = F.array_except("forms", "allowed"), F.array_except("allowed", "forms")
    items = F.concat(F.transform(extra, lambda x: F.concat(F.lit("extra "), x)), F.transform(lost, lambda x: F.concat(F.lit("missing "), x)))
    return forms.select("rec_id", "lang", F.lit("plural-category").alias("code"), F.explode(items).alias("token"))


# Endings in which British and US spelling differ, as patterns, and what US spelling has for them.
US_ENDINGS = (
    (r"^(.{2,})our(s|ed|ing|ite|ites|able|ful|less|ist|ists|er|ers)?$", "$1or$2"),
    (r"^(.{3,})is(e|es|ed|ing|er|ers|ation|ations)$", "$1iz$2"),
    (r"^(.{2,})ys(e|es|ed|ing|er|ers)$", "$1yz$2"),
    (r"^(.+[bt])re(s|d)?$", "$1er$2"),
    (r"^(.{3,}[aeiou])ll(ed|ing|er|ers|or|ors)$", "$1l$2"),
    (r"^(.{3,})ogue(s|d)?$", "$1og$2"),
    (r"^(def|off|lic|pret)ence(s|d)?$", "$1ense$2"),
)
#: Words that stay British here: units of measure.
KEPT_SPELLINGS = ("litre", "litres", "millilitre", "millilitres")


def us_pairs(words: DataFrame, least: int = 1, kept: tuple[str, ...] = KEPT_SPELLINGS) -> DataFrame:
    """words (word, n) -> (word, us, n, us_n): words with a British ending whose US spelling, by US_ENDINGS, is itself a word of
    the texts, found `least` times or more. So a corpus says by its own words what is a variant: 'promise' has no 'promize'
    beside it and is none."""
    made = F.array_compact(F.array(*[F.when(F.col("word").rlike(p), F.regexp_replace("word", p, us)) for p, us in US_ENDINGS]))
    british = words.where(~F.col("word").isin(*kept)).select("word", "n", F.explode(F.array_distinct(made)).alias("us")).where("us <> word")
    return british.join(words.where(F.col("n") >= least).select(F.col("word").alias("us"), F.col("n").alias("us_n")), "us").select("word", "us", "n", "us_n")


def us_spelling(corpus: Corpus, table: dict[str, str] = US_SPELLING, least: int = 1) -> DataFrame:
    """British spellings in source texts: words of the table, and words of us_pairs over the source texts."""
    words = live_values(corpus).where(F.col("lang") == SOURCE_LANG).select("rec_id", "lang", F.explode(F.array_distinct(F.split(F.lower("value"), r"[^\p{L}]+"))).alias("word"))
    listed = corpus.keys.sparkSession.createDataFrame(list(table.items()), "word string, us string")
    ruled = us_pairs(words.where("word <> ''").groupBy("word").agg(F.count("*").alias("n")), least).select("word", "us")
    pairs = listed.unionAll(ruled.join(listed.select("word"), "word", "left_anti"))
    return words.join(pairs, "word").select("rec_id", "lang", F.lit("us-spelling").alias("code"), F.concat("word", F.lit(" -> "), "us").alias("token"))


def length_budget(corpus: Corpus, budgets: dict[str, int] = BUDGETS) -> DataFrame:
    """Values longer than their role's budget, which is soft."""
    lookup = F.broadcast(corpus.keys.sparkSession.createDataFrame(list(budgets.items()), "role string, most int"))
    rows = _typed(corpus).join(lookup, "role")
    return _warn(rows, F.char_length("value") > F.col("most"), "length-budget", F.concat(F.char_length("value").cast("string"), F.lit(" > "), F.col("most").cast("string")))


def final_period(corpus: Corpus) -> DataFrame:
    """Labels, titles and buttons that end with one period; error messages are prose."""
    return _warn(_typed(corpus), F.col("role").rlike(NO_PERIOD) & F.col("value").rlike(r"(?<!\.)\.$"), "final-period", F.col("role"))


def cjk_halfwidth(corpus: Corpus) -> DataFrame:
    script = r"[぀-ヿ㐀-鿿가-힯]"
    beside = F.regexp_extract("value", f"{script}[!?:,]|[!?:,]{script}", 0)
    return _warn(live_values(corpus).where(F.col("lang").isin(*CJK)), beside != "", "cjk-halfwidth", F.regexp_replace(beside, script, ""))


def formal_register_leak(corpus: Corpus) -> DataFrame:
    """Formal address in Russian; texts whose register is formal may have it."""
    rows = live_values(corpus, "context").where((F.col("lang") == "ru") & ~F.coalesce(X.context_body("context", "Register").rlike(r"(?i)\bformal"), F.lit(False)))
    words = F.filter(F.array_distinct(F.split(F.lower("value"), r"[^\p{L}]+")), lambda w: w.isin(*FORMAL_RU))
    return rows.select("rec_id", "lang", F.lit("formal-register").alias("code"), F.explode(words).alias("token"))


def hard_breaks(corpus: Corpus) -> DataFrame:
    return _warn(live_values(corpus), F.col("value").contains("\n") | F.col("value").contains("\\n"), "hard-break", "\\n")


def context_coverage(corpus: Corpus, types: tuple[str, ...] = TYPES) -> DataFrame:
    """Keys without a context, without a required field, or with a Type whose first role is not in the vocabulary."""
    rows = live_keys(corpus).withColumn("lang", F.lit("(context)"))
    none = F.coalesce("context", F.lit("")) == ""
    fields = [F.when(X.context_body("context", f).isNull(), F.lit(f"missing {f}")) for f in ("Surface", "Type", "Context")]
    role = first_role("context")
    items = F.when(none, F.array(F.lit("no context"))).otherwise(F.array_compact(F.array(*fields, F.when(role.isNotNull() & ~role.isin(*types), F.concat(F.lit("unknown role: "), role)))))
    return rows.select("rec_id", "lang", F.lit("context-coverage").alias("code"), F.explode(items).alias("token"))


def key_name_grammar(corpus: Corpus) -> DataFrame:
    rows = live_keys(corpus).where("key_name IS NOT NULL").withColumn("lang", F.lit("(key)"))
    return _warn(rows, ~X.valid_key_name("key_name"), "key-name", F.col("key_name"))


def reuse_candidates(corpus: Corpus) -> DataFrame:
    """(text, n, rec_id, key, platforms): keys whose source text, folded and stripped, n keys have, n over 1. A row a key."""
    rows = source_texts(corpus)
    counts = rows.groupBy("text").agg(F.count("*").alias("n")).where("n > 1")
    return rows.join(counts, "text").select("text", "n", "rec_id", "key", "platforms")


def platform_suggestions(corpus: Corpus, platform: str) -> DataFrame:
    """Keys whose source text another key already carries on the platform, which they lack."""
    rows = source_texts(corpus).withColumn("has", X.has_platform("platforms", platform))
    carried = rows.where("has").select("text").distinct()
    return rows.where("NOT has").join(carried, "text", "left_semi").select("rec_id", "key", "text")

"""Lints over values, contexts, URLs and placeholders. Each gives findings, a row each; none needs a UDF.

Scope: archived keys are skipped. A language filter is applied to the findings, never before a check that compares the
languages of a key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lingspan.functions import text as X
from lingspan.schema import OPTIONAL_CONTEXT_FIELDS, SOURCE_LANG, Corpus
from lingspan.tables import materialize

_ITEM = "struct<severity:string,code:string,token:string>"


def _item(when: Column, severity: Column | str, code: str, token: Column | str) -> Column:
    s = F.lit(severity) if isinstance(severity, str) else severity
    t = F.lit(token) if isinstance(token, str) else token
    return F.when(when, F.struct(s.alias("severity"), F.lit(code).alias("code"), t.alias("token")).cast(_ITEM))


def _items(tokens: Column, severity: str, code: str) -> Column:
    return F.transform(tokens, lambda t: F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code"), t.alias("token")).cast(_ITEM))


def _findings(rows: DataFrame, items: Column, text: Column | str) -> DataFrame:
    found = rows.select("rec_id", "key", "lang", F.explode(items).alias("f"), (F.col(text) if isinstance(text, str) else text).alias("_text"))
    return found.select("rec_id", "key", "lang", "f.severity", "f.code", "f.token", X.snippet("_text").alias("snippet"))


def in_langs(findings: DataFrame, langs: list[str] | None) -> DataFrame:
    return findings if langs is None else findings.where(F.col("lang").isin(*langs))


def live_keys(corpus: Corpus) -> DataFrame:
    return corpus.keys.where(~F.coalesce("archived", F.lit(False))).withColumn("key", X.display_key("key_name", "key_by_platform"))


def live_values(corpus: Corpus, *columns: str) -> DataFrame:
    """Values of keys that aren't archived, with the key's display name; keys are the small side when Spark finds so."""
    return corpus.translations.join(live_keys(corpus).select("rec_id", "key", *columns), "rec_id")


def value_items(value: Column | str) -> Column:
    """Hygiene of one value, as an array of items; also fit for streams."""
    opens, closes = X.parens(value)
    gap = X.longest_gap(value)
    v = F.col(value) if isinstance(value, str) else value
    single = F.array_compact(F.array(
        _item(v.contains(X.EM_DASH), "error", "em-dash", X.EM_DASH),
        _item(opens != closes, "warn", "paren-balance", F.format_string("(%d/%d)", opens, closes)),
        _item(X.edge_side(value).isNotNull(), "warn", "edge-whitespace", X.edge_side(value)),
        _item(gap.isNotNull(), "warn", "double-space", F.format_string("%d spaces", gap)),
    ))
    return F.concat(single, _items(F.transform(X.invisible_spaces(value), X.space_name), "error", "invisible-space"))


def values_found(rows: DataFrame) -> DataFrame:
    """Findings of value_items in rows (rec_id, key, lang, value), of a table or a stream."""
    return _findings(rows, value_items("value"), "value")


def lint_values(corpus: Corpus, langs: list[str] | None = None) -> DataFrame:
    return in_langs(values_found(live_values(corpus)), langs)


def script_found(rows: DataFrame) -> DataFrame:
    """Cyrillic in source values of rows (rec_id, key, lang, value), of a table or a stream."""
    run = X.cyrillic_run("value")
    return _findings(rows.where(F.col("lang") == SOURCE_LANG), F.array_compact(F.array(_item(run.isNotNull(), "error", "cyrillic-in-source", run))), "value")


def lint_source_script(corpus: Corpus) -> DataFrame:
    return script_found(live_values(corpus))


def lint_context(corpus: Corpus) -> DataFrame:
    return contexts_found(live_keys(corpus))


def contexts_found(rows: DataFrame) -> DataFrame:
    """Empty fields and Cyrillic phrases in contexts of rows (rec_id, key, context), of a table or a stream."""
    rows = rows.where(F.coalesce("context", F.lit("")) != "").withColumn("lang", F.lit("(context)"))
    empty = [_item(X.strip(X.context_body("context", f)) == "", "error", "context-empty-field", f) for f in OPTIONAL_CONTEXT_FIELDS]
    phrase = _item(X.has_loose_cyrillic_phrase("context"), "error", "context-cyrillic-block", "Cyrillic phrase (multi-word)")
    return _findings(rows, F.array_compact(F.array(*empty, phrase)), "context")


def _flat(corpus: Corpus) -> DataFrame:
    """Flat values that aren't blank: what group checks compare."""
    return live_values(corpus).where((F.col("form") == "") & (X.strip("value") != ""))


def _reference(rows: DataFrame, column: str, count_empty: bool) -> DataFrame:
    """rows plus ref: the source's value of `column`, else the most frequent one of the key, the one of the first
    language on ties. One shuffle by key, shared with the window that reads it."""
    key = Window.partitionBy("rec_id")
    has_source = F.max((F.col("lang") == SOURCE_LANG).cast("int")).over(key) == 1
    source = F.max(F.when(F.col("lang") == SOURCE_LANG, F.struct(F.col(column).alias("v")))).over(key)["v"]
    counted = F.lit(True) if count_empty else F.size(column) > 0
    same = F.sum(counted.cast("int")).over(Window.partitionBy("rec_id", column))
    first = F.min("lang").over(Window.partitionBy("rec_id", column))
    rows = rows.withColumns({"_n": same, "_first": first})
    best = F.min(F.when(counted, F.struct((-F.col("_n")).alias("n"), F.col("_first").alias("f"), F.col(column).alias("v")))).over(key)["v"]
    return rows.withColumn("ref", F.when(has_source, source).otherwise(F.coalesce(best, F.array().cast("array<string>")))).drop("_n", "_first")


def _of_keys_with(rows: DataFrame, column: str) -> DataFrame:
    """Narrow rows of the keys that have anything in `column` in any language. The window's shuffle by key is the one that
    comparisons need anyway, so values are read once and never shuffled."""
    some = F.max(F.size(column)).over(Window.partitionBy("rec_id"))
    return rows.withColumn("_some", some).where("_some > 0").drop("_some")


def lint_urls(corpus: Corpus, langs: list[str] | None = None) -> DataFrame:
    """Links that differ from the source's."""
    rows = _flat(corpus).select("rec_id", "key", "lang", X.urls("value").alias("urls"))
    rows = _reference(_of_keys_with(rows, "urls"), "urls", count_empty=True)
    said = lambda c: F.when(F.size(c) == 0, "none").otherwise(F.array_join(c, ", "))
    bad = rows.where(F.col("urls") != F.col("ref"))
    found = bad.select("rec_id", "key", "lang", F.lit("warn").alias("severity"), F.lit("url-mismatch").alias("code"), said("urls").alias("token"), F.concat(F.lit("has "), said("urls"), F.lit(f", {SOURCE_LANG} has "), said("ref")).alias("snippet"))
    return in_langs(found, langs)


def companions(corpus: Corpus) -> DataFrame:
    """Names that own a `name::variable` plural companion."""
    return key_names(corpus).where(F.col("name").contains("::")).select(F.substring_index("name", "::", 1).alias("name")).distinct()


def key_names(corpus: Corpus) -> DataFrame:
    """(rec_id, name): every distinct non-empty name of a key."""
    names = F.array_distinct(F.concat(F.array("key_name"), F.coalesce(F.map_values("key_by_platform"), F.array().cast("array<string>"))))
    return corpus.keys.select("rec_id", F.explode(names).alias("name")).where("name <> ''")


def lint_placeholders(corpus: Corpus, langs: list[str] | None = None) -> DataFrame:
    """Tokens of a value that the corpus does not allow; wrapped ones and substitution variables are peeled off first."""
    rows = live_values(corpus, "platforms").where(F.col("value").contains("%"))
    owners = key_names(corpus).join(companions(corpus), "name", "left_semi").select("rec_id").distinct().withColumn("paired", F.lit(True))
    return in_langs(placeholders_found(rows.join(owners, "rec_id", "left")), langs)


def placeholders_found(rows: DataFrame) -> DataFrame:
    """lint_placeholders in rows (rec_id, key, lang, value, platforms, paired), of a table or a stream; `paired` says that the key owns
    a plural companion."""
    none = F.size("platforms") == 0
    runtime = none | F.arrays_overlap("platforms", F.array(F.lit("ios"), F.lit("android")))
    leaks = none | (F.size(F.array_except("platforms", F.array(F.lit("ios")))) > 0)
    variables = X.matches("value", X.STRINGSDICT)
    rest = X.without_wrapped("value")
    plain = F.replace(rest, F.lit("%%"), F.lit(""))
    items = F.concat(
        F.when(F.col("paired"), F.array().cast(f"array<{_ITEM}>")).otherwise(_items(variables, "warn", "stringsdict")),
        F.array_compact(F.array(
            _item(rest.contains("%%"), F.when(leaks, "error").otherwise("warn"), "literal-percent-escape", "%%"),
            _item(runtime & F.regexp_replace(plain, X.BARE, "").contains("%"), "error", "lone-percent", "%"),
        )),
        F.when(F.size(variables) > 0, F.array().cast(f"array<{_ITEM}>")).otherwise(_items(X.matches(plain, X.BARE), "error", "bare-placeholder")),
    )
    return _findings(rows, items, "value")


def _with_tokens(corpus: Corpus) -> DataFrame:
    """(rec_id, key, lang, tokens) of flat values; only a value with an opening mark is looked through."""
    tokens = F.when(F.col("value").contains("[%"), X.universal_tokens("value")).otherwise(F.array().cast("array<string>"))
    return _flat(corpus).select("rec_id", "key", "lang", tokens.alias("tokens"))


def lint_placeholder_count(corpus: Corpus, langs: list[str] | None = None) -> DataFrame:
    rows = _of_keys_with(_with_tokens(corpus), "tokens").withColumn("types", F.array_sort(F.transform("tokens", X.placeholder_type)))
    rows = _reference(rows, "types", count_empty=False).where(F.col("types") != F.col("ref"))
    got, ref = X.multiset_text(F.col("types")), X.multiset_text(F.col("ref"))
    found = rows.select("rec_id", "key", "lang", F.lit("error").alias("severity"), F.lit("placeholder-count").alias("code"), got.alias("token"), F.concat(F.lit("has "), got, F.lit(f", {SOURCE_LANG} has "), ref).alias("snippet"))
    return in_langs(found, langs)


def lint_placeholder_indexing(corpus: Corpus, langs: list[str] | None = None) -> DataFrame:
    """Of languages with two placeholders or more: bare ones beside indexed ones, or all bare."""
    key = Window.partitionBy("rec_id")
    rows = _with_tokens(corpus).where(F.size("tokens") >= 2).withColumn("indexed", F.exists("tokens", X.is_indexed))
    rows = rows.withColumns({"some_indexed": F.max("indexed").over(key), "nth": F.row_number().over(key.orderBy("indexed", (F.col("lang") != SOURCE_LANG), "lang"))})
    rows = rows.where(~F.col("indexed") & (F.col("some_indexed") | (F.col("nth") == 1)))
    mixed, uniform = "bare and numbered tokens are mixed over the languages of this key; number them all", "several bare tokens; number them so that a translation may change their order"
    found = rows.select(
        "rec_id", "key", "lang", F.when(F.col("some_indexed"), "error").otherwise("warn").alias("severity"), F.lit("placeholder-indexing").alias("code"),
        F.lit("[%s]").alias("token"), F.when(F.col("some_indexed"), mixed).otherwise(uniform).alias("snippet"),
    )
    return in_langs(found, langs)


def lint_all(corpus: Corpus, langs: list[str] | None = None) -> DataFrame:
    parts = [f(corpus, langs) for f in (lint_values, lint_urls, lint_placeholders, lint_placeholder_count, lint_placeholder_indexing)]
    return reduce(DataFrame.unionByName, [*parts, in_langs(lint_source_script(corpus), langs), lint_context(corpus)])


def has_errors(findings: DataFrame, strict: bool = False) -> bool:
    return not (findings if strict else findings.where("severity = 'error'")).isEmpty()


def gate(corpus: Corpus, touched: list[str], strict: bool = False) -> tuple[DataFrame, bool]:
    """Findings of the languages a push touches, and whether the push may go on. They are written once, and read for the answer
    and by whoever sorts or prints them; else each would lint the whole corpus again."""
    found = materialize(lint_all(corpus, touched), "findings")
    return found, not has_errors(found, strict)


def ordered(findings: DataFrame) -> DataFrame:
    """Errors first, then by code, key and language."""
    return findings.orderBy(F.col("severity") != "error", "code", "key", "lang", "token")


def report(findings: DataFrame) -> DataFrame:
    return ordered(findings).select(F.format_string("%-5s %s %s [%s] %s: %s", "severity", "code", "key", "lang", "token", "snippet").alias("line"))


def summary(findings: DataFrame) -> DataFrame:
    return findings.agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warn").alias("warnings"), F.count_distinct("rec_id").alias("keys"))


def cube(findings: DataFrame) -> DataFrame:
    """Counts by every combination of code, language and severity; null stands for all."""
    return findings.cube("code", "lang", "severity").agg(F.count("*").alias("findings"))

"""Backlogs, coverage, review batches and quality flags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lingspan.functions import text as X
from lingspan.schema import CO_SOURCE_LANG, SOURCE_LANG, Corpus
from lingspan.tables import free_names, materialize


def known_langs(corpus: Corpus) -> DataFrame:
    return corpus.translations.select("lang").distinct()


def unknown_langs(corpus: Corpus, requested: DataFrame) -> DataFrame:
    """(lang, hint): requested languages the corpus lacks; the hint is a known code that differs in the separator."""
    known = known_langs(corpus)
    lost = requested.select("lang").distinct().join(known, "lang", "left_anti")
    return lost.withColumn("other", X.swap_separator("lang")).join(known.select(F.col("lang").alias("other"), F.col("lang").alias("hint")), "other", "left").select("lang", "hint")


def duplicate_names(names: DataFrame) -> DataFrame:
    """names (rec_id, name) -> names that several keys carry."""
    return names.groupBy("name").agg(F.count("*").alias("n")).where("n > 1")


def flat_text(corpus: Corpus) -> DataFrame:
    """(rec_id, lang, text): of plural values the form 'other', else the first form; missing values have no row."""
    order = F.array_position(F.array(*[F.lit(f) for f in ("zero", "one", "two", "few", "many", "other")]), F.col("form"))
    # Flags repeat on a language's forms, so any true counts.
    return corpus.translations.groupBy("rec_id", "lang").agg(
        F.coalesce(F.max(F.when(F.col("form") == "other", F.col("value"))), F.min_by("value", order)).alias("text"),
        F.bool_or("is_unverified").alias("is_unverified"), F.bool_or("is_dirty").alias("is_dirty"), F.bool_or(F.col("form") != "").alias("plural"),
    )


def backlog_status(text: Column, unverified: Column) -> Column:
    return F.when(text.isNull(), "missing").when(text == "", "empty").when(unverified, "unverified")


def backlog(corpus: Corpus, lang: str, platform: str | None = None) -> DataFrame:
    """Keys whose translation into lang is missing, empty or unverified, with source and co-source."""
    keys = corpus.keys.where(X.has_platform("platforms", platform)) if platform else corpus.keys
    texts = flat_text(corpus).where(F.col("lang").isin(lang, SOURCE_LANG, CO_SOURCE_LANG))
    wide = texts.groupBy("rec_id").agg(
        F.max(F.when(F.col("lang") == lang, F.col("text"))).alias("target"),
        F.coalesce(F.bool_or(F.when(F.col("lang") == lang, F.col("is_unverified"))), F.lit(False)).alias("is_unverified"),
        F.max(F.when(F.col("lang") == SOURCE_LANG, F.col("text"))).alias("source"),
        F.max(F.when(F.col("lang") == CO_SOURCE_LANG, F.col("text"))).alias("co_source"),
    )
    rows = keys.join(wide, "rec_id", "left").withColumn("status", backlog_status(F.col("target"), F.col("is_unverified")))
    return rows.where("status IS NOT NULL").select("rec_id", "key_id", "ord", X.display_key("key_name", "key_by_platform").alias("key"), "platforms", "plural", "context", "status", "source", "co_source", "target")


def backlog_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("status").agg(F.count("*").alias("n"))


def coverage(corpus: Corpus) -> DataFrame:
    """Keys present by language; an empty value is present."""
    return corpus.translations.groupBy("lang").agg(F.count_distinct("rec_id").alias("present"))


def without_source(corpus: Corpus) -> DataFrame:
    return corpus.keys.join(corpus.translations.where(F.col("lang") == SOURCE_LANG).select("rec_id").distinct(), "rec_id", "left_anti")


def numbered(rows: DataFrame, *order: Column | str, by: str | None = None, name: str = "entry") -> DataFrame:
    """rows plus a number from 1 in the given order, without a window over all rows: ranges are sorted by themselves and
    written once, with the range and place of each row, so that rows and counts are of the same ranges; then each range is
    shifted by the rows before it. by: a column whose groups number on their own, however many rows one has; null is a
    group. Ties are in any order."""
    part, row, own, of, group, n, first, before = free_names(rows.columns, "part", "row", "own", "of", "group", "n", "first", "before")
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    keys = [F.col(by), *cols] if by is not None else cols
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    told = materialize(ranged.withColumns({part: F.spark_partition_id(), row: F.monotonically_increasing_id()}), "ranges")
    member = F.col(by) if by is not None else F.lit(0)
    parts = told.groupBy(part, member.alias(group)).agg(F.count("*").alias(n), F.min(row).alias(first))  # a row a range and group
    earlier = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn(before, F.coalesce(F.sum(n).over(earlier), F.lit(0))).select(F.col(part).alias(of), group, first, before)
    joined = told.withColumn(own, member).join(parts, (F.col(part) == F.col(of)) & F.col(own).eqNullSafe(F.col(group)))
    return joined.withColumn(name, F.col(before) + F.col(row) - F.col(first) + 1).drop(part, of, row, own, group, first, before)


def slice_of(rows: DataFrame, start: int, end: int, name: str = "entry") -> DataFrame:
    """Entries start to end, both included; an error if the range is not inside."""
    if start < 1 or end < start:
        raise ValueError(f"no range: {start}-{end}")
    last = rows.agg(F.max(name)).first()[0] or 0
    if end > last:
        raise ValueError(f"range {start}-{end} is beyond the last entry, {last}")
    return rows.where(F.col(name).between(start, end))


def batches(rows: DataFrame, size: int, *order: Column | str, by: str) -> DataFrame:
    """rows plus entry and batch, from 1, for each group of `by`."""
    return numbered(rows, *order, by=by).withColumn("batch", F.ceil(F.col("entry") / size).cast("int"))


def corpus_order() -> list[Column]:
    return [F.col("key_id").asc_nulls_last(), F.col("ord")]


def search(corpus: Corpus, key: list[str] = (), en: list[str] = (), context: list[str] = ()) -> DataFrame:
    """Keys that hold, in each field asked for, one of its pieces; case does not matter."""
    rows = corpus.keys.join(flat_text(corpus).where(F.col("lang") == SOURCE_LANG).select("rec_id", F.col("text").alias("en")), "rec_id", "left")
    rows = rows.withColumn("_names", F.concat_ws(" ", "key_name", F.map_values(F.coalesce("key_by_platform", F.create_map().cast("map<string,string>")))))
    for column, pieces in (("_names", key), ("en", en), ("context", context)):
        if pieces:
            rows = rows.where(reduce(Column.__or__, [F.coalesce(F.lower(column).contains(p.lower()), F.lit(False)) for p in pieces]))
    return rows.drop("_names")


def search_slug(key: list[str] = (), en: list[str] = (), context: list[str] = ()) -> Column:
    """Eight hex digits that name a set of filters."""
    said = "|".join(f"{n}={','.join(sorted(p.lower() for p in v))}" for n, v in (("key", key), ("en", en), ("context", context)))
    return F.substring(F.sha1(F.lit(said).cast("binary")), 1, 8)


def side_by_side(corpus: Corpus, langs: list[str], platform: str | None = None, keys: DataFrame | None = None) -> DataFrame:
    """A row a key, a column a language: source and co-source first, each once; null where missing."""
    shown = list(dict.fromkeys([SOURCE_LANG, CO_SOURCE_LANG, *langs]))
    rows = corpus.keys if keys is None else keys.select(corpus.keys.columns)
    rows = rows.where(X.has_platform("platforms", platform)) if platform else rows
    wide = flat_text(corpus).where(F.col("lang").isin(*shown)).groupBy("rec_id").pivot("lang", shown).agg(F.first("text"))
    return rows.select("rec_id", "key_id", "ord", X.display_key("key_name", "key_by_platform").alias("key"), "platforms", "context").join(wide, "rec_id", "left")


def audit_batch(corpus: Corpus, lang: str, start: int, end: int, platform: str | None = None) -> DataFrame:
    """Entries start to end of a review in corpus order. Numbers count keys without the target, which are not shown
    unless the source itself is reviewed."""
    rows = corpus.keys.where(X.has_platform("platforms", platform)) if platform else corpus.keys
    rows = slice_of(numbered(rows, *corpus_order()), start, end)
    texts = flat_text(corpus).where(F.col("lang").isin(lang, SOURCE_LANG, CO_SOURCE_LANG))
    wide = texts.groupBy("rec_id").pivot("lang", list(dict.fromkeys([SOURCE_LANG, CO_SOURCE_LANG, lang]))).agg(F.first("text"))
    rows = rows.join(wide, "rec_id", "left").withColumn("key", X.display_key("key_name", "key_by_platform"))
    return rows if lang == SOURCE_LANG else rows.where(F.col(lang).isNotNull())


def merge_qa_issues(passes: DataFrame) -> DataFrame:
    """passes (key_id, lang, issue, pass_ord, translation_id, value, qa), a row a flag -> a row for each (key, language)
    with its issues sorted; value and id of the first pass, the first detail there is."""
    first = F.struct("pass_ord")
    return passes.groupBy("key_id", "lang").agg(
        F.array_sort(F.collect_set("issue")).alias("issues"), F.min_by("translation_id", first).alias("translation_id"),
        F.min_by("value", first).alias("value"), F.min_by("qa", F.when(F.col("qa").isNotNull(), first)).alias("qa"),
    )


def qa_summary(flags: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Counts by issue; by language, the most first; and rows with detail."""
    by_issue = flags.select(F.explode("issues").alias("issue")).groupBy("issue").agg(F.count("*").alias("n"))
    by_lang = flags.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang")
    return by_issue, by_lang, flags.agg(F.count("*").alias("n"), F.count("qa").alias("with_detail"))


def qa_batches(corpus: Corpus, flags: DataFrame, size: int, platform: str | None = None) -> DataFrame:
    """Flags joined to their keys, numbered and cut into batches by language; status says 'no_key' or 'off_platform'
    for those that are not shown, drift that the flagged value is not the corpus's flat one."""
    texts = flat_text(corpus).select("rec_id", "lang", F.col("text").alias("corpus_value"), F.col("plural").alias("is_plural"))
    rows = flags.join(corpus.keys.select("key_id", "rec_id", "ord", "platforms", "context", X.display_key("key_name", "key_by_platform").alias("key")), "key_id", "left")
    fits = X.has_platform("platforms", platform) if platform else F.lit(True)
    rows = rows.withColumn("status", F.when(F.col("rec_id").isNull(), "no_key").when(~fits, "off_platform").otherwise("shown"))
    rows = rows.join(texts, ["rec_id", "lang"], "left")
    rows = rows.withColumn("drift", ~F.coalesce("is_plural", F.lit(False)) & ~F.col("value").eqNullSafe(F.col("corpus_value")))
    shown = batches(rows.where("status = 'shown'"), size, F.col("key_id").asc_nulls_last(), by="lang")
    return shown.unionByName(rows.where("status <> 'shown'"), allowMissingColumns=True)


def value_repr(value: Column, lang: str) -> Column:
    return F.coalesce(value, F.lit(f"<MISSING IN {lang}>"))


def render_review(rows: DataFrame, langs: list[str], number: str = "entry") -> DataFrame:
    """(entry, text): a block of text for each row; a missing value says so."""
    head = F.format_string("[%d] %s", number, "key")
    lines = [F.concat(F.lit("platforms: "), F.array_join("platforms", ", ")), F.when(F.coalesce("context", F.lit("")) != "", F.concat(F.lit("context: "), "context"))]
    lines += [F.concat(F.lit(f"{lang}: "), value_repr(F.col(lang), lang)) for lang in langs]
    return rows.select(F.col(number).alias("entry"), F.concat_ws("\n", head, *lines).alias("text"))

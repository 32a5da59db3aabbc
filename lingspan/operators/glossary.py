"""Glossaries: normalising, checking, rendering, reconciling and applying edits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lingspan.functions import text as X
from lingspan.schema import CO_SOURCE_LANG, SOURCE_LANG, TAG_VOCABULARY, Glossary


def normalize(glossary: Glossary) -> Glossary:
    """Stripped descriptions, no empty tags, notes or translations; a blank that isn't empty stays."""
    terms = glossary.terms.withColumns({
        "description": F.nullif(X.strip("description"), F.lit("")),
        "case_sensitive": F.coalesce("case_sensitive", F.lit(False)), "translatable": F.coalesce("translatable", F.lit(True)), "forbidden": F.coalesce("forbidden", F.lit(False)),
        "tags": F.filter(F.coalesce("tags", F.array().cast("array<string>")), lambda t: t != ""),
    })
    texts = glossary.texts.withColumns({"text": F.nullif("text", F.lit("")), "note": F.nullif("note", F.lit(""))})
    return Glossary(terms, texts.where("text IS NOT NULL OR note IS NOT NULL"))


def glossary_order() -> list[Column]:
    return [X.casefold("term"), F.col("term")]


def duplicates(terms: DataFrame) -> DataFrame:
    """(term, n, kind): 'exact', or 'case' for terms that differ only in case, under the folded form."""
    exact = terms.groupBy("term").agg(F.count("*").alias("n"))
    folded = exact.groupBy(X.casefold("term").alias("term")).agg(F.sum("n").alias("n"), F.count("*").alias("kinds"))
    return exact.where("n > 1").withColumn("kind", F.lit("exact")).unionByName(folded.where("kinds > 1").select("term", "n", F.lit("case").alias("kind")))


def lint_glossary(glossary: Glossary, known_langs: list[str]) -> DataFrame:
    """(severity, term, problem)"""
    item = lambda when, severity, problem: F.when(when, F.struct(F.lit(severity).alias("severity"), problem.alias("problem") if isinstance(problem, Column) else F.lit(problem).alias("problem")))
    g = normalize(glossary)
    empty = F.coalesce("term", F.lit("")) == ""
    tags = F.transform(F.filter("tags", lambda t: ~t.isin(*TAG_VOCABULARY)), lambda t: F.struct(F.lit("warn").alias("severity"), F.concat(F.lit("tag not in vocabulary: "), t).alias("problem")))
    of_term = F.when(empty, F.array(item(F.lit(True), "error", "empty term"))).otherwise(F.concat(F.array_compact(F.array(
        item(~F.col("translatable") & F.col("forbidden"), "error", "frozen and forbidden"),
        item(F.size("tags") > 3, "error", F.concat(F.size("tags").cast("string"), F.lit(" tags, at most 3"))),
        item(F.col("description").isNull(), "warn", "no description"),
    )), tags))
    rows = g.terms.select("term", F.explode(of_term).alias("i")).select("i.severity", "term", "i.problem")
    of_text = F.array_compact(F.array(
        item(F.col("text").isNotNull() & (F.col("lang") == SOURCE_LANG), "warn", "source form repeated"),
        item(F.col("text").isNotNull() & (F.col("lang") != SOURCE_LANG) & ~F.col("lang").isin(*known_langs), "error", F.concat(F.lit("unknown language: "), "lang")),
        item(F.col("text").isNull() & F.col("note").isNotNull(), "warn", F.concat(F.lit("note without translation: "), "lang")),
    ))
    texts = g.texts.select("term", F.explode(of_text).alias("i")).select("i.severity", "term", "i.problem")
    dup = duplicates(g.terms.where(~empty)).select(F.when(F.col("kind") == "exact", "error").otherwise("warn").alias("severity"), "term", F.when(F.col("kind") == "exact", F.concat(F.lit("duplicate term x"), F.col("n").cast("string"))).otherwise("differs only in case").alias("problem"))
    return rows.unionByName(texts).unionByName(dup)


def used_langs(glossary: Glossary) -> DataFrame:
    return glossary.texts.where("text IS NOT NULL").select("lang").distinct()


def missing_lang_ids(glossary: Glossary, lang_map: DataFrame) -> DataFrame:
    return used_langs(glossary).join(lang_map, "lang", "left_anti")


def _flag(column: str) -> Column:
    return F.when(F.col(column), "yes").otherwise("no")


def to_csv(glossary: Glossary, langs: list[str] | None = None, notes: bool = True) -> DataFrame:
    """(position, line): a header, then terms in order. Without `langs` only languages that have a translation get a
    column, since an empty cell would delete what is stored; a note column only where there is a note."""
    g = normalize(glossary)
    langs = langs if langs is not None else sorted(r[0] for r in used_langs(g).collect())  # languages are a handful
    with_note = sorted({r[0] for r in g.texts.where("note IS NOT NULL").select("lang").distinct().collect()} & set(langs)) if notes else []
    wide = g.texts.where(F.col("lang").isin(*langs)).groupBy("term").agg(
        F.lit(1).alias("_"), *[F.max(F.when(F.col("lang") == x, F.col("text"))).alias(f"t_{x}") for x in langs], *[F.max(F.when(F.col("lang") == x, F.col("note"))).alias(f"n_{x}") for x in with_note]
    )
    rows = g.terms.join(wide, "term", "left")
    cell = lambda c: F.coalesce(c, F.lit(""))
    quoted = lambda c: F.when(c.rlike('[;"\r\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)
    cells = ["term", "description", _flag("case_sensitive"), _flag("translatable"), _flag("forbidden"), F.array_join("tags", ","), *[f"t_{x}" for x in langs], *[f"n_{x}" for x in with_note]]
    line = F.array_join(F.array(*[quoted(cell(F.col(c) if isinstance(c, str) else c)) for c in cells]), ";")
    header = ";".join(["term", "description", "casesensitive", "translatable", "forbidden", "tags", *langs, *[f"{x}_description" for x in with_note]])
    spark = glossary.terms.sparkSession
    body = rows.select(F.lit(1).alias("position"), *[c.alias(n) for n, c in zip(("o1", "o2"), glossary_order())], line.alias("line"))
    return spark.createDataFrame([(0, "", "", header)], body.schema).unionByName(body).orderBy("position", "o1", "o2").select("position", "line")


def payloads(glossary: Glossary, lang_map: DataFrame) -> DataFrame:
    """lang_map (lang, lang_id) -> (term, term_id, payload): API objects; languages without an id are skipped."""
    g = normalize(glossary)
    said = g.texts.where("text IS NOT NULL").join(F.broadcast(lang_map), "lang")  # a project's languages
    said = said.groupBy("term").agg(F.transform(F.array_sort(F.collect_list(F.struct("lang", F.struct(F.col("lang_id").alias("langId"), F.col("text").alias("translation"), F.col("note").alias("description")).alias("o")))), lambda x: x["o"]).alias("translations"))
    rows = g.terms.join(said, "term", "left")
    body = F.struct(F.col("term_id").alias("id"), "term", F.coalesce("description", F.lit("")).alias("description"), F.col("case_sensitive").alias("caseSensitive"), "translatable", "forbidden", "tags", "translations")
    return rows.select("term", "term_id", F.to_json(body).alias("payload"))


def from_service(raw: DataFrame, lang_map: DataFrame) -> Glossary:
    """raw (id, term, description, caseSensitive, translatable, forbidden, tags, translations[{langId, translation,
    description}]), flags as text."""
    terms = raw.select(
        "term", F.col("id").cast("bigint").alias("term_id"), "description", X.truthy("caseSensitive").alias("case_sensitive"),
        X.falsy_or("translatable", True).alias("translatable"), X.truthy("forbidden").alias("forbidden"), F.coalesce("tags", F.array().cast("array<string>")).alias("tags"),
    )
    texts = raw.select("term", F.explode("translations").alias("t")).select("term", F.col("t.langId").cast("bigint").alias("lang_id"), F.col("t.translation").alias("text"), F.col("t.description").alias("note"))
    return normalize(Glossary(terms, texts.join(F.broadcast(lang_map), "lang_id").select("term", "lang", "text", "note")))  # a project's languages


def upsert_plan(glossary: Glossary, remote: DataFrame) -> DataFrame:
    """remote (term_id, term) -> local terms with remote_id, action (update or create) and stamp (the id is new here).
    A remote id matches first, then the exact term. Remote terms named twice are reported by remote_duplicates."""
    by_id = remote.select("term_id", F.col("term_id").alias("id_hit")).where("term_id IS NOT NULL").distinct()
    by_term = remote.groupBy("term").agg(F.max("term_id").alias("term_hit"))
    rows = normalize(glossary).terms.join(by_id, "term_id", "left").join(by_term, "term", "left").withColumn("remote_id", F.coalesce("id_hit", "term_hit"))
    return rows.select("term", "term_id", "remote_id", F.when(F.col("remote_id").isNull(), "create").otherwise("update").alias("action"), (F.col("remote_id").isNotNull() & ~F.col("remote_id").eqNullSafe(F.col("term_id"))).alias("stamp"))


def remote_duplicates(remote: DataFrame) -> DataFrame:
    return remote.where("term <> ''").groupBy("term").agg(F.count("*").alias("n")).where("n > 1")


def stamp_ids(glossary: Glossary, ids: DataFrame) -> Glossary:
    """ids (term, new_id) from the plan and the service's answers."""
    rows = glossary.terms.join(ids.groupBy("term").agg(F.max("new_id").alias("new_id")), "term", "left")
    return Glossary(rows.withColumn("term_id", F.coalesce("new_id", "term_id")).select(glossary.terms.columns), glossary.texts)


def verify_glossary(local: Glossary, remote: Glossary) -> DataFrame:
    """(term, problems): what is not stored as it is here; languages that only the remote side has don't count."""
    a, b = normalize(local), normalize(remote)
    texts = a.texts.where("text IS NOT NULL").join(b.texts.select("term", "lang", F.col("text").alias("r_text"), F.col("note").alias("r_note")), ["term", "lang"], "left")
    bad = texts.where(~F.col("text").eqNullSafe(F.col("r_text")) | ~F.col("note").eqNullSafe(F.col("r_note"))).groupBy("term").agg(F.array_sort(F.collect_set(F.concat(F.lit("translation "), "lang"))).alias("t_bad"))
    names = ("term_id", "description", "case_sensitive", "translatable", "forbidden", "tags")
    rows = a.terms.join(b.terms.select("term", *[F.col(c).alias(f"r_{c}") for c in names], F.lit(True).alias("_there")), "term", "left").join(bad, "term", "left")
    differs = [F.when(~(F.array_sort(c) if c == "tags" else F.col(c)).eqNullSafe(F.array_sort(f"r_{c}") if c == "tags" else F.col(f"r_{c}")), F.lit(c)) for c in names if c != "term_id"]
    problems = F.when(F.col("_there").isNull(), F.array(F.lit("missing"))).otherwise(F.concat(F.array_compact(F.array(*differs)), F.coalesce("t_bad", F.array().cast("array<string>"))))
    return rows.select("term", problems.alias("problems")).where(F.size("problems") > 0)


def apply_edits(glossary: Glossary, edits: DataFrame, known_langs: list[str]) -> tuple[Glossary, DataFrame]:
    """edits (term, lang, text) on terms that exist; an empty text clears. The report says applied, unmatched,
    source_language or unknown_language."""
    there = glossary.terms.select("term").distinct().withColumn("_there", F.lit(True))
    report = edits.join(there, "term", "left").withColumn(
        "status",
        F.when(F.col("lang") == SOURCE_LANG, "source_language").when(~F.col("lang").isin(*known_langs), "unknown_language").when(F.col("_there").isNull(), "unmatched").otherwise("applied"),
    ).drop("_there")
    new = report.where("status = 'applied'").select("term", "lang", F.struct("text").alias("e"))
    rows = glossary.texts.join(new, ["term", "lang"], "full_outer")
    rows = rows.select("term", "lang", F.when(F.col("e").isNotNull(), F.nullif("e.text", F.lit(""))).otherwise(F.col("text")).alias("text"), "note")
    return Glossary(glossary.terms, rows.where("text IS NOT NULL OR note IS NOT NULL")), report


def checklist(glossary: Glossary, lang: str) -> DataFrame:
    """(section, term, line): what a reviewer of a language checks; freezes, brands, forbidden and canonical terms."""
    g = normalize(glossary)
    said = g.texts.where(F.col("lang") == lang).select("term", "text", "note")
    co = g.texts.where(F.col("lang") == CO_SOURCE_LANG).select("term", F.col("text").alias("co"))
    rows = g.terms.join(said, "term", "left").join(co, "term", "left")
    section = F.when(~F.col("translatable"), "1 freeze").when(F.array_contains("tags", "brand"), "2 brand").when(F.col("forbidden"), "3 forbidden").otherwise(F.concat(F.lit("4 "), X.primary_tag("tags")))
    value = F.when(~F.col("translatable"), F.col("term")).otherwise(F.coalesce("text", F.lit("<none>")))
    extra = F.coalesce("note", "description")
    line = F.concat_ws(" - ", F.concat("term", F.lit(" -> "), value), F.when(F.col("case_sensitive"), "case-sensitive"), X.one_line(extra))
    return rows.select(section.alias("section"), "term", line.alias("line")).orderBy("section", *glossary_order())


def checklist_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("section").agg(F.count("*").alias("n"))


def _words(text: str) -> Column:
    return F.filter(F.split(F.lower(text), r"(?U)[^\w]+"), lambda w: w != "")


def anchors(terms: DataFrame, words: DataFrame) -> DataFrame:
    """terms (term, parts) and words (word, ...), a row for each text that has the word -> (term, word): of each term's words
    the one that the fewest texts have, the first of equally rare ones. A term with a word that no text has is not in it."""
    parts = terms.select("term", F.explode(F.array_distinct("parts")).alias("word"))
    rare = words.groupBy("word").agg(F.count("*").alias("texts"))
    ranked = parts.join(rare, "word", "left").groupBy("term").agg(F.min(F.struct(F.coalesce("texts", F.lit(0)).alias("texts"), "word")).alias("m"))
    return ranked.where("m.texts > 0").select("term", "m.word")


def term_places(terms: DataFrame, sources: DataFrame) -> DataFrame:
    """terms (term, parts) and distinct sources (rec_id, source) -> (rec_id, term) where the words of a term stand in a row. A text
    gives the hashes of its runs of words, of the lengths that terms have; a run that meets a term's is compared in the
    whole text. Equal terms and equal texts are matched once."""
    padded = lambda c: F.concat(F.lit(" "), F.array_join(c, " "), F.lit(" "))
    known = terms.select("term", F.xxhash64(F.size("parts"), F.array_join("parts", " ")).alias("run"), padded("parts").alias("phrase")).distinct()
    lengths = F.coalesce(terms.agg(F.collect_set(F.size("parts"))).scalar(), F.array().cast("array<int>"))  # as many as terms differ in length
    texts = sources.select("source").distinct().select(F.md5("source").alias("text_id"), _words("source").alias("said"))
    run = "transform(filter(sequence(0, greatest(size(z) - n, 0)), i -> i + n <= size(z)), i -> xxhash64(n, array_join(slice(z, i + 1, n), ' ')))"
    runs = F.array_distinct(F.expr(f"flatten(get(transform(array(said), z -> transform(lengths, n -> {run})), 0))"))
    places = texts.withColumn("lengths", lengths).select("text_id", F.explode_outer(runs).alias("run")).where("run IS NOT NULL").join(known, "run")
    places = places.join(texts, "text_id").where(padded("said").contains(F.col("phrase"))).select("text_id", "term")
    return sources.select("rec_id", F.md5("source").alias("text_id")).join(places, "text_id").select("rec_id", "term")


def hits(glossary: Glossary, values: DataFrame) -> DataFrame:
    """values (rec_id, lang, source, value) -> (rec_id, lang, term, kind): a frozen term that the value lacks (freeze), a
    canonical rendering that it lacks (divergence), a forbidden term's rendering that it has (forbidden).

    A term meets the texts that have its words in a row, and no others, however many share some of its words. A term that
    the glossary has several times is looked for once; its findings are repeated at the end."""
    g = normalize(glossary)
    terms = g.terms.select("term", "translatable", "forbidden", _words("term").alias("parts")).where(F.size("parts") > 0)
    near = term_places(terms, values.select("rec_id", "source").distinct())
    found = near.join(terms.groupBy("term", "translatable", "forbidden").agg(F.count("*").cast("int").alias("times")), "term")
    rows = values.where((F.col("lang") != SOURCE_LANG) & (F.col("value") != "")).select("rec_id", "lang", "value").join(found, "rec_id").join(g.texts.select("term", "lang", "text"), ["term", "lang"], "left")
    has = lambda c: F.lower("value").contains(F.lower(c))
    kind = (
        F.when(~F.col("translatable") & ~has("term"), "freeze")
        .when(F.col("forbidden") & F.col("text").isNotNull() & has("text"), "forbidden")
        .when(F.col("translatable") & ~F.col("forbidden") & F.col("text").isNotNull() & ~has("text"), "divergence")
    )
    return rows.withColumn("kind", kind).where("kind IS NOT NULL").withColumn("_nth", F.explode(F.sequence(F.lit(1), "times"))).select("rec_id", "lang", "term", "kind")


def regenerate(raw: DataFrame, lang_map: DataFrame, known_langs: list[str]) -> tuple[Glossary, DataFrame]:
    """A glossary from a dump and its errors; a caller writes it only if there is none."""
    made = from_service(raw, lang_map)
    return made, lint_glossary(made, known_langs).where("severity = 'error'")


def first_of_term(rows: DataFrame, order: str) -> DataFrame:
    """The first row of each term."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy("term").orderBy(order))).where("_n = 1").drop("_n")

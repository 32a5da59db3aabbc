"""Where keys are used: references in source trees, keys without any, and contexts held against the code.

source_files (path, text) and source_lines (path, lineno, line) come from lingspan.sources.trees.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lingspan.functions import text as X
from lingspan.operators.lint import key_names, live_keys
from lingspan.operators.review import flat_text
from lingspan.schema import SOURCE_LANG, Corpus

# Patterns of references, by kind.
IOS_SITES = {"R.string": r"R\.string\.localizable\.([A-Za-z_][A-Za-z0-9_]*)", "NSLocalizedString": r'NSLocalizedString\(\s*"([^"]+)"'}
ANDROID_SITES = {"R.string": r"\bR\.string\.([A-Za-z_][A-Za-z0-9_]*)", "Strings": r"\bStrings\.([A-Za-z_][A-Za-z0-9_]*)", "@string": r"@string/([A-Za-z_][A-Za-z0-9_]*)"}
ANDROID_DEFINITION = r'<(?:string|plurals)\s+name="([^"]+)"'
IDENTIFIER = r"[A-Za-z_][A-Za-z0-9_]*"
CITED_FILE = r"\b([A-Za-z_][A-Za-z0-9_]*\.swift)\b"
CITED_TYPE = r"\b([A-Z][A-Za-z0-9_]+)\.[A-Za-z_]"
CITED_CAMEL = r"\b([A-Z][a-z0-9]+(?:[A-Z][a-z0-9]+){1,})\b"
ACCESSOR = r'\b(?:var|func)\s+([A-Za-z_][A-Za-z0-9_]*)\b.*?\.init\(key:\s*"((?:\\.|[^"\\])*)",\s*tableName:\s*"([^"]+)"'
TYPED = r"\bR\s*\.\s*string(?:\s*\([^)]*\))?\s*\.\s*([A-Za-z_][A-Za-z0-9_]*)\s*\.\s*([A-Za-z_][A-Za-z0-9_]*)\b"
OWNER = r"\bstrings\s*\.\s*([A-Za-z_][A-Za-z0-9_]*)\b"
CLOSURE = r"\$0\s*\.\s*([A-Za-z_][A-Za-z0-9_]*)\b"
LITERAL = r'"((?:\\.|[^"\\])*)"'
XML_VALUE = r"<(?:key|string)>([^<]+)</(?:key|string)>"
RESOURCE = r"@(?:[A-Za-z0-9_.]+:)?(?:array|plurals|string)/([A-Za-z0-9_.]+)"
R_FIELD = r"\bR\s*\.\s*string\s*\.\s*([A-Za-z_][A-Za-z0-9_]*)\b"
CLASS_IMPORT = r"(?m)^\s*import\s+[A-Za-z0-9_.]+\.R\.string(?:\s+as\s+([A-Za-z_][A-Za-z0-9_]*))?\s*$"
STATIC_IMPORT = r"(?m)^\s*import\s+[A-Za-z0-9_.]+\.R\.string\.([A-Za-z_][A-Za-z0-9_]*)\s*$"
DYNAMIC = (
    r'\b(?:defaultName|name|stringName)\s*=\s*"((?:\\.|[^"\\])*)"',
    r'\b(?:getStringIdentifier|getString)\(\s*"((?:\\.|[^"\\])*)"\s*\)',
    r'\bgetIdentifier\(\s*"((?:\\.|[^"\\])*)"\s*,\s*"string"\s*,',
)
POOLS = ("Localizable.strings", "Localizable.stringsdict", "InfoPlist.strings", "widget14.strings")
POOLS_OF_TABLE = {"infoPlist": ("InfoPlist.strings",), "localizable": ("Localizable.strings", "Localizable.stringsdict"), "widget14": ("widget14.strings",)}
POOLS_OF_SUFFIX = {".intentdefinition": ("widget14.strings",), ".plist": ("InfoPlist.strings",)}
CAP_TOLERANCE = 5


def _hits(rows: DataFrame, text: str, pattern: str, kind: str, *keep: str) -> DataFrame:
    return rows.select(*keep, F.explode(X.matches(text, pattern, 1)).alias("name"), F.lit(kind).alias("kind"))


def call_sites(lines: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """(path, lineno, name, kind) of every reference."""
    return reduce(DataFrame.unionByName, [_hits(lines, "line", p, k, "path", "lineno") for k, p in patterns.items()])


def identifiers(lines: DataFrame) -> DataFrame:
    """Distinct identifiers of code; XML gives none."""
    return lines.where(~F.col("path").endswith(".xml")).select(F.explode(F.array_distinct(X.matches("line", IDENTIFIER))).alias("name")).distinct()


def path_names(files: DataFrame) -> DataFrame:
    """File names, with and without .swift, and names of folders."""
    parts = F.split("path", "/")
    names = F.concat(parts, F.array(F.regexp_replace(F.element_at(parts, -1), r"\.swift$", "")))
    return files.select(F.explode(names).alias("name")).where("name <> ''").distinct()


def literal_sites(lines: DataFrame, names: DataFrame, limit: int = 5) -> DataFrame:
    """(name, path, lineno): lines with the name between two quotes, the first `limit` by path and line. The inner
    pieces of a line split at quotes are exactly what stands between two of them."""
    pieces = F.split("line", '"')
    inner = lines.where(F.size(pieces) > 2).select("path", "lineno", F.explode(F.array_distinct(F.slice(pieces, 2, F.size(pieces) - 2))).alias("name"))
    found = inner.join(names.select("name").distinct(), "name", "left_semi")
    nth = F.row_number().over(Window.partitionBy("name").orderBy("path", "lineno"))  # each task keeps `limit` a name before the shuffle
    return found.withColumn("_nth", nth).where(F.col("_nth") <= limit).drop("_nth")


def cited_symbols(keys: DataFrame, allow: tuple[str, ...] = (), allow_files: tuple[str, ...] = ("R.swift",)) -> DataFrame:
    """keys (rec_id, context) -> (rec_id, symbol, kind): what looks like code; the first of file, type, camel counts. allow:
    names that a context may cite though the code does not define them, such as those of the platform's own library."""
    one = lambda p, kind, rank: keys.select("rec_id", F.explode(F.array_distinct(X.matches("context", p, 1))).alias("symbol"), F.struct(F.lit(rank).alias("r"), F.lit(kind).alias("kind")).alias("k"))
    files = one(CITED_FILE, "file", 0).where(~F.col("symbol").isin(*allow_files))
    code = one(CITED_TYPE, "type", 1).unionByName(one(CITED_CAMEL, "camel", 2)).where(~F.col("symbol").isin(*allow))
    return files.unionByName(code).groupBy("rec_id", "symbol").agg(F.min("k")["kind"].alias("kind"))


def alive(symbols: DataFrame, names: DataFrame, paths: DataFrame) -> DataFrame:
    """Symbols that are an identifier, a path's part, or the beginning of an identifier. The prefix test is an equality
    join: identifiers are cut to the lengths that symbols have."""
    symbols = symbols.select("symbol").distinct()
    lengths = symbols.select(F.char_length("symbol").alias("n")).distinct()
    most = F.coalesce(symbols.agg(F.max(F.char_length("symbol"))).scalar(), F.lit(0))
    cuts = names.withColumn("_most", F.least(F.char_length("name"), most)).where("_most > 0").withColumn("n", F.explode(F.sequence(F.lit(1), F.col("_most"))))
    heads = cuts.join(lengths, "n", "left_semi").select(F.expr("substring(name, 1, n)").alias("symbol")).distinct()
    exact = names.unionByName(paths).select(F.col("name").alias("symbol")).distinct()
    return symbols.join(heads.unionByName(exact).distinct(), "symbol", "left_semi")


def longest_translation(corpus: Corpus) -> DataFrame:
    """(rec_id, longest, lang): most code points over languages and forms, the first language on ties; '.plural' marks
    a plural form."""
    said = F.when(F.col("form") == "", F.col("lang")).otherwise(F.concat("lang", F.lit(".plural")))
    best = F.min(F.struct((-F.char_length("value")).alias("n"), F.col("lang").alias("o"), said.alias("lang")))
    return corpus.translations.where("value <> ''").groupBy("rec_id").agg(best.alias("b")).select("rec_id", (-F.col("b.n")).alias("longest"), "b.lang")


def cap_violations(corpus: Corpus, tolerance: int = CAP_TOLERANCE) -> DataFrame:
    """(rec_id, cap, longest, lang, margin) where the longest translation exceeds the context's smallest cap by more."""
    caps = corpus.keys.select("rec_id", X.smallest_cap("context").alias("cap")).where("cap IS NOT NULL")
    return caps.join(longest_translation(corpus), "rec_id").withColumn("margin", F.col("longest") - F.col("cap")).where(F.col("margin") > tolerance)


def lint_context_against_code(corpus: Corpus, ios_lines: DataFrame, ios_files: DataFrame, android_lines: DataFrame, android_files: DataFrame, allow: tuple[str, ...] = ()) -> DataFrame:
    """A row a key: its sites on either platform, where it is referenced, dead citations, citations of code elsewhere than
    its call-sites, cap violation, unexplained placeholders, and whether a register is given."""
    names = key_names(corpus)
    by_name = lambda sites: sites.join(names, "name").select("rec_id", "path", "lineno", "kind")
    precise = by_name(call_sites(ios_lines, IOS_SITES))
    rest = names.join(precise.select("rec_id").distinct(), "rec_id", "left_anti")
    ios = precise.unionByName(by_name(literal_sites(ios_lines, rest).withColumn("kind", F.lit("literal"))))
    android = by_name(call_sites(android_lines, ANDROID_SITES))
    defined = _hits(android_lines.where(F.col("path").endswith(".xml")), "line", ANDROID_DEFINITION, "definition", "path").select("name").distinct()
    site = F.concat("path", F.lit(":"), F.col("lineno").cast("string"), F.lit(" ("), "kind", F.lit(")"))
    nth = F.row_number().over(Window.partitionBy("rec_id").orderBy("path", "lineno", "kind"))

    def listed(sites: DataFrame, n: int, column: str) -> DataFrame:
        first = sites.withColumn("_nth", nth).where(F.col("_nth") <= n)  # at most n a key are collected
        return first.groupBy("rec_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("_nth", site.alias("s")))), lambda x: x["s"]).alias(column))

    declared = names.join(defined, "name", "left_semi").select("rec_id").distinct().withColumn("declared", F.lit(True))
    symbols = cited_symbols(live_keys(corpus).where("context IS NOT NULL"), allow)
    file_alive = path_names(ios_files).select(F.col("name").alias("symbol"), F.lit("file").alias("kind"))
    all_names = identifiers(ios_lines).unionByName(identifiers(android_lines)).unionByName(defined).distinct()
    code_alive = alive(symbols.where("kind <> 'file'"), all_names, path_names(ios_files).unionByName(path_names(android_files)))
    living = symbols.where("kind = 'file'").join(file_alive, ["symbol", "kind"], "left_semi").unionByName(symbols.where("kind <> 'file'").join(code_alive, "symbol", "left_semi").select("rec_id", "symbol", "kind"))
    dead = symbols.join(living, ["rec_id", "symbol"], "left_anti").groupBy("rec_id").agg(F.array_sort(F.collect_set("symbol")).alias("dead_citations"))
    elsewhere = living.where("kind <> 'file'").join(precise.select("rec_id", "path").distinct(), "rec_id")
    elsewhere = elsewhere.groupBy("rec_id", "symbol").agg(F.bool_or(F.col("path").contains(F.col("symbol"))).alias("here")).where("NOT here")
    elsewhere = elsewhere.groupBy("rec_id").agg(F.array_sort(F.collect_set("symbol")).alias("surface_mismatch"))
    source = flat_text(corpus).where((F.col("lang") == SOURCE_LANG) & ~F.col("plural")).select("rec_id", F.col("text").alias("source"))
    rows = live_keys(corpus).select("rec_id", "key", "context")
    for part in (listed(ios, 8, "usage_sites"), listed(android, 6, "android_sites"), declared, dead, elsewhere, source, cap_violations(corpus).select("rec_id", "cap", "longest", "margin")):
        rows = rows.join(part, "rec_id", "left")
    on_android = F.col("android_sites").isNotNull() | F.col("declared")
    referenced = F.when(F.col("usage_sites").isNotNull() & F.col("android_sites").isNotNull(), "both").when(F.col("usage_sites").isNotNull(), "ios").when(on_android, "android").otherwise("none")
    context = F.coalesce("context", F.lit(""))
    return rows.select(
        "rec_id", "key", X.family_of("key").alias("family"), "usage_sites", "android_sites", referenced.alias("referenced"), "dead_citations", "surface_mismatch", "cap", "longest", "margin",
        (F.coalesce("source", F.lit("")).contains("[%") & ~context.rlike(r"(?i)placeholder|\[%|%@|%d|%s|%i")).alias("placeholder_unexplained"), has_register(context).alias("has_register"),
    )


def has_register(context: Column | str) -> Column:
    return (F.col(context) if isinstance(context, str) else context).rlike(r"(?mi)^\s*Register:")


def context_summary(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count("*").alias("keys"), F.count_if(F.col("referenced") == "none").alias("orphans"), F.count_if(F.size("dead_citations") > 0).alias("dead"), F.count_if(F.size("surface_mismatch") > 0).alias("mismatch"),
        F.count_if(F.col("margin").isNotNull()).alias("caps"), F.count_if("placeholder_unexplained").alias("unexplained"), F.count_if("has_register").alias("with_register"),
    )


def family_register(keys: DataFrame) -> DataFrame:
    """keys (key, context) -> members without a register in families where others have one."""
    rows = keys.select("key", X.family_of("key").alias("family"), has_register(F.coalesce("context", F.lit(""))).alias("r"))
    counts = rows.groupBy("family").agg(F.count_if("r").alias("with_register"), F.count_if(~F.col("r")).alias("without_register")).where("with_register > 0")
    return rows.where("NOT r").join(counts, "family").select("key", "family", "with_register", "without_register")


def shared_boilerplate(keys: DataFrame, least: int = 3) -> DataFrame:
    """(family, line, n, key): Surface and Constraints lines of over 25 characters that occur `least` times in a family or
    more. A row a member."""
    lines = keys.select("key", X.family_of("key").alias("family"), F.explode(F.split("context", r"\r?\n")).alias("line")).withColumn("line", X.strip("line"))
    lines = lines.where((F.col("line").startswith("Surface:") | F.col("line").startswith("Constraints:")) & (F.char_length("line") > 25))
    counts = lines.groupBy("family", "line").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return lines.join(counts, ["family", "line"]).select("family", "line", "n", "key")


# Usage scan


def pool_entries(files: DataFrame) -> DataFrame:
    """(pool, key, locale, path) of `"key" = ` in .strings files of the pools and <key> in .stringsdict ones."""
    name = F.element_at(F.split("path", "/"), -1)
    rows = files.where(name.isin(*POOLS)).select("path", name.alias("pool"), F.regexp_extract("path", r"([^/]+)\.lproj/[^/]+$", 1).alias("locale"), "text").where("locale <> ''")
    plain = rows.where(~F.col("pool").endswith("stringsdict")).select("pool", F.explode(X.matches("text", r'"((?:\\.|[^"\\])*)"\s*=', 1)).alias("raw"), "locale", "path")
    plural = rows.where(F.col("pool").endswith("stringsdict")).select("pool", F.explode(X.matches("text", r"(?s)<key>([^<]+)</key>\s*<dict>\s*<key>NSStringLocalizedFormatKey", 1)).alias("raw"), "locale", "path")
    return plain.unionByName(plural).select("pool", X.unescape_json("raw").alias("key"), "locale", "path").distinct()


def table_name(table: Column | str) -> Column:
    t = F.col(table) if isinstance(table, str) else table
    return F.when(t == "InfoPlist", "infoPlist").when(t == "Localizable", "localizable").otherwise(F.concat(F.lower(F.substring(t, 1, 1)), t.substr(F.lit(2), F.char_length(t))))


def _pool_lookup(spark, table: dict[str, tuple[str, ...]], name: str) -> DataFrame:
    return F.broadcast(spark.createDataFrame([(k, p) for k, ps in table.items() for p in ps], f"{name} string, pool string"))


def generated_accessors(lines: DataFrame, entries: DataFrame) -> DataFrame:
    """(table, accessor, pool, key) from generated code, for keys that exist."""
    parts = lines.where(F.col("line").rlike(ACCESSOR)).select(*[F.regexp_extract("line", ACCESSOR, i).alias(n) for i, n in ((1, "accessor"), (2, "raw"), (3, "t"))])
    rows = parts.select(table_name("t").alias("table"), "accessor", X.unescape_json("raw").alias("key"))
    return rows.join(_pool_lookup(lines.sparkSession, POOLS_OF_TABLE, "table"), "table").join(entries.select("pool", "key").distinct(), ["pool", "key"], "left_semi").distinct()


def ios_usage(files: DataFrame, generated: DataFrame, entries: DataFrame) -> DataFrame:
    """(pool, key, evidence): typed accessors, owners, closures in files that name the table, and literals. Commented
    code counts on purpose: it may come back."""
    typed = files.select("path", F.explode(F.arrays_zip(X.matches("text", TYPED, 1).alias("t"), X.matches("text", TYPED, 2).alias("a"))).alias("m")).select("path", F.col("m.t").alias("table"), F.col("m.a").alias("accessor"), F.lit("R.string").alias("kind"))
    owner = _hits(files, "text", OWNER, "strings", "path").select("path", F.lit("localizable").alias("table"), F.col("name").alias("accessor"), "kind")
    closure = _hits(files.where(F.col("text").contains("_R.string.localizable")), "text", CLOSURE, "closure", "path").select("path", F.lit("localizable").alias("table"), F.col("name").alias("accessor"), "kind")
    by_accessor = typed.unionByName(owner).unionByName(closure).join(generated, ["table", "accessor"]).select("pool", "key", F.concat("path", F.lit(":"), "kind", F.lit("."), "accessor").alias("evidence"))
    raw = files.select("path", F.explode(X.matches("text", LITERAL, 1)).alias("name"))
    literals = raw.unionByName(raw.select("path", X.unescape_json("name").alias("name"))).unionByName(files.select("path", F.explode(X.matches("text", XML_VALUE, 1)).alias("name")).select("path", X.strip("name").alias("name"))).where("name <> ''").distinct()
    special = F.regexp_extract("path", r"(\.[^./]+)$", 1)
    suffix = F.when(special.isin(*POOLS_OF_SUFFIX), special).otherwise("*")
    lookup = _pool_lookup(files.sparkSession, POOLS_OF_SUFFIX | {"*": ("Localizable.strings", "Localizable.stringsdict")}, "suffix")
    by_literal = literals.withColumn("suffix", suffix).join(lookup, "suffix").join(entries.select("pool", F.col("key").alias("name")).distinct(), ["pool", "name"]).select("pool", F.col("name").alias("key"), F.concat("path", F.lit(":literal")).alias("evidence"))
    return by_accessor.unionByName(by_literal).distinct()


def android_defined_keys(files: DataFrame) -> DataFrame:
    """Names of string resources in res/values* XML files."""
    xml = files.where(F.col("path").endswith(".xml") & F.col("path").rlike(r"(^|/)res/values[^/]*/"))
    tag = r'<(?:string|plurals|array|string-array)\b[^>]*?\bname="([^"]+)"'
    item = r'<item\b(?=[^>]*\btype="(?:string|plurals|array|string-array)")[^>]*?\bname="([^"]+)"'
    return _hits(xml, "text", tag, "d").unionByName(_hits(xml, "text", item, "d")).select("name").distinct()


def _android_references(files: DataFrame) -> DataFrame:
    """(path, name, kind, field): every reference of a file, told in one pass over the files; `field` marks a name that may be an
    R field, in which other characters than letters and digits are underscores."""
    xml, code = F.col("path").endswith(".xml"), ~F.col("path").endswith(".xml")
    said = lambda names, kind, field: F.transform(names, lambda n: F.struct(n.alias("name"), F.lit(kind).alias("kind"), F.lit(field).alias("field")))
    none = F.array().cast("array<struct<name:string,kind:string,field:boolean>>")
    aliases = F.transform(X.matches("text", CLASS_IMPORT, 1), lambda a: F.when(F.coalesce(a, F.lit("")) == "", "string").otherwise(a))
    member = r"\b([A-Za-z_][A-Za-z0-9_]*)\s*\.\s*([A-Za-z_][A-Za-z0-9_]*)\b"
    members = F.arrays_zip(X.matches("text", member, 1).alias("o"), X.matches("text", member, 2).alias("f"))
    of_alias = F.get(F.transform(F.array(aliases), lambda z: F.filter(members, lambda m: F.array_contains(z, m["o"]))), F.lit(0))  # the aliases of a file are looked up once
    dotted = F.transform(of_alias, lambda m: F.struct(m["f"].alias("name"), m["o"].alias("kind"), F.lit(True).alias("field")))
    found = F.concat(
        F.when(xml, said(X.matches("text", RESOURCE, 1), "@resource", False)).otherwise(none),
        *[F.when(code, said(X.matches("text", p, 1), "dynamic-string", False)).otherwise(none) for p in DYNAMIC],
        F.when(code, F.concat(said(X.matches("text", STATIC_IMPORT, 1), "import", True), said(X.matches("text", R_FIELD, 1), "R.string", True))).otherwise(none),
        F.when(code & F.col("text").rlike(CLASS_IMPORT), dotted).otherwise(none),
    )
    # outer, as Spark would search each file once more to leave out files without a reference before the explode
    rows = files.where("path IS NOT NULL").select("path", F.explode_outer(found).alias("r")).where("r IS NOT NULL")
    name = F.when(F.col("r.kind") == "dynamic-string", X.unescape_json("r.name")).otherwise(F.col("r.name"))
    return rows.select("path", name.alias("name"), "r.kind", "r.field").distinct()


def android_usage(files: DataFrame) -> DataFrame:
    """(key, evidence): resource references, R fields, imports with their aliases, and names in code. A field that is no
    defined name stands for the names that are written so. References meet the names in one shuffled join: how many there
    are can't be told from the size of the files, so no side may be sent to all executors on a guess."""
    defined = android_defined_keys(files)
    written = defined.select(X.android_field("name").alias("name"), F.col("name").alias("key"), F.lit(False).alias("exact"))
    other = written.join(defined.hint("merge"), "name", "left_anti")
    names = defined.select("name", F.col("name").alias("key"), F.lit(True).alias("exact")).unionByName(other)
    found = _android_references(files).join(names.hint("merge"), "name").where("exact OR field")
    return found.select("key", F.concat("path", F.lit(":"), "kind").alias("evidence")).distinct()


def unused_keys(defined: DataFrame, used: DataFrame, dynamic: list[str] = ()) -> DataFrame:
    """Defined names that nothing uses, in case-insensitive order; names put together at run time count as used."""
    rows = defined.select("name").distinct().join(used.select(F.col("key").alias("name")).distinct().hint("merge"), "name", "left_anti")  # of unknown size
    return (rows.where(~F.col("name").isin(*dynamic)) if dynamic else rows).orderBy(F.lower("name"), "name")


def pool_status(entries: DataFrame, used: DataFrame, dynamic: list[str] = ()) -> DataFrame:
    """(key, pools, unused_pools, status): all_unused, all_used or mixed over a key's pools; only all_unused is safe."""
    rows = entries.select("pool", "key").distinct().join(used.select("pool", "key", F.lit(True).alias("u")).distinct(), ["pool", "key"], "left")
    free = F.col("u").isNull() & ~F.col("key").isin(*dynamic) if dynamic else F.col("u").isNull()
    rows = rows.withColumn("free", free)
    status = F.when(F.bool_and("free"), "all_unused").when(F.bool_or("free"), "mixed").otherwise("all_used")
    return rows.groupBy("key").agg(F.array_sort(F.collect_set("pool")).alias("pools"), F.array_sort(F.collect_set(F.when(F.col("free"), F.col("pool")))).alias("unused_pools"), status.alias("status"))


def pool_counts(entries: DataFrame, used: DataFrame) -> DataFrame:
    """Entries and unused entries by pool, and over all (null)."""
    rows = entries.select("pool", "key").distinct().join(used.select("pool", "key", F.lit(True).alias("u")).distinct(), ["pool", "key"], "left")
    return rows.rollup("pool").agg(F.count("*").alias("entries"), F.count_if(F.col("u").isNull()).alias("unused"))

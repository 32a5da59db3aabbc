"""Expressions against plain Python, over hand-written and generated strings."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from lingspan.functions import text as X

HOSTILE = ["", " ", "a", "\u2014", "x \u2014 y", "\u00a0", "a\u202fb", "z\u200b", "\ufeff", ":) (", "a)", "(ok)", " lead", "trail ", "  two", "50% off", "%s", "%%", "%", "[%s] [%1$s]", "[%]", "%1$#@n\u00e9@ %2$d",
           "https://x.com.", "see https://x.com/a?b=1), ok", "Привет", "от Алекса смайл это", '"никогда не появляется"', "никогда не появляется", "\x1cx", "x\x85", "\u3000\u2028", "🙂🙂"]


def generated(n=300):
    r = random.Random(7)
    pieces = [*HOSTILE, "[%i]", "%d", "%1$@", "  ", "(", ")", ";)", "x", "ж", "\n", "https://e.org/"]
    return ["".join(r.choice(pieces) for _ in range(r.randint(0, 6))) for _ in range(n)]


def values(spark, column):
    texts = HOSTILE + generated()
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    got = {r["i"]: r["x"] for r in rows.select("i", column.alias("x")).collect()}
    return [(t, got[i]) for i, t in enumerate(texts)]


def test_strip_is_unicode(spark):
    assert all(got == t.strip() for t, got in values(spark, X.strip("v")))


def test_invisible_spaces(spark):
    found = re.compile("[\u00a0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")
    for t, got in values(spark, X.invisible_spaces("v")):
        assert got == list(dict.fromkeys(found.findall(t)))


def test_paren_balance(spark):
    opens, closes = X.parens("v")
    for t, got in values(spark, F.array(opens, closes)):
        bare = re.sub(r"[:;=]['\-^]?[()]", "", t)
        assert got == [bare.count("("), bare.count(")")]


def test_edges_and_gaps(spark):
    for t, got in values(spark, X.edge_side("v")):
        assert got == (None if t == t.strip() or not t.strip() else "leading" if t[:1].isspace() else "trailing")
    for t, got in values(spark, X.longest_gap("v")):
        assert got == max(map(len, re.findall(" {2,}", t)), default=None)


def test_placeholders(spark):
    for t, got in values(spark, X.placeholder_types("v")):
        assert got == sorted(re.sub(r"[\[\]%\d$.\-+# ]", "", x) or "?" for x in re.findall(r"\[%[^\]]*\]", t))
    form = re.compile(X.FORMAT)
    for t, got in values(spark, X.placeholder_signature("v")):
        rest = re.sub(r"%\d*\$?#@\w+@", "", re.sub(r"\[%[^\]]*\]", "", t))
        assert got == sorted([re.sub(r"^\[%\d+\$", "[%", x) for x in re.findall(r"\[%[^\]]*\]", t)] + [re.sub(r"^%\d+\$", "%", m[0]) for m in form.finditer(rest)])


def test_urls(spark):
    for t, got in values(spark, X.urls("v")):
        assert got == sorted(u.rstrip(".,;:!?)]}'\"") for u in re.findall(r"https?://[^\s\"<>]+", t))


def test_cyrillic_phrase(spark):
    phrase = re.compile("[Ѐ-ԯ]+(?:[ \t]+[Ѐ-ԯ]+)+")
    for t, got in values(spark, X.has_loose_cyrillic_phrase("v")):
        want = any(sum(map(len, m[0].split())) >= 10 and not (m.start() and t[m.start() - 1] in X.QUOTES) for m in phrase.finditer(t))
        assert got == want, t


def test_snippet_counts_code_points(spark):
    got = spark.createDataFrame([("🙂" * 71,), ("a" * 70,)], "v string").select(X.snippet("v")).collect()
    assert [r[0] for r in got] == ["🙂" * 70 + "…", "a" * 70]


def test_plural_and_names(spark):
    rows = spark.createDataFrame([('{"one":"a","other":"b","odd":"c"}',), ("plain",), ("{bad",)], "v string").select(X.plural_value("v")).collect()
    assert [r[0] for r in rows] == [{"one": "a", "other": "b"}, {"other": "plain"}, {"other": "{bad"}]
    rows = spark.createDataFrame([({"ios": "a", "web": "a"},), ({"ios": "a", "web": "b"},)], "m map<string,string>")
    assert [tuple(r) for r in rows.select(X.collapse_key_name(F.col("m")), X.display_key(F.lit(None).cast("string"), "m")).collect()] == [("a", "ios=a, web=a"), (None, "ios=a, web=b")]


def test_context_fields(spark):
    context = "Surface: a\nConstraints:  \nPlaceholders:\n  [%s] name\nRegister: x"
    row = spark.createDataFrame([(context,)], "c string").select(*[X.context_body("c", f) for f in ("Surface", "Constraints", "Placeholders", "Tone")]).first()
    assert row[0].strip() == "a" and row[1].strip() == "" and "[%s]" in row[2] and row[3] is None


def test_family_caps_folding(spark):
    row = spark.createDataFrame([("text1_2M", "at most 60 chars or 55 characters", "STRA\u00dfE \ufb01")], "k string, c string, t string").select(X.family_of("k"), X.smallest_cap("c"), X.casefold("t")).first()
    assert tuple(row) == ("text1", 55, "strasse fi")
